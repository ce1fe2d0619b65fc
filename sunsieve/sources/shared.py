"""Where intermediate tables may lie: a folder every executor can reach."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sunsieve.errors import LoadError


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's checkpoint folder.

    Only a local session, where driver and executors are one, may do without one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise LoadError("set spark.checkpoint.dir to a folder all executors reach")
        root = tempfile.mkdtemp(prefix="sunsieve-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _listed(spark: SparkSession, folder: str) -> list:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return list(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where))


def file_sizes(spark: SparkSession, folder: str, suffix: str = ".parquet") -> dict[str, int]:
    """Names and sizes of the data files in a folder, by listing it; no job runs."""
    found = {f.getPath().getName(): f.getLen() for f in _listed(spark, folder) if f.isFile()}
    return {name: size for name, size in found.items() if name.endswith(suffix)}


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one, wherever that lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: What is landed at the moment is noted in the last of these lists; what is to be kept, in the one before.
_landings: ContextVar[tuple[list[str], ...]] = ContextVar("landings", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Paths landed inside; those that the list holds at the end are removed.

    What is landed to be kept falls to the surrounding `scratch`, if there is one. Frames that
    still read what is removed must be written before the end.
    """
    mine: list[str] = []
    outer = _landings.set((*_landings.get(), mine))
    try:
        yield mine
    finally:
        _landings.reset(outer)
        for path in mine:
            removed(spark, path)


def landed(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The frame, written once to the shared folder and read from there.

    Later passes then read columns of Parquet, whatever the frame came from, and a
    lost executor costs a re-read, not the work before. Inside `scratch` it is removed
    at the end unless it is to be kept.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    noted = _landings.get()[:-1] if keep else _landings.get()
    if noted:
        noted[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
