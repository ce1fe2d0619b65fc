"""The data files of a table, and what their footers say of its columns."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

#: Files whose footers one task reads.
FILES_PER_TASK = 256


def data_files(spark: SparkSession, table: str, partition: StructField) -> DataFrame:
    """(path, length, partition) of the table's Parquet files; no file is opened.

    Spark lists the folders, on executors where they are many, and a filter on the partition
    leaves out others before their files are planned.
    """
    shape = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType())])
    shape = shape.add("length", LongType()).add("content", BinaryType()).add(partition)
    found = spark.read.schema(shape).format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    return found.select("path", "length", partition.name)


def with_chunk_bytes(files: DataFrame, columns: Sequence[str], partition: str) -> DataFrame:
    """The files with `bytes`, the compressed size of the columns' chunks; partition columns have none.

    A task reads the footers of its files and no data; one row per file comes of it.
    """
    wanted = set(columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch.column("path").to_pylist():
                store, where = fs.FileSystem.from_uri(path)
                with store.open_input_file(where) as file:
                    meta = pq.read_metadata(file)
                groups = (meta.row_group(g) for g in range(meta.num_row_groups))
                chunks = (group.column(k) for group in groups for k in range(group.num_columns))
                sizes.append(sum(c.total_compressed_size for c in chunks if c.path_in_schema.split(".")[0] in wanted))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "bytes"])

    kind = files.schema[partition].dataType.simpleString()
    # Files come as they are listed, many to a task: dealt anew, so that footers are read side by side.
    dealt = files.repartition(F.pmod(F.xxhash64("path"), F.lit(FILES_PER_TASK)))
    return dealt.mapInArrow(read, f"path string, length long, {partition} {kind}, bytes long")
