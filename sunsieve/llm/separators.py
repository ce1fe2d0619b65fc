"""Token counts from flat token files that have no index: a scan for end-of-document ids.

A file is a run of little-endian token ids, documents following each other, each closed by an
end-of-document id. Blocks of a file are scanned independently, with one vectorised comparison;
a prefix scan over one summary row per block then stitches the documents that cross blocks.
"""

import functools

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, open_store, runs, text_of
from sunsieve.llm.tokenizer import read_ranks
from sunsieve.sources.shared import landed, shared_folder

#: Tokens of a block: what a task holds at once.
BLOCK_TOKENS = 1 << 20
#: Blocks that a task scans one after the other.
TASK_BLOCKS = 8


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(
        "documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Write the documents as flat token files into `folder`, one per task; (doc_id, file, doc_no), landed.

    A null or empty text is its end id alone. Files carry the attempt's number and only those of
    attempts that succeeded are named in the result, so a task that runs again does no harm.
    """

    def step(batches: Batches) -> Batches:
        own, task = _encoding(vocabulary), TaskContext.get()
        name = f"part-{task.partitionId():06d}"
        store, at = open_store(folder)
        store.create_dir(at, recursive=True)
        path, n = f"{name}-{task.taskAttemptId()}.tokens", 0
        with store.open_output_stream(f"{at}/{path}") as out:
            for batch in batches:
                for run in runs(batch, "text"):
                    ids = own.encode_ordinary_batch(run.column("text").to_pylist(), num_threads=1)
                    for x in ids:
                        x.append(end_id)
                        out.write(np.array(x, dtype=dtype).tobytes())
                    k = len(ids)
                    columns = [run.column("doc_id"), pa.array([path] * k), pa.array(np.arange(n, n + k))]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "doc_no"])
                    n += k

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return landed(rows.mapInArrow(step, "doc_id long, file string, doc_no long"), "tokenized")


def scan_blocks(files: DataFrame, folder: str, end_ids: list[int], dtype: str, block_tokens: int) -> DataFrame:
    """A row per block of each file: file, block, n_tokens, and the places of separators in the file."""
    width = np.dtype(dtype).itemsize

    def cut(batches: Batches) -> Batches:
        store, at = open_store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                n = store.get_file_info(f"{at}/{name}").size // width
                k = max(1, -(-n // block_tokens))
                columns = [pa.array([name] * k), pa.array(np.arange(k)), pa.array([n] * k, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "file_tokens"])

    def scan(batches: Batches) -> Batches:
        store, at = open_store(folder)
        for batch in batches:
            for name, block, n in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "file_tokens"))):
                start = block * block_tokens
                size = min(block_tokens, n - start)
                with store.open_input_file(f"{at}/{name}") as file:
                    file.seek(start * width)
                    ids = np.frombuffer(file.read(size * width), dtype=dtype)
                places = np.flatnonzero(np.isin(ids, end_ids)) + start
                columns = [[name], [block], [size], [places]]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "n_tokens", "places"]
                )

    blocks = files.select("file").distinct().mapInArrow(cut, "file string, block long, file_tokens long")
    # By number: rows this small would otherwise be put into one task, with all the bytes they stand for.
    blocks = landed(blocks, "ranges")
    blocks = blocks.repartition(1 + blocks.count() // TASK_BLOCKS, "file", "block")
    return blocks.mapInArrow(scan, "file string, block long, n_tokens long, places array<long>")


def separator_scan(
    files: DataFrame, folder: str, end_ids: list[int], dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Documents of flat token files: file, doc_no, start, n_tokens, closed.

    `files` holds the names (`file`) below `folder`; repeated names count once. `n_tokens` leaves
    the separator out. Tokens behind a file's last separator are a document that is not closed; a
    file without tokens has no document, and two separators in a row enclose an empty one.
    """
    blocks = landed(scan_blocks(files, folder, end_ids, dtype, block_tokens), "blocks")
    # One row per block: how many separators came before it, and where the last of them was.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("places") > 0, F.element_at("places", -1))
    summary = blocks.select("file", "block", F.size("places").alias("n_ends"), last.alias("last_end"))
    carried = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.last("last_end", ignorenulls=True).over(before), F.lit(-1)).alias("end_before"),
    )
    ends = blocks.join(carried, ["file", "block"]).select(
        "file", "docs_before", "end_before", "places", F.posexplode("places").alias("k", "end")
    )
    start = F.when(F.col("k") == 0, F.col("end_before")).otherwise(F.expr("places[k - 1]")) + 1
    closed = ends.select("file", (F.col("docs_before") + F.col("k")).alias("doc_no"), start.alias("start"), "end").select(
        "file", "doc_no", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed")
    )
    totals = blocks.groupBy("file").agg(
        F.sum("n_tokens").alias("total"), F.sum(F.size("places").cast("long")).alias("doc_no"), F.max(last).alias("last_end")
    )
    begin = F.coalesce(F.col("last_end"), F.lit(-1)) + 1
    opened = totals.where(F.col("total") > begin).select(
        "file", "doc_no", begin.alias("start"), (F.col("total") - begin).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(opened)


def count_tokens(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, file, doc_no, start and n_tokens of every document, counted from its token file."""
    folder = shared_folder(docs.sparkSession, "tokens")
    written = write_token_files(docs, folder, vocabulary, end_id)
    found = separator_scan(written, folder, [end_id])
    named = written.join(found, ["file", "doc_no"])
    return named.select("doc_id", F.substring_index("file", "-", 2).alias("file"), "doc_no", "start", "n_tokens")
