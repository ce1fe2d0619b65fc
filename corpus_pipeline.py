"""From raw documents to packed training sequences: quality rules, near duplicates, secrets, packing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.llm.common import maybe_broadcast, table, workers_find_us
from sunsieve.llm.divergence import features, judged, references
from sunsieve.llm.ngram_join import near_duplicates
from sunsieve.llm.packing import pack_documents
from sunsieve.llm.queries import WORD_VOCABULARY
from sunsieve.llm.secret_scan import find_secrets, train_on
from sunsieve.llm.tokenizer import vocabulary
from sunsieve.sources.shared import landed, scratch


def _free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor lie far from their language stay as they are.

    A null text has no words and goes; repeated rows stay or go together; an empty table stays
    empty, and columns of any other name are handed on.
    """
    known = references(landed(features(docs, ["doc_id"]), "counted"))
    return judged(features(docs), known).where("kept").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays, once.

    Rows are named by a place that is written with them, so that null and repeated ids do no harm
    and every pass names them alike, however Spark cuts the files. Null and empty texts are nobody's
    duplicates, an empty table stays empty, and columns of any other name are handed on.
    """
    workers_find_us(spark)
    at = _free_name(docs, "at")
    with scratch(spark):
        placed = landed(docs.withColumn(at, F.monotonically_increasing_id()), "placed", keep=True)
        found = near_duplicates(placed.select(F.col(at).alias("doc_id"), "text"))
        ids = placed.select(F.col(at).alias("at"), F.col("doc_id").cast("long").alias("doc_id"))
        found = found.select(F.col("doc_id").alias("at"), F.col("component_id").alias("component")).join(ids, "at")
        found = landed(found, "classes")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))["at"]
        stays = found.groupBy("component").agg(first.alias("stays")).where("component IS NOT NULL")
        goes = landed(found.join(stays, "component").where("at <> stays").select(F.col("at").alias(at)), "goes", keep=True)
        return placed.join(maybe_broadcast(goes, goes.count()), at, "left_anti").select(docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; in their texts each secret is replaced by its kind, and n_chars follows.

    Null texts stay null and empty ones empty, repeated rows are treated alike, an empty table
    stays empty, and columns of any other name are handed on.
    """
    workers_find_us(spark)
    found = find_secrets(docs, train_on(docs))
    text, n_chars = F.col("redacted"), F.col("n_chars")
    n_chars = F.when(F.size("secrets") > 0, F.length(text).cast("long")).otherwise(n_chars)
    return found.withColumns({"n_chars": n_chars, "text": text}).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of several lengths, a row per piece of a document.

    A null or empty text is one end token, repeated rows are packed each for themselves, an empty
    table gives no rows, and columns other than doc_id and text are not read.
    """
    workers_find_us(spark)
    return pack_documents(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicate_groups),
    ("secret scans", secret_scans),
    ("packing", packing),
]

#: Hashes, models and tokenizers are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again by the next.

    What was written is removed when it has been read, but for what the last stage reads.
    """
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as written:
        for name, stage in STAGES[:-1]:
            docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        written.pop()
    return STAGES[-1][1](spark, docs, sf_dir)
