"""The operators as registered queries, over whole tables, and their SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.llm.archives import planned, read_packages, write_packages
from sunsieve.llm.bond import hard_negatives
from sunsieve.llm.byte_bpe import encode_documents
from sunsieve.llm.common import table
from sunsieve.llm.divergence import features, judged, references
from sunsieve.llm.hypergeometric import shuffle_into_shards
from sunsieve.llm.mixing import mix
from sunsieve.llm.multi_index import neighbours
from sunsieve.llm.ngram_join import near_duplicates
from sunsieve.llm.packing import pack_documents
from sunsieve.llm.permuterm import spelling_groups
from sunsieve.llm.perspectives import rotate
from sunsieve.llm.secret_scan import KINDS, find_secrets, spelled, train_on
from sunsieve.llm.separators import count_tokens
from sunsieve.llm.sql import archives_sql, divergence_sql, negatives_sql, perspectives_sql
from sunsieve.llm.tokenizer import vocabulary
from sunsieve.sources.shared import landed, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The first id that the byte vocabulary leaves free.
END_OF_DOCUMENT = 50256
WORD_VOCABULARY = "word_bpe_49k.json"


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs, vocabulary(BYTE_VOCABULARY), END_OF_DOCUMENT)


def op2_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, train_on(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("secrets")).alias("spans")
    )


def op5_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    written = write_packages(planned(table(spark, sf_dir, "pages")), folder)
    found = read_packages(written, folder)
    whole = F.col("record_type") == "response"
    return found.select(
        "page_id",
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op6_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(text, F.lit("")))
    small = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"))
    return shuffle_into_shards(small, 8).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = encode_documents(docs, vocabulary(BYTE_VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counted once and written: the references and the verdicts both read the counts, not the texts.
    counted = landed(features(table(spark, sf_dir, "documents"), ["doc_id"]), "counted")
    return judged(counted, references(counted)).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.round("char_distance", 6).alias("char_distance"),
        F.round("word_distance", 6).alias("word_distance"),
        "kept",
    )


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op13_permuterm_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_groups(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Query]:
    return {
        "op1_separator_scan": op1_separator_scan,
        "op2_inverted_multi_index": op2_inverted_multi_index,
        "op3_perspective_rotation": op3_perspective_rotation,
        "op4_markov_secrets": op4_markov_secrets,
        "op5_zip_archives": op5_zip_archives,
        "op6_hypergeometric_shards": op6_hypergeometric_shards,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_hierarchical_packing": op8_hierarchical_packing,
        "op9_ngram_join": op9_ngram_join,
        "op10_distribution_divergence": op10_distribution_divergence,
        "op11_bond_negatives": op11_bond_negatives,
        "op12_entropy_mixing": op12_entropy_mixing,
        "op13_permuterm_spellings": op13_permuterm_spellings,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_perspective_rotation": perspectives_sql(),
        "op5_zip_archives": archives_sql(),
        "op10_distribution_divergence": divergence_sql(),
        "op11_bond_negatives": negatives_sql(),
    }
