"""The corpus pipeline: toxicity, near-duplicates, repeated substrings, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``. Every stage judges rows, not
doc_ids: rows that share a doc_id stand for themselves, and rows of null doc_id come after all others.
Null texts count as empty and stay null; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import minhash, packing, suffix_array_dedup, toxicity
from marquee.llm.bpe import default_path
from marquee.llm.common import materialize, with_row_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps rows that the classifier doesn't flag by their text; it learns from the labels of these documents."""
    return toxicity.without_toxic(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each near-duplicate group: runs of five words, similarity 0.8.

    Texts without words are in no group: all of them stay. Of rows that share a doc_id, those whose texts differ stay.
    """
    keyed = with_row_key(docs.select(*COLUMNS))
    groups = minhash.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text"), shingle=5, least=80)
    return keyed.join(groups.where("not kept").select(F.col("doc_id").alias("row_key")), "row_key", "left_anti").select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes 50-byte strings that an earlier row holds (by doc_id); characters stay whole. Emptied documents stay, empty; n_chars follows the text."""
    keyed = with_row_key(docs.select(*COLUMNS))
    rest = F.struct(F.col("doc_id").alias("id"), "lang", "source", "n_chars", F.when(F.col("text").isNull(), True).alias("none"))
    out = suffix_array_dedup.remove_repeated_bytes(keyed.select(F.col("row_key").alias("doc_id"), "text", rest.alias("rest")), whole_characters=True, carry=F.col("rest"))
    text = F.when(F.col("carry.none").isNull(), F.decode("kept", "UTF-8"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("carry.n_chars"))
    return out.withColumn("text", text).select(F.col("carry.id").alias("doc_id"), "text", "carry.lang", "carry.source", n_chars.alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens: one row per piece. Null and empty texts are one token."""
    return packing.pack(docs, default_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", keep_one_of_each_group),
    ("suffix_array_dedup", remove_repeated_passages),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
