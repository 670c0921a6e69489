"""Documents to training tokens, in stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.bpe import encode_documents
from stratum.llm.common import bounded, stored
from stratum.llm.decontaminate import decontaminate
from stratum.llm.near_dedup import near_duplicates
from stratum.llm.pii import pseudonymise
from stratum.llm.queries import PSEUDONYM_KEY, toxicity_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject.

    Null and empty texts score like texts without matches; repeated rows are judged alike and all stay or
    go; an empty table stays empty. The input's columns stay whole, whatever their names.
    """
    return toxicity_rows(spark, docs, sf_dir).filter("__predicted = 0").select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (its smallest id), and one row of each id; rows without an id stay."""
    judged = stored(near_duplicates(docs).select("doc_id", "kept"), "judged")
    gone = bounded(stored(judged.filter("not kept").select("doc_id").distinct(), "gone"))
    repeated = bounded(stored(judged.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated"))
    left = docs.join(gone, "doc_id", "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    again = left.join(repeated, "doc_id", "left_semi").withColumn("__row", first).filter("__row = 1").drop("__row")
    return left.join(repeated, "doc_id", "left_anti").unionByName(again).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts hold none and stay; rows repeating an id are judged by their own text; without
    benchmark items, or without documents, nothing goes. A column named `__key` is not supported.
    """
    keyed = docs.withColumn("__key", F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash")))
    judged = decontaminate(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="__key")
    gone = bounded(stored(judged.filter("contaminated").select(F.col("__key").alias("__gone")).distinct(), "contaminated"))
    return keyed.join(gone, F.col("__key").eqNullSafe(F.col("__gone")), "left_anti").select(docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; n_chars follows the text.

    Null texts stay null, empty ones empty; every row stays, repeated ones with equal pseudonyms. Other columns are untouched.
    """
    made = pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("__n_pseudonyms") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return made.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes.

    Null and empty texts have no tokens; rows are independent, so repeated ones give repeated rows.
    """
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, out="digests")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("pii", hide_personal_data), ("byte_bpe", tokens)]

# Learned scores and a tokenizer's merges are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
