"""Raw documents to packed training windows, in five stages that each read what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import line_dedup, packing, simhash, substrings, toxicity
from tablemill.llm.common import written


def _with_text(row: str, kept: str, columns: list[str]) -> list:
    """The columns of the struct ``row`` with the text and its length replaced."""
    new = {"text": F.col(kept), "n_chars": F.length(kept).cast("bigint")}
    return [(new[c] if c in new else F.col(row)[c]).alias(c) for c in columns]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go. Null and blank texts say nothing toxic and stay, whatever
    the labels are like; rows that repeat stay or go together; an empty table stays empty."""
    labels = toxicity.grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, toxicity.fitted(spark, docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, up to one edit, go; every document stays, if need be without text. Null texts
    stay null, rows that repeat id and text are one document and come out alike, an empty table stays empty."""
    rows = line_dedup.without_repeated_lines(docs)
    return rows.select(*_with_text("row", "kept", docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints the one with the smallest id stays, null ids last, one of
    rows that repeat; null, empty and blank texts are copies of one another; an empty table stays empty. Rows are
    numbered in a written table, whole in one column, so that repeated ids and columns of any name do no harm."""
    whole = docs.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row"))
    numbered = written(spark, whole, "numbered")
    groups = simhash.near_duplicates(spark, numbered.select(F.col("n").alias("doc_id"), "row.text"))
    members = numbered.select("n", F.col("row.doc_id").alias("id")).join(
        groups.select(F.col("doc_id").alias("n"), "component_id"), "n"
    )
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "n"))
    stays = members.groupBy("component_id").agg(best.alias("best")).select("best.n")
    return numbered.join(stays, "n", "left_semi").select("row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that occur anywhere else go, also from all rows that repeat; every document stays. Texts without
    such words keep their white space, null texts stay null, an empty table stays empty."""
    rows = substrings.without_repeats(spark, docs)
    rows = rows.withColumn("kept", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")))
    return rows.select(*_with_text("row", "kept", docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in windows of 4096 tokens, with their ids. Null texts are empty and give the end id, rows
    that repeat are packed each, an empty table gives no rows."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: Fitted weights, component labels and token ids are out of SQL's reach. Tests hold the operators against brute force,
#: and the stages to their schema and to the documents they may keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. Each one's rows are written to the shared folder and read again by the next."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = written(spark, stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
