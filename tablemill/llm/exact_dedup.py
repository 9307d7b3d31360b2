"""Equal texts over deliveries of documents, by digests screened with static filters and proven by their bytes.

Each delivery but the last becomes an immutable snapshot: its different texts in a table bucketed by digest, and binary
fuse filters of their digests, one per shard of a bounded number of keys. The digests of a later delivery are grouped
by themselves, each once, and asked of the filters of every snapshot. Only those that a filter may hold join the
snapshot's buckets, where the texts are compared byte by byte; a snapshot's texts are never shuffled again. All texts
of a delivery that share a digest are compared byte by byte, too. Should a digest ever stand for two texts, all is done
again with the texts themselves as digests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import binary_fuse
from tablemill.llm.common import shuffle_partitions, written
from tablemill.session import shared_dir

#: A filter has about so many keys, and about so many keys are asked of it in one task.
SHARD_KEYS = 1 << 16

FILTER_SCHEMA = "shard int, seed bigint, segment bigint, segments bigint, values binary"


class Snapshot(NamedTuple):
    table: str  # bucketed by digest: digest, text, n_texts
    filters: DataFrame
    shards: int


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def take_snapshot(spark: SparkSession, texts: DataFrame) -> Snapshot:
    """Writes a delivery's different texts (``digest, text, ...``) in buckets and builds the filters of the digests."""
    table = f"tablemill_snapshot_{uuid.uuid4().hex}"
    bucketed = texts.write.bucketBy(shuffle_partitions(spark), "digest").sortBy("digest")
    bucketed.option("path", shared_dir(spark, "snapshot")).saveAsTable(table)
    held = spark.table(table)
    shards = max(1, -(-held.count() // SHARD_KEYS))
    keys = held.select(_shard(shards).alias("shard"), F.xxhash64("digest").alias("key"))

    def one_filter(group: pa.Table) -> pa.Table:
        made = binary_fuse.build(group.column("key").to_numpy().view(np.uint64))
        row = [[group.column("shard")[0].as_py()], *([value] for value in made)]
        return pa.table([pa.array(v, t) for v, t in zip(row, (pa.int32(), *[pa.int64()] * 3, pa.binary()))], names=names)

    names = [f.split()[0] for f in FILTER_SCHEMA.split(", ")]
    return Snapshot(table, written(spark, keys.groupBy("shard").applyInArrow(one_filter, FILTER_SCHEMA), "filters"), shards)


def screened(spark: SparkSession, digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of ``digests`` (``digest``, each once) that the snapshot's filters may hold. Where there are many more
    than the snapshot has, a shard's are dealt to several tasks, each with a copy of the filter."""
    copies = max(1, -(-digests.count() // (SHARD_KEYS * snapshot.shards)))
    key = F.xxhash64("digest")
    asked = digests.select("digest", key.alias("key"), _shard(snapshot.shards).alias("shard"))
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(copies)).cast("int"))
    filters = snapshot.filters.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    def ask(rows: pa.Table, made: pa.Table) -> pa.Table:
        if not len(rows) or not len(made):
            return rows.select(["digest"]).slice(0, 0)
        one = made.slice(0, 1).to_pylist()[0]
        fuse = binary_fuse.FuseFilter(one["seed"], one["segment"], one["segments"], one["values"])
        held = fuse.may_hold(rows.column("key").to_numpy().view(np.uint64))
        return rows.select(["digest"]).filter(pa.array(held))

    grouped = asked.groupBy("shard", "copy").cogroup(filters.groupBy("shard", "copy"))
    return grouped.applyInArrow(ask, "digest binary")


def _different_texts(rows: DataFrame) -> DataFrame:
    """``digest, text`` and ``n_texts``, which is above 1 where a digest stands for several texts.

    Tasks combine copies before they hand them on. A digest's set of texts has one element, so it is no larger than the
    text."""
    texts = rows.groupBy("digest").agg(F.collect_set("text").alias("texts"))
    return texts.select("digest", F.element_at("texts", 1).alias("text"), F.size("texts").alias("n_texts"))


def _matched(spark: SparkSession, rows: DataFrame, own: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """``digest, n_texts, same`` of a delivery: ``same`` is true if a snapshot has the text, null if none has the
    digest, false if one has the digest for other bytes. Deals the delivery's texts out once, into the buckets."""
    texts, same = _different_texts(rows), []
    for i, snapshot in enumerate(snapshots):
        positive = screened(spark, own.select("digest"), snapshot).withColumn(f"_p{i}", F.lit(True))
        held = spark.table(snapshot.table).select(F.col("digest").alias("_held"), F.col("text").alias(f"_t{i}"))
        texts = texts.join(positive, "digest", "left")
        texts = texts.join(held, F.col(f"_p{i}") & (F.col("digest") == F.col("_held")), "left").drop("_held")
        same.append(F.col("text") == F.col(f"_t{i}"))
    return written(spark, texts.select("digest", "n_texts", F.coalesce(*same).alias("same")), "matched")


def _groups(spark: SparkSession, deliveries: list[DataFrame]) -> DataFrame | None:
    """``digest, n, keep_id`` of all different texts; none if a digest stands for two texts."""
    snapshots: list[Snapshot] = []
    groups = None
    for number, rows in enumerate(deliveries):
        counted = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
        own = written(spark, counted, "delivered")
        if number == 0:
            groups = new = own
        else:
            matched = _matched(spark, rows, own, snapshots)
            if not matched.where("n_texts > 1 OR NOT same").isEmpty():
                return None
            known = matched.where("same").select("digest")
            new = written(spark, own.join(known, "digest", "left_anti"), "new")
            again = own.join(known, "digest", "left_semi").toDF("digest", "_n", "_keep")
            groups = groups.join(again, "digest", "left").select(
                "digest",
                (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"),
                F.greatest("keep_id", "_keep").alias("keep_id"),
            )
            groups = written(spark, groups.union(new), "groups")
        if number < len(deliveries) - 1 or number == 0:
            added = rows if number == 0 else rows.join(new.select("digest"), "digest", "left_semi")
            snapshots.append(take_snapshot(spark, _different_texts(added)))
            if not spark.table(snapshots[-1].table).where("n_texts > 1").isEmpty():
                return None
    return groups


def judge_copies(
    spark: SparkSession,
    deliveries: list[DataFrame],
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of all deliveries: ``doc_id, digest, keep_id, group_size, kept``.

    Texts are equal when they are identical; a null text is as an empty one. Of equal texts of all deliveries the
    largest id (``keep_id``) stays; null ids stay only where all are null. Rows that repeat id and text are one
    document and have the same ``kept``. Texts of any length are compared whole. Other columns are not looked at. Empty
    tables give no rows.
    """
    def rows(made):
        text = F.coalesce(F.col(text_column), F.lit(""))
        return [
            d.select(F.col(id_column).alias("doc_id"), made(text).alias("digest"), text.alias("text")) for d in deliveries
        ]

    def whole(text):
        return text.cast("binary")

    for made in (digest, whole):
        delivered = rows(made)
        groups = _groups(spark, delivered)
        if groups is not None:
            break
    keys = delivered[0].select("doc_id", "digest")
    for more in delivered[1:]:
        keys = keys.union(more.select("doc_id", "digest"))
    groups = groups.select("digest", "keep_id", F.col("n").alias("group_size"))
    joined = keys.join(groups, "digest")
    return joined.select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def without_copies(docs: DataFrame, judged: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not that of a copy, with all their columns. Ids have to be unique."""
    gone = judged.where("NOT kept").select(F.col("doc_id").alias(id_column))
    return docs.join(gone, id_column, "left_anti")
