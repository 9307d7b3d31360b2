"""SimHash fingerprints of documents, linked within a Hamming distance by multi-index hashing.

A fingerprint has two segments of 32 bits. Two fingerprints that differ in at most three bits differ in at most one bit
of one of the segments. So each enters the tables with both segments, and asks them for the segments in their Hamming
balls of radius one. Of two segments that differ in a bit, the one that has it set finds the other by clearing it; that
half of the ball is enough. Rows of one segment value meet in one bucket, where complete distances are verified.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import binary_column, written
from tablemill.llm.components import connected_components

MAX_BITS = 3
SEED = 42
#: A bucket with more fingerprints is split by the bytes of the other segment.
BUCKET_ROWS = 4096
#: At most twice as many buckets are split, so the list of them that tasks get is bounded.
SPLIT_BUCKETS = 5000


def fingerprint(raw: bytes, shingle_words: int) -> int:
    """Words are cut at ASCII white space, A-Z is lower-cased; a bit is set if more than half of the hashes have it."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64)
    votes, step = np.zeros(64, np.int64), 1 << 16
    for i in range(0, len(hashes), step):
        block = hashes[i : i + step].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit integer, for every row; null texts are empty (0)."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(raw, shingle_words) for raw in binary_column(batch, "text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _segments(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return fp >> np.uint64(32), fp & np.uint64(0xFFFFFFFF)


def _enter(batches, split: np.ndarray):
    """Table and probe rows of fingerprints: bucket (segment number and value), part of the bucket, fingerprint."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for number, (own, other) in enumerate((_segments(fp), _segments(fp)[::-1])):
            kinds = [(own, np.arange(len(fp)), 0)]
            for bit in range(32):
                has = np.flatnonzero(own >> np.uint64(bit) & np.uint64(1))
                kinds.append((own[has] ^ np.uint64(1 << bit), has, 1))
            for value, rows, probe in kinds:
                bucket = (value | np.uint64(number << 32)).astype(np.int64)
                large = np.isin(bucket, split)
                for part in range(5):  # 0: the whole bucket, else one byte of the other segment
                    at = np.flatnonzero(large if part else ~large)
                    if not len(at):
                        continue
                    byte = other[rows[at]] >> np.uint64(8 * max(0, part - 1)) & np.uint64(255)
                    parts = (256 * part + byte).astype(np.int32) if part else np.zeros(len(at), np.int32)
                    yield pa.record_batch(
                        [
                            pa.array(bucket[at]),
                            pa.array(parts),
                            pa.array(np.full(len(at), probe, np.int32)),
                            pa.array(fp[rows[at]].view(np.int64)),
                        ],
                        names=["bucket", "part", "probe", "fp"],
                    )


def _forest(members: np.ndarray, max_bits: int):
    """Links of a spanning forest of the members within the distance: each member is compared once with those not
    reached before it."""
    rest = members
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = np.bitwise_count(rest ^ node) <= max_bits
            if near.any():
                for other in rest[near]:
                    yield node, other
                reached.extend(rest[near])
                rest = rest[~near]


def _verify(batches, max_bits: int):
    """Links within buckets of at least one table row; rows come sorted by bucket, part and table before probe."""
    held = None

    def links(rows: np.ndarray, last: bool):
        """``rows``: bucket, part, probe, fp. Keeps the rows of the last bucket unless it is known to be whole."""
        nonlocal held
        ends = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])) + 1
        starts = np.concatenate([[0], ends])
        stops = np.concatenate([ends, [len(rows)]])
        if not last:
            held = rows[starts[-1] :]
            starts, stops = starts[:-1], stops[:-1]
        worth = (stops - starts > 1) & (rows[starts, 2] == 0)
        out = []
        for start, stop in zip(starts[worth], stops[worth]):
            out.extend(_forest(np.unique(rows[start:stop, 3].view(np.uint64)), max_bits))
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
        rows = rows if held is None else np.concatenate([held, rows])
        if len(rows):
            yield links(rows, False)
    if held is not None and len(held):
        yield links(held, True)


def hamming_links(spark: SparkSession, distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints of ``distinct`` (one column ``fp``) which are joined by steps
    of at most ``max_bits`` (0 to 3) bits. Each bucket gives a spanning forest, not all of its pairs.

    Buckets with very many fingerprints are split by the bytes of the other segment: two that differ there in at most
    three bits agree in one of its four bytes.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one find distances up to 3")
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    tables = distinct.select(F.explode(F.array(high, low.bitwiseOR(1 << 32))).alias("bucket"))
    limit = max(BUCKET_ROWS, distinct.count() // SPLIT_BUCKETS)
    large = tables.groupBy("bucket").count().where(F.col("count") > limit).collect()
    split = np.array(sorted(row.bucket for row in large), np.int64)

    entries = distinct.select("fp").mapInArrow(
        lambda batches: _enter(batches, split), "bucket bigint, part int, probe int, fp bigint"
    )
    dealt = entries.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "probe")
    return dealt.mapInArrow(lambda batches: _verify(batches, max_bits), "a bigint, b bigint")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle_words: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest document id that can be reached over links. Null ids are no smallest id: it is
    null where a component has no other. Rows without words have fingerprint 0 and are linked like any other.
    """
    return grouped(spark, written(spark, fingerprints(docs, shingle_words), "fingerprints"), max_bits)


def grouped(spark: SparkSession, prints: DataFrame, max_bits: int = MAX_BITS, links: DataFrame | None = None) -> DataFrame:
    """As :func:`near_duplicates`, from written ``doc_id, fp``; ``links`` (``a``, ``b``) join more fingerprints."""
    nodes = written(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    near = hamming_links(spark, nodes, max_bits)
    labels = connected_components(spark, near if links is None else near.union(links))
    members = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    members = members.withColumn("label", F.coalesce("label", "fp"))
    least = members.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = members.join(least, "label").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")
