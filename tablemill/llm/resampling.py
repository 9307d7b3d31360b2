"""Documents drawn by importance towards a target set, by hashed features of words and pairs of words.

A feature's bucket is the CRC-32 of its bytes. The CRC of a pair goes on from the state behind its first word, so a word
needs hashing once: its CRC, the state behind it and a blank, and its length. The head of the vocabulary, words that make
up at least a ``HEAD_WORDS``-th of all, goes to every task with these values, and the buckets of all pairs of its most
frequent words as a table. Words of the tail get their CRC where they are met, and their pairs from the states. Both ways
give exact buckets; what is in the head changes the cost only.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.llm.common import binary_column, shuffle_partitions, written

BUCKETS = 10_000
#: Words with at least this part of all occurrences are the head, so there are at most so many. Longer ones than
#: ``HEAD_BYTES`` are left to the tail, which bounds what is broadcast.
HEAD_WORDS, HEAD_BYTES = 16_384, 64
#: The pairs of so many most frequent words have a table of buckets.
PAIR_WORDS = 1024
#: Bytes of words of the tail that a worker remembers, and of text that is looked at together.
_TAIL_BYTES, _CHUNK_BYTES = 8 << 20, 1 << 20
_COUNTED_WORDS = 200_000
#: Pairs whose second word is longer are hashed one by one.
_SHIFT_BYTES = 64

#: Fixed: words are of digits, letters of any case and all that is not ASCII; A-Z are lowered.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


def _shift_tables() -> np.ndarray:
    """By length and byte of a CRC: what that byte becomes when so many zero bytes follow. CRCs are linear, so the CRC
    of two texts is the first one's, moved on by the second one's length, and the second one's CRC."""
    tables = np.zeros((_SHIFT_BYTES + 1, 4, 256), np.uint32)
    for length in range(_SHIFT_BYTES + 1):
        zeros = bytes(length)
        base = zlib.crc32(zeros)
        for bit in range(32):
            byte, at = divmod(bit, 8)
            moved = zlib.crc32(zeros, 1 << bit) ^ base
            tables[length, byte, (np.arange(256) >> at) & 1 == 1] ^= np.uint32(moved)
    return tables.reshape(-1)


@dataclass(frozen=True)
class Head:
    """Frequent words, most frequent first, and the buckets of pairs of the first ``n_pairs`` of them."""

    words: list[bytes]
    n_pairs: int
    pair_buckets: np.ndarray


class FeatureHasher:
    """Buckets of texts' features in one worker. Words of the tail are remembered up to a bound of bytes."""

    def __init__(self, head: Head, buckets: int = BUCKETS):
        self.head, self.buckets, self.shifts = head, buckets, _shift_tables()
        self._forget()

    def _forget(self):
        self.ids: dict[bytes, int] = {}
        self.values = np.zeros((3, 0), np.uint32)  # CRC, state behind the word and a blank, length
        self.tail_bytes = 0
        self._learn(self.head.words)
        self.words = list(self.head.words)

    def _learn(self, words: list[bytes]):
        known = len(self.ids)
        self.ids.update(zip(words, range(known, known + len(words))))
        new = np.array(
            [[zlib.crc32(w) for w in words], [zlib.crc32(w + b" ") for w in words], [len(w) for w in words]], np.uint32
        ).reshape(3, -1)
        self.values = np.concatenate([self.values, new], axis=1)
        self.word_buckets = self.values[0] % np.uint32(self.buckets)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.ids.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, k in zip(words, found) if k is None))
            self._learn(new)
            self.words += new
            self.tail_bytes += sum(map(len, new)) + 100 * len(new)
            found = list(map(self.ids.__getitem__, words))
        return np.array(found, np.int64)

    def _pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The buckets of pairs of words. Pairs outside the table go on from the state behind their first word."""
        n = self.head.n_pairs
        out = np.empty(len(first), np.int64)
        frequent = (first < n) & (second < n)
        out[frequent] = self.head.pair_buckets[first[frequent] * n + second[frequent]]
        rest = np.flatnonzero(~frequent)
        a, b = first[rest], second[rest]
        state, length = self.values[1][a], self.values[2][b].astype(np.int64)
        base = np.minimum(length, _SHIFT_BYTES) * 1024
        crc = self.values[0][b]
        for byte in range(4):
            crc = crc ^ self.shifts[base + 256 * byte + ((state >> np.uint32(8 * byte)) & np.uint32(255))]
        for k in np.flatnonzero(length > _SHIFT_BYTES).tolist():
            crc[k] = zlib.crc32(self.words[b[k]], int(state[k]))
        out[rest] = crc % np.uint32(self.buckets)
        return out

    def features(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of texts: the number of words of each, and of all features the bucket and the text's number."""
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= _CHUNK_BYTES):
                held += len(texts[end])
                end += 1
            each = [words_of(raw) for raw in texts[start:end]]
            n_words = np.array([len(w) for w in each], np.int64)
            ids = self._ids([w for words in each for w in words])
            of = np.repeat(np.arange(len(each)), n_words)
            inside = np.flatnonzero(of[1:] == of[:-1])
            pairs = self._pairs(ids[inside], ids[inside + 1])
            yield n_words, np.concatenate([self.word_buckets[ids], pairs]), np.concatenate([of, of[inside]])
            start = end
            if self.tail_bytes > _TAIL_BYTES:
                self._forget()


def head_vocabulary(docs: DataFrame, head_words: int = HEAD_WORDS, pair_words: int = PAIR_WORDS) -> Head:
    """The frequent words of all texts. Tasks hand on the words that make up a large part of their own, so their number
    is bounded; a word that is frequent in all is frequent in some task."""

    def count(batches):
        counted, total = Counter(), 0
        for batch in batches:
            for raw in binary_column(batch, "text"):
                words = words_of(raw)
                total += len(words)
                counted.update(words)
                if len(counted) > _COUNTED_WORDS:
                    counted = Counter(dict(counted.most_common(_COUNTED_WORDS // 4)))
        often = [(w, n) for w, n in counted.items() if n * head_words >= total and len(w) <= HEAD_BYTES]
        words = pa.array([None, *(w for w, _ in often)], pa.binary())
        yield pa.record_batch([words, pa.array([total, *(n for _, n in often)], pa.int64())], names=["word", "n"])

    each = docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    each = written(docs.sparkSession, each, "often")
    total = each.agg(F.max(F.when(F.col("word").isNull(), F.col("n")))).first()[0] or 0
    often = each.where(F.col("word").isNotNull() & (F.col("n") * head_words >= total)).collect()  # ``head_words`` at most
    words = [bytes(r.word) for r in sorted(often, key=lambda r: (-r.n, bytes(r.word)))]
    return _head(words, pair_words)


def _head(words: list[bytes], pair_words: int, buckets: int = BUCKETS) -> Head:
    n = min(len(words), pair_words)
    hasher = FeatureHasher(Head(words, 0, np.empty(0, np.uint16)), buckets)
    ids = np.arange(n)
    table = hasher._pairs(np.repeat(ids, n), np.tile(ids, n))
    return Head(words, n, table.astype(np.uint16 if buckets <= 1 << 16 else np.uint32))


def bucket_totals(spark: SparkSession, docs: DataFrame, head: Head, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket."""
    shared = spark.sparkContext.broadcast(head)

    def add(batches):
        hasher, totals = FeatureHasher(shared.value, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in hasher.features(binary_column(batch, "text")):
                totals += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(at), pa.array(totals[at])], names=["bucket", "n"])

    summed = docs.select("text").mapInArrow(add, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most ``buckets`` rows
        totals[row.bucket] = row.n
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket: thousandths of the logarithm of how much more frequent it is in the target, rounded down."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    gains = []
    for s, t in zip(source.tolist(), target.tolist()):
        odds = (float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))
        gains.append(math.floor(1000 * math.log(odds)))
    return np.array(gains, np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variable that the document id decides, rounded down. A null id is as an empty one."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(
    spark: SparkSession, docs: DataFrame, head: Head, gains: np.ndarray, seed: int, min_words: int
) -> DataFrame:
    """``doc_id, n_features, n_words, weight, score, eligible`` of every document."""
    shared = spark.sparkContext.broadcast((head, gains))

    def weigh(batches):
        head, gains = shared.value
        hasher = FeatureHasher(head, len(gains))
        for batch in batches:
            texts, ids = binary_column(batch, "text"), batch.column("doc_id")
            n_words, n_features, sums = [], [], []
            for words, found, of in hasher.features(texts):
                n_words.append(words)
                n_features.append(np.bincount(of, minlength=len(words)))
                sums.append(np.bincount(of, gains[found], len(words)).astype(np.int64))
            n_words, n, total = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (n_words, n_features, sums))
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            random = np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
            columns = [ids, pa.array(n), pa.array(weight), pa.array(weight + random), pa.array(n_words >= min_words)]
            yield pa.record_batch(columns, names=["doc_id", "n_features", "weight", "score", "eligible"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id bigint, n_features bigint, weight bigint, score bigint, eligible boolean")


def _numbered(spark: SparkSession, rows: DataFrame, order: list) -> DataFrame:
    """The rows with ``place``, their number in the given order from 1. They are dealt to ranges and numbered there;
    what is before a range is added from the ranges' sizes, one row each."""

    def number(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(n + 1, n + 1 + batch.num_rows)
            n += batch.num_rows
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(at)]
            yield pa.record_batch(columns, names=[*batch.schema.names, "part", "at"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    ranges = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed = written(spark, ranges.mapInArrow(number, f"{schema}, part int, at bigint"), "placed")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    located = placed.join(F.broadcast(bases), "part")
    return located.withColumn("place", F.col("base") + F.col("at")).drop("part", "at", "base")


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    seed: int = 7,
    min_words: int = 20,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``.

    Features are words and pairs of neighbouring words, repeats counted. A document's weight is the mean gain of its
    features; with Gumbel noise it is the score. ``percent`` of the documents of at least ``min_words`` words are drawn,
    those with the highest scores, ties to the smaller id (null ids last), and ``rank`` is their place; it is null for
    the others. Null and empty texts have no features and weight 0. Rows that repeat an id have the same noise and are
    drawn one by one. Without a target, all of its counts are zero; an empty table gives no rows. Other columns are not
    looked at.
    """
    head = head_vocabulary(docs)
    if buckets != BUCKETS:
        head = _head(head.words, PAIR_WORDS, buckets)
    gains = bucket_gains(bucket_totals(spark, docs, head, buckets), bucket_totals(spark, target, head, buckets))
    rows = written(spark, weighed(spark, docs, head, gains, seed, min_words), "weighed")
    drawn = percent * rows.where("eligible").count() // 100
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())  # so that one id's rows can be parted
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    placed = _numbered(spark, numbered, order)
    rank = F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
