"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed from its start into phrases, each the longest phrase met before and one more character (LZ78). The
phrases' hashes are a set; its 128 smallest values are the fingerprint. The share of equal values among the smallest
of two fingerprints estimates the Jaccard likeness of the phrase sets, which is high where one text's dictionary
would compress the other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import keyed, shuffle_partitions

SIZE = 128

_STEP = 1 << 21  # above every code point; nodes are multiples of it
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FIRST_ID = -(1 << 63)

COMPARED = (
    "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class _Powers:
    """Powers of a number modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            more = self.values * (self.values[-1:] * self.base)
            self.values = np.concatenate([self.values, more])
        return self.values[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_INVERSE)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Parse:
    """The phrases of one text. The state at ``cut`` can be gone back to, for texts that begin alike."""

    def __init__(self, text: str, cut: int | None = None):
        self.text = text
        self.codes = _codes(text)
        self.cut = len(self.codes) if cut is None else cut
        self.trie: dict[int, int] = {}
        values = self.codes.tolist()
        self.ends: list[int] = []
        self.node = self._parse(values[: self.cut], 0, 0, self.ends)
        self.phrases_at_cut = len(self.ends)
        self.fingerprint: np.ndarray = np.empty(0, np.uint32)
        ends = list(self.ends)
        added = self._parse_and_undo(values[self.cut :], ends)
        self.fingerprint = _smallest(self.codes, ends, added)

    def _parse(self, values: list[int], node: int, at: int, ends: list[int]) -> int:
        """Appends the ends of new phrases and returns the phrase gone into, 0 if none."""
        trie, get = self.trie, self.trie.get
        size = len(trie) * _STEP
        for at, value in enumerate(values, at + 1):
            below = get(node | value)
            if below is None:
                size += _STEP
                trie[node | value] = size
                ends.append(at)
                node = 0
            else:
                node = below
        return node

    def _parse_and_undo(self, values: list[int], ends: list[int]) -> int:
        """Goes on from the cut and takes the new phrases out of the trie again; dictionaries keep their order."""
        before = len(self.trie)
        self._parse(values, self.node, self.cut, ends)
        for _ in range(len(self.trie) - before):
            self.trie.popitem()
        return len(ends)

    def continued(self, rest: str) -> np.ndarray:
        """The fingerprint of the text up to the cut followed by ``rest``."""
        added = _codes(rest)
        ends = list(self.ends)
        self._parse_and_undo(added.tolist(), ends)
        return _smallest(np.concatenate([self.codes[: self.cut], added]), ends, len(ends))


def _smallest(codes: np.ndarray, ends: list[int], n: int) -> np.ndarray:
    """The smallest hashes of the phrases that end there, in ascending order."""
    if not n:
        return np.empty(0, np.uint32)
    powers = _POWERS.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    stops = np.array(ends, np.int64)
    starts = np.concatenate([[0], stops[:-1]])
    hashes = (sums[stops] - sums[starts]) * _INVERSES.upto(len(codes) + 1)[starts]
    short = (_mixed(hashes) >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * SIZE:
        short = np.partition(short, 4 * SIZE)[: 4 * SIZE]  # equal values leave at least as many as are wanted
    return np.unique(short)[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; two texts without phrases are equal."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:SIZE]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def as_text(fingerprint: np.ndarray) -> str:
    """Eight hexadecimal digits per value."""
    return fingerprint.astype(">u4").tobytes().hex()


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(value), ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text; null texts are empty. Map-only."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([as_text(Parse(t or "").fingerprint) for t in texts], pa.string())],
                names=["doc_id", "fingerprint"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def _borders(rows: DataFrame, quantiles: list[int]) -> list[tuple[int, int]]:
    """The smallest (id, hash) of each range but the last, ascending, at the quantiles of the ids."""
    many = Counter(quantiles)
    borders = [(k, _FIRST_ID) for k in many]
    hot = [k for k, n in many.items() if n > 1]
    if hot:  # fewer than there are ranges
        most = max(many.values())
        grid = [i / (8 * most) for i in range(1, 8 * most)]
        own = rows.where(F.col("_k").isin(hot)).groupBy("_k").agg(F.percentile_approx("_h", grid, 100 * most).alias("q"))
        for row in own.collect():
            n = many[row["_k"]]
            borders += [(row["_k"], row.q[8 * most * i // n - 1]) for i in range(1, n)]
    return sorted(set(borders))


def compare_with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each text against itself with its last half replaced, and against the next document by descending id.

    Columns as in ``COMPARED``. The last floor(n_chars / 2) code points are replaced by the first as many (or all) of
    the next document; after the last document comes the first, and a lone one follows itself. Null texts are empty.
    Null ids come last; rows of one id are in descending order of their text's hash, then by text.

    Documents are dealt to ranges whose borders are quantiles of the ids, and of the texts' hashes within an id that
    has several quantiles. The first document of a range also goes to the range before it, where it is the next of the
    last one, so texts are shuffled once. An empty table gives no rows; a task holds two texts at a time.
    """
    rows = keyed(docs).withColumn("_k", F.coalesce("doc_id", F.lit(_FIRST_ID)))
    ranges = shuffle_partitions(spark)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = rows.agg(F.percentile_approx("_k", shares, 100 * ranges).alias("q")).first().q
    borders = _borders(rows, found or [])

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        at = [len(borders) - bisect_right(borders, place) for place in zip(ids.tolist(), hashes.tolist())]
        return pd.Series(at, dtype="int32")

    rows = rows.withColumn("_range", range_of("_k", "_h"))
    firsts = rows.groupBy("_range").agg(F.max(F.struct("_k", "_h")).alias("head")).collect()
    heads = {r["_range"]: tuple(r.head) for r in firsts}
    order = sorted(heads)  # one entry per range
    before = {heads[r]: order[i - 1] for i, r in enumerate(order)}

    @F.pandas_udf("int")
    def range_before(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([before.get(place) for place in zip(ids.tolist(), hashes.tolist())], dtype="Int32")

    extra = range_before("_k", "_h")
    places = F.array_compact(
        F.array(
            F.struct(F.col("_range").alias("range"), F.lit(False).alias("extra")),
            F.when(extra.isNotNull(), F.struct(extra.alias("range"), F.lit(True).alias("extra"))),
        )
    )
    dealt = rows.withColumn("_place", F.explode(places)).select(
        "doc_id", "_k", "_h", "text", F.col("_place.range").alias("_range"), F.col("_place.extra").alias("_extra")
    )
    dealt = dealt.repartition(ranges, "_range").sortWithinPartitions(
        "_range", "_extra", F.desc("_k"), F.desc("_h"), "text"
    )
    return dealt.select("doc_id", "text", "_range", "_extra").mapInArrow(_compare, COMPARED)


def _compare(batches):
    names = [f.split()[0] for f in COMPARED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    previous = None

    def compared(doc_id, parse: Parse, following: Parse) -> tuple:
        rest = following.text[: len(parse.codes) - parse.cut]
        edited = parse.continued(rest)
        own = parse.fingerprint
        return (
            doc_id,
            len(parse.codes),
            parse.text[: parse.cut] + rest,
            as_text(own),
            as_text(edited),
            likeness(own, edited),
            likeness(own, following.fingerprint),
        )

    for batch in batches:
        out = []
        for doc_id, text, number, extra in zip(*(c.to_pylist() for c in batch.columns)):
            if extra and previous is None:
                continue  # the range before has found its next document
            parse = Parse(text, len(text) - len(text) // 2)
            if previous is not None:
                out.append(compared(previous[0], previous[1], parse))
            previous = None if extra else (doc_id, parse)
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
