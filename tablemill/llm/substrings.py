"""Removal of word sequences that occur more than once anywhere, by super-k-mer partitioning.

A window is a run of ``window`` words of one document. Its minimiser is the least hash among its runs of ``MER``
words. Consecutive windows with one minimiser in one place make a super-k-mer: one packed string that holds all of
them. Equal windows have equal minimisers, so packed strings are dealt to buckets by minimiser; in a bucket the windows
are sorted and equal ones counted. The windows of one super-k-mer all differ, as each has its minimiser elsewhere.

Minimisers are counted first. One that begins a single super-k-mer has no repeated window, so its string never
travels. Strings of very frequent minimisers are counted whole, combined on the map side, and then the windows of the
distinct ones. Of those strings and windows the hottest are few by a proven bound: tasks are told them and mark them
where they stand, so that no occurrence of them is shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import text_hash, written

WINDOW = 35
MER = 5
#: Minimisers with more super-k-mers are frequent; strings and windows that occur more often are hot.
BUCKET_STRINGS = 5000
#: There are at most so many of each: where there would be more, the bound above is higher.
FREQUENT = 100_000
#: Texts are cut into words in groups of so many bytes, or one by one if longer; words are hashed in slices.
_GROUP_BYTES = 512 << 10
_SLICE_BYTES = 1 << 16
#: Bytes of strings that a task combines before it hands them on.
_HELD_BYTES = 16 << 20
_FIRST_ID = -(1 << 63)
_BLANK = re.compile(b" ")


_BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# Any fixed odd number and codes do; all tasks must have the same.
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(_SLICE_BYTES + 1, base, np.uint64)
        powers[0] = 1
        found.append(np.multiply.accumulate(powers))
    return tuple(found)


def _bounds(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word in the bytes of documents that stand side by side; ``borders`` are theirs."""
    blank = _BLANKS[data]
    inside = ~blank
    begins = inside.copy()
    begins[1:] &= blank[:-1]
    firsts = borders[borders < len(data)]
    begins[firsts] = inside[firsts]
    lasts = inside
    lasts[:-1] &= blank[1:] | begins[1:]
    return np.flatnonzero(begins), np.flatnonzero(lasts) + 1


def _word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: the sum of their bytes' codes times powers of the base, from sums over a slice."""
    powers, inverses = _powers()
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + _SLICE_BYTES, "right")))
        low, high = int(begins[i]), int(ends[j - 1])
        if high - low > _SLICE_BYTES:  # one long word
            out[i] = xxhash.xxh64_intdigest(data[low:high].tobytes())
        else:
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_CODES[data[low:high]] * powers[: high - low], out=sums[1:])
            at = begins[i:j] - low
            out[i:j] = (sums[ends[i:j] - low] - sums[at]) * inverses[at]
        i = j
    return out ^ (out >> np.uint64(32))


def _sliding_min(values: np.ndarray, reach: int) -> np.ndarray:
    have = 1
    while have < reach:
        step = min(have, reach - have)
        values, have = np.minimum(values[step:], values[: len(values) - step]), have + step
    return values


@dataclass
class _Cut:
    """Documents ``low`` to ``high`` of a batch. ``first`` has each one's first word and ``at`` its first super-k-mer
    (and those behind the last); super-k-mers have the number of their first window in the document, their number of
    windows, their minimiser and document."""

    low: int
    high: int
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    keys: np.ndarray
    documents: np.ndarray

    def packed(self, document: int, start: int, stop: int) -> bytes:
        """Words of a document, joined by one blank."""
        first = self.first[document]
        words = self.data[self.begins[first + start] : self.ends[first + stop - 1]].tobytes()
        return b" ".join(words.split())


def _super_kmers(low: int, high: int, data: np.ndarray, borders: np.ndarray, window: int) -> _Cut:
    begins, ends = _bounds(data, borders)
    first = np.searchsorted(begins, borders)
    n_windows = np.maximum(np.diff(first) - window + 1, 0)
    total, behind = int(n_windows.sum()), np.cumsum(n_windows)
    if not total:
        none = np.empty(0, np.int64)
        return _Cut(low, high, data, begins, ends, first, np.zeros(high - low + 1, np.int64), none, none, none, none)
    mer = min(MER, window)
    h = _word_hashes(data, begins, ends)
    n = len(h) - mer + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(mer):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    least = _sliding_min(mixed, window - mer + 1)

    # Windows within one document, side by side.
    document = np.repeat(np.arange(high - low), n_windows)
    number = np.arange(total) - (behind - n_windows)[document]
    word = first[document] + number
    mixed, least = mixed[word], least[word]
    new = number == 0
    # The first run with the least hash begins the window before: the next one has its minimiser elsewhere.
    new[1:] |= (least[1:] != least[:-1]) | (mixed[:-1] == least[:-1])
    chosen = np.flatnonzero(new)
    counts = np.diff(np.append(chosen, total))
    document = document[chosen]
    at = np.searchsorted(document, np.arange(high - low + 1))
    keys = least[chosen].view(np.int64)
    return _Cut(low, high, data, begins, ends, first, at, number[chosen], counts, keys, document)


def _cuts(texts: pa.Array, window: int):
    """The super-k-mers of a batch's documents, for groups of documents of bounded size; null texts are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, borders, data = texts.buffers()
    borders = np.frombuffer(borders, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(borders, borders[low] + _GROUP_BYTES, "right")) - 1)
        high = min(high, len(texts))
        own = borders[low : high + 1]
        yield _super_kmers(low, high, data[own[0] : own[-1]], own - own[0], window)
        low = high


def _minimisers(batches, window: int):
    for batch in batches:
        for cut in _cuts(batch.column("text"), window):
            own = batch.slice(cut.low, cut.high - cut.low)
            values = pa.array(cut.starts, pa.int32()), pa.array(cut.counts, pa.int32()), pa.array(cut.keys, pa.int64())
            lists = [pa.ListArray.from_arrays(pa.array(cut.at, pa.int32()), v) for v in values]
            yield pa.record_batch(
                [own.column("_d"), own.column("_h"), *lists], names=["_d", "_h", "starts", "counts", "keys"]
            )


_PIECE = "_d bigint, _h bigint, start int, stop int, key bigint, packed binary"
_STRING = "key bigint, packed binary, copies bigint, _d bigint, _h bigint, start int"
_COUNTED = "key bigint, packed binary, copies bigint"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _batches(schema: str, rows):
    out = []
    for row in rows:
        out.append(row)
        if len(out) >= 4096:
            yield _batch(schema, out)
            out = []
    if out:
        yield _batch(schema, out)


def _cut_strings(batches, window: int):
    """The packed strings of a document's chosen super-k-mers, keyed by minimiser."""
    bits = window.bit_length()

    def rows():
        for batch in batches:
            ids, hashes, chosen = (batch.column(c).to_pylist() for c in ("_d", "_h", "chosen"))
            for cut in _cuts(batch.column("row").field("text"), window):
                for document in range(cut.high - cut.low):
                    numbers = np.array(chosen[cut.low + document], np.int64)
                    own = slice(cut.at[document], cut.at[document + 1])
                    starts = numbers >> bits
                    stops = starts + (numbers & (1 << bits) - 1) - 1 + window
                    keys = cut.keys[own][np.searchsorted(cut.starts[own], starts)]
                    d, h = ids[cut.low + document], hashes[cut.low + document]
                    for start, stop, key in zip(starts.tolist(), stops.tolist(), keys.tolist()):
                        yield d, h, start, stop, key, cut.packed(document, start, stop)

    yield from _batches(_PIECE, rows())


def _string_key(packed: bytes) -> int:
    return xxhash.xxh64_intdigest(packed) >> 1


def _marked(d: int, h: int, found, hot: frozenset[bytes]):
    """Rows of ``(start, stop, packed)`` in ascending order, keyed by the string. Those of hot strings carry no string
    but stand for themselves, and are joined where they touch."""
    held = None
    for start, stop, packed in found:
        if hot and hashlib.sha256(packed).digest() in hot:
            if held and start <= held[1]:
                held = held[0], stop
                continue
            if held:
                yield d, h, *held, 0, None
            held = start, stop
        else:
            yield d, h, start, stop, _string_key(packed), packed
    if held:
        yield d, h, *held, 0, None


def _frequent_strings(batches, window: int, often: np.ndarray):
    """Per document that has any: its key, and start, stop and packed string of the super-k-mers of frequent minimisers
    ``often`` (ascending)."""

    def strings(cut: _Cut, document: int, found: np.ndarray):
        starts = cut.starts[found]
        stops = starts + cut.counts[found] - 1 + window
        for start, stop in zip(starts.tolist(), stops.tolist()):
            yield start, stop, cut.packed(document, start, stop)

    for batch in batches:
        ids, hashes = (batch.column(c).to_pylist() for c in ("_d", "_h"))
        for cut in _cuts(batch.column("text"), window):
            place = np.minimum(np.searchsorted(often, cut.keys), len(often) - 1)
            found = np.flatnonzero(often[place] == cut.keys)
            documents, begin = np.unique(cut.documents[found], return_index=True)
            for document, own in zip(documents.tolist(), np.split(found, begin[1:])):
                yield ids[cut.low + document], hashes[cut.low + document], strings(cut, document, own)


def _counted_strings(batches, window: int, often: np.ndarray):
    """The packed strings of frequent minimisers with their numbers in this task and the place of one of each. Equal
    ones are combined while a bounded number of bytes is held."""

    def rows():
        counts: dict[bytes, list[int]] = {}
        held = 0
        for d, h, found in _frequent_strings(batches, window, often):
            for start, _, packed in found:
                if packed in counts:
                    counts[packed][0] += 1
                    continue
                counts[packed] = [1, d, h, start]
                held += len(packed)
                if held > _HELD_BYTES:
                    yield from ((_string_key(p), p, *row) for p, row in counts.items())
                    counts, held = {}, 0
        yield from ((_string_key(p), p, *row) for p, row in counts.items())

    yield from _batches(_STRING, rows())


def _placed_strings(batches, window: int, often: np.ndarray, hot: frozenset[bytes]):
    """The packed strings of frequent minimisers, with their places."""

    def rows():
        for d, h, found in _frequent_strings(batches, window, often):
            yield from _marked(d, h, found, hot)

    yield from _batches(_PIECE, rows())


def _windows_of(packed: bytes, window: int) -> list[bytes]:
    ends = [*(m.start() for m in _BLANK.finditer(packed)), len(packed)]
    begins = [0, *(e + 1 for e in ends[:-1])]
    return [packed[begins[i] : ends[i + window - 1]] for i in range(len(begins) - window + 1)]


def _counted_windows(batches, window: int):
    """The windows of distinct packed strings."""

    def rows():
        for batch in batches:
            for copies, packed in zip(*(batch.column(c).to_pylist() for c in ("copies", "packed"))):
                for each in _windows_of(packed, window):
                    yield _string_key(each), each, copies

    yield from _batches(_COUNTED, rows())


def _placed_windows(batches, window: int, hot: frozenset[bytes]):
    """The windows of packed strings that occur once, with their places."""

    def rows():
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_d", "_h", "start", "packed"))
            for d, h, start, packed in zip(*columns):
                found = ((start + i, start + i + window, w) for i, w in enumerate(_windows_of(packed, window)))
                yield from _marked(d, h, found, hot)

    yield from _batches(_PIECE, rows())


def repeated_windows(strings: list[bytes], window: int) -> list[tuple[int, list[int]]]:
    """Of a bucket's packed strings: for each place in the list that has any, its windows that occur more than once in
    the bucket. Equal strings are taken together; windows are sorted, so equal ones stand together."""
    if len(strings) == 1:
        return []
    copies: dict[bytes, list[int]] = {}
    for at, packed in enumerate(strings):
        copies.setdefault(packed, []).append(at)
    if len(copies) == 1:
        every = list(range(strings[0].count(b" ") + 2 - window))
        return [(at, every) for at in range(len(strings))]
    windows: list[tuple[bytes, int, bytes]] = []
    for packed in copies:
        windows.extend((each, i, packed) for i, each in enumerate(_windows_of(packed, window)))
    windows.sort()
    found: dict[bytes, list[int]] = {}
    i = 0
    while i < len(windows):
        end = i + 1
        while end < len(windows) and windows[end][0] == windows[i][0]:
            end += 1
        if end - i > 1 or len(copies[windows[i][2]]) > 1:
            for _, place, packed in windows[i:end]:
                found.setdefault(packed, []).append(place)
        i = end
    return [(at, sorted(places)) for packed, places in found.items() for at in copies[packed]]


def _count_buckets(batches, window: int):
    """Spans of repeated windows in their documents. Rows come sorted by key; a bucket may go on in the next batch."""
    key, held = None, []

    def spans():
        for at, places in repeated_windows([row[3] for row in held], window):
            d, h, start, _ = held[at]
            for first, last in _runs(places):
                yield d, h, (start + first) << 32 | (start + last + window)

    def batch_of(out):
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["_d", "_h", "span"])

    for batch in batches:
        out = []
        for d, h, start, _, k, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key and held:
                out.extend(spans())
                held = []
            key = k
            held.append((d, h, start, packed))
        if out:
            yield batch_of(out)
    out = list(spans()) if held else []
    if out:
        yield batch_of(out)


def _runs(places: list[int]):
    """First and last of each run of consecutive numbers."""
    first = last = places[0]
    for place in places[1:]:
        if place != last + 1:
            yield first, last
            first = place
        last = place
    yield first, last


def _without(docs: pd.DataFrame, spans: pd.Series) -> pd.DataFrame:
    """``spans``: first word and word behind the last, in one number each."""
    rows = []
    for text, found in zip(docs["text"], spans):
        words = (text or "").encode().split()
        kept = words
        if found is not None and len(found):
            steps = np.zeros(len(words) + 1, np.int32)
            found = np.asarray(found, np.int64)
            np.add.at(steps, found >> 32, 1)
            np.add.at(steps, found & 0xFFFFFFFF, -1)
            kept = [w for w, covered in zip(words, np.cumsum(steps[:-1]).tolist()) if not covered]
        rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def _span(start: str, stop: str):
    return (F.shiftleft(F.col(start).cast("bigint"), 32) + F.col(stop)).alias("span")


def _limit(total: int) -> int:
    """Fewer than ``FREQUENT`` of the things that occur ``total`` times altogether occur more often than this."""
    return max(BUCKET_STRINGS, total // FREQUENT)


def _repeated_spans(
    spark: SparkSession, repeated: DataFrame, places: Callable[[frozenset[bytes]], DataFrame]
) -> DataFrame:
    """Spans of the strings of ``places`` that are in ``repeated`` (``key, packed`` and ``n``, how often they are in
    ``places``). Hot ones are known to the tasks of ``places``; others meet by a join with a bounded group each."""
    limit = _limit(repeated.agg(F.sum("n")).first()[0] or 0)
    digests = repeated.where(F.col("n") > limit).select(F.unhex(F.sha2("packed", 256)).alias("digest")).collect()
    rows = written(spark, places(frozenset(bytes(row.digest) for row in digests)), "frequent-strings")
    others = repeated.where(F.col("n") <= limit).select("key", "packed")
    met = rows.where("packed IS NOT NULL").join(others, ["key", "packed"], "left_semi")
    return rows.where("packed IS NULL").unionByName(met).select("_d", "_h", _span("start", "stop"))


def _frequent_spans(spark: SparkSession, texts: DataFrame, often: list[int], window: int) -> DataFrame:
    """Spans of repeated windows in the super-k-mers of frequent minimisers."""
    keys = np.sort(np.array(often, np.int64))

    def strings(hot: frozenset[bytes]) -> DataFrame:
        return texts.mapInArrow(lambda batches: _placed_strings(batches, window, keys, hot), _PIECE)

    # The place is right for strings that occur once, which are the only ones it is asked of.
    place = (F.min(c).alias(c) for c in ("_d", "_h", "start"))
    counted = texts.mapInArrow(lambda batches: _counted_strings(batches, window, keys), _STRING)
    distinct = counted.groupBy("key", "packed").agg(F.sum("copies").alias("copies"), *place)
    distinct = written(spark, distinct, "distinct-strings")
    whole = distinct.where("copies > 1").select("key", "packed", F.col("copies").alias("n"))

    windows = distinct.select("copies", "packed").mapInArrow(lambda batches: _counted_windows(batches, window), _COUNTED)
    counts = windows.groupBy("key", "packed").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    again = written(spark, counts.where("copies > 1").select("key", "packed", "n"), "repeated-windows")
    once = distinct.where("copies = 1").select("_d", "_h", "start", "packed")

    def placed(hot: frozenset[bytes]) -> DataFrame:
        return once.mapInArrow(lambda batches: _placed_windows(batches, window, hot), _PIECE)

    return _repeated_spans(spark, whole, strings).union(_repeated_spans(spark, again, placed))


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs``: ``row`` (all its columns), ``n_words``, ``n_removed`` and ``kept``, the words left,
    joined by one blank.

    Every word goes that is covered by a window whose words also start anywhere else, in the same document or another.
    Windows are judged on the input. Words are what stands between ASCII white space, unchanged; null texts have none.
    Rows that repeat id and text are repeats of one another. An empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce("doc_id", F.lit(_FIRST_ID)).alias("_d"), text_hash(F.col("text")).alias("_h"), F.struct("*").alias("row")
    )
    texts = rows.select("_d", "_h", F.coalesce("row.text", F.lit("")).alias("text"))
    found = texts.mapInArrow(
        lambda batches: _minimisers(batches, window),
        "_d bigint, _h bigint, starts array<int>, counts array<int>, keys array<bigint>",
    )
    found = written(spark, found.where(F.size("keys") > 0), "minimisers")
    counted = found.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    repeated = written(spark, counted.where("n > 1"), "repeated-minimisers")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    limit = _limit(total)
    frequent = repeated.where(F.col("n") > limit).select("key")
    often = [row.key for row in frequent.collect()]

    # One number has a super-k-mer's first window and its number of windows, which is no larger than the window.
    each = found.select("_d", "_h", F.inline(F.arrays_zip("starts", "counts", "keys")))
    each = each.select(
        "_d",
        "_h",
        F.col("keys").alias("key"),
        (F.shiftleft(F.col("starts").cast("bigint"), window.bit_length()) + F.col("counts")).alias("number"),
    )
    if often:  # fewer than FREQUENT rows
        each = each.join(F.broadcast(frequent), "key", "left_anti")
    chosen = each.join(repeated.where(F.col("n") <= limit).select("key"), "key", "left_semi")
    chosen = chosen.groupBy("_d", "_h").agg(F.collect_set("number").alias("chosen"))
    # Whole rows here and below, so that both joins with the documents read one shuffle of them.
    at_text = rows.join(chosen, ["_d", "_h"]).select("_d", "_h", "row", "chosen")
    dealt = at_text.mapInArrow(lambda batches: _cut_strings(batches, window), _PIECE)
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    spans = dealt.mapInArrow(lambda batches: _count_buckets(batches, window), "_d bigint, _h bigint, span bigint")
    if often:
        spans = spans.union(_frequent_spans(spark, texts, often, window))
    spans = spans.groupBy("_d", "_h").agg(F.collect_set("span").alias("spans"))
    without = F.pandas_udf(_without, "n_words bigint, n_removed bigint, kept string")
    judged = rows.join(spans, ["_d", "_h"], "left").withColumn("_r", without("row", "spans"))
    return judged.select("row", "_r.n_words", "_r.n_removed", "_r.kept")
