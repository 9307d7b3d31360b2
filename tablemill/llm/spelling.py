"""Spelling variants: words one edit apart, by dense comparison of blocks of words.

A word of a block is a row of a padded matrix of code points. Blocks are compared along their diagonals, whole columns
of pairs at once: of two words, the lengths of the common prefix and the common suffix are found, and where they reach
the longer length minus one the words differ by one inserted, deleted or replaced code point.

Blocks are made so that no pair is lost and none is met twice. One edit in the longer one's m code points leaves the
first or the last floor(m / 2) as they are, so a word goes to the blocks of its beginning and of its end, for m its own
length and one more. A pair with a common beginning is left to that block alone. A block of more than ``BLOCK_WORDS``
is not compared but divided in the same way by what its words do not share yet, until it is small or but two code
points are left open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import shuffle_partitions, written

MIN_CHARS = 7
MIN_COUNT = 2
#: A form has at least so many times the occurrences of its variant.
FORM_RATIO = 10
#: One in so many (document, word) has a code point deleted, which decides what a misspelling is in the tables given.
DELETED_IN = 31

BLOCK_WORDS = 256
#: Bytes of matrix cells that are compared at once, and of words that a task counts before it hands counts on.
_CELLS, _COUNTED_BYTES = 1 << 21, 48 << 20

#: Fixed: letters of words as ISO 8859-1 bytes, with A-Z lowered; all else parts words.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)

_BLOCK = ["m", "key", "low", "high", "limit"]
_LINKS = "word string, other string, other_n bigint"


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Words with their numbers of occurrences. Code points above U+00FF become ``?``, which no word has."""
    counts: dict[bytes, int] = {}
    held = 0

    def flush():
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.record_batch([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if (text := text.as_py()) is None:
                continue
            state = zlib.crc32(f"{doc_id}:".encode())
            for word in text.encode("latin-1", "replace").translate(_LETTERS).split():
                if len(word) < MIN_CHARS:
                    continue
                h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), state)
                if not h % DELETED_IN:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < MIN_CHARS:
                        continue
                if word in counts:
                    counts[word] += 1
                else:
                    counts[word] = 1
                    held += len(word) + 120
            if held > _COUNTED_BYTES:
                yield flush()
                counts.clear()
                held = 0
    if counts:
        yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words of at least ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counted = rows.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _divided(rows: DataFrame, lengths) -> DataFrame:
    """Each row in the blocks of the beginning and the end that a partner shares beyond ``low`` and ``high``.

    ``limit`` is the common prefix that a pair must not reach, because it is met in another block then."""
    each = rows.withColumn("m", F.explode(lengths)).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    part = F.floor((F.col("m") - F.col("low") - F.col("high")) / 2).cast("int")
    first, length = F.col("side") == 0, F.length("word")
    shared = F.when(first, F.substring(F.col("word"), F.col("low") + 1, part)).otherwise(
        F.substring(F.col("word"), length - F.col("high") - part + 1, part)
    )
    return each.select(
        "word",
        "n",
        "m",
        F.xxhash64("m", "key", "side", shared).alias("key"),
        F.when(first, F.col("low") + part).otherwise(F.col("low")).alias("low"),
        F.when(first, F.col("high")).otherwise(F.col("high") + part).alias("high"),
        F.when(first, F.col("limit")).otherwise(F.least("limit", F.col("low") + part)).alias("limit"),
    )


def _compared(words: list[bytes], blocks: np.ndarray, m: int, low, high, limit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of words one edit apart. ``blocks`` tells the block of each word, equal ones side by side; the
    longer word of a pair has ``m`` code points. ``low`` and ``high`` are what a block's pairs share at least, as
    hashed keys do not prove it."""
    lengths = np.array([len(w) for w in words])
    left = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(-1, m)
    right = np.frombuffer(b"".join(w[::-1].ljust(m, b"\0") for w in words), np.uint8).reshape(-1, m)
    last = np.searchsorted(blocks, blocks, "right")
    at, step = np.arange(len(words)), max(1, _CELLS // m)
    for d in range(1, len(words)):
        at = at[at + d < last[at]]
        if not len(at):
            return
        for start in range(0, len(at), step):
            a = at[start : start + step]
            a = a[(lengths[a] == m) | (lengths[a + d] == m)]
            b = a + d
            shorter = np.minimum(lengths[a], lengths[b])
            prefix = _common(left[a], left[b], shorter)
            suffix = _common(right[a], right[b], shorter)
            near = prefix + suffix >= m - 1
            near &= (prefix >= low[a]) & (prefix < limit[a]) & (suffix >= high[a])
            if near.any():
                yield a[near], b[near]


def _common(a: np.ndarray, b: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """How many first code points are equal, row by row."""
    differ = a != b
    first = differ.argmax(axis=1)
    return np.where(differ[np.arange(len(a)), first], first, shorter) if len(a) else first


def _links_of_blocks(batches) -> Iterator[pa.RecordBatch]:
    """Both directions of the links in the blocks of sorted rows."""
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in [*_BLOCK, "word", "n"])))
        end = len(rows)
        while end and rows[end - 1][:5] == rows[-1][:5]:
            end -= 1
        held = rows[end:]
        yield from _links_of_rows(rows[:end])
    yield from _links_of_rows(held)


def _links_of_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Runs of whole blocks of one ``m`` are compared together, up to a bound of matrix cells and one block more."""
    start = 0
    while start < len(rows):
        m, end, border = rows[start][0], start + 1, start
        while end < len(rows) and rows[end][0] == m:
            if rows[end][:5] != rows[end - 1][:5]:
                border = end
                if (end - start) * m > _CELLS:
                    break
            end += 1
        else:
            border = end
        part = rows[start:border]
        start = border
        changes = [0, *(a[:5] != b[:5] for a, b in zip(part, part[1:]))]
        words = [r[5].encode("latin-1") for r in part]
        low, high, limit = (np.array([r[k] for r in part]) for k in (2, 3, 4))
        for a, b in _compared(words, np.cumsum(changes), m, low, high, limit):
            one, two = [part[k] for k in a.tolist()], [part[k] for k in b.tolist()]
            columns = [
                pa.array([r[5] for r in one + two], pa.string()),
                pa.array([r[5] for r in two + one], pa.string()),
                pa.array([r[6] for r in two + one], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["word", "other", "other_n"])


def near_words(spark: SparkSession, vocabulary: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, other, other_n`` for all two words of ``vocabulary`` (``word, n``, each word once) one edit apart, in both
    directions. A block too large to be compared is never gathered: its rows are told by its size, which tasks count
    before they hand it on, and are divided where they are."""
    n = F.length("word")
    whole = vocabulary.select("word", "n", F.lit(0).alias("key"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    rows = _divided(whole.withColumn("limit", F.lit((1 << 31) - 1)), F.array(n, n + 1))
    found = None
    while rows is not None:
        rows = written(spark, rows, "blocks")
        sizes = rows.groupBy(*_BLOCK).agg(F.count("*").alias("size")).where("size > 1")
        sizes = written(spark, sizes, "sizes")
        large = f"size > {block_words} AND m - low - high > 2"
        joined = rows.join(sizes, _BLOCK)  # a word alone in its block has no partner there
        small = joined.where(f"NOT ({large})").drop("size")
        small = small.repartition(shuffle_partitions(spark), "key").sortWithinPartitions(*_BLOCK, "word")
        links = written(spark, small.mapInArrow(_links_of_blocks, _LINKS), "links")
        found = links if found is None else found.union(links)
        divided = _divided(joined.where(large).drop("size"), F.array("m"))
        rows = None if sizes.where(large).isEmpty() else divided
    return found


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of all words with a form. Forms are followed by doubling: each round goes twice as far."""
    state = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = state.join(further, F.col("root") == F.col("_word"), "left")
        moved = joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_word").isNotNull().alias("on"))
        moved = written(spark, moved, "roots")
        if moved.where("on").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of at least ``MIN_CHARS`` letters and ``MIN_COUNT``
    occurrences in all texts.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lowered, some with one code point deleted as
    the document id (null: empty text) and the word decide. Near words differ by exactly one inserted, deleted or
    replaced code point. The form is the near word of the largest ``n``, ties to the smaller word, if it has at least
    ``FORM_RATIO`` times the occurrences; ``root`` follows forms to the last and is the word itself without one.
    Null and empty texts have no words; repeated rows count each time; words may be of any length. Other columns are
    not looked at. An empty table gives no rows.
    """
    vocabulary = written(spark, word_counts(docs), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = near_words(spark, vocabulary, block_words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    has = -F.col("best.less") >= FORM_RATIO * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word",
        F.when(has, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(has, -F.col("best.less")).alias("form_n"),
    )
    judged = written(spark, judged, "judged")
    roots = _roots(spark, judged.where("form IS NOT NULL"))
    root = F.coalesce("root", "word").alias("root")
    return judged.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
