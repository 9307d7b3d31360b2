"""Importance resampling against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from tablemill.llm import resampling
from tablemill.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def _features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _plain(docs, target, percent, min_words=20, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    def totals(texts):
        return Counter(bucket(f) for t in texts for f in _features(t)[1])

    s, t = totals(text for _, text in docs), totals(target)
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + buckets) / (float(s[b] + 1) * float(t_all + buckets))))

    rows = []
    for doc_id, text in docs:
        words, found = _features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words) >= min_words])
    eligible = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def test_query_equals_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    target = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    got = QUERIES["op11_head_tail"](spark, SF_DIR)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, got.collect())) == _plain(docs, target, 25)


ODD = [
    (1, "Aa bb AA bb " * 30),
    (2, None),
    (3, ""),
    (4, "-- !! \n"),
    (5, "x" * 70 + " é中文 " + "y" * 300 + " a " * 25),
    (6, "word " * 60_000),
    (None, "null id of twenty words " * 5),
    (None, "null id of twenty words " * 5),
    (7, "null id of twenty words " * 5),
    (7, "null id of twenty words " * 5),
    (8, "nul\x00byte À À " * 10),
]


@pytest.mark.parametrize("head, pairs, tail", [(16_384, 1024, 8 << 20), (3, 2, 0), (1, 0, 50)])
def test_odd_rows_with_any_head(spark, monkeypatch, head, pairs, tail):
    """Whatever is in the head, and with a tail that is forgotten at once, results are those of plain Python."""
    monkeypatch.setattr(resampling, "_TAIL_BYTES", tail)
    monkeypatch.setattr(resampling, "_CHUNK_BYTES", 500)
    found = resampling.head_vocabulary
    monkeypatch.setattr(resampling, "head_vocabulary", lambda docs: found(docs, head, pairs))
    docs = spark.createDataFrame([(*row, 9, 9) for row in ODD], "doc_id bigint, text string, rank int, _row int")
    target = spark.createDataFrame([("aa bb of words", 1), (None, 1)], "text string, n int")
    got = resampling.resample(spark, docs.repartition(3), target, percent=60)
    assert Counter(map(tuple, got.collect())) == _plain(ODD, ["aa bb of words", None], 60)


def test_empty_tables(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string")
    none = docs.limit(0).select("text")
    assert resampling.resample(spark, docs.limit(0), docs).count() == 0
    assert Counter(map(tuple, resampling.resample(spark, docs, none).collect())) == _plain(ODD, [], 25)


def test_head_is_bounded_and_counts_all(spark):
    texts = [(" ".join(f"w{i % 7}" for i in range(k)),) for k in range(50)] + [("z" * 100 + " ",)] * 900
    head = resampling.head_vocabulary(spark.createDataFrame(texts, "text string").repartition(4), 20, 3)
    assert set(head.words) == {f"w{i}".encode() for i in range(7)} and head.n_pairs == 3
    for i, a in enumerate(head.words[:3]):
        for j, b in enumerate(head.words[:3]):
            assert head.pair_buckets[3 * i + j] == zlib.crc32(a + b" " + b) % 10_000
