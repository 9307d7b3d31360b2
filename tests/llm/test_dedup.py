"""Exact dedup against plain Python, and the filters by themselves."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm import binary_fuse, exact_dedup

LONG = "long " * 40_000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 70_000])
def test_filters_hold_all_their_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys, others = (rng.integers(0, 2**64, size, dtype=np.uint64) for size in (n, 50_000))
    made = binary_fuse.build(np.concatenate([keys, keys[:5]]))
    assert made.may_hold(keys).all() and made.may_hold(others).mean() < 0.008
    assert n < 1000 or len(made.values) < 1.5 * n


def _plain(rows):
    groups: dict = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = Counter()
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out[doc_id, hashlib.sha256((text or "").encode()).hexdigest(), keep, len(ids), doc_id == keep] += 1
    return out


DELIVERIES = [
    [(1, "a"), (2, "a"), (3, None), (4, ""), (5, LONG), (None, "null id"), (6, "twice"), (6, "twice"), (7, "x\x00y")],
    [(9, "a"), (8, "new"), (10, "new"), (None, "null id"), (11, LONG), (12, LONG + "."), (13, " a"), (2, "é")],
    [(0, "new"), (20, "é"), (21, "A"), (None, "a"), (22, "only here")] + [(100 + i, "hot") for i in range(300)],
]


def _one_byte(text):
    """A digest that most texts share with others."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 1).cast("string"))


@pytest.mark.parametrize("deliveries", [[0], [0, 1], [0, 1, 2], [2, 1, 0], [0, 0]])
def test_copies_over_deliveries(spark, monkeypatch, deliveries):
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 2)
    rows = [DELIVERIES[k] for k in deliveries]
    frames = [
        spark.createDataFrame([(*r, "x", 5) for r in each], "doc_id bigint, text string, digest string, n int").repartition(3)
        for each in rows
    ]
    got = exact_dedup.judge_copies(spark, frames)
    named = got.select("doc_id", F.lower(F.hex("digest")), "keep_id", "group_size", "kept")
    assert Counter(map(tuple, named.collect())) == _plain([r for each in rows for r in each])


def test_digests_that_stand_for_several_texts(spark):
    rows = [r for each in DELIVERIES[:2] for r in each if r[1] != LONG]
    frames = [spark.createDataFrame(rows[k::2], "doc_id bigint, text string") for k in range(2)]
    got = exact_dedup.judge_copies(spark, frames, digest=_one_byte).collect()
    wanted = Counter((d, k, n, kept) for (d, _, k, n, kept), times in _plain(rows).items() for _ in range(times))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == wanted


def test_empty_deliveries_and_kept_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id bigint, text string")
    none = docs.limit(0)
    assert exact_dedup.judge_copies(spark, [none, none]).count() == 0
    for deliveries in ([none, docs], [docs, none]):
        judged = exact_dedup.judge_copies(spark, deliveries)
        assert {r.doc_id for r in exact_dedup.without_copies(docs, judged).collect()} == {2, 3}
