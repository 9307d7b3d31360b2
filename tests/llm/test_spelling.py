"""Spelling variants against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablemill.llm import spelling
from tablemill.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def _words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def _plain(counts):
    """Near words by their deletion variants, each pair verified by trying all edits."""
    by_variant = {}
    for w in counts:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_variant.setdefault(v, set()).add(w)
    near = {w: set() for w in counts}
    for group in by_variant.values():
        for a in group:
            near[a] |= {b for b in group if _one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    rows = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return rows


def _one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_query_equals_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    got = QUERIES["op13_prefix_suffix"](spark, SF_DIR)
    assert got.dtypes == [
        ("word", "string"),
        ("form", "string"),
        ("root", "string"),
        ("n", "bigint"),
        ("n_near", "bigint"),
        ("form_n", "bigint"),
    ]
    rows = list(map(tuple, got.collect()))
    assert len(rows) == len(set(rows)) and set(rows) == _plain(_words(docs))


@pytest.mark.parametrize("block_words", [256, 8, 1])
def test_crowded_blocks(spark, monkeypatch, block_words):
    """Words of two letters share most beginnings and ends, so blocks are divided several times over."""
    monkeypatch.setattr(spelling, "_CELLS", 500)
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(["a", "b"], size)) for size in rng.integers(7, 12, 500)}
    words |= {"é" * 7, "é" * 8, "a" * 3000, "a" * 3001, "a" * 2999 + "b", "×÷ÀÿABCDE".lower()}
    counts = {w: int(n) for w, n in zip(sorted(words), 2 ** rng.integers(1, 12, len(words)))}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    got = [tuple(r) for r in spelling.near_words(spark, vocabulary, block_words).collect()]
    wanted = {(a, b, counts[b]) for a in words for b in words if _one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 1000


def test_odd_rows(spark):
    chain = "colours " * 200 + "colour s colouurs " + "coloours " * 20 + "colooors colooors " + "COLOURs"
    docs = [
        (1, chain),
        (2, None),
        (3, ""),
        (4, "12345678 -- 中文 short"),
        (None, "unknown unknown"),
        (None, "unknown unknown"),
        (5, "Ärgerlich Ärgerlich ärgerlich ärgerlich"),
        (6, "z" * 50_000 + " " + "z" * 50_000 + " " + "longest " * 40_000),
        (6, "repeated row"),
        (6, "repeated row"),
    ]
    rows = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, word string, n int")
    got = spelling.spelling_variants(spark, rows.repartition(4))
    assert set(map(tuple, got.collect())) == _plain(_words(docs))
    assert spelling.spelling_variants(spark, rows.limit(0)).count() == 0


def test_forms_are_followed_to_the_last(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("x", "w3"), ("y", "z")]
    got = spelling._roots(spark, spark.createDataFrame(forms, "word string, form string"))
    assert dict(map(tuple, got.collect())) == {**{w: "w19" for w, _ in forms}, "y": "z"}
