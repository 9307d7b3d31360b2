"""Duplicate removal, fingerprints, scores and grades against brute force, with odd rows of every kind."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tablemill.llm import hmm, lempel_ziv, line_dedup, simhash, substrings, topk, toxicity
from tablemill.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{i}" for i in range(40))
ROWS = [
    (1, "One line that is long enough to match\nOther\n\nOther", "x"),
    (2, "One line that is long enough to mitch\nmore text", "x"),
    (3, f"a {PASSAGE} b", None),
    (4, f"c d {PASSAGE}", "x"),
    (5, None, "x"),
    (6, "", "x"),
    (None, f"a {PASSAGE} b", "x"),
    (7, "loop " * 90, "x"),
    (8, "One line that is long enough to match", "x"),
    (8, "One line that is long enough to match", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, kept string")


def _without(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append(b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


@pytest.mark.parametrize("bucket", [5000, 1])
def test_repeated_windows_of_many_texts(spark, monkeypatch, bucket):
    """Copies, near copies and a shared passage, with strings and windows on both sides of the bound."""
    monkeypatch.setattr(substrings, "BUCKET_STRINGS", bucket)
    rng = np.random.default_rng(7)
    words = [f"v{i}" for i in range(30)]
    long, shared = list(rng.choice(words, 120)), list(rng.choice(words, 50))
    texts = [" ".join(long)] * 4
    for i in range(6):
        near = list(long)
        near[int(rng.integers(0, 120))] = f"changed{i}"
        texts += [" ".join(near), " ".join([*rng.choice(words, 20), *shared, *rng.choice(words, 60)])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.row.doc_id: r.kept for r in substrings.without_repeats(spark, rows).collect()}
    assert got == dict(enumerate(_without(texts, 35)))


@pytest.mark.parametrize("bucket", [5000, 2, 1])
def test_repeated_windows(spark, docs, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET_STRINGS", bucket)
    got = substrings.without_repeats(spark, docs).collect()
    kept = dict(zip([r[1] for r in ROWS], _without([r[1] for r in ROWS], 35)))
    assert len(got) == len(ROWS)
    for r in got:
        assert r.kept == kept[r.row.text] and r.n_removed == r.n_words - len(r.kept.split())
    assert substrings.without_repeats(spark, docs.limit(0)).count() == 0


def _near(a, b):
    if len(a) < len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:]) and len(a) - len(b) <= 1


@pytest.mark.parametrize("left_chars", [576, 8])
def test_lines_of_any_length(spark, monkeypatch, left_chars):
    """Near lines of 1 to 100,000 characters against plain Python, edits at the start, the end and between."""
    monkeypatch.setattr(line_dedup, "LEFT_CHARS", left_chars)
    rng = np.random.default_rng(4)
    lines = ["a", "b", "ab", "abc", "xyz", "xyzw", "}", "});"]
    for size in (5, 20, 23, 24, 300, 1023, 1024, 1025, 5000, 100_000):
        line = "".join(rng.choice(list("abcdefgh é"), size)).strip() + "."
        for at in (0, 1, len(line) // 2, len(line) - 2, len(line) - 1):
            lines += [line[:at] + "Z" + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + "ZY" + line[at:]]
        lines.append(line)
    lines = [x.strip(" ") for x in lines if x.strip(" ")]
    order = rng.permutation(len(lines))
    texts = ["\n".join(lines[k] for k in part) for part in np.array_split(order, 12)]
    kept, seen = [], []
    for text in texts:
        own = []
        for line in text.split("\n"):
            if not any(abs(len(line) - len(x)) <= 1 and _near(line, x) for x in seen):
                own.append(line)
            seen.append(line)
        kept.append("\n".join(own))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.row.doc_id: r.kept for r in line_dedup.without_repeated_lines(rows).collect()}
    assert got == dict(enumerate(kept))
    equal = line_dedup.without_repeated_lines(rows, min_chars=10**6).agg({"n_removed": "sum"}).first()[0]
    assert equal == len(lines) - len(set(lines))


def test_lines(spark, docs):
    got = {(r.row.doc_id, r.row.text): r for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got[ROWS[0][:2]].kept == "One line that is long enough to match\nOther\n"
    assert got[ROWS[1][:2]].kept == "more text"
    assert got[ROWS[4][:2]].kept is None and got[ROWS[5][:2]].kept == ""
    assert got[ROWS[8][:2]].kept == "" and got[ROWS[8][:2]].n_removed == 1
    assert got[ROWS[6][:2]].kept == ""  # the null id comes after the equal text of document 3
    assert line_dedup.without_repeated_lines(docs.limit(0)).count() == 0


def test_near_lines_by_edit_distance(spark):
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdé "), 30)).strip().ljust(26, "z") for _ in range(12)]
    lines = []
    for line in base:
        i = int(rng.integers(0, len(line)))
        lines += [line, line[:i] + "Q" + line[i + 1 :], line[:i] + line[i + 1 :], line[:i] + "RR" + line[i + 2 :]]
    rows = [(i, line) for i, line in enumerate(lines)]
    got = {r.row.doc_id for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.n_removed}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    trimmed = [line.strip() for line in lines]
    assert got == {
        j for j, b in enumerate(trimmed) for a in trimmed[:j] if a == b or len(a) > 23 and len(b) > 23 and edits(a, b) <= 1
    }


def test_simhash(spark, docs):
    got = simhash.near_duplicates(spark, docs).collect()
    by_text = {r[1]: simhash.fingerprint((r[1] or "").encode(), 3) for r in ROWS}
    assert len(got) == len(ROWS) and {r.fp % 2**64 for r in got} == set(by_text.values())
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert {r.component_id for r in got if r.doc_id in (3, None)} == {3}
    assert simhash.near_duplicates(spark, docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [4096, 3])
def test_hamming_links_join_all_within_three_bits(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    rng = np.random.default_rng(1)
    heads = rng.integers(0, 2**63, 20, dtype=np.uint64)
    prints = np.unique([h ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for h in heads for k in range(1, 8)])
    rows = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp bigint")
    parent = {int(p): int(p) for p in prints.view(np.int64)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in simhash.hamming_links(spark, rows).collect():
        assert (r.a ^ r.b).bit_count() <= 3 or ((r.a ^ r.b) % 2**64).bit_count() <= 3
        parent[root(r.a)] = root(r.b)
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if int(a ^ b).bit_count() <= 3:
                assert root(int(a.view(np.int64))) == root(int(b.view(np.int64)))


def test_lempel_ziv(spark, docs):
    got = lempel_ziv.compare_with_next(spark, docs).collect()
    assert len(got) == len(ROWS)
    eight = [r for r in got if r.doc_id == 8]
    assert len({r.fingerprint for r in eight}) == 1 and all(0 <= r.near_next <= 1 for r in got)
    two = next(r for r in got if r.doc_id == 2)
    text, following = ROWS[1][1], ROWS[0][1]
    half = len(text) // 2
    assert two.edited == text[: len(text) - half] + following[:half]
    assert two.edited_fingerprint == lempel_ziv.as_text(lempel_ziv.Parse(two.edited).fingerprint)
    last = next(r for r in got if r.doc_id is None)
    assert last.edited.endswith(ROWS[8][1][: len(ROWS[6][1]) // 2][-20:])
    assert lempel_ziv.compare_with_next(spark, docs.limit(0)).count() == 0


def test_phrases_by_definition():
    text = "abababcabcabcd" * 20
    seen, current = set(), ""
    for c in text:
        current += c
        if current not in seen:
            seen.add(current)
            current = ""
    parse = lempel_ziv.Parse(text)
    assert len(parse.ends) == len(seen)
    assert lempel_ziv.likeness(parse.fingerprint, parse.fingerprint) == 1.0


def test_hidden_markov_scores(spark):
    got = {r.doc_id: r for r in QUERIES["op3_hidden_markov"](spark, SF_DIR).collect()}
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in table(spark, SF_DIR, "documents").collect()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 5 == 1}
    counts = Counter(w for d, words in texts.items() if d not in held for w in words)
    n, v = counts.total(), len(counts)
    for d, words in texts.items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert got[d].held_out == (d in held) and got[d].n_tokens == len(words) and got[d].train_tokens == n
        assert got[d].n_known == sum(counts[w] > 0 for w in words) and got[d].base_score == pytest.approx(base)
    assert sum(got[d].score for d in held) > sum(got[d].base_score for d in held)


def test_hidden_markov_chances_add_up():
    rng = np.random.default_rng(0)
    emits = rng.random((hmm.CLASSES + 2, hmm.STATES))
    emits[3:] = 0
    model = hmm.Model(np.full(hmm.STATES, 1 / hmm.STATES), rng.dirichlet(np.ones(hmm.STATES), hmm.STATES), emits / emits.sum(axis=0))
    every = [np.array([a, b, c]) for a in range(3) for b in range(3) for c in range(3)]
    assert np.exp(hmm.log_likelihoods(model, every)).sum() == pytest.approx(1)


def test_hidden_markov_odd_rows(spark, docs):
    got = hmm.score_documents(spark, docs).collect()
    assert len(got) == len(ROWS) and all(math.isfinite(r.score) for r in got)
    assert hmm.score_documents(spark, docs.limit(0)).count() == 0


def test_hidden_markov_scores_do_not_depend_on_held_words(spark, docs, monkeypatch):
    """A task that hands words on after every row gives a word many rows of one chunk."""
    want = sorted(hmm.score_documents(spark, docs).collect(), key=str)
    monkeypatch.setattr(hmm, "HELD_WORDS", 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        corpus = hmm.read_corpus(spark, docs)
        got = sorted(hmm.score_documents(spark, docs).collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert corpus.mass[hmm.END_CLASS] > 1
    for a, b in zip(want, got, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_severity(spark):
    rows = [(i, f"word{i % 7} plain text " + ("awful" if i % 3 == 0 else "fine") + (" dreadful" if i % 6 == 0 else "")) for i in range(120)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 2 if i % 6 == 0 else int(i % 3 == 0)) for i in range(60)], "doc_id bigint, grade int")
    model = toxicity.fitted(spark, docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].grade == (2 if i % 6 == 0 else int(i % 3 == 0)) for i in range(120))
    assert got[500].p_any < 0.5 and got[501].p_any < 0.5
    assert toxicity.score(docs, toxicity.fitted(spark, docs, labels.limit(0))).where("severity != 0").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_ROWS", 16)
    monkeypatch.setattr(topk, "ANNULUS_ROWS", 4)
    monkeypatch.setattr(topk, "PIVOT_SAMPLE", 30)
    rng = np.random.default_rng(2)
    vectors = np.repeat(rng.normal(size=(60, 5)), 3, axis=0).round(1)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (920, [1.0, None, 0.0, 0.0, 0.0]), (940, [math.nan] * 5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(spark, frame, 7, lambda i: i % 20 == 0).collect()}
    whole = np.floor(64 * vectors).astype(int)
    want = {}
    for q in range(0, len(whole), 20):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(len(whole)) if i != q)[:7]
        want.update({(q, rank): (i, -s) for rank, (s, i) in enumerate(best, 1)})
    assert got == want
    assert topk.top_k(spark, frame.limit(0), 7, lambda i: i % 20 == 0).count() == 0


def test_copies_of_a_vector_are_cut_beside_others(spark, monkeypatch):
    """A third of the rows at one distance share their part with other distances."""
    monkeypatch.setattr(topk, "CELL_ROWS", 16)
    rows = [(i, 0, 1.0 if i % 3 == 0 else 1.0 + i / 1000) for i in range(1500)]
    index, cells = topk._cut(spark.createDataFrame(rows, "vec_id bigint, pivot int, distance double"))
    got = index.groupBy("cell").count().collect()
    assert sum(r["count"] for r in got) == 1500 and max(r["count"] for r in got) <= 6 * 16
    bounds = {cell: (low, high) for cell, _, low, high in cells}
    assert all(bounds[r.cell][0] <= r.distance <= bounds[r.cell][1] for r in index.collect())


def test_null_and_blank_texts_are_not_toxic_whatever_the_labels(spark):
    rows = [(i, f"bad words here {i}", 1) for i in range(40)] + [(100 + i, "good and calm", 1) for i in range(5)]
    rows += [(200, None, 1), (201, "", 1), (202, " \n\t", 1), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, grade int")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(5)], "doc_id bigint, grade int")
    kept = {r.doc_id for r in toxicity.without_toxic(docs, toxicity.fitted(spark, docs, labels)).collect()}
    assert kept >= {200, 201, 202, None} and not kept & set(range(40))


def test_labelled_rows_are_bounded_where_ids_repeat(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, grade int")
    assert toxicity.labelled_features(spark, docs, labels, 2).count() == 2
