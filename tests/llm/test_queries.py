"""The registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tablemill.llm import simhash
from tablemill.llm.encoding import word_encoder
from tablemill.llm.queries import ORACLES, QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for view in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF_DIR}/{view}.parquet')")
    theirs = connection.sql(ORACLES[name])
    ours = QUERIES[name](spark, SF_DIR).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


def test_all_are_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry_module.queries()


def test_pipeline_stages(spark):
    rows = table(spark, SF_DIR, "documents")
    columns = rows.dtypes
    before = {r.doc_id: r.text for r in rows.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, SF_DIR).collect(), rows.schema)
        assert rows.dtypes == columns, name
        after = {r.doc_id: r.text for r in rows.collect()}
        assert set(after) <= set(before) and after
        before = after
    pieces = corpus_pipeline.packing_stage(spark, rows, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == set(before)


def _near_copies():
    rng = np.random.default_rng(11)
    texts = [None, "", "two words", "Two  words"]
    for b in range(12):
        words = [f"b{b}w{i}" for i in rng.integers(0, 400, 300)]
        texts.append(" ".join(words))
        for changed in range(1, 10):
            near = list(words)
            for at in rng.choice(300, changed, replace=False):
                near[at] = f"c{b}x{changed}y{at}"
            texts.append(" ".join(near))
    return texts


def test_near_duplicate_stage(spark):
    """Copies with some words changed, on both sides of three bits, against all pairs compared in plain Python."""
    texts = _near_copies()
    prints = [simhash.fingerprint((t or "").encode(), 3) for t in texts]
    group = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group = [group[i] if g == group[j] else g for g in group]
    rows = [(i, t, 77 + i, 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row bigint, n bigint").repartition(3)
    got = {tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR).collect()}
    first = {min(i for i, g in enumerate(group) if g == wanted) for wanted in set(group)}
    assert got == {rows[i] for i in first} and 14 < len(first) < len(texts)


PASSAGE = " ".join(f"p{i}" for i in range(40))
LABELLED = [f"{i}plain {i * i}words" for i in range(60)] + [f"vile curse {i} at you" for i in range(40)]
ODD = [
    (1, f"first {PASSAGE} one\nThe same line here, more or less"),
    (2, f"second {PASSAGE} two\nThe same line there, more or less\nanother"),
    (3, "The same line hers, more or less\nvaried ends"),
    (4, "such a vile curse at you"),
    (5, None),
    (6, ""),
    (7, " \n\t"),
    (None, "a row without id"),
    (None, None),
    (8, "twice the same row"),
    (8, "twice the same row"),
    (9, " ".join(f"long{i % 9000}" for i in range(30_000))),
]
CLASHES = "_row int, row string, n int, kept string, grade int, p_any double, fp bigint, component_id bigint, n_chars bigint"


def _odd_rows(rows):
    return [(i, t, 1, "r", 2, "k", 2, 0.9, 3, 4, len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder with labels that call the words of ``LABELLED``'s second half toxic."""
    folder = str(tmp_path_factory.mktemp("labelled"))
    source = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    values = {"doc_id": lambda i: 1000 + i, "toxic": lambda i: i >= 60}
    sample = source.first().asDict()
    rows = []
    for i in range(len(LABELLED)):
        own = dict(sample)
        own.update({c: type(sample[c])(f(i)) for c, f in values.items() if c in sample})
        rows.append(tuple(own[c] for c in source.columns))
    spark.createDataFrame(rows, source.schema).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_by_plain_python(spark, labelled, name):
    """Null ids and texts, blank and long texts, repeated rows and clashing columns, then no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    extra = [(1000 + i, t) for i, t in enumerate(LABELLED)] if name == "toxicity" else []
    rows = _odd_rows(ODD + extra)
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, {CLASHES}").repartition(3)
    out = stage(spark, docs, labelled)
    got = out.collect()
    if name == "packing":
        tokenizer = word_encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer
        want = Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in ODD)
        pieces = Counter()
        for r in got:
            pieces[r.doc_id, r.doc_tokens] += r.length
        assert pieces == Counter({key: key[1] * n for key, n in want.items()})
    else:
        assert out.dtypes == docs.dtypes
        assert all(tuple(r)[2:10] == rows[0][2:10] for r in got)
        kept = sorted(((r.doc_id, r.text) for r in got), key=str)
        texts = dict(ODD)
        if name == "toxicity":
            want = [(i, t) for i, t in ODD + extra[:60] if i != 4]
        elif name == "line_dedup":
            want = [(i, t) for i, t in ODD if i not in (2, 3)]
            want += [(2, f"second {PASSAGE} two\nanother"), (3, "varied ends")]
        elif name == "simhash_near_dedup":
            want = [(i, t) for i, t in ODD if i in (1, 2, 3, 4, 5, 9) or i is None and t]
            want.append((8, texts[8]))
        else:
            one, two = (texts[i].replace("\n", " ").replace(f"{PASSAGE} ", "") for i in (1, 2))
            long = " ".join(f"long{i % 9000}" for i in range(30_000)).split()
            places = Counter(i % 9000 for i in range(30_000 - 34))
            gone = {i + k for i in range(30_000 - 34) if places[i % 9000] > 1 for k in range(35)}
            rest = " ".join(w for i, w in enumerate(long) if i not in gone)
            want = [(i, t) for i, t in ODD if i not in (1, 2, 9)] + [(1, one), (2, two), (9, rest)]
        assert kept == sorted(want, key=str)
    assert stage(spark, docs.limit(0), labelled).count() == 0
