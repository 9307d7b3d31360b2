"""The queries of this package, each over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import (
    exact_dedup,
    hmm,
    lempel_ziv,
    line_dedup,
    packing,
    pieces,
    resampling,
    simhash,
    simple8b,
    spelling,
    substrings,
    topk,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simple8b(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    read = simple8b.token_blocks(spark, table(spark, sf_dir, "documents"), path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_super_kmers(spark, sf_dir):
    rows = substrings.without_repeats(spark, table(spark, sf_dir, "documents"))
    return rows.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_hidden_markov(spark, sf_dir):
    return hmm.score_documents(spark, table(spark, sf_dir, "documents"))


@query
def op4_shared_prefix(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.decode_pieces(pieces.encode_pieces(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


@query
def op5_sum_of_squares(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_pivot_distance(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(spark, vectors, 20, lambda vec_id: vec_id % 20 == 0)


ORACLES["op7_pivot_distance"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op8_cumulative_link(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fitted(spark, docs, toxicity.grades(labels))
    return toxicity.score(docs, model).withColumn("toxic", F.col("p_any") >= 0.5)


@query
def op9_lempel_ziv(spark, sf_dir):
    rows = lempel_ziv.compare_with_next(spark, table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query
def op10_deletion_lines(spark, sf_dir):
    rows = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return rows.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Pairs are looked for among lines that share a half, since one edit leaves one of the halves as it is. Behind the
# characters that two lines have in common from the start, one edit leaves the same rest. Document ids are unique in the
# driver's tables, so the order by the text's hash plays no part.
ORACLES["op10_deletion_lines"] = r"""
WITH cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
), firsts AS (
    SELECT line, min(row(doc_id, pos)) AS place, length(line) AS n
    FROM (SELECT doc_id, pos, trim(raw, ' ') AS line FROM cut) WHERE line <> '' GROUP BY line
), halves AS (
    SELECT DISTINCT line, place, n, s.side, h.h, CASE WHEN s.side = 0 THEN left(line, h.h) ELSE right(line, h.h) END AS half
    FROM firsts, (SELECT unnest([0, 1]) AS side) s,
         LATERAL (SELECT unnest([greatest(n - 2, 0) // 2, (n - 1) // 2, n // 2]) AS h) h
), pairs AS (
    SELECT DISTINCT a.line, a.n, b.line AS other, b.n AS other_n FROM halves a JOIN halves b
      ON a.side = b.side AND a.h = b.h AND a.half = b.half AND b.place < a.place AND abs(a.n - b.n) <= 1
), common AS (
    SELECT *, coalesce(list_position(list_transform(list_zip(string_split(line, ''), string_split(other, '')),
                                                    lambda x: x[1] IS NOT DISTINCT FROM x[2]), false), n + 1) AS differs
    FROM pairs
), near AS (
    SELECT DISTINCT line FROM common
    WHERE CASE WHEN n = other_n THEN substr(line, differs + 1) = substr(other, differs + 1)
               WHEN n > other_n THEN substr(line, differs + 1) = substr(other, differs)
               ELSE substr(line, differs) = substr(other, differs + 1) END
), judged AS (
    SELECT c.doc_id, c.pos, c.raw,
           trim(c.raw, ' ') = '' OR (f.place = row(c.doc_id, c.pos) AND n.line IS NULL) AS stays
    FROM cut c LEFT JOIN firsts f ON f.line = trim(c.raw, ' ') LEFT JOIN near n ON n.line = f.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op11_head_tail(spark, sf_dir):
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_binary_fuse(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    rows = exact_dedup.judge_copies(spark, [docs.where(half == 0), docs.where(half == 1)])
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op12_binary_fuse"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op13_prefix_suffix(spark, sf_dir):
    return spelling.spelling_variants(spark, table(spark, sf_dir, "documents"))
