"""Severity grades of texts by cumulative-link ordinal regression on sparse word features.

The chance that a text's grade is at least k is ``sigmoid(w . x - t_k)``: the grades share the weights ``w`` and have
ordered thresholds ``t_1 < t_2 < ...``. ``x`` tells which of the chosen words the text has. The expected severity is
the sum of these chances.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import WORD_PATTERN, binary_column, written

#: The model is fitted on at most so many labelled documents, those whose id has the smallest hashes.
MAX_LABELLED = 20_000
#: Of the words in at least ``MIN_DOCS`` of them, so many with the strongest link to the grade are features.
MAX_FEATURES = 2048
MIN_DOCS = 5
#: Lengths of the beginnings of words that are features beside the words.
BEGINNINGS = (4, 5, 6)

STEPS = 400
RATE = 0.1
PENALTY = 0.05

_EDGES = b".,;:!?\"'()[]{}<>*_-"
_MEMO_WORDS = 60_000

SEVERITY = "severity double, grade int, p_any double"


@dataclass(frozen=True)
class OrdinalModel:
    """``features`` are word hashes in ascending order; ``thresholds`` has one entry per grade above 0."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """Chances of at least grade 1, 2, ... for texts of these sums of weights."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings, which inflected and compounded words share. Words differ neither by the
    case of A-Z nor by punctuation around them."""
    whole = word.strip(_EDGES)
    letters = whole.decode("utf-8", "replace")
    starts = {whole, *(letters[:n].encode() + b"~" for n in BEGINNINGS if len(letters) >= n)}
    return tuple(xxhash.xxh64_intdigest(s) >> 1 for s in starts)


def labelled_features(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """``doc_id, grade, features`` of the labelled documents with the smallest hashes of ids, as a written table.

    Their number is bounded, so the labels are broadcast and no text is shuffled. Labels without id or grade are left
    out; of several grades of one document the highest counts.
    """
    chosen = labels.where("doc_id IS NOT NULL AND grade IS NOT NULL")
    chosen = chosen.groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # An id that several rows have stands for the first of their texts, so the bound holds for rows, too.

    def run(batches):
        for batch in batches:
            words = [set(raw.lower().split()) for raw in binary_column(batch, "text")]
            found = [sorted({f for w in each for f in word_features(w)}) for each in words]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "grade", "features"],
            )

    named = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    place = F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    rows = named.groupBy("doc_id").agg(F.first("grade").alias("grade"), F.min_by("text", place).alias("text"))
    rows = rows.select("doc_id", "text", "grade")
    return written(spark, rows.mapInArrow(run, "doc_id bigint, grade int, features array<bigint>"), "labelled")


def chosen_features(rows: DataFrame) -> np.ndarray:
    """The features whose documents' mean grade is farthest from the mean of all, by its standard error."""
    whole = rows.agg(F.avg("grade").alias("mean"), F.stddev_pop("grade").alias("sd")).first()
    if not whole.sd:
        return np.empty(0, np.int64)
    each = rows.select("grade", F.explode("features").alias("feature")).groupBy("feature")
    each = each.agg(F.count("*").alias("n"), F.avg("grade").alias("mean")).where(F.col("n") >= MIN_DOCS)
    z = F.abs(F.col("mean") - whole.mean) * F.sqrt("n") / whole.sd
    best = each.orderBy(z.desc(), "feature").limit(MAX_FEATURES).select("feature").collect()
    return np.sort(np.array([row.feature for row in best], np.int64))


def fit(chosen: np.ndarray, features: list[list[int]], grades: list[int]) -> OrdinalModel:
    """Penalized maximum likelihood by full-batch steps. ``features`` are those of ``chosen`` that each text has.

    Without two different grades there are no weights, and the severity is the one grade (0 if there are no labels).
    """
    y = np.array(grades, np.int64)
    top = int(y.max()) if len(y) else 0
    if len(np.unique(y)) < 2:
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.full(top, -500.0))
    rows = np.repeat(np.arange(len(y)), [len(f) for f in features])
    cols = np.searchsorted(chosen, np.array([v for f in features for v in f], np.int64))

    n, k = len(y), len(chosen)
    share = np.array([(y >= g).mean() for g in range(1, top + 1)]).clip(1 / (2 * n), 1 - 1 / (2 * n))
    first = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(first), 1e-3))  # thresholds keep their order
    params = np.concatenate([np.zeros(k), first[:1], gaps])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, thresholds = params[:k], _thresholds(params[k:])
        score = np.bincount(rows, weights[cols], n)
        d_score, d_thresholds = _slopes(score, thresholds, y)
        slope = np.empty_like(params)
        slope[:k] = np.bincount(cols, d_score[rows], k) - PENALTY * weights
        later = np.cumsum(d_thresholds[::-1])[::-1]
        slope[k] = later[0]
        slope[k + 1 :] = later[1:] * np.exp(params[k + 1 :])
        slope /= n
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        params = params + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return OrdinalModel(chosen, params[:k].copy(), _thresholds(params[k:]))


def _thresholds(params: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([params[:1], np.exp(params[1:])]))


def _slopes(score: np.ndarray, thresholds: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the log likelihood in each score and each threshold."""
    n, top = len(score), len(thresholds)
    above = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - thresholds), np.zeros((n, 1))], axis=1)
    upper, lower = above[np.arange(n), y], above[np.arange(n), y + 1]
    chance = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
    d_thresholds = np.zeros(top + 2)
    np.add.at(d_thresholds, y, -d_upper)
    np.add.at(d_thresholds, y + 1, d_lower)
    return d_upper - d_lower, d_thresholds[1:-1]


def severity_of(model: OrdinalModel):
    """A column function of a text: ``severity``, the expected grade, ``grade``, the likeliest one (of equal ones the
    lowest), and ``p_any``, the chance of any grade above 0. Null texts have no words."""
    place = {int(f): i for i, f in enumerate(model.features)}
    weights = model.weights
    memo: dict[bytes, tuple[int, ...]] = {}

    def total(text: str | None) -> float:
        words = set((text or "").encode().lower().split())
        new = words.difference(memo)
        if len(memo) + len(new) > _MEMO_WORDS:
            memo.clear()
            new = words
        memo.update((w, tuple(place[f] for f in word_features(w) if f in place)) for w in new)
        return weights[sorted(set().union(*map(memo.__getitem__, words)))].sum()

    @F.pandas_udf(SEVERITY)
    def run(texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        above = model.at_least(np.array([total(t) for t in texts], np.float64))
        each = -np.diff(np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1), axis=1)
        p_any = above[:, 0] if above.shape[1] else np.zeros(n)
        likeliest = each.argmax(axis=1).astype(np.int32)
        return pd.DataFrame({"severity": above.sum(axis=1), "grade": likeliest, "p_any": p_any})

    return run


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id, severity, grade, p_any`` for every row. Map-only."""
    return docs.select("doc_id", severity_of(model)("text").alias("_s")).select("doc_id", "_s.*")


def without_toxic(docs: DataFrame, model: OrdinalModel, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose chance of any grade above 0 is below ``limit``. Null and blank texts are
    not toxic, also where most labels are."""
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD_PATTERN)
    return docs.where(~has_words | (severity_of(model)("text")["p_any"] < limit))


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """A model of ``labels`` (``doc_id``, ``grade`` from 0) on the texts of ``docs``. What comes to the driver is
    bounded by ``MAX_LABELLED`` rows of ``MAX_FEATURES`` features."""
    rows = labelled_features(spark, docs, labels)
    chosen = chosen_features(rows)
    known = F.array(*(F.lit(int(f)) for f in chosen)) if len(chosen) else F.array().cast("array<bigint>")
    few = rows.select("doc_id", "grade", F.array_sort(F.array_intersect("features", known)).alias("features"))
    got = sorted(few.collect(), key=lambda row: (row.doc_id, row.grade, row.features))
    return fit(chosen, [row.features for row in got], [row.grade for row in got])


def grades(labels: DataFrame) -> DataFrame:
    """Grade 0 for texts that are not toxic, 1 for toxic ones, 2 for toxic ones of low quality."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))
    return labels.select("doc_id", grade.alias("grade"))
