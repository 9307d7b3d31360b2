"""Exact top-k inner products with a pivot-distance index.

Vectors of integers get one more component that gives all of them the length of the longest, M, while queries get a
zero there. Then ``|q - x|^2 = M^2 + |q|^2 - 2 q.x``: the nearest vectors have the largest inner products. The index
keys a vector by its nearest pivot and its distance to it; by these keys it is sorted and cut into cells, whose rows
are cut further into annuli. For a vector x of an annulus, ``|d(q, p) - d(x, p)|`` is at most ``d(q, x)``, so a query
takes annuli in order of that bound and stops where it exceeds the k-th best distance found.

Bounds are computed with floating point and a margin, scores with whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.llm.common import sampled, written

PIVOTS = 32
#: Pivots are chosen among so many vectors, those whose ids have the smallest hashes.
PIVOT_SAMPLE = 2048
#: Rows of a cell, up to four times as many where quantiles do not cut finer; at most ``MAX_CELLS`` parts of a pivot are
#: cut at quantiles. The list of cells goes to every task.
CELL_ROWS = 8192
MAX_CELLS = 128
ANNULUS_ROWS = 512
#: About so many queries from neighbouring cells search a cell in one task; so many go through its annuli together.
QUERY_ROWS = 8192
QUERY_GROUP = 256

MARGIN = 1e-6

_HITS = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id``, ``v`` = floor(scale * x) as an array of longs and ``n2``, its squared length.

    Null vectors and such with null or non-finite components take no part. Scores have to fit into 64 bits.
    """
    vector = F.col(vector_column)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = rows.where(vector.isNotNull() & ~bad).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )
    return clean.withColumn("n2", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x))


def choose_pivots(points: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Farthest-first among a sample of vectors."""
    points = points.astype(np.float64)
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < pivots and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _distances(v: np.ndarray, n2: np.ndarray, rest: float | np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to all pivots, which have zero as their last component; ``rest`` is the vectors' last one squared."""
    squares = (n2 + rest)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * v @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _matrix(batch, name: str = "v") -> np.ndarray:
    lists = batch.column(name)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _scores(a: np.ndarray, b: np.ndarray, exact_in_floats: bool) -> np.ndarray:
    """All inner products as whole numbers; floats hold them exactly where lengths show that they are small enough."""
    if exact_in_floats:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _key(batches, pivots: np.ndarray, longest2: int):
    for batch in batches:
        v, n2 = _matrix(batch).astype(np.float64), batch.column("n2").to_numpy()
        if len(v):
            far = _distances(v, n2, longest2 - n2, pivots)
            nearest = far.argmin(axis=1)
            distance = far[np.arange(len(v)), nearest]
            yield pa.record_batch(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "v", "n2", "pivot", "distance"],
            )


def _cut(index: DataFrame) -> tuple[DataFrame, list]:
    """The index with a ``cell`` for each row, and the cells: ``cell, pivot, low, high`` (least and largest distance).

    A pivot's rows are cut at quantiles of their distances. Parts of over four times ``CELL_ROWS``, such as those with
    copies of a vector, are cut further by hashes of ids; the cells of a part have the same bounds.
    """
    grid = [i / MAX_CELLS for i in range(1, MAX_CELLS)]
    found = index.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("distance", grid, 10_000).alias("q"))
    borders = {}
    for row in found.collect():
        parts = min(MAX_CELLS, -(-row.n // CELL_ROWS))
        borders[row.pivot] = np.unique([row.q[MAX_CELLS * i // parts - 1] for i in range(1, parts)])

    @F.pandas_udf("int")
    def part_of(pivot: pd.Series, distance: pd.Series) -> pd.Series:
        out = np.zeros(len(pivot), np.int32)
        for p in pivot.unique():
            at = (pivot == p).to_numpy()
            out[at] = np.searchsorted(borders[p], distance.to_numpy()[at], side="right")
        return pd.Series(out)

    placed = index.withColumn("part", part_of("pivot", "distance"))
    sizes = placed.groupBy("pivot", "part").agg(
        F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")
    )
    cells, first = [], {}
    for row in sorted(sizes.collect(), key=lambda r: (r.pivot, r.part)):
        split = -(-row.n // (4 * CELL_ROWS))
        begin = len(cells)
        first[row.pivot * MAX_CELLS + row.part] = (begin, split)
        cells.extend((begin + i, row.pivot, row.low, row.high) for i in range(split))

    @F.pandas_udf("int")
    def cell_of(pivot: pd.Series, part: pd.Series, h: pd.Series) -> pd.Series:
        where = [first[k] for k in (pivot.astype("int64") * MAX_CELLS + part).tolist()]
        return pd.Series([cell + v % split for (cell, split), v in zip(where, h.tolist())], dtype="int32")

    return placed.withColumn("cell", cell_of("pivot", "part", F.xxhash64("vec_id"))), cells


def _grouped(queries: DataFrame, cells: int) -> DataFrame:
    """``vec_id, v, n2, part``: queries of neighbouring cells, which reach about the same cells, have one ``part`` of
    about ``QUERY_ROWS``. A cell has a bounded number of rows, so a part has a bounded number of queries."""
    many = np.zeros(cells, np.int64)
    for row in queries.groupBy("q.cell").count().collect():
        many[row.cell] = row["count"]
    parts = ((np.cumsum(many) - many) // QUERY_ROWS).astype(np.int32)

    @F.pandas_udf("int")
    def part_of(cell: pd.Series) -> pd.Series:
        return pd.Series(parts[cell.to_numpy()])

    return queries.select("vec_id", "q.v", "q.n2", part_of("q.cell").alias("part"))


def _route(batches, k: int, sample: tuple, pivots: np.ndarray, cells: list, longest2: int, in_floats: bool):
    """For each query the cells that may hold one of its ``k`` best. The k-th best score among the sample's vectors
    is a first bound."""
    """Rows ``cell, vec_id, part, floor``."""
    numbers, owner = np.array([c[0] for c in cells], np.int32), np.array([c[1] for c in cells])
    low, high = np.array([c[2] for c in cells]), np.array([c[3] for c in cells])
    ids, points = sample
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            v, n2, own = _matrix(part), part.column("n2").to_numpy(), part.column("vec_id").to_numpy()
            known = _scores(v, points, in_floats)
            none = np.iinfo(np.int64).min
            known[ids[None, :] == own[:, None]] = none
            floor = np.partition(known, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(v), none)
            reach = _reach(floor, n2, longest2)
            far = _distances(v.astype(np.float64), n2, 0.0, pivots)[:, owner]
            at, cell = np.nonzero(np.maximum(low - far, far - high) <= reach[:, None])
            yield pa.record_batch(
                [
                    pa.array(numbers[cell]),
                    part.column("vec_id").take(pa.array(at)),
                    part.column("part").take(pa.array(at)),
                    pa.array(floor[at]),
                ],
                names=["cell", "vec_id", "part", "floor"],
            )


def _reach(floor: np.ndarray, n2: np.ndarray, longest2: int) -> np.ndarray:
    """The distance of a vector with that score, and a margin."""
    squares = longest2 + n2 - 2.0 * floor.astype(np.float64)
    return np.sqrt(np.maximum(squares, 0)) + MARGIN * (1 + np.sqrt(longest2))


def _search_cell(queries: pa.Table, rows: pa.Table, k: int, pivots: np.ndarray, longest2: int, in_floats: bool):
    """The hits of each query in a cell, at least its ``k`` best there as far as they reach its bound."""
    out = [np.empty((0, 3), np.int64)]
    if len(queries) and len(rows):
        order = np.lexsort((rows.column("vec_id").to_numpy(), rows.column("distance").to_numpy()))
        v, ids = _matrix(rows)[order], rows.column("vec_id").to_numpy()[order]
        distance = rows.column("distance").to_numpy()[order]
        starts = np.arange(0, len(v), ANNULUS_ROWS)
        low, high = distance[starts], distance[np.minimum(starts + ANNULUS_ROWS, len(v)) - 1]
        pivot = pivots[rows.column("pivot")[0].as_py()][None, :]
        q, q2 = _matrix(queries), queries.column("n2").to_numpy()
        own, floor = queries.column("vec_id").to_numpy(), queries.column("floor").to_numpy()
        far = _distances(q.astype(np.float64), q2, 0.0, pivot)[:, 0]
        by_distance = np.argsort(far, kind="stable")
        for first in range(0, len(q), QUERY_GROUP):
            at = by_distance[first : first + QUERY_GROUP]
            bounds = np.maximum(np.maximum(low[None, :] - far[at][:, None], far[at][:, None] - high[None, :]), 0)
            best = np.empty((0, 3), np.int64)  # query's place in the group, score, vector's id
            least = floor[at].copy()
            for annulus in np.argsort(bounds.min(axis=0), kind="stable"):
                reach = _reach(least, q2[at], longest2)
                if not (bounds.min(axis=0)[annulus] <= reach.max()):
                    break  # no later annulus is nearer
                near = np.flatnonzero(bounds[:, annulus] <= reach)
                if not len(near):
                    continue
                block = slice(starts[annulus], starts[annulus] + ANNULUS_ROWS)
                scores = _scores(q[at[near]], v[block], in_floats)
                hit, column = np.nonzero((scores >= least[near][:, None]) & (ids[block][None, :] != own[at[near]][:, None]))
                found = np.stack([near[hit], scores[hit, column], ids[block][column]], axis=1)
                best, least = _best(np.concatenate([best, found]), k, least)
            out.append(np.stack([own[at][best[:, 0]], best[:, 2], best[:, 1]], axis=1))
    hits = np.concatenate(out)
    return pa.table([pa.array(hits[:, i].copy()) for i in range(3)], names=["query_id", "vec_id", "score"])


def _best(hits: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best hits of each query and its k-th score, if it has so many."""
    hits = hits[np.lexsort((hits[:, 2], -hits[:, 1], hits[:, 0]))]
    begins = np.searchsorted(hits[:, 0], hits[:, 0], side="left")
    rank = np.arange(len(hits)) - begins
    least = least.copy()
    last = rank == k - 1
    least[hits[last, 0]] = np.maximum(least[hits[last, 0]], hits[last, 1])
    return hits[rank < k], least


def top_k(
    spark: SparkSession,
    rows: DataFrame,
    k: int,
    is_query: Callable[[Column], Column],
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` (of the id) picks, the ``k`` largest inner
    products with the other rows, ties to the smaller id.

    Rows without id take no part. Rows of one id are one another's own row, so they are left out of each other's
    results, and as queries they count once, with the smallest vector. All vectors need the same number of components. A table without queries
    gives no rows. A task searches one cell for a bounded number of queries; every cell within reach of a query's
    bound is searched, so results are exact.
    """
    usable = rows.where(F.col(id_column).isNotNull())
    vectors = written(spark, whole_vectors(usable, id_column, vector_column, scale), "vectors")
    size = vectors.agg(
        F.count("*").alias("n"), F.max("n2").alias("longest2"), F.count_if(is_query(F.col("vec_id"))).alias("queries")
    ).first()
    if not size.queries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    got = sampled(vectors, "vec_id", PIVOT_SAMPLE, F.col("v"))
    ids, points = np.array([row.vec_id for row in got]), np.array([row.picked for row in got], np.int64)
    pivots, longest2 = choose_pivots(points), size.longest2
    in_floats = longest2 < 2**52

    keyed = vectors.mapInArrow(
        lambda batches: _key(batches, pivots, longest2),
        "vec_id bigint, v array<bigint>, n2 bigint, pivot int, distance double",
    )
    index, cells = _cut(written(spark, keyed, "pivot-index"))
    asked = index.where(is_query(F.col("vec_id"))).groupBy("vec_id")
    queries = _grouped(written(spark, asked.agg(F.min(F.struct("v", "n2", "cell")).alias("q")), "queries"), len(cells))
    routed = queries.mapInArrow(
        lambda batches: _route(batches, k, (ids, points), pivots, cells, longest2, in_floats),
        "cell int, vec_id bigint, part int, floor bigint",
    )
    routed = written(spark, routed, "routed-queries")
    # A cell goes to the parts that have a query within reach of it.
    met = routed.select(F.col("cell").alias("cell"), F.col("part").alias("part")).distinct()
    dealt = index.select("cell", "pivot", "distance", "vec_id", "v").join(met, "cell")
    searching = routed.join(queries.select("vec_id", "v", "n2"), "vec_id")
    hits = (
        searching.groupBy("cell", "part")
        .cogroup(dealt.groupBy("cell", "part"))
        .applyInArrow(lambda q, r: _search_cell(q, r, k, pivots, longest2, in_floats), _HITS)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.dropDuplicates().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
