"""Nearest neighbours by inner product over stable projections and kd-trees.

With M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0), the
largest inner product is the smallest distance |q' - x'|.  A Gaussian
(2-stable) projection to ``m`` dimensions turns a distance d into a
projected one r, with r^2 / d^2 distributed as chi-square of m degrees.  So
neighbours are taken in the order of projected distance, and verified on
the original vectors, until

    P(chi2_m <= r^2 / d_k^2) > confidence,

d_k being the k-th best distance verified so far: a true neighbour that is
still unseen would have had a projected distance that unlikely.

A kd-tree fitted on a bounded sample (``SAMPLE`` rows) cuts the projected
space into cells; every row is indexed in its cell, and large cells are
dealt into parts of about ``CELL_ROWS``.  Each query first searches one part
of its nearest cell, then all parts of the cells that the test does not rule
out.  Queries and parts meet by a shuffle: a unit is one part with up to
about ``QUERY_ROWS`` queries, so a cell that many queries reach, or that holds
a third of all rows, is many units.  Within a unit a kd-tree of small leaves
gives the neighbours leaf by leaf, each query stopping by the same test.

Defined results: vectors that are null, zero, of another length than most
(ties: the shorter), or hold null or non-finite components take no part, nor
do rows without an id.  Rows equal in id and vector count once; rows that
share an id only are candidates of their own, none of them for the query of
that id, which is the smallest such vector.  Ties go to the smaller id; a
table without valid queries gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

PROJECTIONS = 8
CONFIDENCE = 0.95
SAMPLE = 1 << 14
MAX_CELLS = 1 << 10
CELL_ROWS = 1 << 14
QUERY_ROWS = 1 << 13
LEAF_ROWS = 256
QUERY_BATCH = 512
SEED = 42


def chi_square(x: float, m: int) -> float:
    """P(chi2_m <= x), m even."""
    term = total = math.exp(-x / 2)
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


class Space:
    """The projection, the same in every task."""

    def __init__(self, dim: int, top: float, m: int = PROJECTIONS, confidence: float = CONFIDENCE):
        self.dim, self.top2, self.m = dim, top * top, m
        self.matrix = np.random.default_rng(SEED).standard_normal((dim + 1, m))
        self.limit = chi_square_quantile(confidence, m)

    def rows(self, x: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(self.top2 - (x * x).sum(axis=1), 0.0))
        return x @ self.matrix[:-1] + last[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]

    def reach(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Squared projected distance at which the test holds, for a k-th
        best inner product of ``bound``."""
        return self.limit * np.maximum((q * q).sum(axis=1) + self.top2 - 2 * bound, 0.0)


def kd_cuts(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, place) of each inner node's cut, heap-ordered: the widest
    dimension at its median."""
    dims, places = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
    held = {0: np.arange(len(points))}
    for node in range((1 << depth) - 1):
        at = held.pop(node)
        if len(at):
            here = points[at]
            dims[node] = d = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
            places[node] = np.median(here[:, d])
            right = here[:, d] > places[node]
        else:
            right = np.zeros(0, dtype=bool)
        held[2 * node + 1], held[2 * node + 2] = at[~right], at[right]
    return dims, places


def kd_leaves(points: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    dims, places = cuts
    node, every = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
    for _ in range((len(dims) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[every, dims[node]] > places[node])
    return node - len(dims)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d:d + 1]
        out += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0) ** 2
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Tree:
    """kd-tree over the projections of one unit's rows."""

    def __init__(self, space: Space, ids: np.ndarray, x: np.ndarray, k: int):
        # Of equal vectors, only the k + 1 smallest ids can be in a result.
        order = np.lexsort((ids, *x.T[::-1]))
        ids, x = ids[order], x[order]
        fresh = np.ones(len(ids), dtype=bool)
        fresh[1:] = (x[1:] != x[:-1]).any(axis=1)
        once = fresh.copy()
        once[1:] |= ids[1:] != ids[:-1]
        ids, x, fresh = ids[once], x[once], fresh[once]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
        kept = np.arange(len(ids)) - start <= k
        ids, x = ids[kept], x[kept]
        low = space.rows(x)
        depth = max(0, math.ceil(math.log2(max(1, len(ids)) / LEAF_ROWS)))
        leaf = kd_leaves(low, kd_cuts(low, depth))
        order = np.argsort(leaf, kind="stable")
        self.space, self.k, self.ids, self.x, low = space, k, ids[order], x[order], low[order]
        starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
        self.edges = np.append(starts, len(ids))
        self.low, self.high = np.minimum.reduceat(low, starts), np.maximum.reduceat(low, starts)
        self.by_id = np.argsort(self.ids, kind="stable")

    def search(self, qids: np.ndarray, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query place, id, score) of the k best rows of each query, best
        first; only those that reach ``bound`` (-inf: none known)."""
        n, leaves = len(q), len(self.low)
        far = box_distances(self.space.queries(q), self.low, self.high)
        rank = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1, kind="stable")
        scores = np.full((n, len(self.ids)), -np.inf)
        slack = 1e-9 * (1.0 + np.sqrt((q * q).sum(axis=1) * self.space.top2))
        best, done = bound.copy(), 0
        for until in sorted({min(1, leaves), min(4, leaves), min(16, leaves), leaves}):
            # ~(>): a bound that is not finite rules nothing out
            open_ = (rank >= done) & (rank < until) & ~(far > self.space.reach(q, best)[:, None])
            done = until
            if not open_.any():
                continue
            for leaf in np.flatnonzero(open_.any(axis=0)):
                who, a, b = np.flatnonzero(open_[:, leaf]), self.edges[leaf], self.edges[leaf + 1]
                scores[who, a:b] = q[who] @ self.x[a:b].T
            first = np.searchsorted(self.ids, qids, sorter=self.by_id)
            last = np.searchsorted(self.ids, qids, side="right", sorter=self.by_id)
            for i in np.flatnonzero(last > first):  # a query is no candidate of its own
                scores[i, self.by_id[first[i]:last[i]]] = -np.inf
            if scores.shape[1] >= self.k:
                kth = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
                best = np.maximum(best, kth - slack)
        who, at = np.nonzero((scores > -np.inf) & (scores >= (best - slack)[:, None]))
        exact = np.concatenate([np.zeros(0)] + [(q[who[i:i + 65536]] * self.x[at[i:i + 65536]]).sum(axis=1) for i in range(0, len(who), 65536)])
        order = np.lexsort((self.ids[at], -exact, who))
        who, at, exact = who[order], at[order], exact[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        take = place < self.k
        return who[take], self.ids[at[take]], exact[take]


def _searched(space: Space, k: int, bounds_only: bool):
    """Rows of units, sorted: the indexed rows of a unit, then its queries."""
    def answer(tree: Tree, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = np.concatenate([b.column("id").to_numpy() for b in held])
        q = np.concatenate([_matrix(b.column("vec"), space.dim) for b in held])
        bound = np.concatenate([b.column("bound").fill_null(-np.inf).to_numpy() for b in held])
        who, near, score = tree.search(ids, q, bound)
        if bounds_only:  # the k-th best score of each query that found k
            last = np.arange(len(who)) - np.searchsorted(who, who) == k - 1
            who, near, score = who[last], near[last], score[last]
        return pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(near), pa.array(score)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, tree, rows, asked, n = None, None, [], [], 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "sub", "copy", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                here, piece = tuple(keys[a, :3].tolist()), batch.slice(a, b - a)
                if here != unit:
                    if asked:
                        yield answer(tree, asked)
                    unit, tree, rows, asked, n = here, None, [], [], 0
                if keys[a, 3] == 0:
                    rows.append((piece.column("id").to_numpy(), _matrix(piece.column("vec"), space.dim)))
                    continue
                if tree is None:
                    if not rows:
                        continue
                    tree, rows = Tree(space, np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), k), []
                for i in range(0, piece.num_rows, QUERY_BATCH):
                    asked.append(piece.slice(i, QUERY_BATCH))
                    n += asked[-1].num_rows
                    if n >= QUERY_BATCH:
                        yield answer(tree, asked)
                        asked, n = [], 0
        if asked:
            yield answer(tree, asked)

    return run


def _whole(x: Column, at_most: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(x / at_most)).cast("int")


def _meet(index: DataFrame, parts: DataFrame, routed: DataFrame, space: Space, k: int, bounds_only: bool) -> DataFrame:
    """Search each routed query (query_id, vec, bound, cell, sub or null for
    all parts of the cell) in its units."""
    load = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
    sized = parts.join(load, "cell").select("cell", "subs", _whole(F.col("asked"), QUERY_ROWS).alias("copies"))
    sized = F.broadcast(store(sized, "neighbour-units"))  # one row a cell: MAX_CELLS at most
    rows = index.join(sized, "cell").select(
        "cell", "sub", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"),
        F.col("vec_id").alias("id"), "vec", F.lit(None).cast("double").alias("bound"))
    every = F.when(F.col("sub").isNull(), F.sequence(F.lit(0), F.col("subs") - 1)).otherwise(F.array("sub"))
    asked = routed.join(sized, "cell").select(
        "cell", F.explode(every).alias("sub"), F.pmod(F.xxhash64("query_id"), F.col("copies")).cast("int").alias("copy"),
        F.lit(1).alias("kind"), F.col("query_id").alias("id"), "vec", "bound")
    units = rows.unionByName(asked).repartition("cell", "sub", "copy").sortWithinPartitions("cell", "sub", "copy", "kind")
    return units.mapInArrow(_searched(space, k, bounds_only), "query_id bigint, vec_id bigint, score double")


def _router(space: Space, cells: np.ndarray, low: np.ndarray, high: np.ndarray, home: bool):
    """Cells that a query searches: its nearest one, or all that its bound
    does not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, QUERY_BATCH):
                piece = batch.slice(i, QUERY_BATCH)
                q = _matrix(piece.column("vec"), space.dim)
                far = box_distances(space.queries(q), low, high)
                if home:
                    who, at = np.arange(len(q)), far.argmin(axis=1)
                else:
                    bound = piece.column("bound").fill_null(-np.inf).to_numpy()
                    who, at = np.nonzero(~(far > space.reach(q, bound)[:, None]))
                taken = piece.take(pa.array(who))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells[at], pa.int32())], names=[*piece.schema.names, "cell"])

    return run


def valid_vectors(table: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, vec of the usual length, without the rows that take no part;
    that length)."""
    kind = "float" if table.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    rows = table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("vec")).where(
        F.col("vec_id").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vec", lambda x: x != 0))
    usual = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = usual["dim"] if usual else 0
    return rows.where(F.size("vec") == dim), dim


def nearest(table: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            projections: int = PROJECTIONS, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product
    for each row whose key ``every`` divides."""
    spark = table.sparkSession
    rows, dim = valid_vectors(table, key, vector)
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("top2")).first()
    if not seen["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    space = Space(dim, math.sqrt(seen["top2"]), projections, confidence)

    depth = max(0, min(MAX_CELLS.bit_length() - 1, math.ceil(math.log2(seen["n"] / CELL_ROWS))))
    picked = rows.orderBy(F.xxhash64("vec_id", "vec")).limit(SAMPLE).select("vec").toArrow() if depth else None
    sample = space.rows(_matrix(picked.column("vec").combine_chunks(), dim)) if depth else np.zeros((0, projections))
    cuts = kd_cuts(sample, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                low = space.rows(_matrix(batch.column("vec"), dim))
                cells = kd_leaves(low, cuts).astype(np.int32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(low.ravel()), projections).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), flat], names=["vec_id", "vec", "cell", "low"])

    kind = rows.schema["vec"].dataType.simpleString()
    index = rows.mapInArrow(place, f"vec_id bigint, vec {kind}, cell int, low array<double>")
    # The number in the table deals a cell's rows into its parts.
    index = store(index.withColumn("nth", F.monotonically_increasing_id()), "neighbour-index")
    corners = [f(F.col("low")[d]).alias(f"{n}{d}") for d in range(projections) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    boxes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *corners).orderBy("cell").collect()  # MAX_CELLS rows at most
    cells = np.array([b["cell"] for b in boxes], dtype=np.int32)
    low, high = (np.array([[b[f"{n}{d}"] for d in range(projections)] for b in boxes]) for n in ("lo", "hi"))
    parts = spark.createDataFrame([(b["cell"], max(1, math.ceil(b["n"] / CELL_ROWS))) for b in boxes], "cell int, subs int")
    index = index.join(F.broadcast(parts), "cell").select(
        "vec_id", "vec", "cell", F.pmod(F.xxhash64("nth"), F.col("subs")).cast("int").alias("sub"))

    asked = index.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    asked = store(asked.withColumnRenamed("vec_id", "query_id"), "neighbour-queries")
    fields = f"query_id bigint, vec {kind}"
    home = asked.mapInArrow(_router(space, cells, low, high, True), f"{fields}, cell int").join(F.broadcast(parts), "cell")
    home = home.select("query_id", "vec", F.lit(None).cast("double").alias("bound"), "cell",
                       F.pmod(F.hash("query_id"), F.col("subs")).alias("sub"))
    bounds = store(_meet(index, parts, home, space, k, True).select(F.col("query_id").alias("q2"), F.col("score").alias("bound")), "neighbour-bounds")
    known = store(asked.join(bounds, F.col("query_id") == F.col("q2"), "left").select("query_id", "vec", "bound"), "neighbour-known")
    routed = known.mapInArrow(_router(space, cells, low, high, False), f"{fields}, bound double, cell int")
    routed = routed.withColumn("sub", F.lit(None).cast("int"))
    found = _meet(index, parts, routed, space, k, False).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
