import math

import numpy as np
import pytest

from deskflow.llm import neighbours
from deskflow.llm.neighbours import Space, box_distances, chi_square, chi_square_quantile, kd_cuts, kd_leaves, nearest
from deskflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(ids, x, every, k):
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            score = (x * v).sum(axis=1)
            out[int(i)] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items() if w])


def test_chi_square():
    assert math.isclose(chi_square(chi_square_quantile(0.95, 8), 8), 0.95, abs_tol=1e-9)
    assert math.isclose(chi_square_quantile(0.95, 8), 15.507313, abs_tol=1e-5)
    assert math.isclose(chi_square_quantile(0.5, 2), 2 * math.log(2), abs_tol=1e-9)


def test_tree_cells_and_boxes():
    x = np.random.default_rng(1).normal(size=(2000, 4))
    leaf = kd_leaves(x, kd_cuts(x, 4))
    assert np.bincount(leaf, minlength=16).min() >= 100 and leaf.max() == 15
    low, high = x[:50].min(axis=0)[None], x[:50].max(axis=0)[None]
    assert (box_distances(x[:50], low, high) == 0).all()
    inside = np.clip(x, low, high)
    assert np.allclose(box_distances(x, low, high)[:, 0], ((x - inside) ** 2).sum(axis=1))


def test_projected_distances_follow_the_test():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(20, 64)), rng.normal(size=(1, 64))
    top = math.sqrt((x * x).sum(axis=1).max())
    space, inside = Space(64, top), []
    for _ in range(500):  # over projections, not rows: rows share the query's
        space.matrix = rng.standard_normal(space.matrix.shape)
        d2 = (q * q).sum() + top * top - 2 * (x @ q[0])
        r2 = ((space.rows(x) - space.queries(q)) ** 2).sum(axis=1)
        inside.append(np.mean(r2 <= space.limit * d2))
    assert 0.94 < np.mean(inside) < 0.96


@pytest.mark.parametrize("cell_rows", [neighbours.CELL_ROWS, 40])
def test_query_against_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(neighbours, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 16)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 8)
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=float)
    want, got = brute(ids, x, 20, 20), found(QUERIES["op11_neighbours"](spark, SF))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    score = {i: v for i, v in zip(ids, x)}
    assert all(s == (score[q] * score[i]).sum() for q, v in got.items() for i, s in v)


def test_clusters_norms_and_a_vector_that_a_third_of_rows_share(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 64)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 8)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(12, 16))[rng.integers(0, 12, 900)] * 3 + rng.normal(size=(900, 16))) * rng.uniform(0.5, 2, size=(900, 1))
    x[300:600] = x[300]
    x = x.astype(np.float32).astype(float)
    ids = np.arange(900)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], SCHEMA)
    got, want = found(nearest(df, every=10, k=7)), brute(ids, x, 10, 7)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]]  # ties by id


def test_rows_that_take_no_part_repeats_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], None), (3, None, 0), (4, [0.0, 0.0], 0),
            (5, [nan, 1.0], 0), (6, [1.0, inf], 0), (7, [None, 1.0], 0), (8, [1.0, 1.0, 1.0], 0), (9, [], 0), (None, [1.0, 1.0], 0),
            (10, [-1.0, 0.0], 0), (0, [0.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "'x' as score", "2 as cell", "3 as vec", "4 as nth")
    got = found(nearest(df, every=5, k=20))
    # Query 0 is the smaller of its two vectors; none of them is its candidate.
    assert got == {0: [(1, 1.0), (2, 1.0), (10, 0.0)], 10: [(0, 0.0), (1, -0.5), (2, -0.5), (0, -1.0)]}
    assert nearest(df.where("vec_id is null or vec_id in (3, 4)")).count() == 0
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0
    assert nearest(df.where("vec_id in (1, 2)"), every=5).count() == 0
