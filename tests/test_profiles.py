"""Quantiles by selection and profiles by sketches."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from deskflow.operators import profile, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def values(kind, n=5000):
    rng = random.Random(7)
    return {"ids": lambda: [float(i * 3 - 900) for i in range(n)], "few": lambda: [float(rng.choice([1, 2, 2, 2, 9])) for _ in range(n)],
            "wide": lambda: [math.exp(rng.uniform(-200, 200)) * rng.choice([-1, 1]) for _ in range(n)],
            "hot": lambda: [7.0 if i % 3 else rng.gauss(0, 1e9) for i in range(n)], "one": lambda: [4.5] * n,
            "huge": lambda: [rng.choice([-1.7e308, 1.7e308, 0.0]) for _ in range(n)]}[kind]()


@pytest.mark.parametrize("few", [0, 4096])
def test_quantiles_of_odd_distributions(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "BUCKETS", 32)
    kinds = ["ids", "few", "wide", "hot", "one", "huge"]
    table = list(zip(*[values(k) for k in kinds]))
    df = spark.createDataFrame(table + [(None,) * 6, (float("nan"),) * 6], ", ".join(f"{k} double" for k in kinds)).withColumn("none", F.lit(None).cast("double"))
    got = {r.column_name: list(r)[1:] for r in quantiles.exact_quantiles(df, [*kinds, "none"], PROBS).collect()}
    assert set(got) == set(kinds)
    for k in kinds:
        x = sorted(values(k))
        for p, q in zip(PROBS, got[k]):
            at = p * (len(x) - 1)
            lo, hi = x[math.floor(at)], x[math.ceil(at)]
            assert q == lo + (hi - lo) * (at - math.floor(at)), (k, p)


def test_rounds_return_few_rows(spark, monkeypatch):
    """No round brings more than the buckets, or the few last values, back."""
    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(rows := collect(self)) or rows)
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") * 17 % 50_000).cast("double").alias("x"))
    out = quantiles.exact_quantiles(df, ["x"], [0.5])
    assert [len(x) for x in seen[:1]] == [1] and len(seen[1]) <= quantiles.BUCKETS and len(seen[2]) <= 2 * quantiles.FEW and len(seen) == 3
    assert out.first().q0 == 24999.5


def test_grouped_quantiles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    rng = np.random.default_rng(5)
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 40}", i % 2, float(v)) for i, v in enumerate(rng.normal(size=4000) ** 3)]
    df = spark.createDataFrame(rows + [("empty", 1, None), ("empty", 1, float("nan"))], "g string, h int, x double")
    got = {(r.g, r.h): list(r)[2:] for r in quantiles.grouped_quantiles(df, ["g", "h"], "x", [0.25, 0.5, 0.95]).collect()}
    want = {}
    for g, h, v in rows:
        want.setdefault((g, h), []).append(v)
    assert set(got) == set(want)
    for key, xs in want.items():
        n, *qs = got[key]
        assert n == len(xs) and np.allclose(qs, np.quantile(xs, [0.25, 0.5, 0.95]), rtol=1e-12, atol=0)
    assert quantiles.grouped_quantiles(df.limit(0), ["g"], "x", [0.5]).count() == 0


def test_grouped_quantiles_make_their_rows_once(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    made = spark.sparkContext.accumulator(0)

    def row(i):
        made.add(1)
        return (f"g{i % 3}", float(i * i % 997))

    df = spark.createDataFrame(spark.sparkContext.range(0, 600, 1, 3).map(row), "g string, x double")
    got = {r.g: (r.n, r.q0) for r in quantiles.grouped_quantiles(df, ["g"], "x", [0.5]).collect()}
    assert got == {f"g{k}": (200, statistics.median(float(i * i % 997) for i in range(k, 600, 3))) for k in range(3)}
    assert made.value == 600


def test_describe_matches_statistics(spark):
    xs = values("hot")
    df = spark.createDataFrame([(x, int(x) % 5, "a" if x > 0 else None) for x in xs], "x double, k int, t string")
    row = {r.column_name: r for r in profile.describe(df).collect()}
    q = statistics.quantiles(xs, n=4, method="inclusive")
    assert [row["x"].q25, row["x"].q50, row["x"].q75] == [round(v, 6) for v in q]
    assert (row["t"].unique, row["t"].top, row["k"]["count"]) == (1, "a", len(xs))


def test_sketches_never_lose_a_key_column(spark):
    n = 3000
    cols = {f"c{d}": (F.col("id") % d).cast("string") for d in (1, 2, 18, 19, 20, 21, 400, n)}
    df = spark.range(n).select(*[c.alias(k) for k, c in cols.items()], F.lit(None).cast("string").alias("none"),
                               F.when(F.col("id") % 2 == 0, "x").alias("half"), "id")
    passed = profile.maybe_few(df, [*cols, "none", "half"], 20)
    assert {"c1", "c2", "c18", "c19", "half"} <= set(passed) and not {"c400", f"c{n}"} & set(passed)
    assert {r.column_name: r.distinct_count for r in profile.key_columns(df).collect()} == {"c1": 1, "c2": 2, "c18": 18, "c19": 19, "half": 1}
    unique = {(r.column_name, r.value): r.row_count for r in profile.unique_values(df).collect()}
    assert unique["half", None] == n // 2 and unique["c1", "0"] == n and ("c20", "0") not in unique
    assert profile.maybe_few(df, ["c400"], 300) == ["c400"]
    assert profile.key_columns(df.select("id")).count() == 0


def test_only_screened_columns_are_shuffled(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("many"), (F.col("id") % 3).cast("string").alias("few"))
    plan = profile.key_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "few" in plan and "many" not in plan
