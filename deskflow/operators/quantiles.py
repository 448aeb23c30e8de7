"""Exact quantiles by selection: no global sort, no value map in one task.

The values between the least and the greatest are counted in equal buckets
(a combining aggregate of few rows); a rank lies in one bucket, whose own
least and greatest value bound the next, narrower count.  A bucket of one
value, or of few, ends it.  Two values in an interval always fall into two
buckets, so every round narrows.  NaN counts as missing; quantiles are
linearly interpolated between the two ranks they fall between.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskflow.functions.util import local_rows
from deskflow.session import work_dir

BUCKETS = 1024
# Values of an interval that are fetched rather than narrowed further.
FEW = 4096


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _bucket(x: Column, lo: Column, hi: Column) -> Column:
    """Bucket of x in [lo, hi]; does not decrease with x.  Halves keep the
    width of any two doubles finite."""
    return F.least(F.lit(BUCKETS - 1), F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * BUCKETS).cast("int"))


@dataclass(frozen=True)
class _Span:
    """An interval of a column: its values lo..hi, ``n`` of them, with
    ``below`` smaller ones, and the ranks wanted from it."""
    column: str
    lo: float
    hi: float
    n: int
    below: int
    ranks: tuple[int, ...]


def _in_spans(df: DataFrame, spans: list[_Span], what) -> DataFrame:
    """(span, key, value) of every value in a span: rows that are in none go
    first, the others are unpivoted."""
    inside = [_number(s.column).between(s.lo, s.hi) for s in spans]
    cells = [x for i, (s, hit) in enumerate(zip(spans, inside)) for x in (F.lit(i), what(i, s), F.when(hit, _number(s.column)))]
    some = reduce(lambda a, b: a | b, inside)
    return df.where(some).select(F.stack(F.lit(len(spans)), *cells).alias("span", "key", "value")).where("value is not null")


def _shares(span: _Span, parts: list[tuple[float, float, int]]) -> list[_Span]:
    """The parts (lo, hi, n; in order) that hold the span's ranks."""
    ends = list(accumulate(n for _, _, n in parts))
    wanted: dict[int, list[int]] = {}
    for r in span.ranks:
        wanted.setdefault(bisect_right(ends, r - span.below), []).append(r)
    return [_Span(span.column, parts[k][0], parts[k][1], parts[k][2], span.below + ends[k] - parts[k][2], tuple(rs))
            for k, rs in wanted.items()]


def selected_values(df: DataFrame, bounds: dict[str, tuple[int, float, float]], ranks: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """Values at the given ranks (from 0) of each column; ``bounds`` holds
    each column's number of values, least and greatest.  A round returns
    ``BUCKETS`` rows a span at most, the last one ``FEW``."""
    found: dict[tuple[str, int], float] = {}
    few: list[_Span] = []
    spans = [_Span(c, lo, hi, n, 0, tuple(sorted(set(ranks[c])))) for c, (n, lo, hi) in bounds.items() if n and ranks.get(c)]
    while True:
        for s in spans:
            if s.lo == s.hi:
                found |= {(s.column, r): s.lo for r in s.ranks}
        few += [s for s in spans if s.lo < s.hi and s.n <= FEW]
        spans = [s for s in spans if s.lo < s.hi and s.n > FEW]
        if not spans:
            break
        rows = _in_spans(df, spans, lambda i, s: _bucket(_number(s.column), F.lit(s.lo), F.lit(s.hi))).groupBy("span", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("span", "key").collect()
        parts: dict[int, list] = {}
        for r in rows:
            parts.setdefault(r["span"], []).append((r["lo"], r["hi"], r["n"]))
        spans = [t for i, s in enumerate(spans) for t in _shares(s, parts[i])]
    if few:
        rows = _in_spans(df, few, lambda i, s: F.lit(0)).groupBy("span", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("span", "value").collect()
        values: dict[int, list] = {}
        for r in rows:
            values.setdefault(r["span"], []).append((r["value"], r["value"], r["n"]))
        for i, s in enumerate(few):
            for t in _shares(s, values[i]):
                found |= {(t.column, r): t.lo for r in t.ranks}
    return found


def _places(p: float, n: int) -> tuple[int, int, float]:
    exact = p * (n - 1)
    return math.floor(exact), math.ceil(exact), exact - math.floor(exact)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    bounds: dict[str, tuple[int, float, float]] | None = None) -> DataFrame:
    """column_name, q0, q1, ...: quantiles of several numeric columns; columns
    without values have no row."""
    if bounds is None:
        one = df.agg(*[a for i, c in enumerate(columns) for a in (
            F.count(_number(c)).alias(f"n{i}"), F.min(_number(c)).alias(f"lo{i}"), F.max(_number(c)).alias(f"hi{i}"))]).first()
        bounds = {c: (one[f"n{i}"], one[f"lo{i}"], one[f"hi{i}"]) for i, c in enumerate(columns)}
    places = {c: [_places(p, bounds[c][0]) for p in probs] for c in columns if bounds[c][0]}
    values = selected_values(df, bounds, {c: [r for lo, hi, _ in ps for r in (lo, hi)] for c, ps in places.items()})
    rows = [(c, *[values[c, lo] + (values[c, hi] - values[c, lo]) * f for lo, hi, f in ps]) for c, ps in places.items()]
    return local_rows(df.sparkSession, rows, "column_name string, " + ", ".join(f"q{i} double" for i in range(len(probs))))


def grouped_quantiles(df: DataFrame, by: list[str], column: str, probs: list[float]) -> DataFrame:
    """``by`` columns, n, q0, q1, ...: quantiles of a column within each group
    (a null group key is a group).  The spans of all groups are a table that
    is narrowed round by round, so neither many groups nor one that holds
    most of the rows gathers values in a task.  The group keys and values are
    stored first: every round reads them again, not what ``df`` is made of."""
    spark = df.sparkSession
    root = work_dir(spark, "quantiles")
    keys = [f"g{i}" for i in range(len(by))]

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    x = df.select(*[F.col(c).alias(k) for k, c in zip(keys, by)], _number(column).alias("value")).where("value is not null")
    x = stored(x, "values")
    exact = [F.lit(p) * (F.col("n") - 1) for p in probs]
    every = F.array_distinct(F.array(*[f(e).cast("bigint") for e in exact for f in (F.floor, F.ceil)]))
    groups = stored(x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")), "groups")
    state = stored(groups.select(*keys, F.explode(every).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below")), "state-0")
    done, turn = [state.where("lo = hi")], 0
    while not (state := state.where("lo < hi")).isEmpty():
        turn += 1
        spans = state.select(*[F.col(k).alias(f"s{k}") for k in keys], F.col("lo").alias("slo"), F.col("hi").alias("shi")).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"s{k}")) for k in keys]
        inside = x.join(spans, _all(same) & F.col("value").between(F.col("slo"), F.col("shi")))
        counted = inside.groupBy(*spans.columns, _bucket(F.col("value"), F.col("slo"), F.col("shi")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("m"), F.min("value").alias("blo"), F.max("value").alias("bhi"))
        # BUCKETS rows a span at most.
        upto = F.sum("m").over(Window.partitionBy(*spans.columns).orderBy("bucket"))
        counted = counted.withColumn("upto", upto)
        here = _all(same) & (F.col("lo") == F.col("slo")) & (F.col("hi") == F.col("shi"))
        held = F.col("rank") - F.col("below")
        nxt = state.join(counted, here & (held < F.col("upto")) & (held >= F.col("upto") - F.col("m"))).select(
            *keys, "rank", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("below") + F.col("upto") - F.col("m")).alias("below"))
        state = stored(nxt, f"state-{turn}")
        done.append(state.where("lo = hi"))
    values = done[0]
    for d in done[1:]:
        values = values.unionByName(d)
    values = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("v"))  # 2 a quantile
    values = values.select(*[F.col(k).alias(f"s{k}") for k in keys], "v")
    out = groups.join(values, _all([F.col(k).eqNullSafe(F.col(f"s{k}")) for k in keys]))
    at = lambda r: F.element_at("v", r.cast("bigint"))
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "n", *[
        (at(F.floor(e)) + (at(F.ceil(e)) - at(F.floor(e))) * (e - F.floor(e))).alias(f"q{i}") for i, e in enumerate(exact)])


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
