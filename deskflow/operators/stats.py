"""Grouped statistics used by the analysis reports.

Totals that a share divides by come from a scalar subquery (computed once,
used as a constant), never from a window over all rows or a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskflow.functions.numeric import first_label_of_max, first_label_of_min, pearson, share_pct
from deskflow.functions.util import col, local_rows


def row_total(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar-subquery Column."""
    return df.agg(F.count(F.lit(1))).scalar()


def value_counts(df: DataFrame, key: str, count_name: str, share_name: str | None = "share_pct") -> DataFrame:
    """Rows per non-null key, descending; the share divides by all rows
    (null keys included), as a row share of the whole frame."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    if share_name:
        counts = counts.withColumn(share_name, share_pct(F.col(count_name), row_total(df)))
    return counts.orderBy(F.desc(count_name), key)


def normalized_counts(df: DataFrame, key: str, pct_name: str = "pct", digits: int = 1) -> DataFrame:
    """Share of non-null rows per value, x100, rounded half to even."""
    present = df.where(F.col(key).isNotNull())
    counts = present.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    pct = F.rint(F.col("__n").cast("double") / row_total(present).cast("double") * 100 * 10 ** digits) / 10 ** digits
    return counts.select(key, pct.alias(pct_name)).orderBy(F.desc(pct_name), key)


def peaks(counts: DataFrame, label: str, value: str) -> DataFrame:
    """Mean of the group counts, first label of the max and of the min."""
    return counts.agg(
        F.avg(value).alias("avg_count"),
        first_label_of_max(label, value).alias("peak_label"), F.max(value).alias("peak_count"),
        first_label_of_min(label, value).alias("low_label"), F.min(value).alias("low_count"))


def crosstab_fixed(df: DataFrame, row_key: str, row_values: Sequence[str], col_key: str,
                   col_values: Sequence[int], col_name, order_name: str = "row_order") -> DataFrame:
    """Counts of row_key x col_key with fixed row and column lists; every
    listed row is present and empty cells are 0.  The pivot values are given,
    so no extra job looks them up."""
    piv = df.groupBy(row_key).pivot(col_key, list(col_values)).count()
    piv = piv.select(row_key, *[F.col(str(v)).alias(col_name(v)) for v in col_values])
    rows = local_rows(df.sparkSession, [(v, i + 1) for i, v in enumerate(row_values)], f"{row_key} string, {order_name} int")
    out = rows.join(piv, row_key, "left")
    return out.select(row_key, order_name,
                      *[F.coalesce(F.col(col_name(v)), F.lit(0).cast("long")).alias(col_name(v)) for v in col_values])


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles (linear interpolation), 1.5 IQR whiskers (most extreme value
    inside the fences) and the outlier count per group.  Rows are counted per
    (group, value) first; quartiles, whiskers and outliers come from those
    counts, so the rows themselves are read and shuffled once."""
    counted = df.groupBy(group, col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    x, n = F.col("__v"), F.col("__n")
    q = (counted.groupBy(group)
         .agg(F.coalesce(F.sum(F.when(x.isNotNull(), n)), F.lit(0).cast("long")).alias("n"),
              F.percentile(x, [0.25, 0.5, 0.75], n).alias("__q"))
         .select(group, "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                 F.col("__q")[2].alias("q3")))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")).withColumn(
        "upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    fences = q.select(group, "lower_fence", "upper_fence")
    lo, hi = F.col("lower_fence"), F.col("upper_fence")
    w = counted.join(fences, group).groupBy(group).agg(
        F.min(F.when(x >= lo, x)).alias("whisker_low"), F.max(F.when(x <= hi, x)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((x < lo) | (x > hi), n)), F.lit(0).cast("long")).alias("outliers"))
    return q.join(w, group)


def correlation_long(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson matrix in long form (x, y, r), pairwise-complete, one pass:
    all pairs are aggregated in a single ``agg``."""
    pairs = [(a, b) for a in columns for b in columns]
    aggs = [F.round(pearson(a, b), digits).alias(f"{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (x_col, y_col, r)")


def lag_diff_mean(df: DataFrame, order: str, value: str) -> DataFrame:
    """Mean of consecutive differences of ``value`` in ``order`` (a short,
    fixed list of rows, so one ordered window partition is fine)."""
    d = F.col(value) - F.lag(value).over(Window.orderBy(order))
    return df.select(d.alias("__d")).agg(F.avg("__d").alias("mean_step"))
