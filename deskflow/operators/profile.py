"""Data profiling in whole-table passes: shape, missing values, duplicates,
describe, distinct values and date ranges.

Per-column statistics are computed in one aggregation over all columns, or
by unpivoting (column, value) pairs once and grouping them, instead of one
job per column.  Quartiles are selected from bucket counts, and columns of
few distinct values are found by sketches before any value is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from deskflow.functions.util import local_rows
from deskflow.operators.quantiles import exact_quantiles


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each (union of count aggregates)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def _is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType))


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, column count and column names per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.lit(",".join(df.columns)).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


def missing_values(df: DataFrame) -> DataFrame:
    """Null count per column: one aggregation, unpivoted to rows."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"{i + 1}, '{c}', m{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {pairs}) as (column_position, column_name, missing_count)")


def duplicate_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that repeat an earlier identical row (nulls compare equal).
    Identical rows are combined map-side before the shuffle."""
    out = None
    for name, df in tables.items():
        groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
        one = groups.agg(F.sum("__n").cast("long").alias("row_count"),
                         F.sum(F.col("__n") - 1).cast("long").alias("duplicate_rows")).select(
            F.lit(name).alias("table_name"), F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
            F.coalesce("duplicate_rows", F.lit(0).cast("long")).alias("duplicate_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def _text_value_counts(df: DataFrame, columns: list[str], keep_nulls: bool) -> DataFrame:
    """(column_name, value, n) for the given columns: the frame is unpivoted
    once and grouped once, so all columns share one shuffle."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, value)")
    if not keep_nulls:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, digits: int = 6) -> DataFrame:
    """count/unique/top/freq for text and boolean columns; count/mean/std/
    min/quartiles/max for numeric columns (exact, linearly interpolated
    quartiles; most frequent value ties go to the smallest)."""
    fields = df.schema.fields
    numeric = [f.name for f in fields if _is_numeric(f.dataType)]
    categorical = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    position = {f.name: i + 1 for i, f in enumerate(fields)}
    parts = []
    if numeric:
        aggs = []
        for i, c in enumerate(numeric):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            aggs += [F.count(x).alias(f"c{i}"), F.round(F.avg(x), digits).alias(f"mean{i}"),
                     F.round(F.stddev_samp(x), digits).alias(f"std{i}"), F.min(x).alias(f"min{i}"),
                     F.max(x).alias(f"max{i}")]
        one = df.agg(*aggs).first()
        ddl = ", ".join(f"c{i} long, mean{i} double, std{i} double, min{i} double, max{i} double" for i in range(len(numeric)))
        wide = local_rows(df.sparkSession, [tuple(one)], ddl)
        bounds = {c: (one[f"c{i}"], one[f"min{i}"], one[f"max{i}"]) for i, c in enumerate(numeric)}
        rows = ", ".join(f"{position[c]}, '{c}', c{i}, mean{i}, std{i}, min{i}, max{i}" for i, c in enumerate(numeric))
        num = wide.selectExpr(f"stack({len(numeric)}, {rows}) as (column_position, column_name, count, mean, std, min, max)")
        quart = exact_quantiles(df, numeric, [0.25, 0.5, 0.75], bounds)
        num = num.join(quart, "column_name", "left")
        parts.append(num.select("column_position", "column_name", F.col("count").cast("long").alias("count"),
                                F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
                                F.lit(None).cast("long").alias("freq"), "mean", "std", "min",
                                F.round("q0", digits).alias("q25"), F.round("q1", digits).alias("q50"),
                                F.round("q2", digits).alias("q75"), "max"))
    if categorical:
        vc = _text_value_counts(df, categorical, keep_nulls=False)
        cat = vc.groupBy("column_name").agg(
            F.sum("n").cast("long").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"))
        names = local_rows(df.sparkSession, [(position[c], c) for c in categorical], "column_position int, column_name string")
        cat = names.join(cat, "column_name", "left")
        dbl = F.lit(None).cast("double")
        parts.append(cat.select("column_position", "column_name",
                                F.coalesce("count", F.lit(0).cast("long")).alias("count"),
                                F.coalesce("unique", F.lit(0).cast("long")).alias("unique"), "top", "freq",
                                dbl.alias("mean"), dbl.alias("std"), dbl.alias("min"), dbl.alias("q25"),
                                dbl.alias("q50"), dbl.alias("q75"), dbl.alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Registers of the sketches: the standard error 0.05 of the estimate gives 512.
SKETCH_ERROR, SKETCH_REGISTERS = 0.05, 512


def maybe_few(df: DataFrame, columns: list[str], max_distinct: int) -> list[str]:
    """Columns that may have fewer than ``max_distinct`` distinct non-null
    values, by one pass of HyperLogLog sketches (a sketch a column; nothing
    else is shuffled).  The estimate of so few values is the one by empty
    registers, m ln(m / empty), and d values leave m - d empty at least: a
    column whose estimate is above that bound for ``max_distinct`` values has
    more for certain.  Limits beyond half the registers screen nothing."""
    if not columns or 2 * max_distinct > SKETCH_REGISTERS:
        return columns
    one = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), SKETCH_ERROR).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    most = 1 + SKETCH_REGISTERS * math.log(SKETCH_REGISTERS / (SKETCH_REGISTERS - max_distinct))
    return [c for i, c in enumerate(columns) if one[f"d{i}"] <= most]


def _few_value_counts(df: DataFrame, max_distinct: int) -> DataFrame:
    """(column_name, value, n), nulls included, of the text columns that
    passed the sketches."""
    text = maybe_few(df, [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)], max_distinct)
    if not text:
        return local_rows(df.sparkSession, [], "column_name string, value string, n long")
    return _text_value_counts(df, text, keep_nulls=True)


def key_columns(df: DataFrame, max_distinct: int = 20) -> DataFrame:
    """Text columns with fewer than ``max_distinct`` distinct non-null values:
    exact counts of the columns that a sketch does not rule out."""
    vc = _few_value_counts(df, max_distinct)
    return (vc.groupBy("column_name").agg(F.count("value").alias("distinct_count"))
            .where((F.col("distinct_count") > 0) & (F.col("distinct_count") < max_distinct)))


def unique_values(df: DataFrame, max_distinct: int = 20) -> DataFrame:
    """Every value (null included) with its row count, for the key columns."""
    vc = _few_value_counts(df, max_distinct)
    keys = vc.groupBy("column_name").agg(F.count("value").alias("d")).where((F.col("d") > 0) & (F.col("d") < max_distinct))
    return vc.join(keys.select("column_name"), "column_name").select("column_name", "value", F.col("n").alias("row_count"))


def date_ranges(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Earliest and latest value of every date/time-typed column."""
    out = None
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields if _is_time(f.dataType)]
        if not cols:
            continue
        wide = df.agg(*[a for i, c in enumerate(cols)
                        for a in (F.min(c).cast("timestamp_ntz").alias(f"lo{i}"), F.max(c).cast("timestamp_ntz").alias(f"hi{i}"))])
        rows = ", ".join(f"'{c}', lo{i}, hi{i}" for i, c in enumerate(cols))
        one = wide.selectExpr(f"'{name}' as table_name", f"stack({len(cols)}, {rows}) as (column_name, min_value, max_value)")
        out = one if out is None else out.unionByName(one)
    return out
