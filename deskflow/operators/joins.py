"""Joins: dimension lookups, FK and PK enforcement.

Dimensions at warehouse scale are not all small (clients and sites grow with
the business), so no side is hinted for broadcast: Spark's size threshold and
AQE's measured sizes choose the join.  Where a parent is too large for that,
the facts are split by the set of their orphan keys, so that keys are
shuffled, not whole fact rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from deskflow.session import work_dir


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Fact-to-dimension equi-join."""
    return fact.join(dim, on=on, how=how)


def lookup_with_default(df: DataFrame, key_col: str, dim: DataFrame, dim_key: str, dim_value: str,
                        out_col: str, default, last_wins_by: str | None = None) -> DataFrame:
    """Map ``key_col`` to ``dim_value`` via ``dim`` (a dictionary lookup).

    Duplicate dimension keys resolve to the row with the largest
    ``last_wins_by`` (the last one read in key order).  Unmatched or null
    keys get ``default``.  The deduplicated map is an aggregate, so its size
    is bounded by the number of distinct keys.
    """
    order = last_wins_by or dim_value
    mapping = (dim.where(F.col(dim_key).isNotNull())
               .groupBy(F.col(dim_key).alias("__key"))
               .agg(F.max_by(F.col(dim_value), F.col(order)).alias("__value")))
    joined = df.join(mapping, F.col(key_col) == F.col("__key"), "left")
    return joined.withColumn(out_col, F.coalesce(F.col("__value"), F.lit(default))).drop("__key", "__value")


@dataclass(frozen=True)
class Constant:
    """A key column known to hold one value for every row (a default)."""
    value: object


def _may_broadcast(parent: DataFrame) -> bool:
    """Whether Spark's size estimate of the parent is under its broadcast
    threshold (a choice of plan only: both ways give the same rows)."""
    limit = parent.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = parent._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null values of ``column`` that the parent does not hold.
    Only keys are shuffled, and equal ones are combined before."""
    keys = df.where(F.col(column).isNotNull()).select(column).distinct()
    known = parent.select(F.col(parent_key).alias("__parent"))
    return keys.join(known, F.col(column) == F.col("__parent"), "left_anti")


def split_by_foreign_keys(df: DataFrame, checks: Sequence[tuple[str | Constant, DataFrame, str, str]]):
    """Split rows into (accepted, rejected) by foreign-key existence.

    ``checks`` holds (column, parent frame, parent key, reason); the first
    failing check in order gives the reject reason.  A null key is not a
    violation (SQL foreign keys ignore nulls).  A parent that can be
    broadcast is joined as a set of keys with a flag, and the facts are
    scanned once.  For a larger one, the distinct fact keys are compared with
    the parent first, and the orphans among them (few, in sound data) are
    joined back to the facts, which therefore stay where they are.
    """
    out = df
    flags = []
    for i, (column, parent, parent_key, reason) in enumerate(checks):
        if isinstance(column, Constant):
            # A defaulted key is the same for every row: one existence test
            # (a scalar subquery), not a join against a folded constant.
            found = parent.where(F.col(parent_key) == F.lit(column.value)).agg(F.count(F.lit(1)) > 0).scalar()
            flags.append((found, reason))
            continue
        flag, key = f"__fk{i}", f"__pk{i}"
        if _may_broadcast(parent):
            keys = parent.select(F.col(parent_key).alias(key)).distinct().withColumn(flag, F.lit(True))
            ok = F.col(column).isNull() | F.col(flag).isNotNull()
        else:
            # Stored, so that the join knows how few they are.
            path = work_dir(df.sparkSession, "orphans")
            orphan_keys(df, column, parent, parent_key).select(F.col(column).alias(key)).write.parquet(path)
            keys = df.sparkSession.read.parquet(path).withColumn(flag, F.lit(True))
            ok = F.col(flag).isNull()
        out = out.join(keys, F.col(column) == F.col(key), "left").drop(key)
        flags.append((ok, reason))
    reason_col = F.lit(None).cast("string")
    for ok, reason in reversed(flags):
        reason_col = F.when(~ok, F.lit(reason)).otherwise(reason_col)
    out = out.withColumn("reject_reason", reason_col)
    temp = [c for c in out.columns if c.startswith("__fk")]
    accepted = out.where(F.col("reject_reason").isNull()).drop("reject_reason", *temp)
    rejected = out.where(F.col("reject_reason").isNotNull()).drop(*temp)
    return accepted, rejected


ROW = "__row"


def with_row_numbers(source: DataFrame) -> DataFrame:
    """Tag the rows of a source with their position.  To be called on a file
    scan or stored rows, before any join or shuffle: those give the same
    rows in the same places each time a plan reads them, which the parts of
    a keyed split rely on."""
    return source.withColumn(ROW, F.monotonically_increasing_id())


def mark_repeats(df: DataFrame, key: str, order: Sequence[str | Column], flag: str = "__again",
                 prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``flag``: whether the row repeats the key of another row that
    comes before it by ``order`` (rows equal in all of it: one of them stays,
    by position in the source).  A null key is no key and never repeated.

    One narrow aggregate finds the keys held twice; only their rows go
    through the ordered choice, whose result (a key and a row number for each
    of those keys) is joined back.  All other rows are left where they are.
    Row numbers are those of ``with_row_numbers``, taken here if the frame
    has none.  ``prepare`` derives the order columns where they are costly:
    it is applied to the rows of repeated keys only, and must keep the key
    and the row number.

    Where the result is too large to broadcast, the rows meet it by key and
    a hash that goes with it; rows without a key, however many, are spread
    by their row number instead of meeting in one task."""
    tagged = df if ROW in df.columns else with_row_numbers(df)
    held = tagged.where(F.col(key).isNotNull())
    twice = held.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    asked = held.join(twice, F.col(key) == F.col("__key"), "left_semi")
    asked = prepare(asked) if prepare else asked
    rank = F.struct(*[(c if isinstance(c, Column) else F.col(c)).alias(f"o{i}") for i, c in enumerate(order)],
                    F.col(ROW).alias("row"))
    first = asked.groupBy(F.col(key).alias("__key")).agg(F.min(rank).alias("__first")).select(
        "__key", F.col("__first.row").alias("__stays"))
    at = F.when(F.col(key).isNull(), F.xxhash64(ROW)).otherwise(F.xxhash64(key))
    marked = tagged.join(first, (F.col(key) == F.col("__key")) & (at == F.xxhash64("__key")), "left")
    return marked.withColumn(flag, F.coalesce(F.col("__stays") != F.col(ROW), F.lit(False))).drop(ROW, "__key", "__stays")


def split_by_key(df: DataFrame, key: str, order: Sequence[str | Column], reason: str | None = None):
    """(first row of each key, all other rows with ``reject_reason``): primary
    key enforcement that keeps both sides, so input = first + rejected.  Rows
    with a null key are rejected as missing one."""
    marked = mark_repeats(df, key, order)
    why = F.when(F.col(key).isNull(), F.lit(f"{key} is missing")).when(F.col("__again"), F.lit(reason or f"{key} is repeated"))
    marked = marked.withColumn("reject_reason", why).drop("__again")
    return marked.where(F.col("reject_reason").isNull()).drop("reject_reason"), marked.where(F.col("reject_reason").isNotNull())


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (primary-key rejection keeps
    the first).  An aggregate with map-side partial merge, not a window, so
    a hot key is combined before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others]).alias("__row")
    rank = F.struct(*[F.col(c) for c in order], packed)
    return (df.groupBy(*keys).agg(F.min(rank).alias("__first"))
            .select(*keys, *[F.col(f"__first.__row.{c}").alias(c) for c in others])
            .select(*df.columns))


def new_rows_only(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (idempotent append)."""
    existing = target.select(*keys).distinct()
    return batch.join(existing, on=list(keys), how="left_anti")
