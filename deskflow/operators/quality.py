"""Data quality: validation metrics with PASS/FAIL, foreign-key audit, score.

Checks on one table are computed in one aggregation and unpivoted; the
validation log is a DataFrame of (table, type, metric, value, threshold,
notes) rows whose status follows the log rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from deskflow.functions.numeric import pct2

METRIC_TYPE = "decimal(20,4)"


@dataclass(frozen=True)
class Check:
    validation_type: str
    metric: str
    value: Column  # an aggregate expression over the table
    threshold: float
    notes: str | None = None


def status(value, threshold) -> Column:
    """PASS/FAIL rule: threshold 0 -> PASS only when the value is 0; else
    PASS when value <= threshold; a missing value or threshold -> FAIL."""
    v, t = F.col(value) if isinstance(value, str) else value, F.col(threshold) if isinstance(threshold, str) else threshold
    rule = F.when(t == 0, F.when(v == 0, "PASS").otherwise("FAIL")).otherwise(F.when(v <= t, "PASS").otherwise("FAIL"))
    return F.coalesce(rule, F.lit("FAIL"))


def table_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One aggregation for all checks on ``table``, one row per check."""
    wide = df.agg(*[c.value.cast(METRIC_TYPE).alias(f"v{i}") for i, c in enumerate(checks)])
    rows = []
    for i, c in enumerate(checks):
        notes = "cast(null as string)" if c.notes is None else "'" + c.notes.replace("'", "''") + "'"
        rows.append(f"'{c.validation_type}', '{c.metric}', v{i}, cast({c.threshold} as {METRIC_TYPE}), {notes}")
    return wide.selectExpr(
        f"'{table}' as table_name",
        f"stack({len(checks)}, {', '.join(rows)}) as (validation_type, validation_metric, metric_value, threshold_value, notes)")


def null_pct(c: str) -> Column:
    return F.count_if(F.col(c).isNull()).cast("double") * 100 / F.count(F.lit(1))


def fk_audit(tables: Mapping[str, DataFrame], edges) -> DataFrame:
    """Orphan rows per foreign-key edge (null keys are not orphans).

    Each child table is read once: its key columns are joined with each
    parent's distinct keys (a flag per edge) and one aggregation counts the
    orphans of all its edges."""
    by_child: dict[str, list] = {}
    for child, column, parent, parent_key in edges:
        by_child.setdefault(child, []).append((column, parent, parent_key))
    out = None
    for child, child_edges in by_child.items():
        cols = sorted({c for c, _, _ in child_edges})
        df = tables[child].select(*cols)
        counts = []
        for i, (column, parent, parent_key) in enumerate(child_edges):
            keys = (tables[parent].select(F.col(parent_key).alias(f"__pk{i}")).distinct()
                    .withColumn(f"__hit{i}", F.lit(True)))
            df = df.join(keys, F.col(column) == F.col(f"__pk{i}"), "left").drop(f"__pk{i}")
            orphan = F.col(column).isNotNull() & F.col(f"__hit{i}").isNull()
            counts.append(F.count_if(orphan).alias(f"o{i}"))
        wide = df.agg(*counts)
        rows = ", ".join(f"'{column}', '{parent}', o{i}" for i, (column, parent, _) in enumerate(child_edges))
        one = wide.selectExpr(f"'{child}' as child_table",
                              f"stack({len(child_edges)}, {rows}) as (fk_column, parent_table, orphan_rows)")
        out = one if out is None else out.unionByName(one)
    return out.select("child_table", "fk_column", "parent_table", "orphan_rows")


def validation_log(metric_rows: DataFrame, validation_date: Column) -> DataFrame:
    """Log rows with status; ids follow (table, type, metric) order.  The
    log holds one row per check, so numbering it in one partition is fine."""
    from pyspark.sql import Window

    w = Window.orderBy("table_name", "validation_type", "validation_metric")
    return metric_rows.select(
        F.row_number().over(w).cast("long").alias("validation_id"), validation_date.alias("validation_date"),
        "table_name", "validation_type", "validation_metric", "metric_value", "threshold_value",
        status("metric_value", "threshold_value").alias("validation_status"), "notes")


def dq_score(log: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    passed = F.count_if(F.col("validation_status") == "PASS")
    return log.agg(n.alias("checks_total"), passed.alias("checks_passed"), (n - passed).alias("checks_failed"),
                   pct2(passed, n).alias("dq_score_pct"))
