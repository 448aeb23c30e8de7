"""Aggregate and rounding expressions with warehouse (SQL/pandas) semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from deskflow.functions.util import col


def int_avg(c) -> Column:
    """SQL ``AVG`` over an integer column: an integer truncated toward zero;
    null when no value is present."""
    x = col(c).cast("long")
    total, n = F.sum(x), F.nullif(F.count(x), F.lit(0))
    # (total - total % n) is an exact multiple of n; % keeps the sign of the
    # dividend, so the quotient is truncated toward zero.
    return F.round((total - total % n) / n).cast("int")


def pct2(numerator, denominator) -> Column:
    """``CAST(n * 100.0 / d AS DECIMAL(5,2))``: decimal division, rounded half up."""
    n = col(numerator).cast("decimal(20,0)")
    d = F.nullif(col(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (n * F.lit(100).cast("decimal(3,0)") / d).cast("decimal(5,2)")


def share_pct(count, total) -> Column:
    """``count / total * 100`` as a double (pandas share of rows)."""
    return col(count).cast("double") * 100 / F.nullif(col(total).cast("double"), F.lit(0.0))


def round_even(c, digits: int = 2) -> Column:
    """pandas/numpy ``round``: half to even on the scaled value."""
    scale = 10.0 ** digits
    return F.rint(col(c) * scale) / scale


def pearson(x, y) -> Column:
    """Pearson correlation over rows where both values are present; null on
    zero variance or fewer than two pairs (never raises)."""
    cx, cy = col(x).cast("double"), col(y).cast("double")
    both = cx.isNotNull() & cy.isNotNull()
    px, py = F.when(both, cx), F.when(both, cy)
    denom = F.stddev_pop(px) * F.stddev_pop(py)
    return F.when(denom > 0, F.covar_pop(px, py) / denom)


def first_label_of_max(label, value) -> Column:
    """Label of the largest value; ties go to the smallest label."""
    return F.min_by(col(label), F.struct(-col(value), col(label)))


def first_label_of_min(label, value) -> Column:
    """Label of the smallest value; ties go to the smallest label."""
    return F.min_by(col(label), F.struct(col(value), col(label)))


def sum_flag(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")
