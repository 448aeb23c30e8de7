"""Cleaning and business-rule expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deskflow import schemas
from deskflow.functions.util import col


def null_tokens(c, tokens: Sequence[str] = schemas.NULL_TOKENS) -> Column:
    """Text equal to a missing-value token (``NA``, ``nan``, empty, ...) -> null."""
    x = col(c)
    return F.when(~x.isin(list(tokens)), x)


def placeholder_to_null(c, placeholder: str) -> Column:
    """Whole-value placeholder (``?``, ``-100``) -> null."""
    return F.nullif(col(c), F.lit(placeholder))


def map_values(c, mapping: Mapping[str, str], default=None, keep_unmatched: bool = False) -> Column:
    """Whole-value, case-sensitive lookup in a small fixed map."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    x = col(c)
    hit = F.try_element_at(lookup, x)
    if keep_unmatched:
        return F.coalesce(hit, x)
    return hit if default is None else F.coalesce(hit, F.lit(default))


LEADING_INT = r"^\s*(\+?\d+)\s*(-|$)"


def leading_int(c) -> Column:
    """Integer before the first ``-`` ("2 - Medium" -> 2, "7" -> 7); null when
    that part is not an integer.  The pattern test runs first, so the cast
    only sees digits (a failing cast per row is far slower)."""
    x = col(c)
    return F.when(x.rlike(LEADING_INT), F.regexp_extract(x, LEADING_INT, 1).try_cast("int"))


def as_text(c) -> Column:
    """``str(x)`` with nulls kept as null."""
    return col(c).cast("string")


def truncate(c, width: int) -> Column:
    """Keep the first ``width`` characters (column width on load)."""
    return F.substring(col(c), 1, width)


def clean_state(c) -> Column:
    """Incident state: '-100' -> null, trim, lower, then state codes mapped."""
    s = F.lower(F.trim(placeholder_to_null(c, "-100")))
    s = F.when(s != "nan", s)
    return map_values(s, schemas.INCIDENT_STATE_CODES, keep_unmatched=True)


def ticket_priority_name(c) -> Column:
    """Ticket priority text -> name via the fixed map; unmatched or null -> Medium."""
    return map_values(col(c).cast("string"), schemas.TICKET_PRIORITY_MAP, default=schemas.TICKET_PRIORITY_DEFAULT)


def ticket_priority_id(c) -> Column:
    """Ticket priority by substring, first rule wins:
    CRITICAL/P1 -> 1, HIGH/P2 -> 2, LOW/P4 -> 4, else 3."""
    t = F.upper(F.trim(F.coalesce(col(c).cast("string"), F.lit("NAN"))))
    has = lambda *words: _any(t.contains(w) for w in words)
    return (F.when(has("CRITICAL", "P1"), 1).when(has("HIGH", "P2"), 2)
            .when(has("LOW", "P4"), 4).otherwise(3).cast("int"))


def incident_priority_id(priority_text, priority_name) -> Column:
    """Incident priority from a code text and a name, first rule wins:
    '1' or critical -> 1, '2' or high -> 2, '4' or low -> 4, else 3."""
    code = F.trim(F.coalesce(col(priority_text).cast("string"), F.lit("3")))
    name = F.lower(F.coalesce(col(priority_name).cast("string"), F.lit("")))
    rule = lambda digit, word: code.contains(digit) | name.contains(word)
    return (F.when(rule("1", "critical"), 1).when(rule("2", "high"), 2)
            .when(rule("4", "low"), 4).otherwise(3).cast("int"))


def incident_priority_label(c) -> Column:
    """'1 - Critical' -> 'critical' ...; unmatched -> null."""
    return map_values(c, schemas.INCIDENT_PRIORITY_LABELS)


def bool_to_int(c) -> Column:
    """Flag as 0/1 from a boolean, a number or a text form; else null."""
    x = col(c)
    return F.coalesce(x.try_cast("int"), x.cast("string").try_cast("boolean").cast("int"))


def synthetic_int(key, lo: int, hi: int, salt: int) -> Column:
    """Deterministic stand-in for a random integer in ``[lo, hi)`` derived from
    a row key: ``lo + (key * 7919 + salt) mod (hi - lo)``."""
    k = col(key).cast("long")
    return (F.lit(lo) + F.pmod(k * 7919 + F.lit(salt), F.lit(hi - lo))).cast("int")


def round_robin(n, k: int) -> Column:
    """``(n mod k) + 1`` for spreading rows over k keys."""
    return (F.pmod(col(n), F.lit(k)) + 1).cast("int")


def reassign_bin(c) -> tuple[Column, Column]:
    """Right-closed bins over the fixed edges -> (label, order); outside -> null."""
    x = col(c)
    edges, labels = schemas.REASSIGN_BIN_EDGES, schemas.REASSIGN_BIN_LABELS
    label, order = F.lit(None).cast("string"), F.lit(None).cast("int")
    for i in reversed(range(len(labels))):
        inside = (x > edges[i]) & (x <= edges[i + 1])
        label = F.when(inside, F.lit(labels[i])).otherwise(label)
        order = F.when(inside, F.lit(i)).otherwise(order)
    return label, order


def home_or_international(country, home: str) -> Column:
    """Region type: the home country's name, else 'International'."""
    return F.when(col(country) == home, F.lit(home)).otherwise(F.lit("International"))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame lacks are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def add_missing(df: DataFrame, defaults: Mapping[str, object], types: Mapping[str, str] | None = None) -> DataFrame:
    """Add a constant column for each default whose column is absent (a null
    value in a present column is left alone)."""
    types = types or {}
    new = {}
    for name, value in defaults.items():
        if name not in df.columns:
            lit = F.lit(value)
            new[name] = lit.cast(types[name]) if name in types else lit
    return df.withColumns(new) if new else df


def _any(conds) -> Column:
    out = None
    for c in conds:
        out = c if out is None else (out | c)
    return out
