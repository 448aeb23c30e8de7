"""Column renames by map, planned before they are applied.

A plan lists what becomes of every source column and of every name that the
map speaks of, so a source that drifted (a column gone, two columns that end
up under one name, a name that the target table does not have) is seen before
rows are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from deskflow.functions.util import local_rows


@dataclass(frozen=True)
class Step:
    """What becomes of a source column: ``renamed``, ``kept`` (its name
    stays), ``collision`` (another column takes the name before it) or
    ``absent`` (the map names it, the source lacks it)."""
    source: str
    target: str
    status: str
    in_target: bool | None


class RenameCollision(ValueError):
    """Two source columns would get one name."""


def plan_renames(columns: Sequence[str], mapping: Mapping[str, str], target: Sequence[str] | None = None) -> list[Step]:
    """Steps for the source columns in order, then for the mapped names that
    the source lacks.  Names are compared without case, as Spark resolves
    them.  A name that several columns would get goes to a mapped column
    before an unmapped one, and to the first in the map."""
    given = {c.lower(): c for c in columns}
    by_name = {k.lower(): v for k, v in mapping.items()}
    mapped = [given[k.lower()] for k in mapping if k.lower() in given]
    taken: dict[str, str] = {}
    for c in [*mapped, *[c for c in columns if c not in mapped]]:
        taken.setdefault(by_name.get(c.lower(), c).lower(), c)
    known = None if target is None else {t.lower() for t in target}
    inside = lambda name: None if known is None else name.lower() in known
    steps = []
    for c in columns:
        name = by_name.get(c.lower(), c)
        status = "collision" if taken[name.lower()] != c else "kept" if name == c else "renamed"
        steps.append(Step(c, name, status, inside(name)))
    return steps + [Step(k, v, "absent", inside(v)) for k, v in mapping.items() if k.lower() not in given]


def apply_renames(df: DataFrame, mapping: Mapping[str, str], target: Sequence[str] | None = None,
                  collisions: str = "fail", known_only: bool = False) -> DataFrame:
    """Rename by map.  A collision raises ``RenameCollision``, or with
    ``collisions="first"`` the later column is left out.  ``known_only``
    drops columns whose name the target lacks."""
    steps = plan_renames(df.columns, mapping, target)
    lost = [s for s in steps if s.status == "collision"]
    if lost and collisions != "first":
        raise RenameCollision("; ".join(f"{s.source} would take the name {s.target} a second time" for s in lost))
    keep = [s for s in steps if s.status in ("renamed", "kept") and not (known_only and s.in_target is False)]
    return df.select(*[F.col(f"`{s.source}`").alias(s.target) for s in keep])


def rename_report(name: str, df: DataFrame, mapping: Mapping[str, str], target: Sequence[str] | None = None) -> DataFrame:
    """The plan of a source with the non-null rows of each of its columns,
    counted in one pass."""
    steps = plan_renames(df.columns, mapping, target)
    counts = df.agg(F.struct(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).alias("n"))
    place = {c: i for i, c in enumerate(df.columns)}
    rows = [(name, s.source, s.target, s.status, s.in_target, place.get(s.source)) for s in steps]
    plan = local_rows(df.sparkSession, rows, "source_name string, source_column string, target_column string, status string, in_target boolean, place int")
    filled = F.array(*[F.col(f"n.n{i}") for i in range(len(df.columns))])
    per = counts.select(F.posexplode(filled).alias("at", "non_null_rows"))
    return plan.join(per, F.col("place") == F.col("at"), "left").drop("place", "at")
