"""Small shared helpers for Column arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def local_rows(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small constant table as a local relation (its true, tiny size is
    known to the optimizer, so joins against it broadcast)."""
    schema = T._parse_datatype_string(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
