"""Readers and writers: CSV with explicit schemas and corrupt-record rejects,
optional sources, schema alignment, and parquet tables that are reloaded as
versions.

A reloaded table is a folder of versions and a pointer file that names the
current one.  A reload writes a new version first and then replaces the
pointer in one rename, so readers see the old rows or the new ones, and a
reload that fails midway leaves the table as it was.  A folder without a
pointer is read as a plain parquet table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deskflow.functions.clean import null_tokens
from deskflow.session import work_dir

CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
CORRUPT = "_corrupt_record"
POINTER = "_current"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, token_columns: Sequence[str] = ()) -> DataFrame:
    """CSV with a header and an explicit schema.  Quoted fields may hold
    newlines and doubled quotes.  Malformed rows become nulls (PERMISSIVE);
    ``read_csv_split`` keeps their text.  Missing-value tokens (NA, nan, ...)
    in ``token_columns`` become null.  Multi-line files are not splittable,
    so the scan is repartitioned."""
    df = (spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE").csv(path))
    df = df.repartition(spark.sparkContext.defaultParallelism)
    if token_columns:
        df = df.withColumns({c: null_tokens(c) for c in token_columns})
    return df


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None,
                   token_columns: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rejects) of a CSV source.  A record with a field that does
    not parse to its type, or with too many or too few fields, is a reject:
    ``record`` holds its raw text and ``reject_reason`` the first cause.

    The whole record is parsed, whatever columns are read later (a pruned
    scan would judge a record by the columns it needs), and stored once for
    both sides.  By default one line is one record, so that files are split;
    pass ``multiLine`` for quoted newlines."""
    names = [f.name for f in schema.fields]
    parsed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    given = {**CSV_OPTIONS, "multiLine": "false", **(options or {})}
    rows = (spark.read.schema(parsed).options(**given).option("mode", "PERMISSIVE").option("columnPruning", "false")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    stored = f"{work_dir(spark, 'csv')}/parsed"
    rows.write.parquet(stored)
    rows = spark.read.schema(parsed).parquet(stored)
    sound = rows.where(F.col(CORRUPT).isNull()).select(*names)
    if token_columns:
        sound = sound.withColumns({c: null_tokens(c) for c in token_columns})
    # Fields as the parser splits them; more than the schema has are counted too.
    fields = F.from_csv(F.col(CORRUPT), F.lit(", ".join(f"c{i} string" for i in range(len(names) + 1))),
                        {k: given[k] for k in ("quote", "escape", "sep") if k in given})
    width = F.when(F.col(f"__f.c{len(names)}").isNotNull(), len(names) + 1).otherwise(
        F.array_size(F.array_compact(F.array(*[F.col(f"__f.c{i}") for i in range(len(names))]))))
    first = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(schema.fields))):
        if not isinstance(f.dataType, T.StringType):
            value = F.col(f"__f.c{i}")
            first = F.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f"{f.name} is not of type {f.dataType.simpleString()}")).otherwise(first)
    # try_cast and the CSV parser can disagree on odd number or time forms.
    reason = (F.when(F.col(f"__f.c{len(names)}").isNotNull(), F.lit("too many fields"))
              .otherwise(F.coalesce(first, F.when(width < len(names), F.lit("too few fields")), F.lit("malformed record"))))
    rejects = rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, fields.alias("__f")).select(
        F.col(CORRUPT).alias("record"), reason.alias("reject_reason"))
    return sound, rejects


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, no index; doubled quotes inside quoted fields."""
    (df.write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", "false").csv(path))


# ------------------------------------------------------------- small files
def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, hpath, hpath.getFileSystem(conf)


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists on its file system (None when the check is
    not available, e.g. on a remote session)."""
    try:
        _, _, hpath, fs = _hadoop(spark, path)
        return bool(fs.exists(hpath))
    except Exception:  # noqa: BLE001 - fall back to reading
        return None


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    _, _, hpath, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file on any of Spark's file systems; None if absent."""
    if not path_exists(spark, path):
        return None
    jvm, _, hpath, fs = _hadoop(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file's text in one step: written beside it, then
    renamed over it."""
    jvm, conf, hpath, fs = _hadoop(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), conf).rename(beside, hpath, how)


# ------------------------------------------------------------------ tables
def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """Read a parquet source if it exists, else an empty frame of ``schema``."""
    if path_exists(spark, path) is False:
        return spark.createDataFrame([], schema), False
    try:
        return spark.read.schema(schema).parquet(path), True
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            return spark.createDataFrame([], schema), False
        raise


def align(df: DataFrame, target: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Select the target's columns in order: present ones cast to the target
    type, absent ones as the default (or null); extra columns are dropped."""
    defaults = defaults or {}
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def table_folder(spark: SparkSession, path: str) -> str:
    """Folder that holds the table's rows now."""
    version = read_small(spark, f"{path}/{POINTER}")
    return f"{path}/{version}" if version else path


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty parquet table at ``path`` unless one exists."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(table_folder(spark, path))


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows aligned to the table schema (explicit column list)."""
    align(df, schema).write.mode("append").parquet(table_folder(df.sparkSession, path))


def stage(df: DataFrame, path: str, schema: T.StructType | None = None) -> str:
    """Write a new version of the table and return its name; readers do not
    see it before ``publish``."""
    version = f"v-{uuid.uuid4().hex[:16]}"
    (align(df, schema) if schema is not None else df).write.parquet(f"{path}/{version}")
    return version


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a staged version the current one.  The version before it stays
    for readers that are still on it; older ones are deleted."""
    before = read_small(spark, f"{path}/{POINTER}")
    replace_small(spark, f"{path}/{POINTER}", version)
    _, _, hpath, fs = _hadoop(spark, path)
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            fs.delete(status.getPath(), True)


def overwrite(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Full reload of a table, all or nothing.  The source may read the table
    itself."""
    publish(df.sparkSession, path, stage(df, path, schema))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    return (r.schema(schema) if schema is not None else r).parquet(table_folder(spark, path))
