"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

# ASCII white space, as a character class and as a list of characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE, -1))


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null key: fold 0)."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0).cast("bigint"))


_SCRATCH: list[str] = []


@contextmanager
def scratch(spark) -> Iterator[None]:
    """Within it, ``store`` writes to one folder, which goes at the end:
    what comes of the stored frames must have been stored outside by then
    (see ``store``'s ``keep``)."""
    folder = work_dir(spark, "scratch")
    _SCRATCH.append(folder)
    try:
        yield
    finally:
        _SCRATCH.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a frame under the shared checkpoint folder and read it back
    (cuts lineage; survives lost executors).  Within ``scratch`` it goes with
    that folder, unless it is to ``keep`` beyond the innermost one."""
    path = work_dir(df.sparkSession, name)
    around = _SCRATCH[:-1] if keep else _SCRATCH
    if around:
        path = f"{around[-1]}/{path.rsplit('/', 1)[1]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def carried(docs: DataFrame, carry: list[str] | None, added: Sequence[str], named: dict[str, str] | None) -> tuple[list[str], dict[str, str]]:
    """(input columns that an operator carries along, output name of each
    column it adds).  An input column is left out only where an added one
    takes its name."""
    told = {c: (named or {}).get(c, c) for c in added}
    taken = {c.lower() for c in told.values()}
    return [c for c in (carry if carry is not None else docs.columns) if c.lower() not in taken], told


def fresh_names(docs: DataFrame, added: Sequence[str]) -> dict[str, str]:
    """Names for added columns that ``docs`` does not have."""
    return {c: fresh(docs, c) for c in added}


def exclusive_scan(values: Column, op: Callable[[Column, Column], Column], zero: int = 0, block: int = 256) -> Column:
    """For an array of longs: ``op`` over the elements before each one, and
    over all of them last (one element more than the array).  ``op`` is
    associative.  Blocks are scanned on their own and then moved by the
    blocks before them, so that no array grows element by element beyond the
    block length or the number of blocks."""
    start = F.lit(zero).cast("bigint")

    def scan(a: Column) -> Column:
        return F.aggregate(a, F.array(start), lambda s, x: F.concat(s, F.array(op(F.element_at(s, -1), x))))

    def joined(a: Column) -> Column:
        places = F.sequence(F.lit(0), F.ceil(F.size(a) / block).cast("int") - 1)
        parts = F.transform(F.transform(places, lambda i: F.slice(a, i * block + 1, F.lit(block))), scan)
        def moved(p: Column) -> Column:
            before = scan(F.transform(p, lambda x: F.element_at(x, -1)))
            each = F.zip_with(p, F.slice(before, F.lit(1), F.size(p)), lambda x, b: F.transform(
                F.slice(x, F.lit(1), F.size(x) - 1), lambda v: op(b, v)))
            return F.concat(F.flatten(each), F.slice(before, F.size(before), F.lit(1)))
        return let(parts, moved)

    return let(values, lambda a: F.when(F.size(a) <= block, scan(a)).otherwise(joined(a)))


def code_points(text: Column) -> Column:
    """The text with four bytes a code point, for slices by position whose
    cost does not grow with the position."""
    return F.encode(text, "UTF-32")


def text_slice(points: Column, start: Column, end: Column) -> Column:
    """Text between two code-point positions of ``code_points``."""
    return F.decode(F.substring(points, (4 * start + 1).cast("int"), (4 * F.greatest(end - start, F.lit(0))).cast("int")), "UTF-32")
