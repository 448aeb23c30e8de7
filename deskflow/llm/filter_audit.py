"""Filter interaction audit on sorted posting lists.

Each filter that a document fails puts the document's row number on that
filter's posting list.  Lists are kept per part and per range of row
numbers, sorted, so none grows with the table.  Within a range, unions of
lists come from galloping merges: the place of the next elements of one
list in the other is found by doubling steps from the last place and a
bisection of the last step.  Sizes of unions (all documents, good ones,
toxic ones) are summed over the ranges; every figure of the audit is a sum
or difference of union sizes:

* kept after filters S: documents of the part less the union of S;
* removed by f after S: union of S and f, less union of S;
* redundant: failing f, less removed;
* unique failures: union of all, less union of all but f;
* Shapley total: removed, weighted by the number of orders in which exactly
  S precedes f.

Defined results: a null text is empty; a null part is the empty string; a
null doc_id is smaller than no other, so it neither fails the copy filter
nor makes another document fail it; repeated rows count as documents of
their own, and equal texts under one doc_id do not fail the copy filter for
each other; a document is good (toxic) if any label row of its doc_id says
so; an empty table gives no parts and no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

# Row numbers in one range: bounds the lists that one merge holds.
RANGE_BITS = 16
BLOCK = 512

Test = Callable[[str, bytes], bool]


def _ascii(keep: bytes) -> bytes:
    return bytes(b for b in range(256) if b not in keep)


_NOT_UPPER = _ascii(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_NOT_SYMBOL = _ascii(b"#$%&*|")


def few_words(text: str, raw: bytes, words: Sequence[bytes]) -> bool:
    return len(words) < 200


def repetitive(text: str, raw: bytes, words: Sequence[bytes]) -> bool:
    return 100 * len(set(words)) < 50 * len(words)


def shouting(text: str, raw: bytes, words: Sequence[bytes]) -> bool:
    return 100 * len(raw.translate(None, _NOT_UPPER)) > 3 * len(text)


def symbols(text: str, raw: bytes, words: Sequence[bytes]) -> bool:
    return len(raw.translate(None, _NOT_SYMBOL)) > 0


TEXT_FILTERS = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}
COPY_FILTER = "E"


def marks(docs: DataFrame, filters: dict[str, Callable] = TEXT_FILTERS, part: str = "lang") -> DataFrame:
    """doc_id, part, fails (bit k: k-th filter) and a 128-bit text digest."""
    tests = list(filters.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                raw = text.encode("utf-8")
                words = raw.split()  # ASCII white space
                fails.append(sum(1 << k for k, test in enumerate(tests) if test(text, raw, words)))
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fails, pa.int32()),
                                              pa.array(digests, pa.binary())], names=["doc_id", "part", "fails", "digest"])

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text"))
    return read.mapInArrow(run, "doc_id bigint, part string, fails int, digest binary")


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Place of each needle in ``hay`` (both sorted).  Block by block, the
    search window starts where the last block ended and doubles until it
    passes the block's last needle; the block is bisected within it."""
    out = np.empty(len(needles), dtype=np.int64)
    low, n = 0, len(hay)
    for k in range(0, len(needles), BLOCK):
        block = needles[k:k + BLOCK]
        step, high = 1, low
        while high < n and hay[high] < block[-1]:
            high, step = low + step, 2 * step
        high = min(high + 1, n)
        out[k:k + BLOCK] = low + np.searchsorted(hay[low:high], block)
        low = int(out[min(k + BLOCK, len(needles)) - 1])
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Elements of ``a`` that are not in ``b`` (sorted, without repeats)."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = gallop(a, b)
        return a[(at == len(b)) | (b[np.minimum(at, len(b) - 1)] != a)]
    at = gallop(b, a)
    hit = (at < len(a)) & (a[np.minimum(at, len(a) - 1)] == b)
    return np.delete(a, at[hit])


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sorted union: what the longer list lacks is put in its place."""
    if len(a) < len(b):
        a, b = b, a
    new = difference(b, a)
    return np.insert(a, gallop(new, a), new) if len(new) else a


def common_size(a: np.ndarray, b: np.ndarray) -> int:
    return len(a) - len(difference(a, b))


def union_sizes(lists: Sequence[np.ndarray], among: Sequence[np.ndarray]) -> np.ndarray:
    """[set of lists (bit mask), 0 or 1 + index in ``among``]: size of the
    union, and how much of it each list of ``among`` holds."""
    n = len(lists)
    sizes = np.zeros((1 << n, 1 + len(among)), dtype=np.int64)
    unions = {0: np.empty(0, dtype=np.int64)}
    for mask in range(1, 1 << n):
        rest = mask & (mask - 1)
        merged = unions[mask] = union(unions[rest], lists[(mask ^ rest).bit_length() - 1])
        sizes[mask] = [len(merged), *(common_size(x, merged) for x in among)]
    return sizes


def posting_lists(marked: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part and range: documents, the sorted row numbers that
    fail each filter (``f0``, ``f1``, ...), the good and the toxic ones."""
    lists = [F.sort_array(F.collect_list(F.when(F.col("fails").bitwiseAND(F.lit(1 << k)) != 0, F.col("row")))).alias(f"f{k}")
             for k in range(len(names))]
    seen = [F.sort_array(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c) for c in ("good", "toxic")]
    ranged = marked.withColumn("range", F.shiftright("row", RANGE_BITS))
    return ranged.groupBy("part", "range").agg(F.count(F.lit(1)).alias("n"), *lists, *seen)


def _sized(names: Sequence[str]):
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, out = [], []
            for i in range(batch.num_rows):
                column = {c: batch.column(c)[i] for c in batch.schema.names}
                row = lambda c: np.asarray(column[c].values.to_numpy(zero_copy_only=False), dtype=np.int64)
                sizes = union_sizes([row(f"f{k}") for k in range(n)], [row("good"), row("toxic")])
                sizes[0, 0] = column["n"].as_py()  # the empty union's place holds the part's documents
                parts.append(column["part"].as_py())
                out.append(sizes.ravel().tolist())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(out, pa.list_(pa.int64()))],
                                             names=["part", "sizes"])

    return run


def _audited(names: Sequence[str]):
    n, full = len(names), (1 << len(names)) - 1
    orders = [tuple(names.index(c) for c in p) for p in permutations(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in AUDIT.names}
            for part, flat in zip(batch.column("part").to_pylist(), batch.column("sizes").to_pylist()):
                size = np.array(flat, dtype=np.int64).reshape(1 << n, 3)
                docs = int(size[0, 0])
                size[0, 0] = 0
                weight = [factorial(k) * factorial(n - 1 - k) for k in range(n)]
                shapley = [sum(weight[s.bit_count()] * int(size[s | 1 << f, 0] - size[s, 0])
                               for s in range(1 << n) if not s >> f & 1) for f in range(n)]
                for order in orders:
                    before = 0
                    for step, f in enumerate(order, 1):
                        after = before | 1 << f
                        removed = size[after] - size[before]
                        values = (part, "".join(names[x] for x in order), step, docs - int(size[after, 0]), int(removed[0]),
                                  int(size[1 << f, 0] - removed[0]), int(size[full, 0] - size[full ^ 1 << f, 0]),
                                  int(removed[1]), int(removed[2]), shapley[f])
                        for name, value in zip(AUDIT.names, values):
                            rows[name].append(value)
                        before = after
            yield pa.RecordBatch.from_pydict(rows, schema=AUDIT)

    return run


AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), ("kept", pa.int64()),
                   ("removed", pa.int64()), ("redundant", pa.int64()), ("unique_fails", pa.int64()), ("good_lost", pa.int64()),
                   ("toxic_lost", pa.int64()), ("shapley", pa.int64())])
AUDIT_SQL = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
             "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable] = TEXT_FILTERS,
                 part: str = "lang") -> DataFrame:
    """One row per part, order of the filters (the text filters and the copy
    filter) and step."""
    names = [*filters, COPY_FILTER]
    # Stored with its row numbers: they stay the same when a task runs again.
    marked = store(marks(docs, filters, part).withColumn("row", F.monotonically_increasing_id()), "audit-marks")

    # Only texts that stand under two doc_ids can fail the copy filter.  The
    # second key makes both sides shuffle, so that AQE can split a text that
    # a third of the documents share.
    first = marked.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    first = first.select(F.col("digest").alias("d2"), F.xxhash64("digest").alias("h2"), "first")
    copied = marked.join(first, (F.col("digest") == F.col("d2")) & (F.xxhash64("digest") == F.col("h2")), "left")
    bit = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << len(filters))).otherwise(F.lit(0))
    marked = copied.select("doc_id", "part", "row", F.col("fails").bitwiseOR(bit).alias("fails"))

    said = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("bigint").alias("l2")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).withColumn("lh", F.xxhash64("l2"))
    marked = marked.join(said, (F.col("doc_id") == F.col("l2")) & (F.xxhash64("doc_id") == F.col("lh")), "left")

    sizes = posting_lists(marked.select("part", "row", "fails", "good", "toxic"), names).mapInArrow(
        _sized(names), "part string, sizes array<bigint>")
    cells = sizes.select("part", F.posexplode("sizes").alias("cell", "size")).groupBy("part", "cell").agg(F.sum("size").alias("size"))
    whole = cells.groupBy("part").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "size"))), lambda x: x["size"]).alias("sizes"))
    return whole.mapInArrow(_audited(names), AUDIT_SQL)
