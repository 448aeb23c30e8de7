"""SimHash near-duplicates with a pigeonring candidate filter.

Fingerprints have 64 bits.  They are cut into a ring of segments.  If two
fingerprints differ in at most t bits, the pigeonring principle gives a
segment from which every chain of l consecutive segments holds at most
floor(l * t / m) differences.  With m = 4t segments the first three of the
chain agree, and (t >= 2) the next four hold one difference at most, so one
of their two halves agrees too.  Those agreeing segments are the index key:
a fingerprint that shares no key with another one is pruned.

The full Hamming check of what remains needs no pairs either: two
fingerprints are within t bits when some value lies within floor(t/2) bits
of one and ceil(t/2) of the other.  Each candidate is listed under the
values of that ball; the fingerprints listed under one value are few, being
all within reach of it, and each links to the smallest near one.  Links and
so components are exact, whatever the size of a bucket or a group of copies.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; repeated rows get the same class; a null doc_id is never the
smallest (a class of null ids only has a null component_id); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, scratch, store
from .components import components

BITS = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bits set in over half of the shingles' XXH64 (seed 42), unsigned."""
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    starts = np.zeros(len(tokens), dtype=np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    ends = (starts + lengths)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    n = len(ends)
    counts = np.zeros(BITS, dtype=np.int64)
    step = 1 << 16  # bounds the bit matrix of a very long text
    for k in range(0, n, step):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[k:k + step].tolist(), ends[k:k + step])],
                          dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keys: list[str], shingle: int = 3) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint as a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps)], names=[*keys, "fp"])

    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys) + ", fp bigint"
    return docs.select(F.col("text").alias("_text"), *keys).mapInArrow(run, schema)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    m = min(BITS, 4 * max_bits)
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain_masks(max_bits: int) -> list[int]:
    """Masks of the bits that agree for a pair within ``max_bits``: for at
    least one of the masks, both fingerprints have the same bits there."""
    if max_bits == 0:
        return [(1 << BITS) - 1]
    ring = segments(max_bits)
    m = len(ring)
    bits = [((1 << w) - 1) << a for a, w in ring]
    free = (m - 1) // max_bits  # longest chain with a budget below one
    masks = []
    for i in range(m):
        head = sum(bits[(i + j) % m] for j in range(free))
        one = min(m, (2 * m - 1) // max_bits) - free  # more segments with a budget below two
        if max_bits == 1 or one < 2:
            masks.append(head)
            continue
        half = one // 2
        masks.append(head | sum(bits[(i + free + j) % m] for j in range(half)))
        masks.append(head | sum(bits[(i + free + j) % m] for j in range(half, one)))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ball(fp: Column, radius: int) -> Column:
    flips = [0] + [sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(range(BITS), r)]
    return F.transform(F.array(*[F.lit(_signed(f)) for f in flips]), lambda x: fp.bitwiseXOR(x))


def candidates(fps: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints that share a chain key with another one."""
    masks = F.array(*[F.lit(_signed(m)) for m in chain_masks(max_bits)])
    keyed = fps.select("fp", F.posexplode(masks).alias("chain", "mask")).select(
        "fp", "chain", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    # min <> max: the bucket holds two fingerprints at least.
    shared = keyed.groupBy("chain", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi") \
        .select(F.col("chain").alias("c2"), F.col("key").alias("k2"), F.xxhash64("key").alias("h2"))
    return keyed.join(shared, (keyed["chain"] == shared["c2"]) & (keyed["key"] == shared["k2"])
                      & (F.xxhash64(keyed["key"]) == shared["h2"]), "left_semi").select("fp").distinct()


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints reachable by steps
    of at most ``max_bits`` bits."""
    near, far = max_bits // 2, (max_bits + 1) // 2
    found = store(candidates(fps, max_bits), "simhash-candidates")
    listed = found.select("fp", F.explode(_ball(F.col("fp"), far)).alias("z"))
    listed = listed.withColumn("near", F.bit_count(F.col("fp").bitwiseXOR(F.col("z"))) <= near)
    group = listed.groupBy("z").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("u"), F.collect_set("fp").alias("all"))
    return group.where("u is not null and size(all) > 1").select("u", F.explode("all").alias("v")).where("u <> v").distinct()


def simhash_classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2, key: str = "doc_id",
                    carry: list[str] | None = None) -> DataFrame:
    """One row per document: key, ``carry`` columns, fingerprint (hex),
    component_id (smallest key of the class, reached over links of at most
    ``max_bits`` bits) and class_id (hex; also tells classes of null keys
    apart)."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    carry = [c for c in carry or [] if c != key]
    marked = store(fingerprints(docs, [key, *carry], shingle), "simhash-fp")
    fps = store(marked.groupBy("fp").agg(F.min(key).alias("rep")), "simhash-distinct")
    if max_bits == 0:
        classes = fps.select("fp", F.col("fp").alias("root"), F.col("rep").alias("component_id"))
    else:
        with scratch(docs.sparkSession):  # candidates, and the edges of every round
            comp = store(components(links(fps, max_bits)), "simhash-components", keep=True)
        rooted = fps.join(comp, F.col("fp") == F.col("node"), "left").select(
            "fp", "rep", F.coalesce("root", "fp").alias("root"))
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        classes = rooted.join(least, "root").select("fp", "root", "component_id")
    classes = classes.select(F.col("fp").alias("cfp"), F.xxhash64("fp").alias("cfh"), "root", "component_id")
    out = marked.join(classes, (marked["fp"] == classes["cfp"]) & (F.xxhash64(marked["fp"]) == classes["cfh"]))
    return out.select(key, *carry, _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("class_id"))


def _hex(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def one_per_class(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Rows of ``docs``, one of each class: that with the smallest doc_id
    (of rows that share it, one)."""
    a, b = fresh(docs, "ka"), fresh(docs, "kb")
    keyed = docs.withColumns({a: F.xxhash64("doc_id", "text"), b: F.hash("text", "doc_id")})
    classes = simhash_classes(keyed, shingle, max_bits, carry=[a, b])
    keep = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("class_id").agg(
        F.min(F.struct(a, b)).alias("k")).select(F.col(f"k.{a}").alias("keep_a"), F.col(f"k.{b}").alias("keep_b"))
    keep = store(keep, "simhash-keep")
    kept = keyed.join(keep, (keyed[a] == keep["keep_a"]) & (keyed[b] == keep["keep_b"]), "left_semi")
    return kept.dropDuplicates([a, b]).select(*docs.columns)
