"""SimHash classes and components against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from deskflow.llm.components import components
from deskflow.llm.simhash import candidates, chain_masks, fingerprint, links, one_per_class, simhash_classes


def plain_fingerprint(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(nodes, joined):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in joined:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_follow_the_definition(docs):
    texts = [r.text for r in docs.limit(60).collect()] + ["", None, "A b", "É É É", "a b c d", "x " * 70_000]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert fingerprint("a b c d e", 5) == plain_fingerprint("a b c d e", 5)


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_every_close_pair_shares_a_chain(bits):
    rnd = random.Random(bits)
    masks = chain_masks(bits)
    for _ in range(4000):
        flips = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, bits)))
        assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_connect_exactly_what_is_reachable(spark, bits):
    rnd = random.Random(bits)
    fps = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):  # chains of close and of just too distant values
            fps.add(x)
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, bits, bits + 1, bits + 2])))
    fps |= {rnd.getrandbits(64) for _ in range(200)}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    close = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= bits]
    want = union(fps, close)
    got = union(fps, [(u % (1 << 64), v % (1 << 64)) for u, v in links(df, bits).collect()])
    assert {frozenset(k for k in fps if want[k] == r) for r in set(want.values())} == \
        {frozenset(k for k in fps if got[k] == r) for r in set(got.values())}
    assert {a for p in close for a in p} <= {r[0] % (1 << 64) for r in candidates(df, bits).collect()}


def test_components(spark):
    rnd = random.Random(2)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    others = [(rnd.randint(5000, 5200), rnd.randint(5000, 5200)) for _ in range(120)]
    edges = path + star + others + [(7, 7), (8, 9), (9, 8)]
    rnd.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    want = union({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in want.items() if n in got} and all(n in got or r == n for n, r in want.items())
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_table_against_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(fps)
    want = union(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_classes(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def test_odd_rows(odd, empty, make):
    out = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_classes(odd).collect()]
    assert len(out) == odd.count()
    zero = {r[2] for r in out if r[1] == "0" * 16}
    assert zero == {1}  # null and blank texts are one class; a null id is not its smallest
    assert [r[2] for r in out if r[0] in (5, 6)] == [5, 5]
    assert simhash_classes(make([(None, "a b"), (None, "a b")])).first().component_id is None
    assert simhash_classes(empty).count() == 0
    clash = odd.withColumn("ka", F.lit(1)).withColumn("fp", F.lit(2)).withColumn("component_id", F.lit(3))
    assert simhash_classes(clash).count() == odd.count()
    kept = one_per_class(clash)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 1, 4, 5, 7]
    assert one_per_class(make([(None, "a b"), (None, "a b")])).count() == 1
