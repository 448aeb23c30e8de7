"""Mixing sources: temperature weights realised as block permutations.

Source shares p are raised to an exponent a and normalised.  The exponent is
bisected to the largest one whose weights have the target entropy, or to the
smallest one that repeats no source more often than allowed.  A source then
gets its weight's part of the token budget: whole epochs of all its
documents and a part of one more.  Each epoch is a permutation of the source
by hash; a document's place in it, over the source's whole quota, tells its
block of the mix, so every block holds each source in its weight's
proportion.

Places are running sums in three levels: over slices of about ``SLICE``
documents by hash, within groups of ``SLICE`` slices, and over those groups.
A window holds about ``SLICE`` rows, the last one a row for every million
documents of a source.  Equal rows share one place.

Defined results: a document weighs its words, one at least, so empty and
null texts take part; a null source is a source of its own; repeated rows
all take part; one source alone gets weight 1; an empty table gives an empty
result; other columns are carried under their own names; an input column
that has the name of an added one is left out, unless that one is given
another name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, store, words

SLICE = 1000
SECTIONS = 16  # exponents tried per round; a round narrows the bracket 16-fold
ROUNDS = 6


def source_tokens(rows: DataFrame) -> DataFrame:
    """(sid, total, n) per source of (sid, tokens, n_rows)."""
    return rows.groupBy("sid").agg(F.sum(F.col("tokens") * F.col("n_rows")).alias("total"), F.count(F.lit(1)).alias("n"))


def _tried(shares: DataFrame, exponents: list[float]) -> list[dict]:
    """Entropy and largest repetition for each exponent, one aggregate."""
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(exponents)])
    each = shares.select("p", F.explode(grid).alias("g")).select("p", "g.i", "g.a")
    out = each.groupBy("i").agg(
        F.first("a").alias("a"), F.sum(F.pow("p", F.col("a"))).alias("z"),
        F.sum(F.pow("p", F.col("a")) * F.col("a") * F.log("p")).alias("e"),
        F.max(F.pow("p", F.col("a") - 1)).alias("most"), F.min(F.pow("p", F.col("a") - 1)).alias("least"))
    return [r.asDict() for r in out.orderBy("i").collect()]  # SECTIONS + 1 rows


def exponent(shares: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
             budget_share: float | None = None) -> float:
    """The exponent in [0, 1].

    ``target_entropy`` is a fraction of the largest entropy possible;
    ``max_repeats`` bounds the epochs of any source at a budget of
    ``budget_share`` times all tokens (None: the least budget that uses every
    document)."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("name a target entropy or a repetition limit")
    n = shares.count()
    if n < 2:
        return 1.0

    def even_enough(r: dict) -> bool:  # true for small exponents
        return math.log(r["z"]) - r["e"] / r["z"] >= target_entropy * math.log(n)

    def rare_enough(r: dict) -> bool:  # true for large exponents
        scale = budget_share / r["z"] if budget_share is not None else 1 / r["least"]
        return r["most"] * scale <= max_repeats

    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
        tried = _tried(shares, grid)
        if target_entropy is not None:
            good = [i for i, r in enumerate(tried) if even_enough(r)]
            k = max(good, default=0)
            lo, hi = grid[k], grid[min(k + 1, SECTIONS)]
            answer = lo
        else:
            good = [i for i, r in enumerate(tried) if rare_enough(r)]
            k = min(good, default=SECTIONS)
            lo, hi = grid[max(k - 1, 0)], grid[k]
            answer = hi
    return answer


def _source_id(source: Column) -> Column:
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


ADDED = ("n_tokens", "weight", "epoch", "mix_block", "mix_order")


def temperature_mix(docs: DataFrame, carry: list[str] | None = None, target_entropy: float | None = None,
                    max_repeats: float | None = None, budget_share: float | None = None,
                    block_tokens: int = 1_000_000, seed: int = 0, named: dict[str, str] | None = None) -> DataFrame:
    """One row per placed copy of a document: the columns of ``docs`` (or
    ``carry``) with ``n_tokens``, ``weight`` (of its source), ``epoch``
    (0, 1, ...), ``mix_block`` and ``mix_order`` (sort key in the block),
    each under its own name or the one that ``named`` gives it.

    ``budget_share`` is the token budget over the tokens at hand; None takes
    the least budget at which every document is used."""
    names, told = carried(docs, carry, ADDED, named)
    key = F.xxhash64("doc_id", "source", "text")
    key2 = F.hash("text", "source", "doc_id")
    tokens = F.greatest(F.size(words(F.col("text"))), F.lit(1)).cast("long")
    marked = docs.select(key.alias("ka"), key2.alias("kb"), _source_id(F.col("source")).alias("sid"), tokens.alias("tokens"))
    rows = store(marked.groupBy("ka", "kb", "sid", "tokens").agg(F.count(F.lit(1)).alias("n_rows")), "mix-rows")
    sources = store(source_tokens(rows), "mix-sources")
    whole = sources.agg(F.sum("total").alias("t")).first()["t"]
    if whole is None:
        kinds = dict(zip(ADDED, ("bigint", "double", "int", "bigint", "bigint")))
        return docs.where(F.lit(False)).select(*names, *[F.lit(0).cast(kinds[c]).alias(told[c]) for c in ADDED])
    shares = sources.select((F.col("total") / F.lit(whole)).alias("p"))
    a = exponent(shares, target_entropy, max_repeats, budget_share)
    z, least = shares.agg(F.sum(F.pow("p", F.lit(a))), F.min(F.pow("p", F.lit(a - 1)))).first()
    share = budget_share if budget_share is not None else z / least
    weight = F.pow(F.col("total") / F.lit(whole), F.lit(a)) / F.lit(z)
    # tokens of a source in the mix, a whole epoch at least under the least budget
    quota = F.round(weight * F.lit(share * whole)).cast("long")
    if budget_share is None:
        quota = F.greatest(quota, F.col("total"))
    plan = sources.select(F.col("sid").alias("s2"), "total", weight.alias("weight"), quota.alias("quota"),
                          F.greatest(F.ceil(F.col("n") / F.lit(SLICE)), F.lit(1)).cast("long").alias("slices"))
    plan = store(plan, "mix-plan")
    blocks = max(1, math.ceil(share * whole / block_tokens))

    placed = rows.join(plan, F.col("sid") == F.col("s2")).where("quota > 0").select(
        "ka", "kb", "sid", "tokens", (F.col("tokens") * F.col("n_rows")).alias("mass"), "total", "weight", "quota", "slices",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - 1) / F.col("total")).cast("int"))).alias("epoch"))
    placed = placed.withColumn("h", F.xxhash64(F.lit(seed), "epoch", "ka", "kb")).withColumn("slice", F.pmod("h", "slices"))
    slices = placed.groupBy("sid", "epoch", "slice").agg(F.sum("mass").alias("m")).withColumn("far", F.floor(F.col("slice") / SLICE))
    far = slices.groupBy(F.col("sid").alias("s4"), F.col("epoch").alias("e4"), F.col("far").alias("f4")).agg(F.sum("m").alias("m4"))
    far = far.withColumn("before4", F.sum("m4").over(Window.partitionBy("s4", "e4").orderBy("f4")) - F.col("m4"))
    near = F.sum("m").over(Window.partitionBy("sid", "epoch", "far").orderBy("slice")) - F.col("m")
    slices = slices.withColumn("near", near).join(far, (F.col("sid") == F.col("s4")) & (F.col("epoch") == F.col("e4")) & (F.col("far") == F.col("f4")))
    slices = slices.select(F.col("sid").alias("s3"), F.col("epoch").alias("e3"), F.col("slice").alias("c3"),
                           (F.col("before4") + F.col("near")).alias("before"))
    inside = Window.partitionBy("sid", "epoch", "slice").orderBy("h", "ka", "kb")
    placed = placed.withColumn("within", F.sum("mass").over(inside) - F.col("mass"))
    placed = placed.join(slices, (F.col("sid") == F.col("s3")) & (F.col("epoch") == F.col("e3")) & (F.col("slice") == F.col("c3")))
    at = F.col("epoch") * F.col("total") + F.col("before") + F.col("within")
    placed = placed.withColumn("at", at).where("at < quota")
    block = F.least(F.floor(F.col("at") / F.col("quota") * F.lit(blocks)), F.lit(blocks - 1)).cast("long")
    places = placed.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("tokens").alias("n_tokens"), "weight", "epoch",
                           block.alias("mix_block"), F.xxhash64(F.lit(seed), "h", "epoch").alias("mix_order"))
    body = docs.select(*[F.col(c).alias(f"in_{c}") for c in names], key.alias("ka"), key2.alias("kb"))
    out = body.join(places, (F.col("ka") == F.col("pa")) & (F.col("kb") == F.col("pb")))
    return out.select(*[F.col(f"in_{c}").alias(c) for c in names], *[F.col(c).alias(told[c]) for c in ADDED])
