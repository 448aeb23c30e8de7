"""Benchmark decontamination by template windows.

A text becomes a template: runs of numbers, of names and units after numbers
turn into typed placeholders, other words are lower-cased without
punctuation.  A text has two templates, with names as placeholders and
without: a copy in other letter case has no names to tell, but shares the
second one.  Windows of template words are hash-joined with those of the
benchmark, and the windows of an item that a document holds are chained over
neighbouring diagonals (document place less item place), so that a word put
in or left out does not break an occurrence.  It counts when enough windows
are found (a share of the item's, or ``MIN_RUN`` whatever its length: an
excerpt) and the slots agree: wherever one number, name or unit of the item
comes back, the document holds one and the same value for it.  So questions
that were only given other numbers or names are caught, and chance matches
of placeholders are not.

Items that have the same template are matched once, as a class.  Templates
are made by patterns over whole texts and hashed once a word; values are
read from the documents that matched only, a slot at a time.

Defined results: a null or empty text has no windows and is never
contaminated, nor is anything by a null or empty item.  Items shorter than a
window are matched as a whole.  Windows of fewer than ``MIN_LITERAL`` words
beside placeholders tell nothing and are left out; items that have no
others, and items of fewer words, are matched literally (numbers and names
as they stand, without case or punctuation).  Repeated documents and items
give one row per (doc_id, item_id).  Empty tables give an empty result;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, store

WIDTH = 8
MIN_LITERAL = 4
MIN_SHARE = 0.3
MIN_RUN = 4
# Diagonals that one occurrence may span: words put in or left out.
BAND = 16
# A benchmark of up to this many different windows (about 50 bytes each in a
# task's hash table) is broadcast after counting; beyond that the windows are
# joined by shuffling.
BROADCAST_WINDOWS = 1_000_000

# Placeholders and a decimal point, as private characters that texts lack.
NUMBER, NAME, UNIT, POINT = "\ue000", "\ue001", "\ue002", "\ue003"
SLOT = f"^[{NUMBER}{NAME}{UNIT}]"
# Kinds of templates: with names as placeholders, without, and literal words.
NAMED, CASELESS, LITERAL = 0, 1, 2

# Units that make a word after a number a unit slot.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "t", "l", "ml", "s", "sec", "min", "h", "hour", "hours", "day", "days",
         "week", "weeks", "year", "years", "inch", "inches", "ft", "feet", "mile", "miles", "lb", "lbs", "oz", "percent",
         "usd", "eur", "dollar", "dollars", "euro", "euros", "cent", "cents", "mph", "w", "kw", "v", "hz", "b",
         "kb", "mb", "gb")

# Everything that is no letter, mark, digit, placeholder or sentence end.
_GAP = r"[^\p{L}\p{M}\p{N}\p{Co}.!?]+"


def _replace(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, pattern, by)


def _spaced(text: Column, values: bool) -> Column:
    """Words and sentence ends, with number and unit slots: a placeholder
    each, followed by its value if ``values``."""
    text = F.coalesce(text, F.lit(""))
    if values:
        text = _replace(_replace(text, r",(?<=\d,)(?=\d)", ""), r"\.(?<=\d\.)(?=\d)", POINT)
        text = _replace(_replace(text, rf"\d+(?:{POINT}\d+)*", f" {NUMBER}$0 "), _GAP, " ")
        text = _replace(text, f"({NUMBER}[^ ]*) (?={NUMBER})", "$1_")
        return _replace(text, rf"({NUMBER}[^ ]* )((?i:{'|'.join(UNITS)}))(?![^ .!?])", f"$1{UNIT}$2")
    text = _replace(_replace(text, r"\d+(?:[.,]\d+)*", f" {NUMBER} "), _GAP, " ")
    text = _replace(text, f"{NUMBER}(?: {NUMBER})+", NUMBER)
    return _replace(text, rf"{NUMBER} (?i:{'|'.join(UNITS)})(?![^ .!?])", f"{NUMBER} {UNIT}")


def _named(spaced: Column, values: bool) -> Column:
    """Runs of capitalised words that do not begin a sentence as one slot."""
    word = r"\p{Lu}(?<=[^.!? ] \p{Lu})[^ .!?]*"
    if values:
        return _replace(_replace(spaced, word, f"{NAME}$0"), f"({NAME}[^ .!?]*) (?={NAME})", "$1_")
    return _replace(spaced, word + r"(?: \p{Lu}[^ .!?]*)*", NAME)


def _words(spaced: Column) -> Column:
    return F.array_remove(F.split(F.lower(_replace(spaced, "[.!? ]+", " ")), " ", -1), "")


def template(text: Column, kind: int, values: bool = False) -> Column:
    """Template words of a text; with ``values`` the placeholders are
    followed by what they stand for."""
    if kind == LITERAL:
        return _words(_replace(F.coalesce(text, F.lit("")), _GAP, " "))
    spaced = _spaced(text, values)
    return _words(_named(spaced, values) if kind == NAMED else spaced)


def _window_hashes(h: Column, width: int) -> Column:
    """Order-sensitive hashes of all windows of ``width`` entries, doubling
    the width of partial windows."""
    def tail(a: Column, shift: int, n: Column) -> Column:
        return F.slice(a, F.lit(shift + 1), n)

    def join(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def grow(a: Column, done: int) -> Column:
        if done == width:
            return a
        step = min(done, width - done)
        n = F.size(h) - (done + step - 1)
        other = a if step == done else _window_hashes(h, step)
        return let(join(tail(a, 0, n), tail(other, done, n)), lambda x: grow(x, done + step))

    return F.when(F.size(h) < width, F.array().cast("array<bigint>")).otherwise(grow(h, 1))


def windows_of(words: Column, width: int) -> Column:
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _window_hashes(h, width))


class Bench:
    """Stored tables of a benchmark.

    ``items``: item_id, ih (hash of the text), cls (its template class);
    ``windows``: branch, wh, cls, ip, n_item, needed;
    ``slots``: branch, cls, item_id, ih, sp, t, iv.
    A branch is a kind of template and a window width."""

    def __init__(self, benchmark: DataFrame) -> None:
        every = benchmark.where("text is not null").select(
            "item_id", F.xxhash64("text").alias("ih"), *[template(F.col("text"), k).alias(f"t{k}") for k in (NAMED, CASELESS, LITERAL)],
            *[template(F.col("text"), k, True).alias(f"v{k}") for k in (NAMED, CASELESS)]).distinct()
        plain = lambda w: ~w.rlike(SLOT)
        told = F.size(F.filter("t1", plain)) >= MIN_LITERAL
        # A class of templates, or of literal words where those tell too little.
        every = every.where(F.size("t2") > 0).withColumn("told", told & F.exists(
            self._starts("t1"), lambda i: F.size(F.filter(F.slice(F.col("t1"), i + 1, F.least(F.size("t1"), F.lit(WIDTH))), plain)) >= MIN_LITERAL))
        every = every.withColumn("cls", F.when(F.col("told"), F.xxhash64("t0", "t1")).otherwise(F.xxhash64("t2")))
        self.all = every = store(every, "bench-items")
        classes = every.groupBy("cls").agg(*[F.any_value(c).alias(c) for c in ("told", "t0", "t1", "t2")])
        self.branches: dict[int, tuple[int, int]] = {}
        parts = []
        for kind, use in ((NAMED, "told"), (CASELESS, "told"), (LITERAL, "not told")):
            words = F.col(f"t{kind}")
            here = classes.where(use).where(F.size(words) > 0).withColumn("width", F.least(F.size(words), F.lit(WIDTH)))
            for (width,) in sorted(here.select("width").distinct().collect()):  # WIDTH values at most
                branch = kind * (WIDTH + 1) + width
                self.branches[branch] = (kind, width)
                w = here.where(F.col("width") == width).select("cls", words.alias("t"), F.posexplode(windows_of(words, width)).alias("ip", "wh"))
                if kind != LITERAL:
                    w = w.where(F.size(F.filter(F.slice("t", F.col("ip") + 1, F.lit(width)), plain)) >= MIN_LITERAL)
                parts.append(w.select(F.lit(branch).alias("branch"), "wh", "cls", "ip"))
        if not parts:
            return
        found = store(reduce(DataFrame.unionByName, parts), "bench-windows")
        sizes = found.groupBy(F.col("branch").alias("b2"), F.col("cls").alias("c2")).agg(F.count(F.lit(1)).alias("n_item"))
        needed = F.greatest(F.lit(1), F.least(F.ceil(F.col("n_item") * MIN_SHARE), F.lit(MIN_RUN))).cast("int")
        sized = found.join(sizes, (F.col("branch") == F.col("b2")) & (F.col("cls") == F.col("c2")))
        self.windows = store(sized.select("branch", "wh", "cls", "ip", "n_item", needed.alias("needed")), "bench-windows-kept")
        slots = []
        for branch, (kind, _) in self.branches.items():
            if kind != LITERAL:
                s = every.where("told").select("cls", "item_id", "ih", F.posexplode(f"v{kind}").alias("sp", "w"))
                slots.append(s.where(F.col("w").rlike(SLOT)).select(
                    F.lit(branch).alias("branch"), "cls", "item_id", "ih", "sp", F.substring("w", 1, 1).alias("t"), F.col("w").alias("iv")))
        none = every.where(F.lit(False)).select(F.lit(0).alias("branch"), "cls", "item_id", "ih", F.lit(0).alias("sp"), F.lit("").alias("t"), F.lit("").alias("iv"))
        self.slots = store(reduce(DataFrame.unionByName, slots, none), "bench-slots")

    @staticmethod
    def _starts(words: str) -> Column:
        return F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0)))


def row_key(*cols: Column) -> Column:
    """96-bit key of a row's id and text: equal rows share it."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.hash(*reversed(cols)).alias("b"))


def _hits(keyed: DataFrame, bench: Bench) -> DataFrame:
    """Document windows that the benchmark has: doc_id, key, branch, dp, wh
    (each once; equal rows share a key), of the documents that hold enough
    of them for some class."""
    kinds = {kind for kind, _ in bench.branches.values()}
    spaced = keyed.select("doc_id", "key", "text", _spaced(F.col("text"), False).alias("spaced"))
    named = spaced.select("doc_id", "key", "text", "spaced", _named(F.col("spaced"), False).alias("named")) if NAMED in kinds else spaced
    told = {CASELESS: _words(F.col("spaced")), LITERAL: template(F.col("text"), LITERAL)}
    # Without names both templates are one, and the other kind has it all.
    told[NAMED] = F.when(F.col("named").contains(NAME), _words(F.col("named")))
    words = named.select("doc_id", "key", *[told[k].alias(f"t{k}") for k in sorted(kinds)])
    arrays = [x for b, (kind, width) in bench.branches.items() for x in (F.lit(b), windows_of(F.col(f"t{kind}"), width))]
    listed = words.select("doc_id", "key", F.stack(F.lit(len(bench.branches)), *arrays).alias("branch", "hashes"))
    windows = listed.select("doc_id", "key", "branch", F.posexplode("hashes").alias("dp", "dh"))
    known = store(bench.windows.groupBy("wh").agg(F.min("needed").alias("least")), "bench-hashes")
    few = known.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    hits = windows.join(F.broadcast(known) if few else known, F.col("dh") == F.col("wh"))
    hits = store(hits.groupBy("doc_id", "key", "branch", "dp", "wh", "least").agg(F.lit(1).alias("one")), "decontaminate-hits")
    enough = hits.groupBy(F.col("key").alias("k2"), F.col("branch").alias("b2")).agg(F.count(F.lit(1)).alias("held"))
    hits = hits.join(enough, (F.col("key") == F.col("k2")) & (F.col("branch") == F.col("b2")))
    return hits.where("held >= least").select("doc_id", "key", "branch", "dp", "wh")


def occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Item occurrences that count: doc_id, key (of the document's row),
    item_id, n_windows, item_windows, n_slots."""
    schema = "doc_id bigint, key struct<a:bigint,b:int>, item_id bigint, n_windows bigint, item_windows bigint, n_slots bigint"
    bench = Bench(benchmark)
    if not bench.branches:
        return docs.sparkSession.createDataFrame([], schema)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    places = _hits(keyed, bench).join(bench.windows, ["branch", "wh"])
    # One diagonal; or two halves-shifted rows of bands, so that any BAND / 2
    # neighbouring diagonals stand in one band.
    shift = F.col("dp") - F.col("ip")
    bands = F.array(F.struct(F.lit(0).alias("row"), shift.alias("band")),
                    *[F.struct(F.lit(r).alias("row"), F.floor((shift + (r - 1) * BAND // 2) / BAND).cast("int").alias("band")) for r in (1, 2)])
    places = places.select("doc_id", "key", "branch", "cls", "ip", "dp", "n_item", "needed", F.inline(bands))
    where = ["key", "branch", "cls", "row", "band"]
    chains = places.groupBy("doc_id", *where, "n_item", "needed").agg(F.count_distinct("ip").alias("n_windows")).where("n_windows >= needed")
    chains = store(chains, "decontaminate-chains")

    # Slots: the places of the class's placeholders in the found windows,
    # and the values there in the documents that matched.
    widths = F.create_map(*[F.lit(x) for b, (_, w) in bench.branches.items() for x in (b, w)])
    slot_places = bench.slots.select(F.col("branch").alias("sb"), F.col("cls").alias("sc"), "sp").distinct()
    held = places.join(chains.select(*where), where, "left_semi").select(*where, "ip", "dp", widths[F.col("branch")].alias("width"))
    held = held.join(slot_places, (F.col("branch") == F.col("sb")) & (F.col("cls") == F.col("sc"))
                     & F.col("sp").between(F.col("ip"), F.col("ip") + F.col("width") - 1))
    held = held.select(*where, "sp", (F.col("dp") + F.col("sp") - F.col("ip")).alias("dpos")).distinct()
    matched = chains.select(F.col("key").alias("k2")).distinct()
    texts = keyed.join(matched, F.col("key") == F.col("k2"), "left_semi").groupBy("key").agg(F.any_value("text").alias("text"))
    values = [texts.select(F.col("key").alias("vk"), F.lit(k).alias("vkind"), F.posexplode(template(F.col("text"), k, True)).alias("vp", "dv"))
              for k in (NAMED, CASELESS)]
    values = values[0].unionByName(values[1]).where(F.col("dv").rlike(SLOT))
    kinds = F.floor(F.col("branch") / (WIDTH + 1)).cast("int")
    filled = held.withColumn("kind", kinds).join(values, (F.col("key") == F.col("vk")) & (F.col("dpos") == F.col("vp")) & (F.col("kind") == F.col("vkind")))
    filled = filled.select(*where, F.col("sp").alias("fp"), "dv")
    of = bench.slots.select(F.col("branch").alias("sb"), F.col("cls").alias("sc"), "item_id", "ih", "sp", "t", "iv")
    said = filled.join(of, (F.col("branch") == F.col("sb")) & (F.col("cls") == F.col("sc")) & (F.col("fp") == F.col("sp")))
    said = said.groupBy(*where, "item_id", "ih", "t", "iv").agg(F.min("dv").alias("lo"), F.max("dv").alias("hi"))
    said = said.groupBy(*where, "item_id", "ih").agg(F.count(F.lit(1)).alias("n_slots"), F.bool_or(F.col("lo") != F.col("hi")).alias("torn"))

    items = bench.all.select(F.col("cls").alias("ic"), F.col("item_id").alias("i2"), F.col("ih").alias("h2"))
    named = chains.join(items, F.col("cls") == F.col("ic")).drop("ic")
    said = said.select(*[F.col(c).alias(f"s_{c}") for c in where], F.col("item_id").alias("s_item"), F.col("ih").alias("s_ih"), "n_slots", "torn")
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"s_{c}") for c in where])
    judged = named.join(said, same & F.col("i2").eqNullSafe(F.col("s_item")) & (F.col("h2") == F.col("s_ih")), "left")
    judged = judged.where(~F.coalesce("torn", F.lit(False)))
    best = F.max(F.struct("n_windows", F.col("n_item").alias("item_windows"), F.coalesce("n_slots", F.lit(0).cast("bigint")).alias("n_slots")))
    return judged.groupBy("doc_id", "key", F.col("i2").alias("item_id")).agg(best.alias("b")).select("doc_id", "key", "item_id", "b.*")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item."""
    best = F.max(F.struct("n_windows", "item_windows", "n_slots")).alias("b")
    return occurrences(docs, benchmark).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` without an occurrence of an item, all columns."""
    bad = store(occurrences(docs, benchmark).select("key").distinct(), "contaminated-keys")
    a, b = fresh(docs, "bad_a"), fresh(docs, "bad_b")
    bad = bad.select(F.col("key.a").alias(a), F.col("key.b").alias(b))
    key = row_key(docs["doc_id"], docs["text"])
    return docs.join(bad, (key["a"] == bad[a]) & (key["b"] == bad[b]), "left_anti")
