"""Counts over one whole text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import SPACE_CHARS, let, words

SYMBOLS = "#*$%&|<>"
# Up to this many different repeated windows are looked up one by one;
# texts with more of them sort their windows instead.  Same counts.
FEW = 16


def _equal_neighbours(s: Column) -> Column:
    """Values that stand next to an equal one in a sorted array."""
    n = F.size(s)
    pairs = F.zip_with(F.slice(s, F.lit(1), n - 1), F.slice(s, F.lit(2), n - 1),
                       lambda a, b: F.when(a == b, a))
    return F.array_distinct(F.filter(pairs, lambda x: x.isNotNull()))


def _positions_few(v: Column, repeated: Column) -> Column:
    return F.filter(F.transform(v, lambda x, i: F.when(F.array_contains(repeated, x), i)), lambda p: p.isNotNull())


def _positions_sorted(v: Column) -> Column:
    n = F.size(v)

    def flagged(s: Column) -> Column:
        ahead = F.zip_with(F.slice(s, F.lit(1), n - 1), F.slice(s, F.lit(2), n - 1),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
                               F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(ahead)))

    return let(F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), flagged)


def repeated_words(w: Column, width: int = 3) -> Column:
    """Words that stand in a window of ``width`` words found twice or more
    in the text (every occurrence counts, the first included)."""

    def windows(h: Column) -> Column:
        n = F.size(h) - (width - 1)
        out = F.slice(h, F.lit(1), n)
        for k in range(1, width):
            out = F.zip_with(out, F.slice(h, F.lit(k + 1), n), lambda a, b: F.xxhash64(a, b))
        return out

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(p, start, lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(width), i - s["last"])).alias("n"), i.alias("last")))["n"]

    def count(v: Column) -> Column:
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(
            let(_equal_neighbours(F.sort_array(v)), lambda r: covered(
                F.when(F.size(r) <= FEW, _positions_few(v, r)).otherwise(_positions_sorted(v)))))

    return F.when(F.size(w) < width, F.lit(0)).otherwise(
        let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(windows(h), count)))


def duplicate_lines(text: Column) -> Column:
    r"""Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                     lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, ""))


def symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def count_struct(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = let(words(text), lambda w: F.struct(F.size(w).alias("words"), repeated_words(w).alias("repeats")))
    return let(n, lambda s: F.struct(
        s["words"].cast("long").alias("n_words"), word_chars(text).cast("long").alias("word_chars"),
        symbols(text).cast("long").alias("n_symbols"), duplicate_lines(text).cast("long").alias("n_dup_lines"),
        s["repeats"].cast("long").alias("n_repeat_words")))
