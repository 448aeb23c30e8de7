"""Secret scans: patterns, and character Markov models of random strings.

The patterns give the base spans.  Beyond them, long runs of key characters,
with the base spans cut out, are scored by two first-order character models,
one of random strings and one of ordinary identifiers; a run, or what is left
of it, is a ``markov`` span when its log-likelihood ratio reaches the
threshold.  The models
are learned from labelled samples: all values that the patterns caught
against all identifiers that stand in two texts.  Pair counts
are one aggregate; scores are integers (thousandths of a nat), so sums do
not depend on their order.

All spans are found by expressions over one text: the pattern splits the
text, and the lengths of pieces and matches add up to code-point positions,
in time that grows with the text and its spans, not with their product.

Defined results: a null text is empty and has no spans; texts of any length
are scanned whole; repeated rows get equal results; without any caught value
the random model is uniform, and with neither values nor identifiers there
are no markov spans; an empty table gives an empty result; other columns are
carried under their own names; an input column that has the name of an added
one is left out, unless that one is given another name.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, code_points, exclusive_scan, let, store, text_slice

# The base patterns.  A run of 16 or 18 characters at least is
# a maximal run with that length; the assigned value's length is checked
# after matching.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
THRESHOLD = 10_000  # thousandths of a nat: odds of about 22,000 to 1
MIN_DISTINCT = 8  # characters; a rule drawn with one or two is no key
SPAN = "array<struct<start:int,kind:int,end:int>>"
FOUND = "array<struct<start:int,kind:int,end:int,word:string>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern, in order; ``word`` is the group's text.  The
    pattern splits the text; lengths of gaps and matches add up to places."""
    def place(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        lengths = F.transform(hits, F.length)
        gaps = F.slice(gaps, F.lit(1), F.size(hits))  # the last gap ends the text
        values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        before = exclusive_scan(F.zip_with(gaps, lengths, lambda g, n: (g + n).cast("bigint")), lambda a, b: a + b)
        before = F.slice(before, F.lit(1), F.size(hits))
        items = F.arrays_zip(before.alias("before"), gaps.alias("gap"), lengths.alias("length"), values.alias("value"))

        def span(x: Column) -> Column:
            start = (x["before"] + x["gap"]).cast("int")
            return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["length"]).alias("end"), x["value"].alias("word"))

        return F.filter(F.transform(items, span), lambda x: F.length(x["word"]) >= least)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(
        F.size(hits) == 0, F.array().cast(FOUND)).otherwise(place(hits)))


def base_spans(text: Column) -> Column:
    found = F.concat(_spans(text, ASSIGN, 0, 2, MIN_VALUE), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    return F.sort_array(found)


def _covered(spans: Column) -> Column:
    """For spans in order: the end of what those before each one cover, and
    of what all cover last."""
    return exclusive_scan(F.transform(spans, lambda x: x["end"].cast("bigint")), F.greatest)


def _replaced(text: Column, spans: Column, mark: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with ``mark`` (start, end, end of what is covered before) for
    each span, and the text between them."""
    def put(points: Column, covered: Column) -> Column:
        items = F.arrays_zip(spans.alias("span"), F.slice(covered, F.lit(1), F.size(spans)).alias("at"))
        parts = F.transform(items, lambda x: F.concat(
            text_slice(points, x["at"], x["span"]["start"]), mark(x["span"]["start"], x["span"]["end"], x["at"])))
        tail = text_slice(points, F.element_at(covered, -1), F.length(text).cast("bigint"))
        return F.concat(F.array_join(parts, ""), tail)

    done = let(code_points(text), lambda p: let(_covered(spans), lambda c: put(p, c)))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def _blanked(text: Column, base: Column) -> Column:
    """The text with base spans (in order) turned into as many spaces: what
    is left of a run beside them is a shorter run."""
    return _replaced(text, base, lambda start, end, at: F.repeat(F.lit(" "), F.greatest(end - F.greatest(start, at), F.lit(0)).cast("int")))


def _narrow(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat(
        F.element_at(names, x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def _codes(word: Column) -> Column:
    return F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))  # 1-based; 0: another character


def _pair_cells(word: Column) -> Column:
    size = len(ALPHABET) + 1
    return let(_codes(word), lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: a * size + b))


def pair_counts(samples: DataFrame) -> DataFrame:
    """(label, cell, n) of character pairs in samples (word, label)."""
    return samples.where(F.length("word") > 1).select("label", F.explode(_pair_cells(F.col("word"))).alias("cell")) \
        .groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))


def log_ratios(counts: list[tuple[int, int, int]], weight: float = 20.0) -> list[int]:
    """Thousandths of a nat per cell: random against identifier model.  Each
    row of the random model is smoothed towards the uniform distribution by
    ``weight`` pairs, each row of the identifier model towards its characters'
    overall shares (a tenth of them uniform)."""
    size = len(ALPHABET) + 1
    tables = [[0.0] * (size * size) for _ in range(2)]
    for label, cell, n in counts:
        tables[label][cell] += n
    plain, wild = tables
    whole = sum(plain)
    overall = [(0.9 * sum(plain[b::size]) / whole if whole else 0.9 / size) + 0.1 / size for b in range(size)]
    out = []
    for a in range(size):
        row = slice(a * size, (a + 1) * size)
        n_plain, n_wild = sum(plain[row]), sum(wild[row])
        for b in range(size):
            p_plain = (plain[a * size + b] + weight * overall[b]) / (n_plain + weight)
            p_wild = (wild[a * size + b] + weight / size) / (n_wild + weight)
            out.append(round(1000 * math.log(p_wild / p_plain)))
    return out


def _scored(word: Column, ratios: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")  # folded to one constant
    return F.aggregate(_pair_cells(word), F.lit(0), lambda s, c: s + F.element_at(table, c + 1))


def _identifiers(docs: DataFrame) -> DataFrame:
    """Identifiers that stand in two different texts at least (a random
    string hardly comes back), without what the patterns caught.  Each text
    names an identifier once, under its text's hash; least and greatest hash
    tell whether there are two, so the count combines before the shuffle."""
    clean = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        clean = F.regexp_replace(clean, pattern, " ")
    found = F.array_distinct(F.regexp_extract_all(clean, F.lit(IDENTIFIER), F.lit(0)))
    named = docs.where("text is not null").select(F.xxhash64("text").alias("h"), F.explode(found).alias("word"))
    return named.groupBy("word").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("word")


ADDED = ("base", "spans")


def secret_scan(docs: DataFrame, carry: list[str] | None = None, threshold: int = THRESHOLD,
                named: dict[str, str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or ``carry``) with ``base`` and ``spans``, both
    arrays of struct(start, kind, end) in order, each under its own name or
    the one that ``named`` gives it."""
    names, told = carried(docs, carry, ADDED, named)
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select(*[F.col(c).alias(f"in_{c}") for c in names], text.alias("text"), base_spans(text).alias("base"))
    runs = let(_blanked(F.col("text"), F.col("base")), lambda t: _spans(t, RUN, 3))
    scanned = store(scanned.select(*[f"in_{c}" for c in names], "base", runs.alias("runs")), "secret-spans")

    caught = scanned.select(F.explode("base.word").alias("word"), F.lit(1).alias("label"))
    plain = _identifiers(docs).select("word", F.lit(0).alias("label"))
    counts = [tuple(r) for r in pair_counts(caught.unionByName(plain)).collect()]  # at most 2 * 68^2 rows
    added = F.array().cast(FOUND)
    if any(label == 0 for label, _, _ in counts):
        ratios = log_ratios(counts)
        added = F.filter("runs", lambda r: (F.size(F.array_distinct(F.split(r["word"], ""))) >= MIN_DISTINCT)
                         & (_scored(r["word"], ratios) >= threshold))
    return scanned.select(*[F.col(f"in_{c}").alias(c) for c in names], _narrow(F.col("base")).alias(told["base"]),
                          F.sort_array(_narrow(F.concat("base", added))).alias(told["spans"]))


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with every span (overlapping ones together) replaced."""
    return _replaced(text, spans, lambda start, end, at: F.when(
        (start < at) & (at > 0), F.lit("")).otherwise(F.lit(mark)))
