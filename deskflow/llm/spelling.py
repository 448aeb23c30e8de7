"""Spelling variants of the words of a corpus, by asymmetric q-chunks.

Two words are near when they differ by one inserted, deleted or replaced
code point.  Of a pair, the shorter word (of equal lengths, either) is cut
into two disjoint chunks, the other one gives its positional grams of the
chunks' lengths.  One edit touches one chunk at most, and moves what follows
it by one place at most, so a near pair meets at a gram that equals a chunk
and stands within one place of it.  The same holds within the chunk that the
edit touches: cut in two again, one half is left whole.  So the join is on a
chunk and a half of the other one, three quarters of the word, which keeps
the groups that meet small even where many words share a beginning or an
end.  What meets is verified by edit distance.

A word's form is its most frequent near word, if that is at least ``ratio``
times as frequent.  Counts grow along a chain of forms, so chains are short
and have no cycle; roots are found by doubling the steps along them.

Defined results: a null or empty text has no words; a null doc_id counts as
an empty one in the hash; repeated rows count again; ties between forms go
to the smallest word in code-point order; a run of any length is read whole;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, store

RUN = re.compile("[a-zÀ-ÿ]+")
# Words counted in a task before their partial counts are handed on.
HELD = 1 << 17
LONG = 1 << 20


def variant(word: str, seed: int, every: int) -> str:
    """The word, or (when ``every`` divides its crc32) less one code point;
    ``seed`` is the crc32 of what stands before it."""
    h = zlib.crc32(word.encode("utf-8"), seed)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def text_words(doc_id: int | None, text: str | None, every: int, least: int) -> Counter:
    """Counts of a text's words of at least ``least`` code points."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = (text or "").encode("utf-8").lower().decode("utf-8")  # A-Z only
    found = RUN.findall(lowered) if len(lowered) < LONG else map(itemgetter(0), RUN.finditer(lowered))
    out: Counter = Counter()
    for word, n in Counter(found).items():
        if len(word) >= least:
            word = variant(word, seed, every)
            if len(word) >= least:
                out[word] += n
    return out


def word_counts(docs: DataFrame, every: int = 97, least: int = 5, seen: int = 3) -> DataFrame:
    """word, n: the words of at least ``least`` code points that occur at
    least ``seen`` times overall."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words, counts = pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.update(text_words(doc_id.as_py(), text.as_py(), every, least))
                if len(held) >= HELD:
                    yield flush()
        yield flush()

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = read.mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


# For an edit in the last, third, second or first quarter of a word: the
# quarters before it, which stay in place, and those after it, which may move.
KEPT = [((0, 1, 2), ()), ((0, 1), (3,)), ((0,), (2, 3)), ((), (1, 2, 3))]


def _cuts(length: Column) -> list[Column]:
    half = F.floor(length / 2)
    return [c.cast("int") for c in (F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length)]


def _pieces(of: Column, shift: Column) -> list[Column]:
    """For words of length ``of`` with what follows the edit moved by
    ``shift``: the parts left whole, one text for each place of the edit."""
    cuts = _cuts(of)
    out = []
    for before, after in KEPT:
        head = F.substring(F.col("word"), F.lit(1), cuts[before[-1] + 1]) if before else F.lit("")
        tail = F.substring(F.col("word"), cuts[after[0]] + shift + 1, cuts[4] - cuts[after[0]]) if after else F.lit("")
        out.append(F.concat(head, F.lit("|"), tail))
    return out


def chunks(words: DataFrame) -> DataFrame:
    """Each word's chunks (with a half of the other chunk), for every
    quarter that an edit may touch."""
    length = F.length("word")
    parts = [F.struct(F.lit(i).alias("chunk"), p.alias("gram")) for i, p in enumerate(_pieces(length, F.lit(0)))]
    return words.select("word", "n", length.alias("len"), F.inline(F.array(*parts)))


def grams(words: DataFrame) -> DataFrame:
    """Grams of each word that stand where the chunks of a word of its length
    (none moved) or of one less (what follows the edit moved by one) would.
    ``of`` is that word's length."""
    length = F.length("word")
    parts = [F.struct((length - d).alias("of"), F.lit(i).alias("at"), p.alias("piece"))
             for d in (0, 1) for i, p in enumerate(_pieces(length - d, F.lit(d)))]
    return words.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.inline(F.array(*parts)))


def _sorted(side: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: Spark sizes it by the stored
    file, without the rows that ``inline`` adds and with packed words, so that
    a table sized at 10 MB may take the driver hundreds."""
    return side.hint("merge")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each ordered pair of near words once."""
    c, g = chunks(words), grams(words)
    same = (c["len"] == g["of"]) & (c["chunk"] == g["at"]) & (c["gram"] == g["piece"])
    once = (F.length("other") > F.col("len")) | (F.col("word") < F.col("other"))
    met = c.join(_sorted(g), same & once & (F.levenshtein("word", "other", 1) == 1))
    pairs = met.select("word", "n", F.col("other").alias("near"), F.col("other_n").alias("near_n")).distinct()
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms; ``forms`` holds
    word and form, of the words that have one."""
    at = store(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-forms")
    while not at.where("moved").isEmpty():
        on = at.select(F.col("word").alias("w2"), F.col("root").alias("r2"))
        step = at.join(_sorted(on), F.col("root") == F.col("w2"), "left")
        at = store(step.select("word", F.coalesce("r2", "root").alias("root"), F.col("r2").isNotNull().alias("moved")), "spelling-roots")
    return at.select("word", "root")


def spelling_groups(docs: DataFrame, every: int = 97, least: int = 5, seen: int = 3, ratio: int = 2) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = store(word_counts(docs, every, least, seen), "spelling-words")
    best = near_words(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    best = store(best.select("word", "n_near", F.when(has, F.col("best.near")).alias("form"),
                             F.when(has, -F.col("best.less")).alias("form_n")), "spelling-near")
    with scratch(docs.sparkSession):
        ends = store(roots(best.where("form is not null")), "spelling-ends", keep=True)
    out = words.join(_sorted(best), "word", "left").join(_sorted(ends), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
