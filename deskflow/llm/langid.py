"""Language identification by prediction by partial matching.

Each language has a variable-order tree of byte contexts with counts.  A
byte costs -log2 of its probability in the longest known context; contexts
that never saw it cost their escape probability first (method C: as many
escapes as different bytes seen), down to one of 256.  Counts are frozen
after training and no exclusion is made, so a text's code length is an exact
sum over its bytes, whatever their order of evaluation: equal byte runs are
priced once per batch and added up.

The trees are learned from a bounded sample of labelled texts: for every
language at most ``sample`` different texts, chosen by hash, each read
whole.  Their runs are counted by Spark; the driver gets counts only, of at
most ``GROUP`` languages at a time.  More languages than that are priced in
as many passes over the texts.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is every text when nothing could be learned.  Of equal code lengths
the alphabetically first language wins.  Texts of any length are priced
whole; repeated rows get equal results; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

ORDER = 3  # bytes of context; a run with its context fits 32 bits
SAMPLE = 200
GROUP = 64  # languages whose trees (some 2 MB each) a task holds at once
MAX_BROADCAST = 200_000
CHUNK = 1 << 22  # bytes priced at once; a longer text alone


def runs(data: np.ndarray, starts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, zero beyond the start
    of its text."""
    key = data.astype(np.uint32)
    since = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    for k in range(1, order + 1):
        back = np.zeros(len(data), dtype=np.uint32)
        back[k:] = data[:-k] if len(data) > k else back[k:]
        back[since < k] = 0
        key |= back << np.uint32(8 * k)
    return key


def sample_texts(train: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, text): at most ``sample`` different texts of each language.
    The choice is a combining aggregate over hashes; texts come after."""
    rows = train.where("lang is not null and text is not null and text <> ''")
    h = F.xxhash64("text")
    chosen = rows.groupBy("lang", F.pmod(h, F.lit(sample)).alias("slot")).agg(F.min(h).alias("h")).select(F.col("lang").alias("l2"), "h")
    chosen = store(chosen, "langid-sample")
    # Rows of a hash and a language name, sent to the tasks when few.
    few = chosen.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    found = rows.join(F.broadcast(chosen) if few else chosen, (F.col("lang") == F.col("l2")) & (F.xxhash64("text") == F.col("h")))
    return found.groupBy("lang", "h").agg(F.any_value("text").alias("text")).select("lang", "text")


def count_runs(texts: DataFrame) -> DataFrame:
    """(lang, size, run, n): counts of all runs of 1 to ORDER + 1 bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
                key = runs(data, np.zeros(1, dtype=np.int64))
                for size in range(1, ORDER + 2):
                    found, n = np.unique(key[size - 1:] & np.uint32((1 << 8 * size) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array([size] * len(found), pa.int32()),
                                                      pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                     names=["lang", "size", "run", "n"])

    return texts.mapInArrow(count, "lang string, size int, run bigint, n bigint").groupBy("lang", "size", "run").agg(F.sum("n").alias("n"))


class Tree:
    """Frozen counts of one language."""

    def __init__(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.orders = []
        for size in range(1, ORDER + 2):
            run, n = counts.get(size, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            at = np.argsort(run)
            run, n = run[at], n[at]
            context, first = np.unique(run >> 8, return_index=True)
            total = np.add.reduceat(n, first) if len(n) else n
            different = np.diff(np.append(first, len(run)))
            self.orders.append((run, n, context, total, different))

    def bits(self, key: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each run, in the context before it."""
        key = key.astype(np.int64)
        cost = np.zeros(len(key))
        left = np.arange(len(key))  # runs that no longer context has priced
        for size in range(ORDER + 1, 0, -1):
            run, n, context, total, different = self.orders[size - 1]
            if not len(run) or not len(left):
                continue
            here = key[left] & ((1 << 8 * size) - 1)
            c = np.minimum(np.searchsorted(context, here >> 8), len(context) - 1)
            known = context[c] == here >> 8
            r = np.minimum(np.searchsorted(run, here), len(run) - 1)
            seen = known & (run[r] == here)
            mass = total[c] + different[c]
            cost[left[seen]] -= np.log2(n[r[seen]] / mass[seen])
            escape = known & ~seen
            cost[left[escape]] -= np.log2(different[c[escape]] / mass[escape])
            left = left[~seen]
        cost[left] += 8.0
        return cost


def train(texts: DataFrame) -> dict[str, Tree]:
    rows = count_runs(texts).toArrow()  # counts of a bounded sample
    lang, size = np.array(rows.column("lang").to_pylist(), dtype=object), rows.column("size").to_numpy()
    run, n = rows.column("run").to_numpy(), rows.column("n").to_numpy()
    out = {}
    for name in sorted(set(lang)):
        own = lang == name
        out[name] = Tree({s: (run[own & (size == s)], n[own & (size == s)]) for s in range(1, ORDER + 2)})
    return out


def code_lengths(trees: dict[str, Tree], texts: list[bytes]) -> np.ndarray:
    """Bits of every (non-empty) text under every language."""
    out = np.zeros((len(texts), len(trees)))
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size == 0 or size + len(texts[last]) <= CHUNK):
            size += len(texts[last])
            last += 1
        lengths = [len(t) for t in texts[first:last]]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        found, place = np.unique(runs(np.frombuffer(b"".join(texts[first:last]), dtype=np.uint8), starts), return_inverse=True)
        for j, tree in enumerate(trees.values()):
            out[first:last, j] = np.add.reduceat(tree.bits(found)[place], starts)
        first = last
    return out


def _priced(docs: DataFrame, trees: dict[str, Tree], keys: list[str], first: bool, last: bool) -> DataFrame:
    """Price the texts under some languages, on top of what the languages
    before them gave: least bits, their language, and the likelihood of all
    over that of the best.  The last pass turns those into a result."""
    names, told = list(trees), ["_bits", "_lang", "_mass"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            n = len(texts)
            if first:
                least, lang, mass = np.full(n, np.inf), np.full(n, "und", dtype=object), np.zeros(n)
            else:
                least, mass = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("_bits", "_mass"))
                lang = np.array(batch.column("_lang").to_pylist(), dtype=object)
            at = np.array([i for i, t in enumerate(texts) if names and t and any(map(str.isalpha, t))], dtype=np.int64)
            if len(at):
                bits = code_lengths(trees, [texts[i].encode("utf-8") for i in at])
                best = bits.min(axis=1)
                likely = np.exp2(best[:, None] - bits).sum(axis=1)
                lower = np.minimum(best, least[at])
                lang[at] = np.where(best < least[at], np.array(names, dtype=object)[bits.argmin(axis=1)], lang[at])
                mass[at] = mass[at] * np.exp2(lower - least[at]) + likely * np.exp2(lower - best)
                least[at] = lower
            kept = [batch.column(k) for k in keys]
            langs = pa.array(lang.tolist(), pa.string())
            if last:
                score = np.divide(1.0, mass, out=np.zeros(n), where=mass > 0)
                yield pa.RecordBatch.from_arrays([*kept, langs, pa.array(score)], names=[*keys, "lang_pred", "score"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), *kept, pa.array(least), langs, pa.array(mass)],
                                                 names=["_text", *keys, *told])

    kinds = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keys)
    schema = f"{kinds}lang_pred string, score double" if last else f"_text string, {kinds}_bits double, _lang string, _mass double"
    read = docs.select(F.col("text").alias("_text"), *keys) if first else docs.select("_text", *keys, *told)
    return read.mapInArrow(run, schema)


def identify(docs: DataFrame, trees: dict[str, Tree], keys: list[str]) -> DataFrame:
    """keys, lang_pred and score (share of the best language's likelihood)
    of every text."""
    return _priced(docs, trees, keys, True, True)


def learn_and_identify(docs: DataFrame, texts: DataFrame, keys: list[str], group: int = GROUP) -> DataFrame:
    """``identify`` by all languages of the sample ``texts`` (lang, text)."""
    texts = store(texts, "langid-texts")
    names = sorted(r["lang"] for r in texts.select("lang").distinct().collect())  # one name a language
    groups = [names[i:i + group] for i in range(0, len(names), group)] or [[]]
    for i, part in enumerate(groups):
        trees = train(texts.where(F.col("lang").isin(part)) if len(groups) > 1 else texts)
        docs = _priced(docs, trees, keys, i == 0, i == len(groups) - 1)
        if i < len(groups) - 1:
            docs = store(docs, "langid-priced")
    return docs
