"""Quality classifier: histogram gradient-boosted trees on text statistics.

Statistics are counted from the bytes of a whole Arrow batch at a time.
Trees are grown level by level from binned statistics on a bounded sample of
labelled texts, and flattened into arrays (feature, threshold, value, in
heap order), which score all rows of a batch at once.

Defined results: a null text is empty and gets the score of its (zero)
statistics.  Labels that contradict each other, and null labels, are left out of
training; with none or one class left, the score is that class's share (0.5
without labels).  Repeated rows get equal scores; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

TRAIN_ROWS = 20_000
BINS = 64
DEPTH = 4
TREES = 60
RATE = 0.15

# Byte classes: 0 lower case, 1 upper case, 2 digits, 3 blanks, 4 line ends,
# 5 symbols, 6 bars, 7 sentence ends, 8 other punctuation, 9 control, 10 beyond ASCII.
N_CLASSES = 11


def _byte_classes() -> np.ndarray:
    table = np.full(256, 8, dtype=np.uint8)
    table[:32] = 9
    table[128:] = 10
    for chars, c in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                     (b" \t", 3), (b"\n\r\x0b\x0c", 4), (b"#*$%&<>", 5), (b"|", 6), (b".!?", 7)):
        table[np.frombuffer(chars, dtype=np.uint8)] = c
    return table


CHUNK = 1 << 22  # bytes counted at once; a longer text alone


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of statistics per text."""
    raw = [(t or "").encode("utf-8") for t in texts]
    out, first = [], 0
    while first < len(raw):
        last, size = first, 0
        while last < len(raw) and (size == 0 or size + len(raw[last]) <= CHUNK):
            size += len(raw[last])
            last += 1
        out.append(_statistics(raw[first:last]))
        first = last
    return np.concatenate(out) if out else _statistics([])


def _statistics(raw: list[bytes]) -> np.ndarray:
    n = len(raw)
    size = np.array([len(r) for r in raw], dtype=np.float64)
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kind = _byte_classes()[data]
    by_class = np.bincount(owner * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float64)
    shouts = np.zeros(len(data), dtype=bool)
    if len(data) > 1:  # "!!" and doubled symbols
        shouts[1:] = (data[1:] == data[:-1]) & (kind[1:] >= 5) & (kind[1:] <= 8) & (owner[1:] == owner[:-1])
    doubled = np.bincount(owner[shouts], minlength=n).astype(np.float64)
    words, different, lines, line_kinds, longest, long_words = (np.zeros(n) for _ in range(6))
    for i, r in enumerate(raw):
        w = r.split()
        words[i], different[i] = len(w), len(set(w))
        x = [y for y in r.split(b"\n") if y.strip()]
        lines[i], line_kinds[i] = len(x), len(set(x))
        if w:
            lengths = list(map(len, w))
            longest[i] = max(lengths)
            long_words[i] = sum(k > 15 for k in lengths)
    per_byte, per_word = by_class / np.maximum(size, 1)[:, None], 1 / np.maximum(words, 1)
    letters = np.maximum(by_class[:, 0] + by_class[:, 1] + by_class[:, 10], 1)
    return np.column_stack([
        np.log1p(size), np.log1p(words), per_byte, doubled * per_word, by_class[:, 1] / letters,
        (size - by_class[:, 3] - by_class[:, 4]) * per_word, different * per_word, np.log1p(longest), long_words * per_word,
        np.log1p(lines), (lines - line_kinds) / np.maximum(lines, 1), (lines - line_kinds) * per_word, lines * per_word,
        by_class[:, 5] * per_word, by_class[:, 6] * per_word, by_class[:, 7] * per_word, by_class[:, 2] * per_word,
    ])


class Forest:
    """Flattened trees: node i has the children 2i+1 and 2i+2."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> None:
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
         penalty: float = 1.0) -> Forest:
    """Logistic boosting over binned statistics."""
    n, d = x.shape
    inner = (1 << depth) - 1
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = node - first
            gains = np.full((d, width), -np.inf)
            cuts = np.zeros((d, width), dtype=np.int64)
            for j in range(d):
                if not len(edges[j]):
                    continue
                at = slot * bins + binned[:, j]
                sg = np.bincount(at, weights=g, minlength=width * bins).reshape(width, bins)
                sh = np.bincount(at, weights=h, minlength=width * bins).reshape(width, bins)
                lg, lh = sg.cumsum(axis=1)[:, :-1], sh.cumsum(axis=1)[:, :-1]
                tg, th = sg.sum(axis=1)[:, None], sh.sum(axis=1)[:, None]
                gain = lg ** 2 / (lh + penalty) + (tg - lg) ** 2 / (th - lh + penalty) - tg ** 2 / (th + penalty)
                gain[:, len(edges[j]):] = -np.inf
                gain[(lh < 1e-3) | (th - lh < 1e-3)] = -np.inf
                cuts[j], gains[j] = gain.argmax(axis=1), gain.max(axis=1)
            best = gains.argmax(axis=0)
            for s in range(width):
                j = best[s]
                if gains[j, s] > 1e-6:
                    feature[t, first + s], threshold[t, first + s] = j, edges[j][cuts[j, s]]
            f = feature[t, node]
            node = 2 * node + 1 + (x[np.arange(n), f] > threshold[t, node])
        leaf = node - inner
        sg, sh = np.bincount(leaf, weights=g, minlength=inner + 1), np.bincount(leaf, weights=h, minlength=inner + 1)
        value[t] = -rate * sg / (sh + penalty)
        total += value[t, leaf]
    return Forest(base, feature, threshold, value)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled documents, chosen
    by the hash of doc_id."""
    sure = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("lo"), F.max(label).alias("hi")).where("lo = hi").select(F.col("doc_id").alias("d2"), F.col("lo").alias("y"))
    chosen = store(sure.orderBy(F.xxhash64("d2"), "d2").limit(rows), "classifier-labels")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("d2")).select("doc_id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.float64()), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["doc_id", "y", "x"])

    counted = found.withColumn("y", F.col("y").cast("double")).mapInArrow(run, "doc_id bigint, y double, x array<double>")
    # one row per labelled id, however often a document repeats
    got = counted.groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("r")).select("r.y", "r.x").collect()
    return np.array([r["x"] for r in got]), np.array([r["y"] for r in got])


def fit(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> Forest:
    x, y = training_rows(docs, labels, label, rows)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
        flat = np.zeros((0, 1))
        return Forest(float(np.log(share / (1 - share))), flat.astype(np.int64), flat, flat)
    at = np.lexsort((*x.T, y))  # the same forest whatever order rows came in
    return grow(x[at], y[at])


def scores(docs: DataFrame, forest: Forest, keys: list[Column]) -> DataFrame:
    """The key columns and ``score`` of every whole text."""
    frame = docs.select(*keys)
    names = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(statistics(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score, pa.float64())], names=[*names, "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields) + "score double"
    return docs.select(F.col("text").alias("_text"), *keys).mapInArrow(run, schema)
