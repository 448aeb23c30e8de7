"""Quality classifier, language identification and token counts."""

import math
import random
from collections import Counter as Tally

import numpy as np
from pyspark.sql import functions as F

from deskflow.llm.classifier import Forest, fit, grow, scores, statistics
from deskflow.llm.langid import ORDER, Tree, code_lengths, identify, runs, sample_texts, train
from deskflow.llm.queries import TOKENIZER, op1_quality_classifier, op4_language, op9_token_counts
from deskflow.llm.tokens import Counter, token_counts

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ classifier
def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    forest = grow(x, y, trees=30, depth=3)

    def walk(row):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if row[f[i]] > t[i] else 1)
            total += v[i - len(f)]
        return 1 / (1 + math.exp(-total))

    got = forest.score(x)
    assert np.allclose(got, [walk(r) for r in x])
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.97


def test_statistics_are_of_the_whole_text_and_of_one_text_only():
    texts = ["", None, "A!! b | c\nA!! b | c\n", "é" * 10, "word " * 50_000]
    together = statistics(texts)
    assert np.allclose(together, np.vstack([statistics([t]) for t in texts]))
    assert statistics([]).shape[0] == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op1_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    area = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert area > 0.9 and min(good) >= 0.3


def test_classifier_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, 0), (5, 1), (5, 0), (4, 1), (None, 1), (7, None)], "doc_id bigint, quality int")
    forest = fit(odd, labels, "quality")
    out = scores(odd, forest, [F.col("doc_id")]).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert scores(empty, forest, [F.col("doc_id")]).count() == 0
    none = fit(empty, labels, "quality")
    assert isinstance(none, Forest) and {r.score for r in scores(odd, none, [F.col("doc_id")]).collect()} == {0.5}


# -------------------------------------------------------------- language
def plain_bits(train_texts, text):
    """Method C by hand over dictionaries."""
    counts = [Tally() for _ in range(ORDER + 1)]
    for t in train_texts:
        for i in range(len(t)):
            for k in range(min(i, ORDER) + 1):
                counts[k][t[i - k:i + 1]] += 1
    total = 0.0
    for i in range(len(text)):
        for k in range(min(i, ORDER), -1, -1):
            context = text[i - k:i]
            seen = {r: n for r, n in counts[k].items() if r[:-1] == context}
            if not seen:
                continue
            mass = sum(seen.values()) + len(seen)
            if text[i - k:i + 1] in seen:
                total -= math.log2(seen[text[i - k:i + 1]] / mass)
                break
            total -= math.log2(len(seen) / mass)
        else:
            total += 8
    return total


def test_code_lengths_are_exact(make):
    learned = ["abracadabra", "banana bandana", "é"]
    trees = train(make([(i, t) for i, t in enumerate(learned)]).select("lang", "text"))
    texts = [b"abra", b"banana", b"zzz", "été".encode(), b"a", b"bandabra"]
    got = code_lengths(trees, texts)[:, 0]
    assert np.allclose(got, [plain_bits([t.encode() for t in learned], t) for t in texts])


def test_runs_start_anew_with_each_text():
    data = np.frombuffer(b"abcd", dtype=np.uint8)
    got = runs(data, np.array([0, 2]))
    assert [hex(x) for x in got] == [hex(0x61), hex(0x6162), hex(0x63), hex(0x6364)]


def test_language_accuracy_and_contract(spark, docs):
    rows = op4_language(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert held and np.mean(held) > 0.98


def test_language_of_odd_rows(odd, empty, make):
    trees = train(sample_texts(odd.select("lang", "text")))
    out = identify(odd, trees, ["doc_id"]).collect()
    assert len(out) == odd.count()
    assert {(r.lang_pred, r.score) for r in out if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in out if r.doc_id in (4, 5)} == {"en"}
    assert train(sample_texts(empty.select("lang", "text"))) == {}
    assert {r.lang_pred for r in identify(odd, {}, ["doc_id"]).collect()} == {"und"}
    assert identify(empty, trees, ["doc_id"]).count() == 0
    tie = train(make([(1, "aa", "x", "s", 2), (2, "aa", "b", "s", 2)]).select("lang", "text"))
    assert [r.lang_pred for r in identify(make([(1, "aa")]), tie, ["doc_id"]).collect()] == ["b"]
    assert isinstance(next(iter(tie.values())), Tree)


# ---------------------------------------------------------------- tokens
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def machine():
    import json

    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        return Counter(json.load(f))


def test_counts_equal_the_library():
    rnd = random.Random(8)
    parts = ["the", "ing", " th", "er", "http", "://", ".com", "12", "'", "'ll", "'s", "'re", "é", "ção", "  ", "\n", "\t", "中文", "\U0001f600",
             "<|endoftext|>", " ", "'", "r", "v", "l", "S", " ", " ", "٣", "½", "--", "=" * 40]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    texts += ["", "'r", "'v", "'l", " 's", "''s", "   ", " \n x", "x" * 3000, "ab" * 2000, " " * 700 + "a", "<|endoftext|>" * 3, "a\x00b"]
    want = [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]
    assert machine().counts(texts) == want


def test_machine_starts_over_when_full():
    counter = machine()
    counter.tokens.MOST = 50
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(30)) for _ in range(30)]
    assert counter.counts(texts) == [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]


def test_token_query_and_odd_rows(spark, docs, odd, empty):
    import public_tokenizers

    want = {d.doc_id: n for d, n in zip(docs.collect(), [len(e.ids) for e in library().encode_batch([r.text for r in docs.collect()], add_special_tokens=False)])}
    got = {r.doc_id: r for r in op9_token_counts(spark, SF).collect()}
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got.values())
    path = public_tokenizers.path(TOKENIZER)
    out = token_counts(odd.withColumn("n_tokens", F.lit(1)).withColumn("k", F.lit(2)), path).collect()
    assert len(out) == odd.count() and {r.n_tokens for r in out if r.doc_id in (1, 2)} == {0}
    assert token_counts(empty, path).count() == 0
