"""Quality rules: counts against brute force, robust estimates, odd input."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from deskflow.llm.quality_rules import COUNTS, FLOOR, VECTOR, mcd, quality_rules
from deskflow.llm.textstats import count_struct


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if seen[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def counted(df):
    return {r[0]: tuple(r[1]) for r in df.select("doc_id", count_struct(F.col("text")).alias("s")).collect()}


def test_counts_of_the_table(docs):
    got = counted(docs)
    assert all(got[r.doc_id] == brute(r.text) for r in docs.collect())


def test_counts_of_planted_texts(make):
    rnd = random.Random(5)
    texts = ["", "a", "a a a", "a b a b a b", "x y z x y z", "a\n a\na\n\n", "#$ | <b>", "\x0ba\x0cb c\r\nd", "a b  c"]
    texts += [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    texts += [" ".join(str(rnd.randint(0, k)) for _ in range(3000)) for k in (1, 5, 12, 40)]  # few and many repeated windows
    got = counted(make(list(enumerate(texts))))
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_estimate_ignores_a_minority_of_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([5, 1, 0, 2], np.diag([1.0, 0.25, 0.5, 2.0]), 900)
    bad = rng.normal(40, 1, (100, 4))
    rows = [(1, *map(float, x)) for x in np.vstack([good, bad])]
    out = mcd(spark.createDataFrame(rows, "g bigint, " + ", ".join(f"{v} double" for v in VECTOR)), "g").first()
    assert out["n_fitted"] == 1000
    mean, cov = good.mean(axis=0), np.cov(good.T) + np.diag(np.square(FLOOR))
    assert np.allclose([out[f"m{i}"] for i in range(4)], mean, atol=0.15)
    lower = np.array([[out[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    assert np.allclose(np.diag(lower @ lower.T), np.diag(cov), rtol=0.25)


def test_clean_documents_stay_and_junk_goes(make):
    rnd = random.Random(1)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    clean = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(60, 300)))) for i in range(300)]
    junk = [(1000 + i, " ".join(rnd.choice(vocabulary) + rnd.choice(["###", "$$$", "%%%"]) for _ in range(120))) for i in range(20)]
    short = [(2000, "too short")]
    repeated = [(3000, "buy this now " * 60)]
    got = {r.doc_id: r for r in quality_rules(make(clean + junk + short + repeated)).collect()}
    assert all(got[i].kept for i, _ in clean)
    assert not any(got[i].kept or got[i].base_failed for i, _ in junk)
    assert got[2000].base_failed and got[3000].base_failed and not got[3000].kept


def test_copies_of_one_bad_text_do_not_shape_the_estimate(make):
    rnd = random.Random(2)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    clean = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(60, 300)))) for i in range(380)]
    bad = " ".join(rnd.choice(vocabulary) + "###" for _ in range(120))
    copies = [(1000 + i, bad) for i in range(200)]  # a third of the source
    other = [(2000 + i, " ".join(rnd.choice(vocabulary) + "$" for _ in range(120))) for i in range(20)]
    got = {r.doc_id: r for r in quality_rules(make(clean + copies + other)).collect()}
    assert all(got[i].kept for i, _ in clean)
    assert not any(got[i].kept or got[i].base_failed for i, _ in copies + other)


def test_odd_rows_and_clashing_names(odd, empty):
    extra = odd.withColumn("kept", F.lit("mine")).withColumn("g", F.lit(1)).withColumn("m0", F.lit(2))
    out = quality_rules(extra)
    assert out.count() == odd.count()
    assert out.columns.count("kept") == 1 and {"g", "m0", *COUNTS} <= set(out.columns)
    got = {(r.doc_id, r.text is None): r for r in out.collect()}
    assert got[1, True].n_words == 0 and got[1, True].base_failed
    assert got[3, False].n_words == 0 and got[4, False].n_words == 100_000 and got[4, False].base_failed
    assert quality_rules(empty).count() == 0
