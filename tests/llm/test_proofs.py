"""Results of the corpus queries against plain Python on small tables."""

import math
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskflow.llm import langid, urls
from deskflow.llm.common import exclusive_scan, let, scratch, store
from deskflow.llm.langid import identify, learn_and_identify, sample_texts, train
from deskflow.llm.mixing import temperature_mix
from deskflow.llm.queries import QUERIES, op1_quality_classifier, op4_language, op10_mixing
from deskflow.llm.quality_rules import COUNTS, CUTOFF, FLOOR, INNER, REWEIGHT, CONSISTENCY, lower_quantiles, quality_rules
from deskflow.llm.secrets import redacted, secret_scan
from deskflow.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


def test_sql_answers_agree(spark):
    from oracle.compare import compare, duck_views

    assert compare(QUERIES["op6_warc"](spark, SF), duck_views(SF, ["pages"]), ORACLES["op6_warc"]) == []


# ------------------------------------------------------------------- folds
def test_folds_and_predictions(spark, docs):
    fold = {d.doc_id: crc32(str(d.doc_id).encode()) for d in docs.collect()}
    one = op1_quality_classifier(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in one} == {i: h % 5 == 0 for i, h in fold.items()}
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in one)
    four = op4_language(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in four} == {i: h % 3 == 1 for i, h in fold.items()}
    texts = {d.doc_id: d.text for d in docs.collect()}
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")) for r in four)


def test_languages_in_groups_equal_one_pass(spark, docs, odd):
    texts = sample_texts(docs.select("lang", "text"))
    whole = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, train(texts), ["doc_id"]).collect()}
    for group in (1, 3):
        parts = {r.doc_id: (r.lang_pred, r.score) for r in learn_and_identify(docs, texts, ["doc_id"], group).collect()}
        assert {i: p[0] for i, p in parts.items()} == {i: p[0] for i, p in whole.items()}
        assert all(math.isclose(parts[i][1], whole[i][1], rel_tol=1e-9, abs_tol=1e-12) for i in whole)
    many = odd.limit(0).unionByName(docs.limit(5)).sparkSession.createDataFrame([(f"l{i:03}", f"text {i} " * 3) for i in range(langid.GROUP + 9)], "lang string, text string")
    got = learn_and_identify(docs.limit(3), sample_texts(many), ["doc_id"]).collect()
    assert len(got) == 3 and all(r.lang_pred.startswith("l") for r in got)


# --------------------------------------------------------------- url filter
def plain_templates(rows):
    """{(host, segments): template} by rounds of wildcards over a tree held
    in dictionaries; rows: (host, segments, bad or None)."""
    paths = defaultdict(lambda: [0, 0, 0])
    for host, segs, bad in rows:
        c = paths[host, segs]
        c[0], c[1], c[2] = c[0] + 1, c[1] + (bad is not None), c[2] + (bad or 0)
    tree = {key: [(s, False) for s in key[1]] for key in paths}
    while True:
        node = defaultdict(lambda: [0, 0, 0])
        for (host, segs), (n, seen, bad) in paths.items():
            way = tree[host, segs]
            for d in range(len(way)):
                c = node[(host, *way[:d + 1])]
                c[0], c[1], c[2] = c[0] + n, c[1] + seen, c[2] + bad
        kids = defaultdict(list)
        for key in node:
            kids[key[:-1]].append(key)
        wild = set()
        for parent, children in kids.items():
            pn, pl, pb = (sum(node[c][i] for c in children) for i in range(3))
            p = (pb + 0.5) / (pl + 1)
            spread = len(children) >= urls.MANY_CHILDREN and len(children) >= urls.LEAST_SPREAD * pn
            for c in children:
                _, seen, bad = node[c]
                z = abs(bad - seen * p) / math.sqrt(max(seen * p * (1 - p), 1e-9))
                if not c[-1][1] and (spread or (len(children) > 1 and (seen == 0 or z < urls.SAME_Z))):
                    wild.add(c)
        if not wild:
            return {key: "/" + "/".join(s for s, _ in way) for key, way in tree.items()}, paths
        for (host, segs), way in tree.items():
            for d in range(len(way)):
                if (host, *way[:d + 1]) in wild:
                    way[d] = ("*", True)
                    break


@pytest.mark.parametrize("seed", [1, 2])
def test_url_templates_and_verdicts_against_plain_python(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(700):
        host = rnd.choice(["a.org", "a.org", "b.org", "c.org"])
        kind = rnd.choice(["win", "news", "help"])
        segs = [kind, rnd.choice([f"user{rnd.randint(0, 40)}q", "all"]), rnd.choice(["x", "y", f"p{i}"])][:rnd.randint(0, 3)]
        share = 0.9 if kind == "win" and host != "c.org" else 0.1
        rows.append((i, host, tuple(segs), None if rnd.random() < 0.3 else int(rnd.random() < share)))
    df = spark.createDataFrame([(i, f"http://{h}/{'/'.join(s)}", b) for i, h, s, b in rows], "page_id bigint, url string, bad int")
    template, paths = plain_templates([(h, s, b) for _, h, s, b in rows])
    whole = [sum(c[i] for c in paths.values()) for i in (1, 2)]
    share = whole[1] / whole[0]
    by_host, by_kind = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (h, s), (_, seen, bad) in paths.items():
        for c in (by_host[h], by_kind[h, template[h, s]]):
            c[0], c[1] = c[0] + seen, c[1] + bad
    w = urls.WEIGHT
    got = {r.page_id: r for r in urls.judge(df, [], F.col("bad")).collect()}
    for i, h, s, _ in rows:
        prior = (by_host[h][1] + w * share) / (by_host[h][0] + w)
        seen, bad = by_kind[h, template[h, s]]
        score = (bad + w * prior) / (seen + w)
        assert got[i].template == template[h, s]
        assert math.isclose(got[i].bad_share, score, rel_tol=1e-9)
        assert got[i].verdict == ("block" if score >= urls.LIMIT else "allow")
    assert {r.verdict for r in got.values()} == {"block", "allow"}


# ------------------------------------------------------------------- mixing
def test_mix_places_against_plain_python(spark, make, monkeypatch):
    from deskflow.llm import mixing

    monkeypatch.setattr(mixing, "SLICE", 7)  # many slices, many groups of them
    rnd = random.Random(3)
    sizes = {"big": 700, "mid": 90, None: 40, "tiny": 3}
    rows = [(i, "w " * rnd.randint(0, 9), "en", s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += rows[:25]  # repeated rows share a place
    docs = make(rows)
    hashed = docs.select("doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("ka"), F.hash("text", "source", "doc_id").alias("kb"),
                         F.greatest(F.size(F.array_remove(F.split(F.trim("text"), " "), "")), F.lit(1)).alias("tokens"),
                         *[F.xxhash64(F.lit(0), F.lit(e), F.xxhash64("doc_id", "source", "text"), F.hash("text", "source", "doc_id")).alias(f"h{e}") for e in (0, 1)])
    docs_of, total = defaultdict(dict), defaultdict(int)
    for r in hashed.collect():
        total[r.source] += r.tokens
        d = docs_of[r.source].setdefault((r.ka, r.kb), [r, 0])
        d[1] += r.tokens
    got = temperature_mix(docs, carry=["doc_id", "source"], max_repeats=2.0, block_tokens=300).collect()
    weight = {r.source: r.weight for r in got}
    whole = sum(total.values())
    z, least = None, None
    p = {s: t / whole for s, t in total.items()}
    a = 1 - math.log(2.0) / math.log(max(p.values()) / min(p.values()))  # repeats of the smallest over the largest source
    ratio = weight["big"] / weight["tiny"]
    assert math.isclose(math.log(ratio) / math.log(p["big"] / p["tiny"]), max(a, 0), abs_tol=1e-4)
    assert math.isclose(sum(weight.values()), 1, rel_tol=1e-9) and z is least is None
    # The least budget that uses every document: the largest source once.
    scale = max(total[s] / weight[s] for s in total)
    blocks = max(1, math.ceil(scale / 300))
    want = set()
    for s, held in docs_of.items():
        quota = max(round(weight[s] * scale), total[s])
        slices = max(1, math.ceil(len(held) / 7))
        for epoch in range((quota - 1) // total[s] + 1):
            at = epoch * total[s]
            for r, mass in sorted(held.values(), key=lambda x: (x[0][f"h{epoch}"] % slices, x[0][f"h{epoch}"], x[0].ka, x[0].kb)):
                if at < quota:
                    want.add((r.doc_id, epoch, min(int(at / quota * blocks), blocks - 1)))
                at += mass
    assert {(r.doc_id, r.epoch, r.mix_block) for r in got} == want
    assert sum(1 for r in got if r.epoch == 0) == len(rows)


def test_mixing_query_uses_every_document(spark, docs):
    got = op10_mixing(spark, SF).collect()
    assert {r.doc_id for r in got if r.epoch == 0} == {d.doc_id for d in docs.collect()} and max(r.epoch for r in got) <= 1


# ------------------------------------------------------------ quality rules
def lower(x, q):
    return np.sort(x)[math.ceil(len(x) * q) - 1]


def plain_mcd(x):
    d = x.shape[1]
    floor = np.diag(np.square(FLOOR))

    def far(m, c):
        z = np.linalg.solve(np.linalg.cholesky(c), (x - m).T)
        return (z * z).sum(axis=0)

    med = np.array([lower(x[:, i], 0.5) for i in range(d)])
    mad = np.array([lower(np.abs(x[:, i] - med[i]), 0.5) for i in range(d)])
    starts = [(med, np.diag((1.4826 * mad) ** 2) + floor), (x.mean(axis=0), np.cov(x.T, bias=True) + floor)]
    out = []
    for m, c in starts:
        for _ in range(2):
            dist = far(m, c)
            inner = x[dist <= lower(dist, INNER) * (1 + 1e-9)]
            m, c = inner.mean(axis=0), np.cov(inner.T, bias=True) * CONSISTENCY + floor
        out.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(out, key=lambda o: o[0])
    inner = x[far(m, c) <= REWEIGHT]
    return inner.mean(axis=0), np.cov(inner.T, bias=True) + floor


def test_kept_against_plain_estimates(spark, docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality_rules(docs, carry=["doc_id", "lang", "source"]).collect()
    c = {k: np.array([r[k] for r in rows], dtype=float) for k in COUNTS}
    n = np.maximum(c["n_words"], 1)
    x = np.stack([c["word_chars"] / n, np.log1p(c["n_symbols"] / n), np.sqrt(c["n_dup_lines"] / n), np.sqrt(c["n_repeat_words"] / n)], axis=1)
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    assert [r.base_failed for r in rows] == failed.tolist()
    lang, group = np.array([r.lang for r in rows]), np.array([f"{r.lang}/{r.source}" for r in rows])
    differ = 0
    for g in set(group):
        own = (group == g) & ~failed
        fit = own if own.sum() >= 50 else (lang == g.split("/")[0]) & ~failed
        m, cov = plain_mcd(x[fit])
        z = np.linalg.solve(np.linalg.cholesky(cov), (x - m).T)
        kept = ~failed & ((z * z).sum(axis=0) <= CUTOFF)
        differ += sum(kept[i] != rows[i].kept for i in np.flatnonzero(group == g))
    assert differ <= 0.002 * len(rows)  # distances at the cut, and cuts a bucket apart


def test_lower_quantiles(spark):
    rng = np.random.default_rng(9)
    rows = [(i % 3, float(v), float(w)) for i, (v, w) in enumerate(zip(rng.exponential(5, 3000) ** 3, rng.integers(0, 4, 3000)))] + [(7, 2.0, 0.0)]
    got = {r.g: r for r in lower_quantiles(spark.createDataFrame(rows, "g int, a double, b double"), ["g"], [F.col("a"), F.col("b")], 0.5).collect()}
    for g in (0, 1, 2, 7):
        a, b = (np.array([r[k] for r in rows if r[0] == g]) for k in (1, 2))
        assert got[g].n == len(a)
        assert math.isclose(got[g].q0, lower(a, 0.5), rel_tol=1e-4) and math.isclose(got[g].q1, lower(b, 0.5), rel_tol=1e-9)


# ------------------------------------------------------------------ secrets
def test_scan_in_blocks(spark):
    rng = random.Random(6)
    rows = [(n, [rng.randint(-5, 50) for _ in range(n)]) for n in (0, 1, 2, 255, 256, 257, 700, 5000)]
    df = spark.createDataFrame(rows, "n int, a array<bigint>")
    got = df.select("n", exclusive_scan(F.col("a"), lambda x, y: x + y).alias("s"), exclusive_scan(F.col("a"), F.greatest).alias("m")).collect()
    for r, (_, a) in zip(sorted(got), sorted(rows)):
        sums, tops = [0], [0]
        for v in a:
            sums.append(sums[-1] + v)
            tops.append(max(tops[-1], v))
        assert (r.s, r.m) == (sums, tops)


def test_a_text_of_very_many_secrets(make):
    import time

    line = "é key-0123456789abcdef/Zq8xK2mW9rT4vB7nL1 token: 'abcdefgh%06dxyz' \U0001f600\n"
    text = "".join(line % i for i in range(50_000))
    began = time.time()
    out = secret_scan(make([(1, text), (2, line % 7)])).select("doc_id", "base", F.size("spans").alias("n"), redacted(F.col("text"), F.col("spans")).alias("masked"))
    rows = {r.doc_id: r for r in out.collect()}
    assert time.time() - began < 120
    assert len(rows[1].base) == 100_000 and rows[1].masked.count("<secret>") >= 100_000 and "0123456789abcdef" not in rows[1].masked
    at = rows[1].base[-2].start
    assert text[at:at + 16] == "0123456789abcdef" or text[at:].startswith("token")
    assert rows[1].masked.startswith(rows[2].masked[:len("é key-<secret>")])


def test_scratch_goes_and_kept_tables_stay(spark):
    from deskflow.sources.files import path_exists

    with scratch(spark):
        inner = store(spark.range(5), "inner")
        kept = store(inner, "kept", keep=True)
        folder = inner.inputFiles()[0].rsplit("/", 2)[0]
        assert path_exists(spark, folder)
    assert kept.count() == 5 and not path_exists(spark, folder)
    assert store(spark.range(2), "plain").count() == 2
    assert spark.range(1).select(let(F.lit(3), lambda x: x + x)).first()[0] == 6


