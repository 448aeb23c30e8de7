import re
import zlib
from collections import Counter

from deskflow.llm import spelling
from deskflow.llm.queries import QUERIES
from deskflow.llm.spelling import near_words, roots, spelling_groups, text_words

SF = "/root/testdata/sf0.001"


def counted(rows, every=97, least=5, seen=3):
    n = Counter()
    for i, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= seen}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(n, ratio=2):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) if xs else None for w, xs in near.items()}
    form = {w: b if b and n[b] >= ratio * n[w] else None for w, b in best.items()}
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def grouped(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_every_kind_of_edit_chain_and_tie(make):
    words = {"colour": 40, "color": 18, "colon": 9, "colonx": 3, "colours": 20, "aaaaa": 8, "aaaaaa": 4, "aaaaaaa": 3, "stories": 5,
             "storiés": 5, "xstories": 5, "lonely": 3, "abcde": 3, "bbcde": 6, "cbcde": 6, "short": 2, "zzzz": 9}
    rows = [(k, " ".join([w] * c)) for k, (w, c) in enumerate(words.items())]
    want = brute(counted(rows, every=1 << 40))
    assert want["colonx"][:2] == ("colon", "colour") and want["abcde"][0] == "bbcde" and want["lonely"][0] is None
    assert grouped(spelling_groups(make(rows), every=1 << 40)) == want


def test_query_equals_brute_force_on_the_table(spark, docs):
    want = brute(counted([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert grouped(QUERIES["op13_spelling"](spark, SF)) == want and len(want) > 1000


def test_long_texts_nulls_repeats_and_clashing_columns(make, odd, empty):
    rows = [(None, "Große Großen " * 3), (7, None), (8, ""), (9, "É×÷Ý " * 5 + "Ünïcödé " * 4), (9, "Ünïcödé"), (9, "Ünïcödé"),
            (10, "b" * 5000 + " " + ("b" * 5000 + " ") * 2), (11, "word-word_WORD'Words words " * 200_000)]
    df = make(rows).selectExpr("*", "'x' as word", "1 as n", "'y' as form", "'z' as gram")
    assert grouped(spelling_groups(df)) == brute(counted(rows))
    assert spelling_groups(empty).count() == 0
    assert spelling_groups(odd, seen=1, least=1).count() > 0


def test_long_text_is_read_whole():
    text = "alpha beta! " * 200_000
    assert text_words(1, text, 1 << 40, 1) == {"alpha": 200_000, "beta": 200_000}


def test_near_pairs_once_each_way(spark):
    words = spark.createDataFrame([("house", 5), ("houses", 3), ("horse", 2), ("mouse", 2)], "word string, n bigint")
    pairs = sorted((r["word"], r["near"]) for r in near_words(words).collect())
    assert pairs == sorted([("house", "houses"), ("houses", "house"), ("house", "horse"), ("horse", "house"), ("house", "mouse"), ("mouse", "house")])


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(37)]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i:02}": "w37" for i in range(37)}


def test_no_join_rests_on_an_estimated_size(make, monkeypatch):
    """Every table here is below Spark's broadcast threshold, as the stored
    words of a larger corpus may seem to be before they are cut."""
    plans, kept = [], spelling.store

    def noted(df, *args, **named):
        plans.append(df)
        return kept(df, *args, **named)

    monkeypatch.setattr(spelling, "store", noted)
    words = {"colour": 40, "color": 18, "colon": 9, "colonx": 3}
    rows = [(k, " ".join([w] * c)) for k, (w, c) in enumerate(words.items())]
    out = spelling_groups(make(rows), every=1 << 40)
    assert grouped(out) == brute(counted(rows, every=1 << 40))
    shown = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, out]]
    assert not any("Broadcast" in x for x in shown)
    assert sum("SortMergeJoin" in x for x in shown) == 5  # near words, three doublings, the result
