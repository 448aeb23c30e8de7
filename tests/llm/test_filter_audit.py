from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deskflow.llm.filter_audit import common_size, difference, filter_audit, gallop, union, union_sizes
from deskflow.llm.queries import QUERIES
from deskflow.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"
LABELS = "doc_id bigint, quality int, toxic int"
SORTED = st.lists(st.integers(0, 3000), unique=True, max_size=1500).map(lambda x: np.array(sorted(x), dtype=np.int64))


@settings(max_examples=60, deadline=None)
@given(SORTED, SORTED)
def test_galloping_merges(a, b):
    assert gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    assert union(a, b).tolist() == sorted(set(a.tolist()) | set(b.tolist()))
    assert difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert common_size(a, b) == len(set(a.tolist()) & set(b.tolist()))


@settings(max_examples=20, deadline=None)
@given(st.lists(SORTED, min_size=3, max_size=3), SORTED)
def test_union_sizes_of_all_subsets(lists, good):
    sizes = union_sizes(lists, [good])
    for mask in range(8):
        want = set().union(*[set(x.tolist()) for k, x in enumerate(lists) if mask >> k & 1])
        assert sizes[mask].tolist() == [len(want), len(want & set(good.tolist()))]


def brute(rows, labels):
    """Audit rows by plain counting."""
    def fails(i, text):
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                "E": i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows)}

    docs = [(i, p or "", fails(i, t or "")) for i, t, p in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p for _, p, _ in docs}:
        here = [(i, f) for i, p, f in docs if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = here
            for step, x in enumerate(order, 1):
                gone, left = [d for d in left if d[1][x]], [d for d in left if not d[1][x]]
                total[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[x] for _, f in here) - len(gone),
                    sum(f[x] and sum(f.values()) == 1 for _, f in here), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                                                      "toxic_lost", "shapley")] for r in df.collect()}


def test_matches_counting(spark, make):
    many = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", many, many + " #", "WORD " * 300, "a " * 300, many, many.upper(), "x y", "x y", "naïve É " + many, many + "|"]
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(texts)]
    rows += [(None, many, "en"), (2, many, "en"), (2, many, "en"), (11, "x y", None), (-5, "a " * 300, "fr")]
    labels = [(0, 1, 0), (2, 1, None), (2, None, 1), (3, None, 1), (6, 0, 1), (None, 1, 1), (99, 1, 1), (9, 1, 1)]
    docs = make([(i, t, p, "s", 0) for i, t, p in rows])
    want = brute(rows, labels)
    assert audited(filter_audit(docs, spark.createDataFrame(labels, LABELS))) == want
    assert len(want) == 600 * len({p or "" for _, _, p in rows})


def test_odd_rows_clashing_columns_and_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], LABELS)
    plain = audited(filter_audit(odd, none))
    clashing = odd.selectExpr("*", "'x' as part", "'y' as fails", "1 as row", "'z' as good", "2 as n", "3 as digest", "4 as f0")
    assert audited(filter_audit(clashing, none)) == plain
    assert {k[0] for k in plain} == {"", "en", "es", "fr"}
    assert filter_audit(empty, none).count() == 0


@pytest.mark.parametrize("key", ["op12_filter_audit"])
def test_query_equals_sql(spark, key):
    from oracle.compare import compare, duck_views

    assert compare(QUERIES[key](spark, SF), duck_views(SF, ["documents", "labels"]), ORACLES[key]) == []
