"""Mixing, URL filters and WARC archives."""

import base64
import hashlib
import math
from collections import defaultdict
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from deskflow.llm.mixing import exponent, temperature_mix
from deskflow.llm.queries import URL_RULES, op3_url_filter, op6_warc
from deskflow.llm.urls import host_and_path, judge
from deskflow.llm.warc import WarcReader, read_archives, write_archives
from deskflow.session import work_dir

SF = "/root/testdata/sf0.001"


def sources(make, sizes, words=20):
    rows = [(1000 * k + i, "w " * words, "en", name, 0) for k, (name, n) in enumerate(sizes.items()) for i in range(n)]
    return make(rows)


def test_exponent_meets_its_target(spark):
    p = [0.6, 0.2, 0.1, 0.1]
    shares = spark.createDataFrame([(x,) for x in p], "p double")

    def entropy(a):
        w = [x ** a / sum(y ** a for y in p) for x in p]
        return -sum(x * math.log(x) for x in w) / math.log(len(p))

    a = exponent(shares, target_entropy=0.95)
    assert abs(entropy(a) - 0.95) < 1e-5
    a = exponent(shares, max_repeats=2.0)
    assert abs((0.6 / 0.1) ** (1 - a) - 2.0) < 1e-5
    assert exponent(shares, max_repeats=100.0) == 0.0 and exponent(shares.limit(1), max_repeats=2.0) == 1.0
    with pytest.raises(ValueError):
        exponent(shares)


def test_every_document_is_used_and_weights_are_met(make):
    mix = temperature_mix(sources(make, {"big": 600, "mid": 120, "small": 60}), max_repeats=2.0, block_tokens=2000).cache()
    rows = mix.collect()
    per, tokens, weight = defaultdict(set), defaultdict(int), {}
    for r in rows:
        per[r.doc_id].add(r.epoch)
        tokens[r.source] += r.n_tokens
        weight[r.source] = r.weight
    assert len(per) == 780 and all(0 in e for e in per.values())
    assert len(rows) == sum(map(len, per.values())) and max(map(max, per.values())) == 1
    assert abs(sum(weight.values()) - 1) < 1e-9
    for s, n in tokens.items():
        assert abs(n / sum(tokens.values()) - weight[s]) < 0.01
    blocks = defaultdict(lambda: defaultdict(int))
    for r in rows:
        blocks[r.mix_block][r.source] += r.n_tokens
    for b in blocks.values():
        assert abs(b["big"] / sum(b.values()) - weight["big"]) < 0.1


def test_budget_takes_part_of_a_source(make):
    rows = temperature_mix(sources(make, {"a": 400, "b": 100}), target_entropy=1.0, budget_share=0.5).collect()
    n = defaultdict(int)
    for r in rows:
        n[r.source] += 1
    assert abs(n["a"] - 125) <= 1 and abs(n["b"] - 125) <= 1


def test_mix_of_odd_rows(odd, empty):
    clash = odd.withColumn("epoch", F.lit("x")).withColumn("ka", F.lit(1)).withColumn("sid", F.lit(2)).withColumn("total", F.lit(3))
    out = temperature_mix(clash, max_repeats=1.5)
    assert out.columns.count("epoch") == 1 and {"ka", "sid", "total"} <= set(out.columns)
    assert out.where("epoch = 0").count() == odd.count()
    assert temperature_mix(empty, max_repeats=2.0).count() == 0


def pages(spark, urls, bad=None):
    rows = [(i, u, (bad or {}).get(i)) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, bad int")


def test_host_and_path(spark):
    urls = ["http://A.Com/x/Y?q#f", "x", None, "a://b", "a://b?c/d", "a://É.com:8/p#q", "http://h/a://b", "", "s://h//"]
    got = [tuple(r) for r in pages(spark, urls).select(*host_and_path(F.col("url"))).collect()]
    assert got == [("a.com", "/x/Y"), ("", ""), ("", ""), ("b", ""), ("b", ""), ("É.com:8", "/p"), ("h", "/a://b"), ("", ""), ("h", "//")]


def test_rules(spark):
    urls = ["http://example.com/en/1", "http://www.example.com/en/1", "http://m.www.example.com/en/1", "http://x.net/es/1", "http://x.net/de/1",
            "http://badexample.com/en/1", "http://com", "http://net/fr/", "http://example.com/en", None]
    got = {r.page_id: (r.rule, r.verdict) for r in judge(pages(spark, urls), URL_RULES).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("www.example.com/en/", "allow"), ("net/es/", "block"), (None, "allow"),
        ("com/", "allow"), (None, "allow"), ("net/fr/", "block"), ("com/", "allow"), (None, "allow")]


def test_templates_split_pure_branches(spark):
    urls, bad = [], {}
    for i in range(200):
        spam = i % 2
        urls.append(f"http://h.org/{'win' if spam else 'news'}/{i * 7}/page{i}.html")
        if i % 3:
            bad[i] = spam
    df = pages(spark, urls, bad)
    got = {r.page_id: r for r in judge(df, [], F.col("bad")).collect()}
    assert all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(200))
    assert {r.template for r in got.values()} == {"/win/<number>/*", "/news/<number>/*"}


def test_branches_below_a_wildcard_are_judged_together(spark):
    urls = [f"http://h.org/user{i}x/{kind}" for i in range(300) for kind in ("spam", "about")]
    df = pages(spark, urls, {i: int(u.endswith("spam")) for i, u in enumerate(urls)})
    got = {(r.template, r.verdict) for r in judge(df, [], F.col("bad")).collect()}
    assert got == {("/*/spam", "block"), ("/*/about", "allow")}


def test_url_query_and_odd_rows(spark):
    out = op3_url_filter(spark, SF)
    n = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert out.count() == n and out.where("rule is null and verdict is null").count() == 0
    odd = pages(spark, [None, "", "http://h/" + "a/" * 3000, "http://h/x", "http://h/x", "http://" + quote("é") + "/"]).withColumn(
        "pid", F.lit(1)).withColumn("host", F.lit("mine"))
    assert judge(odd, URL_RULES).count() == 6
    assert judge(pages(spark, []), URL_RULES).count() == 0


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def archive(spark, rows, **options):
    path = work_dir(spark, "warc-test")
    write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path, **options)
    return path


ROWS = [(3, "u3", "same é\r\n\r\nWARC/1.1\r\n"), (1, "u1", "same é\r\n\r\nWARC/1.1\r\n"), (2, None, None), (5, "u5", ""), (4, "a\r\nb", "x" * 300_000),
        (6, "u6", "tie"), (6, "u6", "tie"), (None, "n", "tie"), (None, "n", "alone")]


def test_archives_round_trip(spark):
    got = sorted(map(tuple, read_archives(spark, archive(spark, ROWS)).select(
        "record_id", "record_type", "refers_to_id", "payload_bytes", "payload_digest", "payload").collect()), key=str)
    want = []
    for key, _, html in ROWS:
        first = {"same é\r\n\r\nWARC/1.1\r\n": 1, "": 2, "tie": 6}.get(html or "")
        response = first is None or key == first
        data = (html or "").encode()
        want.append((f"urn:x-page:{'null' if key is None else key}", "response" if response else "revisit",
                     None if response else f"urn:x-page:{first}", len(data), digest(html), data if response else None))
    assert got == sorted(want, key=str)


def test_filters_are_pushed_down_and_small_payloads_kept(spark):
    path = archive(spark, ROWS)
    revisits = read_archives(spark, path).where("record_type = 'revisit'")
    assert revisits.count() == 3
    # The reader took the filter over: Spark plans none of its own, and the
    # reader alone leaves the other records out.
    assert not any("record_type" in line for line in revisits._jdf.queryExecution().executedPlan().toString().splitlines()
                   if line.lstrip("+-:*( 0123456789)").startswith("Filter") and "isnotnull(record_type" not in line)
    reader = WarcReader({"path": path})
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("record_id",), ("urn:x-page:3",)), EqualTo(("payload_bytes",), 3)]))
    assert rest == [EqualTo(("payload_bytes",), 3)]
    seen = [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]
    assert [row["record_id"] for row in seen] == ["urn:x-page:3"]
    assert read_archives(spark, path, record_type="response").count() == 6
    some = read_archives(spark, path).where(F.col("record_id").isin("urn:x-page:1", "urn:x-page:4"))
    assert sorted(r.payload_bytes for r in some.collect()) == [len(ROWS[0][2].encode()), 300_000]
    assert read_archives(spark, archive(spark, ROWS, min_bytes=5)).where("record_type = 'revisit'").count() == 1
    assert read_archives(spark, archive(spark, [])).count() == 0
    assert read_archives(spark, archive(spark, ROWS, compression="none"), payload="false").where("payload is null").count() == 9


def test_unwanted_payloads_are_not_inflated(spark, monkeypatch):
    from deskflow.llm import warc

    path = archive(spark, ROWS)
    inflated = []
    into = warc.Member.readinto
    monkeypatch.setattr(warc.Member, "readinto", lambda self, b: inflated.append(n := into(self, b)) or n)
    for wanted, most in (("urn:x-page:2", 40_000), ("urn:x-page:4", 400_000)):
        reader, inflated[:] = WarcReader({"path": path, "record_id": wanted}), []
        rows = [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]
        assert [r["record_id"] for r in rows] == [wanted] and sum(inflated) < most
    assert sum(inflated) > 300_000  # page 4 itself


def test_archives_are_split_and_damage_is_seen(spark, monkeypatch, tmp_path):
    import gzip
    import os

    from deskflow.llm import warc

    monkeypatch.setattr(warc, "SPLIT_BYTES", 2000)
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(60)]
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
        write_archives(df, path, compression=compression)
        files = [f for f in os.listdir(path) if not f.startswith(("_", "."))]
        parts = WarcReader({"path": path}).partitions()
        assert len(parts) > len(files) and sum(p.end - p.start for p in parts) == sum(os.path.getsize(f"{path}/{f}") for f in files)
        assert sorted(r.record_id for r in read_archives(spark, path).collect()) == sorted(f"urn:x-page:{i}" for i in range(60))
        assert not os.path.exists(f"{path}/_pending")
    # Any reader of gzip can read it, and archives of other makers are read.
    name = next(f for f in os.listdir(tmp_path / "gzip") if f.endswith(".gz") and not f.startswith("_"))
    whole = gzip.decompress((tmp_path / "gzip" / name).read_bytes())
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "other" / "b.warc").write_bytes(whole)
    got = read_archives(spark, str(tmp_path / "other")).groupBy("record_id").count().collect()
    assert {r["count"] for r in got} == {2} and len(got) == whole.count(b"WARC-Record-ID")
    assert read_archives(spark, str(tmp_path / "other"), record_id="urn:x-page:0").count() in (0, 2)
    data = bytearray((tmp_path / "gzip" / name).read_bytes())
    data[-6] ^= 1
    (tmp_path / "gzip" / name).write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        read_archives(spark, str(tmp_path / "gzip")).count()


def test_warc_query(spark):
    got = {r.page_id: r for r in op6_warc(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/pages.parquet").collect()
    first = {}
    for p in sorted(table, key=lambda p: p.page_id):
        first.setdefault(p.html, p.page_id)
    for p in table:
        r = got[p.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(p.html.encode()), digest(p.html))
        assert (r.record_type, r.refers_to) == (("response", None) if first[p.html] == p.page_id else ("revisit", first[p.html]))
