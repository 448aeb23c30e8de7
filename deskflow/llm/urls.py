"""URL filters: listed rules, and a path-template tree judged by purity.

Per host, paths form a tree of segments.  Segments that vary become
wildcards: by their shape (numbers, long hex strings, dates), and where a
node has many children for its rows.  Sibling branches whose labelled share
of bad pages does not differ from that of their parent are merged into one
wildcard branch.  What is left of a path is its template; a template is
rejected when its labelled purity, smoothed towards its host's and that
towards the whole table's, reaches the limit.

All steps are aggregates over distinct host and path pairs: nodes are
addressed by a running hash, and a host that holds most pages is combined
before any shuffle.  The tree is settled from the top, a level a round: what
lies below a wildcard is tested on the counts of the merged branch.  A path
that shares its node with no other one is done; segments beyond the
``MAX_DEPTH``th count as one, so there are that many rounds at most.

Defined results: a null url, or one without ``://``, has an empty host and
path; rules still apply to them as written; urls without labelled relatives
are judged by the host's, then the table's smoothed share (none: allow).
Repeated rows are judged alike; an empty table gives an empty result; other
columns are carried under their own names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MANY_CHILDREN, LEAST_SPREAD = 8, 0.3
SAME_Z = 2.0
WEIGHT = 5.0
LIMIT = 0.5
MAX_DEPTH = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at == 0, F.lit("")).otherwise(F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null.  A rule is
    (allow or block, host followed by a path)."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):  # later wins
        name, slash, rest = rule.partition("/")
        ok = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        fits = F.when(ok, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def segments(path: Column) -> Column:
    """Path segments, variable shapes replaced by their kind."""
    def shape(x: Column) -> Column:
        stem = F.regexp_extract(x, r"^([^.]*)", 1)
        end = F.substring(x, F.length(stem) + 1, F.length(x))
        kind = (F.when(stem.rlike(r"^\d{4}-\d{2}-\d{2}$"), "<date>").when(stem.rlike(r"^\d+$"), "<number>")
                .when(stem.rlike(r"^[0-9a-fA-F-]{8,}$") & stem.rlike(r"\d"), "<hex>").otherwise(stem))
        return F.concat(kind, end)

    def bounded(segs: Column) -> Column:
        rest = F.array_join(F.slice(segs, F.lit(MAX_DEPTH), F.size(segs)), "/")
        return F.when(F.size(segs) <= MAX_DEPTH, segs).otherwise(F.concat(F.slice(segs, F.lit(1), F.lit(MAX_DEPTH - 1)), F.array(rest)))

    return let(F.transform(F.filter(F.split(path, "/", -1), lambda x: x != ""), shape), bounded)


def _wildcards(branch: DataFrame) -> DataFrame:
    """For the branches (at, seg) of some nodes: whether each becomes part of
    a wildcard, and whether it is all that the node has."""
    parent = branch.groupBy(F.col("at").alias("a3")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("paths").alias("held"), F.sum("n").alias("pn"), F.sum("labelled").alias("pl"), F.sum("bad").alias("pb"))
    spread = (F.col("children") >= MANY_CHILDREN) & (F.col("children") >= LEAST_SPREAD * F.col("pn"))
    p = (F.col("pb") + 0.5) / (F.col("pl") + 1.0)
    # Two shares: the branch against its parent.  Unlabelled branches cannot differ.
    z = F.abs(F.col("bad") - F.col("labelled") * p) / F.sqrt(F.greatest(F.col("labelled") * p * (1 - p), F.lit(1e-9)))
    same = (F.col("labelled") == 0) | (z < SAME_Z)
    return branch.join(parent, F.col("at") == F.col("a3")).select(
        F.col("at").alias("a2"), F.col("seg").alias("s2"), (spread | ((F.col("children") > 1) & same)).alias("wild"), (F.col("held") == 1).alias("alone"))


def templates(pages: DataFrame) -> DataFrame:
    """(pid, host, template, n_bad, n_labelled) per distinct host and
    segment list of ``pages`` (host, path, bad); ``bad`` is 1, 0 or null."""
    paths = pages.select("host", segments(F.col("path")).alias("segs"), F.col("bad").cast("long").alias("bad")) \
        .groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    counts = ("n", "labelled", "bad")
    active = store(paths.select(F.xxhash64("host", "segs").alias("pid"), "host", F.xxhash64("host").alias("at"), "segs",
                                F.array().cast("array<string>").alias("done"), *counts), "url-paths")
    parts = []
    for depth in range(MAX_DEPTH):
        here = active.withColumn("seg", F.get("segs", F.lit(depth)))
        branch = here.where("seg is not null").groupBy("at", "seg").agg(F.count(F.lit(1)).alias("paths"), *[F.sum(c).alias(c) for c in counts])
        told = _wildcards(store(branch, "url-branches"))
        moved = here.join(told, (F.col("at") == F.col("a2")) & (F.col("seg") == F.col("s2")), "left")
        wild = F.coalesce("wild", F.lit(False))
        named = F.when(F.col("seg").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.when(wild, "*").otherwise(F.col("seg"))))
        ended = F.col("seg").isNull() | F.coalesce("alone", F.lit(False)) | (depth == MAX_DEPTH - 1)
        moved = store(moved.select("pid", "host", F.xxhash64("at", F.when(wild, "*").otherwise(F.col("seg")), wild).alias("at"), "segs",
                                   F.concat("done", named).alias("done"), *counts, ended.alias("ended")), "url-paths")
        rest = F.slice("segs", F.size("done") + 1, F.greatest(F.size("segs") - F.size("done"), F.lit(0)))
        template = F.concat(F.lit("/"), F.array_join(F.concat("done", rest), "/"))
        parts.append(moved.where("ended").select("pid", "host", template.alias("template"), "labelled", "bad"))
        active = moved.where(~F.col("ended"))
        if active.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts)


def purity(paths: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """(pid, template, bad_share): smoothed labelled share of bad pages of
    each path's template."""
    paths = store(paths, "url-templates")
    total = paths.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("labelled"), F.lit(0))).first()
    share = (total[0] / total[1]) if total[1] else 0.0
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb")).select(
        F.col("host").alias("host2"), ((F.col("hb") + weight * share) / (F.col("hl") + weight)).alias("prior"))
    kinds = paths.groupBy("host", "template").agg(F.sum("labelled").alias("tl"), F.sum("bad").alias("tb"))
    kinds = kinds.join(hosts, F.col("host") == F.col("host2")).select(
        F.col("host").alias("h3"), F.col("template").alias("t3"), ((F.col("tb") + weight * F.col("prior")) / (F.col("tl") + weight)).alias("bad_share"))
    kinds = kinds.withColumn("x3", F.xxhash64("t3", "h3"))
    joined = paths.withColumn("x", F.xxhash64("template", "host")).join(
        kinds, (F.col("host") == F.col("h3")) & (F.col("template") == F.col("t3")) & (F.col("x") == F.col("x3")))
    return joined.select("pid", "template", "bad_share")


def judge(pages: DataFrame, rules: list[tuple[str, str]], bad: Column | None = None, limit: float = LIMIT,
          carry: list[str] | None = None) -> DataFrame:
    """Columns of ``pages`` (or ``carry``) with host, path, rule, verdict,
    template and bad_share.  ``bad``: 1, 0 or null per page."""
    added = {"host", "path", "rule", "verdict", "template", "bad_share"}
    names = [c for c in (carry if carry is not None else pages.columns) if c not in added]
    host, path = host_and_path(F.col("url"))
    rows = pages.select(*[F.col(c).alias(f"in_{c}") for c in names], host.alias("host"), path.alias("path"),
                        (F.lit(None).cast("int") if bad is None else bad).alias("bad"))
    rows = store(rows, "url-rows")
    judged = store(purity(templates(rows)), "url-purity").select(
        F.col("pid").alias("pid4"), F.hash("pid").alias("x4"), "template", "bad_share")
    rows = rows.withColumn("pid", F.xxhash64("host", segments(F.col("path"))))
    out = rows.join(judged, (F.col("pid") == F.col("pid4")) & (F.hash("pid") == F.col("x4")))
    ruled = out.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("r.verdict", F.when(F.col("bad_share") >= limit, "block").otherwise("allow"))
    return ruled.select(*[F.col(f"in_{c}").alias(c) for c in names], "host", "path", F.col("r.rule").alias("rule"),
                        verdict.alias("verdict"), "template", "bad_share")
