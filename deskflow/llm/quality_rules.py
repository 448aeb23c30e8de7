"""Quality rules: plain counts, and robust multivariate outliers.

For each language and source a minimum-covariance-determinant estimate of a
vector of transformed counts is fitted, and a text is rejected when its
Mahalanobis distance from that estimate is too large.  Everything is
DataFrame work: the counts are expressions over one text; each
concentration step is one set of sums and one cut per group.  Cuts and
medians come from bucket counts, narrowed to the bucket that holds the rank:
they combine before any shuffle, are spread over tasks by bucket, and do not
depend on the order of merging, however many rows a group has.

Defined results: a null or empty text has no words and fails the base rule.
Null languages and sources are groups of their own.  A group with fewer than
``min_group`` fitted rows is judged by its language's estimate; when that is
too small as well, the base rule alone decides.  Repeated rows are judged
alike, and equal distances fall on the same side of every cut.  Other
columns are carried under their own names; an input column that has the
name of an added one is left out, unless that one is given another name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, store
from .textstats import count_struct

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = ("x1", "x2", "x3", "x4")
# Smallest spread that counts for each coordinate (keeps groups whose
# texts all agree in one coordinate from rejecting the least deviation).
FLOOR = (0.15, 0.05, 0.05, 0.15)
# Fixed values for four coordinates: the factor that makes the covariance of
# the inner half consistent at the normal, the 97.5 % and the 99.9999 %
# quantile of chi-square.  Half is the most that outliers (a third of the
# rows may be copies of one text) cannot reach into.
INNER, CONSISTENCY, REWEIGHT, CUTOFF = 0.5, 2.109, 11.14, 33.4
# Buckets of a cut, and how often they are narrowed.
BUCKETS, ROUNDS = 512, 2
# Estimates (of about 200 bytes) that may be broadcast: some 20 MB.
MAX_BROADCAST = 100_000


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector_of_counts() -> list[Column]:
    """Mean word length, symbols a word, repeated lines and repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        (F.col("word_chars") / n).alias("x1"), F.log1p(F.col("n_symbols") / n).alias("x2"),
        F.sqrt(F.col("n_dup_lines") / n).alias("x3"), F.sqrt(F.col("n_repeat_words") / n).alias("x4"),
    ]


def _cell(i: int, j: int) -> str:
    return f"c{max(i, j)}{min(i, j)}"


def _moments(d: int, weight: Column | None = None) -> list[Column]:
    """Means and centred cross products from sums of about-centred values.
    Values are taken relative to the centre ``m*`` the rows were joined to."""
    def kept(v: Column) -> Column:
        return v if weight is None else F.when(weight, v)

    dev = [F.col(VECTOR[i]) - F.col(f"m{i}") for i in range(d)]
    out = [F.count(kept(F.lit(1))).alias("n")]
    out += [F.sum(kept(dev[i])).alias(f"s{i}") for i in range(d)]
    out += [F.sum(kept(dev[i] * dev[j])).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)]
    return out + [F.any_value(f"m{i}").alias(f"m{i}") for i in range(d)]


def _from_moments(df: DataFrame, keys: list[str], d: int, factor: float) -> DataFrame:
    """Centre, covariance (times ``factor``, plus the floor) and its Cholesky
    factor, written out column by column."""
    n = F.greatest(F.col("n"), F.lit(1)).cast("double")
    df = df.select(*keys, "n", *[F.coalesce(F.col(f"s{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(d)],
                   *[F.coalesce(F.col(f"s{i}{j}"), F.lit(0.0)).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)],
                   *[f"m{i}" for i in range(d)])
    cov = {_cell(i, j): ((F.col(f"s{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}") / n) / n * factor
                         + (FLOOR[i] ** 2 if i == j else 0.0)) for i in range(d) for j in range(i + 1)}
    df = df.select(*keys, "n", *[(F.col(f"m{i}") + F.col(f"s{i}") / n).alias(f"m{i}") for i in range(d)],
                   *[c.alias(k) for k, c in cov.items()])
    return _factored(df, d)


def _factored(df: DataFrame, d: int) -> DataFrame:
    """Adds l<i><j> with L L' = covariance, and its log determinant."""
    for i in range(d):
        for j in range(i + 1):
            rest = F.col(_cell(i, j)) - reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = reduce(lambda a, b: a + b, [2 * F.log(F.col(f"l{i}{i}")) for i in range(d)])
    return df.withColumn("logdet", logdet)


def _distance(d: int) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i in range(d):
        rest = F.col(VECTOR[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return F.round(reduce(lambda a, b: a + b, [v * v for v in z]), 6)


def _columns(d: int, *extra: str) -> list[str]:
    return [*extra, *[f"m{i}" for i in range(d)], *[f"l{i}{j}" for i in range(d) for j in range(i + 1)]]


def _small(estimates: DataFrame, rows: int = MAX_BROADCAST) -> DataFrame:
    """``estimates`` (stored, one or two short rows a group), to be sent to
    every task when counted to be at most ``rows``; beyond that the size
    threshold and skew splitting decide the join."""
    return F.broadcast(estimates) if estimates.limit(rows + 1).count() <= rows else estimates


def _bucket(y: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi > lo, F.least(F.floor((y - lo) / (hi - lo) * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0).cast("int")


def _sent(estimates: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(estimates) if few else estimates


def lower_quantiles(rows: DataFrame, keys: list[str], values: list[Column], q: float, few: bool = False) -> DataFrame:
    """``keys``, n and q0, q1, ...: the value of rank ceil(q n) of each of the
    ``values`` (not negative) in a group, or one within a
    ``BUCKETS``-to-the-``ROUNDS``th part of the range of log1p.  ``few``: the
    groups have been counted to be few enough to broadcast.

    The state of a round is a row for each group and value: its least and
    greatest value that can be the one, and how many are below."""
    y = F.array(*[F.struct(F.lit(i).alias("v"), F.log1p(x).alias("y")) for i, x in enumerate(values)])
    long, at = rows.select(*keys, F.inline(y)), [*keys, "v"]
    state = long.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"))
    state = state.withColumn("below", F.lit(0).cast("bigint"))
    for turn in range(ROUNDS):
        state = store(state, "quantile-range") if turn else state
        counted = long.join(_sent(state, few), at).where(F.col("y").between(F.col("lo"), F.col("hi"))).groupBy(
            *at, "n", "below", _bucket(F.col("y"), F.col("lo"), F.col("hi")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("m"), F.min("y").alias("lo"), F.max("y").alias("hi"))
        upto = F.col("below") + F.sum("m").over(Window.partitionBy(*at).orderBy("bucket"))  # BUCKETS rows at most
        rank = F.ceil(F.col("n") * q)
        here = counted.withColumn("upto", upto).where((F.col("upto") >= rank) & (F.col("upto") - F.col("m") < rank))
        state = here.select(*at, "n", "lo", "hi", (F.col("upto") - F.col("m")).alias("below"))
    pick = [F.max(F.when(F.col("v") == i, F.expm1("lo"))).alias(f"q{i}") for i in range(len(values))]
    return state.groupBy(*keys).agg(F.max("n").alias("n"), *pick)


def mcd(rows: DataFrame, key: str, steps: int = 2) -> DataFrame:
    """One row per group: centre ``m*`` and Cholesky factor ``l**`` of the
    minimum-covariance-determinant estimate, and the fitted rows ``n``.

    Deterministic starts (median with median absolute deviations; classical
    mean and covariance), ``steps`` concentration steps each, the start with
    the smaller determinant, then one reweighting step.  ``rows`` holds
    ``key`` and the vector; it is read ``ROUNDS`` + 2 times per step."""
    d = len(VECTOR)
    most = MAX_BROADCAST // (2 * d)
    few = rows.select(key).distinct().limit(most + 1).count() <= most
    med = lower_quantiles(rows, [key], [F.col(v) for v in VECTOR], 0.5, few)
    med = store(med.select(key, *[F.col(f"q{i}").alias(f"m{i}") for i in range(d)]), "mcd-median")
    near = rows.join(_sent(med, few), key)
    mad = lower_quantiles(near, [key], [F.abs(F.col(VECTOR[i]) - F.col(f"m{i}")) for i in range(d)], 0.5, few)
    mad = mad.select(key, *[F.col(f"q{i}").alias(f"mad{i}") for i in range(d)])
    first = store(near.groupBy(key).agg(*_moments(d)).join(mad, key), "mcd-start")
    spread = first.select(key, F.lit(0).alias("start"), "n", *[f"m{i}" for i in range(d)], *[
        (F.pow(1.4826 * F.col(f"mad{i}"), 2) + FLOOR[i] ** 2 if i == j else F.lit(0.0)).alias(_cell(i, j))
        for i in range(d) for j in range(i + 1)])
    state = _factored(spread, d).unionByName(
        _from_moments(first.withColumn("start", F.lit(1)), [key, "start"], d, 1.0))
    keys = [key, "start"]
    for step in range(steps):
        state = store(state.select(*keys, *_columns(d, "logdet")), "mcd-state")
        cut = lower_quantiles(rows.join(_sent(state, few), key), keys, [_distance(d)], INNER, few)
        # The bucket's least value is a little low where it holds others.
        inner = store(state.join(cut.select(*keys, (F.col("q0") * (1 + 1e-9)).alias("cut")), keys), "mcd-cut")
        sums = rows.join(_sent(inner, few), key).groupBy(*keys).agg(*_moments(d, _distance(d) <= F.col("cut")))
        state = _from_moments(sums, keys, d, CONSISTENCY)
    state = store(state.select(*keys, *_columns(d, "logdet")), "mcd-state")
    best = state.groupBy(key).agg(F.min_by(F.struct(*_columns(d)), F.struct("logdet", "start")).alias("b")).select(key, "b.*")
    best = store(best, "mcd-best")
    sums = rows.join(_sent(best, few), key).groupBy(key).agg(*_moments(d, _distance(d) <= REWEIGHT), F.count(F.lit(1)).alias("n_rows"))
    final = _from_moments(sums, [key, "n_rows"], d, 1.0)
    return store(final.select(key, F.col("n_rows").alias("n_fitted"), *_columns(d)), "mcd-final")


def _group(level: str) -> Column:
    cols = [F.lit(level), F.col("lang").isNull(), F.coalesce("lang", F.lit(""))]
    if level == "source":
        cols += [F.col("source").isNull(), F.coalesce("source", F.lit(""))]
    return F.xxhash64(*cols)


ADDED = (*COUNTS, "base_failed", "distance", "kept")


def quality_rules(docs: DataFrame, carry: list[str] | None = None, min_group: int = 50,
                  cutoff: float = CUTOFF, named: dict[str, str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or those in ``carry``) with the counts,
    ``base_failed``, ``distance`` (null without an estimate) and ``kept``,
    each under its own name or the one that ``named`` gives it.

    ``docs`` needs text, lang and source."""
    names, told = carried(docs, carry, ADDED, named)
    counted = docs.select(*[F.col(c).alias(f"in_{c}") for c in names], "lang", "source", count_struct(F.col("text")).alias("s"))
    counted = counted.select(*[f"in_{c}" for c in names], "lang", "source", "s.*")
    counted = counted.select("*", *vector_of_counts(), base_failed().alias("base_failed"),
                             _group("source").alias("g"), _group("lang").alias("g_lang"))
    counted = store(counted.drop("lang", "source"), "quality-counts")
    fit = counted.where(~F.col("base_failed"))
    rows = fit.select(F.explode(F.array("g", "g_lang")).alias("g"), *VECTOR)
    estimates = _small(mcd(rows, "g")).where(F.col("n_fitted") >= min_group)
    d = len(VECTOR)
    own = estimates.select("g", F.struct(*_columns(d)).alias("own"))
    by_lang = estimates.select(F.col("g").alias("g_lang"), F.struct(*_columns(d)).alias("wide"))
    judged = counted.join(own, "g", "left").join(by_lang, "g_lang", "left")
    judged = judged.withColumn("e", F.coalesce("own", "wide")).select("*", "e.*").withColumn("distance", _distance(d))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    judged = judged.withColumn("kept", kept)
    return judged.select(*[F.col(f"in_{c}").alias(c) for c in names], *[F.col(c).alias(told[c]) for c in ADDED])
