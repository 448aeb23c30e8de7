"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .classifier import fit, scores
from .common import crc_fold, documents
from .decontaminate import contaminated
from .filter_audit import filter_audit
from .langid import learn_and_identify, sample_texts
from .mixing import temperature_mix
from .neighbours import nearest
from .quality_rules import COUNTS, quality_rules
from .secrets import secret_scan, span_text
from .simhash import simhash_classes
from .spelling import spelling_groups
from .sql import ORACLES  # noqa: F401 - registered beside the queries
from .tokens import token_counts
from .urls import judge
from .warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]


# Parameters of the queries.
TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = labels.where(crc_fold(F.col("doc_id"), 5) != 0)
    forest = fit(docs.where(crc_fold(F.col("doc_id"), 5) != 0), seen, "quality")
    scored = scores(docs, forest, [F.col("doc_id"), (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out")])
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: the number that ends a url's path names the document the page
    shows; a page is bad when that document is labelled toxic or of low
    quality."""
    pages, labels = spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("label_bad"))
    shown = F.regexp_extract("url", r"^[^?#]*/([0-9]{1,18})(\.html?)?/?([?#]|$)", 1)
    pages = pages.select("page_id", "url", F.nullif(shown, F.lit("")).cast("bigint").alias("shown_id"))
    labelled = pages.join(bad, F.col("shown_id") == F.col("label_id"), "left")
    return judge(labelled, URL_RULES, F.col("label_bad"), carry=["page_id"])


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    texts = sample_texts(docs.where(crc_fold(F.col("doc_id"), 3) != 1).select("lang", "text"))
    keyed = docs.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return learn_and_identify(keyed, texts, ["doc_id", "held_out"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    back = read_archives(spark, path, payload="false")

    def page(name: str) -> Column:
        number = F.regexp_extract(name, r"^urn:x-page:(-?[0-9]+)$", 1)
        return F.nullif(F.coalesce(number, F.lit("")), F.lit("")).cast("bigint")

    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page("refers_to_id").alias("refers_to"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), limit=1024)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(documents(spark, sf_dir), shingle=3, max_bits=2)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(documents(spark, sf_dir), carry=["doc_id"])

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(("assign", "access", "hex"))]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(documents(spark, sf_dir), carry=["doc_id"])
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix(documents(spark, sf_dir), carry=["doc_id", "source"], max_repeats=2.0)


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, k=20)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(documents(spark, sf_dir), every=97, least=5, seen=3, ratio=2)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_classifier, op2_decontamination, op3_url_filter, op4_language, op5_simhash, op6_warc, op7_secrets,
    op8_quality_rules, op9_token_counts, op10_mixing, op11_neighbours, op12_filter_audit,
    op13_spelling)}
