"""A corpus pipeline: documents in, a training mix out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns the columns of its input, whatever their names; the last
one adds the place of every copy in the mix.  ``run`` writes each stage's
rows as Parquet under the shared checkpoint folder and reads them back for
the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskflow.llm import mixing, quality_rules, secrets
from deskflow.llm.common import documents, fresh, fresh_names, let, scratch, store
from deskflow.llm.decontaminate import decontaminated
from deskflow.llm.simhash import one_per_class


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: null and empty texts go."""
    own = fresh_names(docs, quality_rules.ADDED)
    return quality_rules.quality_rules(docs, named=own).where(F.col(own["kept"])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: that with the smallest doc_id, a
    null one only where there is no other."""
    return one_per_class(docs, shingle=3, max_bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark item; null texts stay."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span that the secret scan finds masked; ``n_chars``
    of a masked text is counted again, that of others and null texts stay."""
    own = fresh_names(docs, secrets.ADDED)
    scanned = secrets.secret_scan(docs, named=own)
    masked = let(secrets.redacted(F.col("text"), F.col(own["spans"])), lambda t: F.struct(t.alias("text"), F.length(t).cast("long").alias("n")))
    scanned = scanned.select(*docs.columns, masked.alias(m := fresh(docs, "masked")), F.size(own["spans"]).alias(k := fresh(docs, "found")))
    changed = {"text": F.col(f"{m}.text"), "n_chars": F.when(F.col(k) > 0, F.col(f"{m}.n")).otherwise(F.col("n_chars"))}
    return scanned.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; small sources up to twice.  The place of
    a copy is added under names that the documents do not have."""
    return mixing.temperature_mix(docs, max_repeats=2.0, named=fresh_names(docs, mixing.ADDED))


STAGES = [("quality_rules", quality), ("simhash", near_duplicates), ("decontamination", benchmark),
          ("secrets", masked_secrets), ("mixing", mix)]

# The robust estimates, the character models and the fingerprints have no
# plain SQL form; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents.  Of a stage, only its rows are kept in the
    shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
