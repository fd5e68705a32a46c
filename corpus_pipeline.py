"""The corpus pipeline: filter, deduplicate, decontaminate, redact and mix the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskweave.llm import decontaminate, pii_crf, quality, simhash, source_mix
from deskweave.llm.common import stored, table

ORACLE_SQL = None  # the classifier, the fingerprints and the tagger are beyond SQL


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (operator 7)."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by operator 1 or beside it, verified at 0.8 similarity
    of five-word shingles."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (operator 5)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked in the text (operator 8); n_chars follows."""
    masked = pii_crf.mask(docs, pii_crf.train(pii_crf.labelled_table(docs)))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their targets (operator 10)."""
    return source_mix.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is written and read again as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
