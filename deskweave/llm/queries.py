"""Registered queries of the numbered operators; each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_stream,
    collocations,
    decontaminate,
    digest,
    mixing_lm,
    pii_crf,
    quality,
    simhash,
    source_mix,
    token_counts,
    url_filter,
    warc,
    whitening,
)
from .common import fresh_dir, table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    _REGISTRY[query.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


@register
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@register
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("hits", "key")


@register
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.html_links(pages))


@register
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_mix.with_copies(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@register
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_crf.detect(docs, pii_crf.train(pii_crf.labelled_table(docs)))


@register
def op2_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.neighbour_report(table(spark, sf_dir, "documents"))


@register
def op9_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_lm.score(table(spark, sf_dir, "documents"))


@register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; then, twice, the batch that `labels` names: documents of quality 0
    are deleted, toxic ones lose their words with digits and move to a source of their own.

    The texts meet the labels in one exchange at every size; hashing the labels, one narrow row
    per id, spares sorting whole texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counters = {"words": token_counts.count_words, token_counts.BPE_NAME: token_counts.count_bpe()}
    rollup = token_counts.Rollup(spark, fresh_dir(spark, "token-counts"), counters)
    rollup.commit(1, docs.withColumn("deleted", F.lit(False)))
    named = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        (F.min("quality") == 0).alias("deleted"), (F.max("toxic") == 1).alias("toxic")
    )
    changes = docs.join(named.where("deleted OR toxic").hint("shuffle_hash"), "doc_id").select(
        "doc_id",
        F.concat("source", F.lit(" toxic")).alias("source"),
        "lang",
        F.regexp_replace("text", r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "").alias("text"),
        "deleted",
    )
    rollup.commit(2, changes)
    rollup.commit(2, changes)  # delivered again, changes nothing
    return rollup.totals()


def word_bpe() -> str:
    """The public word-end vocabulary of operator 11."""
    import public_tokenizers

    return bpe_stream.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@register
def op11_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = word_bpe()
    encoded = bpe_stream.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), definition)
    decoded = bpe_stream.decode(encoded.drop("text"), definition, form="tokens")
    return decoded.select("doc_id", *bpe_stream.digests())


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
