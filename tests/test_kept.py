"""Kept counts, facets and profiles against a recount of the whole corpus."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskweave.operators import browse, profile
from deskweave.operators.corpus import Corpus
from deskweave.operators.kept import KeptSummary
from deskweave.operators.schema import UPDATED
from deskweave.sources.space import path_exists

SHAPE = f"id string, title string, kind string, {UPDATED} timestamp_ntz"
FIELDS, FACETS = ["id", "title", "absent"], ["kind"]


def made(spark, rows):
    plain = SHAPE.replace("timestamp_ntz", "string")
    return spark.createDataFrame(rows, plain).withColumn(UPDATED, F.col(UPDATED).cast("timestamp_ntz"))


def corpus_at(spark, path):
    return Corpus(spark, str(path), T.StructType.fromDDL(SHAPE), buckets=8)


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def assert_equals_recount(summary, corpus):
    whole = corpus.read()
    assert summary.documents().first()["documents"] == whole.count()
    assert as_set(summary.facets()) == as_set(browse.facets(whole, FACETS))
    exact = profile.field_profile(whole, FIELDS)
    assert as_set(summary.profile().select(*exact.columns)) == as_set(exact)


def test_equals_a_recount_after_upserts(spark, tmp_path):
    rng = random.Random(4)
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    for run in range(4):
        rows = [
            (f"k{rng.randrange(60)}", rng.choice([None, "", "a\nb", "x" * rng.randrange(200)]),
             rng.choice(["p", "q", None]), rng.choice([None, day(run + 1), day(1)]))
            for _ in range(40)
        ]
        corpus.upsert(made(spark, rows))
        assert_equals_recount(summary, corpus)


def test_reads_touched_buckets_only(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    corpus.upsert(made(spark, [(f"k{i}", "t", "p", day(1)) for i in range(80)]))
    assert summary.refresh() == list(range(8))
    assert summary.refresh() == []
    before = corpus.bucket_versions()
    corpus.upsert(made(spark, [("k3", "new title", "q", day(2))]))
    touched = [b for b, v in corpus.bucket_versions().items() if v != before[b]]
    assert len(touched) == 1
    assert summary.refresh() == touched
    # rows of the other buckets are gone: the answers still hold
    expected = as_set(browse.facets(corpus.read(), FACETS))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{corpus.path}/data")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    assert as_set(summary.facets()) == expected
    assert summary.documents().first()["documents"] == 80


def test_unfinished_states_are_computed_again(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    corpus.upsert(made(spark, [(f"k{i}", "t", "p", day(1)) for i in range(20)]))
    summary.refresh()
    version = max(corpus.bucket_versions().values())
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{summary.path}/facets/{version}/_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, False)
    assert summary.refresh() == sorted(corpus.bucket_versions())
    assert_equals_recount(summary, corpus)


def test_old_states_go(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    for run in range(5):
        corpus.upsert(made(spark, [("k1", f"t{run}", "p", day(run + 1))]))
        summary.refresh()
    assert not path_exists(spark, f"{summary.path}/fields/1")
    assert_equals_recount(summary, corpus)


def test_empty_and_recreated(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    assert summary.refresh() == [] and summary.facets().count() == 0
    corpus.upsert(made(spark, [("a", "t", "p", day(1)), ("b", None, None, None)]))
    assert_equals_recount(summary, corpus)
    corpus.recreate(confirmed=True)
    assert summary.documents().first()["documents"] == 0 and summary.profile().count() == 0
    corpus.upsert(made(spark, [("a", "other", "q", day(1))]))
    assert_equals_recount(summary, corpus)


def test_field_added_later(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, [*FIELDS, "later"], FACETS)
    corpus.upsert(made(spark, [(f"k{i}", "t", "p", day(1)) for i in range(30)]))
    summary.refresh()
    corpus.evolve(T.StructType.fromDDL(f"{SHAPE}, later string"))
    corpus.upsert(made(spark, [("k1", "t", "p", day(2))]).withColumn("later", F.lit("x")))
    got = {r["field"]: r for r in summary.profile().collect()}
    assert (got["later"]["records"], got["later"]["present"], got["later"]["filled"]) == (30, 1, 1)
    assert got["absent"]["filled"] == 0 and got["absent"]["median_length"] is None


def test_sketches_are_near_the_exact_counts(spark, tmp_path):
    corpus = corpus_at(spark, tmp_path / "c")
    summary = KeptSummary(corpus, FIELDS, FACETS)
    for part in range(2):
        ids = spark.range(part * 2000, part * 2000 + 3000)
        titles = F.expr("repeat('y', cast(id % 501 as int))")
        corpus.upsert(ids.select(F.concat(F.lit("k"), "id").alias("id"), titles.alias("title"),
                                 F.lit("p").alias("kind"), F.lit(None).cast("timestamp_ntz").alias(UPDATED)))
    got = {r["field"]: r for r in summary.profile().collect()}
    assert got["id"]["records"] == 5000
    assert got["id"]["approx_values"] == pytest.approx(5000, rel=0.06)
    assert got["title"]["approx_values"] == pytest.approx(500, rel=0.06)
    assert got["title"]["median_length"] == pytest.approx(250, abs=12)
    assert got["absent"]["approx_values"] == 0


def test_needs_a_field_and_a_facet(spark, tmp_path):
    with pytest.raises(ValueError):
        KeptSummary(corpus_at(spark, tmp_path / "c"), [], FACETS)
