import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskweave.operators import browse
from deskweave.operators.corpus import Corpus, latest_per_key, merge_versions
from deskweave.operators.schema import (
    UPDATED,
    corpus_schema,
    describe_schema,
    evolved_schema,
    flagged,
)

SHAPE = f"id string, title string, note string, {UPDATED} timestamp_ntz"
SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField(UPDATED, T.TimestampNTZType()),
    ]
)


def rows(spark, *data, columns=("id", "title", "note", UPDATED)):
    shape = ", ".join(f"{c} string" for c in columns)
    made = spark.createDataFrame(list(data), shape)
    if UPDATED in columns:
        made = made.withColumn(UPDATED, F.col(UPDATED).try_cast("timestamp_ntz"))
    return made


def content(df):
    return sorted((r["id"], r["title"], r["note"]) for r in df.collect())


D1, D2, D3 = (f"2024-01-0{d} 00:00:00" for d in (1, 2, 3))


def test_latest_per_key(spark):
    many = rows(
        spark,
        ("a", "old", "", D1),
        ("a", "new", "", D3),
        ("a", "mid", "", D2),
        ("a", "undated", "", None),
        ("b", "only", "", None),
    )
    got = latest_per_key(many)
    assert content(got) == [("a", "new", ""), ("b", "only", "")]
    # a hot key is cut down before the shuffle
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_merge_decides_by_version(spark):
    old = rows(
        spark,
        ("same", "o", "o", D2),
        ("older", "o", "o", D2),
        ("newer", "o", "o", D2),
        ("undated new", "o", "o", D2),
        ("undated old", "o", "o", None),
        ("only old", "o", "o", D1),
    )
    new = rows(
        spark,
        ("same", "n", None, D2),
        ("older", "n", "n", D1),
        ("newer", "n", None, D3),
        ("undated new", "n", "n", None),
        ("undated old", "n", "n", None),
        ("only new", "n", "n", None),
    )
    expected = sorted(
        [
            ("same", "n", None),
            ("older", "o", "o"),
            ("newer", "n", None),
            ("undated new", "o", "o"),
            ("undated old", "n", "n"),
            ("only old", "o", "o"),
            ("only new", "n", "n"),
        ]
    )
    key = lambda t: t[0]
    assert sorted(content_any(merge_versions(old, new)), key=key) == sorted(expected, key=key)


def content_any(df):
    return [(r["id"], r["title"], r["note"]) for r in df.collect()]


def test_only_supplied_columns_are_merged(spark):
    old = rows(spark, ("a", "t", "keep", D1))
    new = rows(spark, ("a", None, D2), ("b", "x", D2), columns=("id", "title", UPDATED))
    assert sorted(content_any(merge_versions(old, new))) == [("a", None, "keep"), ("b", "x", None)]


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_upserts_in_sequence(spark, tmp_path, buckets):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA, buckets=buckets)
    first = rows(spark, *[(k, "1", k, D1) for k in "abcdef"])
    assert table.upsert(first) == 6
    assert table.upsert(rows(spark, ("a", "2", None, D2), ("z", "2", "z", D2))) == 2
    assert table.upsert(rows(spark, ("a", "late", "x", D1), ("b", "3", "b", D3), ("b", "2", "b", D2))) == 2
    assert table.upsert(rows(spark, ("b", "4", D3), columns=("id", "title", UPDATED))) == 1
    expected = [
        ("a", "2", None), ("b", "4", "b"), ("c", "1", "c"), ("d", "1", "d"),
        ("e", "1", "e"), ("f", "1", "f"), ("z", "2", "z"),
    ]
    assert sorted(content_any(table.read())) == expected


def test_untouched_buckets_stay(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA, buckets=8)
    table.upsert(rows(spark, *[(k, "1", k, D1) for k in "abcdefghijkl"]))
    before = set(table.read().inputFiles())
    table.upsert(rows(spark, ("a", "2", "", D2)))
    after = set(table.read().inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1
    assert table.read().count() == 12
    for day in range(10, 16):
        table.upsert(rows(spark, ("a", str(day), "", f"2024-01-{day} 00:00:00")))
    kept = sorted(int(p.name) for p in (tmp_path / "c" / "pointer").iterdir())
    assert len(kept) == 3 and not list((tmp_path / "c" / "staged").iterdir())
    assert table.read().count() == 12


def test_upsert_twice_is_upsert_once(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA)
    batch = rows(spark, ("a", "1", "", D1), ("b", "1", "", None))
    for _ in range(3):
        table.upsert(batch)
    assert content(table.read()) == [("a", "1", ""), ("b", "1", "")]


def test_replayed_batch_is_skipped(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA)
    assert table.upsert(rows(spark, ("a", "1", "", D1)), ("q", 0)) == 1
    assert table.upsert(rows(spark, ("a", "2", "", D2)), ("q", 0)) == 0
    assert content(table.read()) == [("a", "1", "")]
    assert table.upsert(rows(spark, ("a", "3", "", D2)), ("another", 0)) == 1
    table.recreate(confirmed=True)
    assert table.upsert(rows(spark, ("a", "4", "", D1)), ("q", 0)) == 1
    assert content(table.read()) == [("a", "4", "")]


def test_unfinished_write_stays_invisible(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA)
    table.upsert(rows(spark, ("a", "1", "", D1)))
    # a writer that died before it moved the pointer
    rows(spark, ("a", "half", "", D3)).write.parquet(str(tmp_path / "c" / "data" / "2" / "_bucket=0"))
    assert content(table.read()) == [("a", "1", "")]
    table.upsert(rows(spark, ("a", "2", "", D2)))
    assert content(table.read()) == [("a", "2", "")]


def test_ensure_recreate(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.ensure()
    assert table.read().count() == 0 and table.read().columns == SCHEMA.names
    table.upsert(rows(spark, ("a", "1", "", D1)))
    table.ensure()
    assert table.read().count() == 1
    with pytest.raises(ValueError):
        table.recreate()
    table.recreate(confirmed=True)
    assert table.read().count() == 0


def test_empty_upsert(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA)
    none = rows(spark, ("a", "1", "", D1)).where("false")
    assert table.upsert(none) == 0
    assert table.upsert(rows(spark, ("a", "1", "", D1))) == 1
    assert table.upsert(none) == 0
    assert content(table.read()) == [("a", "1", "")]


def test_schema_grows(spark, tmp_path):
    small = T.StructType([f for f in SCHEMA.fields if f.name != "note"])
    table = Corpus(spark, str(tmp_path / "c"), small)
    table.upsert(rows(spark, ("a", "1", D1), ("b", "1", D1), columns=("id", "title", UPDATED)))
    table.evolve(SCHEMA)
    assert sorted(content_any(table.read())) == [("a", "1", None), ("b", "1", None)]
    table.upsert(rows(spark, ("a", "2", "n", D2)))
    assert sorted(content_any(table.read()), key=lambda t: t[0]) == [("a", "2", "n"), ("b", "1", None)]
    with pytest.raises(ValueError):
        table.evolve(small)
    with pytest.raises(ValueError):
        evolved_schema(SCHEMA, T.StructType([T.StructField(f.name, T.LongType()) for f in SCHEMA]))


# --- schema -----------------------------------------------------------------


def test_corpus_schema_flags(spark):
    schema = corpus_schema(3072)
    shown = [f.name for f in schema.fields if not f.name.startswith("_")]
    assert len(shown) == 16 and "cmdb_ci" not in shown
    assert flagged(schema, "key") == ["id"]
    assert schema["contentVector"].metadata["dimensions"] == 3072
    hidden = {"description", "resolution", "work_notes", "comments", "contentVector"}
    assert set(shown) - set(flagged(schema, "retrievable")) == hidden
    assert flagged(schema, "facetable") == ["assignment_group_name", "priority", "impact", "urgency"]
    assert flagged(schema, "sortable") == ["number", "closed_at"]
    assert T.StructType.fromJson(schema.jsonValue()) == schema
    table = {r["name"]: r for r in describe_schema(spark, schema).collect()}
    assert len(table) == 16 and table["id"]["key"] and table["url"]["retrievable"]
    assert table["contentVector"]["type"] == "array<float>"


@pytest.fixture
def documents(spark):
    data = [("a", "1 - High", "HD x", "t1"), ("b", "1 - High", "HD y", "t2"), ("c", "2 - Low", "HD x", "t3")]
    return spark.createDataFrame(
        data, "id string, urgency string, assignment_group_name string, description string"
    )


def test_browse(documents):
    assert browse.visible(documents).columns == ["id", "urgency", "assignment_group_name"]
    assert browse.count_documents(documents).first()[0] == 3
    assert browse.get_document(documents, "b")["urgency"] == "1 - High"
    with pytest.raises(KeyError):
        browse.get_document(documents, "nope")
    got = browse.facets(documents, ["urgency", "assignment_group_name"]).collect()
    assert sorted(map(tuple, got)) == [
        ("assignment_group_name", "HD x", 2),
        ("assignment_group_name", "HD y", 1),
        ("urgency", "1 - High", 2),
        ("urgency", "2 - Low", 1),
    ]


def test_flags_decide_what_can_be_filtered_and_sorted(documents):
    found = browse.select_sorted(documents, {"urgency": ["1 - High"]})
    assert sorted(r["id"] for r in found.collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        browse.select_sorted(documents, {"description": ["t1"]})
    with pytest.raises(ValueError):
        browse.select_sorted(documents, sort=[("urgency", False)])


# --- large corpora: versions are brought together by readers ----------------


@pytest.mark.parametrize("buckets", [1, 3])
def test_added_versions_read_as_merged(spark, tmp_path, buckets):
    """The same batches, merged at once and added, give the same rows; small batches do not write
    all rows again."""
    batches = [
        [(k, "1", k, D2) for k in "abcdef"] + [("u", "1", "u", None)],
        [("a", "2", None, D3), ("b", "late", "x", D1), ("c", "same", "c", D2), ("d", "2", "d", None)],
        [("u", "2", None, None), ("z", "1", "z", D1), ("a", "late", "a", D2)],
        *[[("z", str(n), "z", f"2024-02-{n:02d} 00:00:00")] for n in range(1, 13)],
    ]
    both = [Corpus(spark, str(tmp_path / str(b)), SCHEMA, buckets, merge_below=b) for b in (0, 1 << 30)]
    for batch in batches:
        counts = {table.upsert(rows(spark, *batch)) for table in both}
        assert len(counts) == 1
        assert content_any_sorted(both[0].read()) == content_any_sorted(both[1].read())
    # rows of other folders are left alone, and folders are put together now and then
    folders = {f.rsplit("/data/")[1].split("/")[0] for f in both[0].read().inputFiles()}
    assert 2 < len(folders) < len(batches)
    by_row = both[0].read("id", F.length("title").alias("n"))
    assert by_row.columns == ["id", "n"] and by_row.count() == 8
    # supplied columns that do not cover what is known are merged at once
    for table in both:
        assert table.upsert(rows(spark, ("b", "9", D3), columns=("id", "title", UPDATED))) == 1
    assert content_any_sorted(both[0].read()) == content_any_sorted(both[1].read())
    assert ("b", "9", "b") in content_any_sorted(both[0].read())


def content_any_sorted(df):
    return sorted(content_any(df), key=lambda t: t[0])


def test_an_upsert_deals_rows_once(spark, tmp_path):
    """Rows that are one per key are written where they are; to a large corpus nothing else is."""
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA, merge_below=0)
    table.upsert(rows(spark, *[(k, "1", k, D1) for k in "abcdef"]))
    before = set(table.read().inputFiles())
    table.upsert(rows(spark, ("a", "2", "", D2)), unique=True)
    after = set(table.read().inputFiles())
    assert before < after and len(after - before) == 1


def test_whole_rows_of_several_folders_are_not_exchanged(spark, tmp_path):
    table = Corpus(spark, str(tmp_path / "c"), SCHEMA, 2, merge_below=0)
    table.upsert(rows(spark, ("a", "1", "n", D1), ("b", "1", "n", D2), ("c", "1", "n", None), ("d", "1", "n", D1)))
    table.upsert(rows(spark, ("a", "2", "n", D2), ("b", "2", "n", D1), ("c", "2", "n", None), ("e", "2", "n", D1)))
    got = table.read_buckets([0, 1])
    assert content(got) == [("a", "2", "n"), ("b", "1", "n"), ("c", "2", "n"), ("d", "1", "n"), ("e", "2", "n")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert content(table.read("id", "title", "note")) == content(got)
