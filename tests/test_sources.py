import json

import pytest
from pyspark.sql import functions as F

from deskweave.operators import scope
from deskweave.operators.scope import Scope, in_scope
from deskweave.sources import lists, pages
from deskweave.sources.marks import MarkStore, later_mark
from deskweave.sources.space import shared_dir

RECORD = {
    "number": ("REQ40", "REQ40"),
    "short_description": ("Posta ferma", "Posta ferma"),
    "description": ("La casella non riceve", "La casella non riceve"),
    "close_notes": ("Nuova chiave, pwd = Tulipano9", "Nuova chiave, pwd = Tulipano9"),
    "work_notes": (
        "raw",
        "Sessione posta/Rovo55@mx2:993 sul relay",
    ),
    "comments": ("raw", "Di nuovo tutto a posto"),
    "sys_id": ("k77", "k77"),
    "assignment_group": ("g-mail", "HD Mail"),
    "priority": ("3", "3 - Moderate"),
    "impact": ("2", "2 - Some"),
    "urgency": ("1", "1 - Now"),
    "closed_at": ("2023-11-20 17:30:00", "20.11.2023, 18:30"),
    "sys_updated_on": ("2023-11-20 18:00:00", "local"),
    "state": ("7", "Closed"),
}


def record(**changes):
    made = {k: {"value": v, "display_value": d} for k, (v, d) in RECORD.items()}
    made.update(changes)
    return made


def land(folder, *bodies):
    for i, body in enumerate(bodies):
        (folder / f"page{i}.json").write_text(json.dumps(body, indent=1))
    return str(folder)


def numbers(rows):
    return sorted(r["number"] for r in rows.collect())


@pytest.fixture
def three_pages(tmp_path):
    def row(n, day):
        return record(number=n, sys_updated_on=f"2024-01-0{day} 00:00:00", sys_id=n)

    return land(
        tmp_path,
        {"result": [row("INC1", 1), row("INC2", 2)]},
        {"result": [row("INC3", 3)]},
        {"result": []},
        {"error": "no result"},
    )


def test_pages_are_unwrapped(spark, three_pages):
    flat = pages.flatten_cells(pages.read_pages(spark, three_pages))
    assert numbers(flat) == ["INC1", "INC2", "INC3"]
    assert [str(r[0]) for r in flat.select(F.max("updated_at")).collect()] == ["2024-01-03 00:00:00"]


def test_first_rows_follow_update_order(spark, three_pages):
    flat = pages.flatten_cells(pages.read_pages(spark, three_pages))
    assert numbers(scope.first_by_update(flat, 2)) == ["INC1", "INC2"]


def test_flat_record(spark, tmp_path):
    path = land(tmp_path, {"result": [record()]})
    row = pages.flatten_cells(pages.read_pages(spark, path)).first()
    assert row["number"] == "REQ40"
    assert (row["assignment_group"], row["assignment_group_name"]) == ("g-mail", "HD Mail")
    assert (row["priority"], row["closed_at"]) == ("3 - Moderate", "2023-11-20 17:30:00")
    assert (row["resolved_at"], row["cmdb_ci"]) == ("", "")


def test_landing_keeps_rows_and_prunes_by_day(spark, three_pages, tmp_path):
    out = str(tmp_path / "landed")
    pages.land_records(pages.flatten_cells(pages.read_pages(spark, three_pages)), out)
    landed = pages.read_landed(spark, out)
    assert numbers(landed) == ["INC1", "INC2", "INC3"]
    late = landed.where("updated_day >= date'2024-01-02'")
    assert numbers(late) == ["INC2", "INC3"]
    assert "PartitionFilters: [isnotnull(updated_day" in late._jdf.queryExecution().toString()


def test_delta_predicate_reaches_the_scan(spark, three_pages, tmp_path):
    out = str(tmp_path / "landed")
    pages.land_records(pages.flatten_cells(pages.read_pages(spark, three_pages)), out)
    chosen = in_scope(pages.read_landed(spark, out), Scope(), "2024-01-02 00:00:00", 15)
    plan = chosen._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(updated_at,2024-01-01T23:45)" in plan
    assert "In(state, [6,7])" in plan
    # days before the mark are not listed
    assert "PartitionFilters: [isnotnull(updated_day" in plan
    assert numbers(chosen) == ["INC2", "INC3"]


def test_landing_exchanges_nothing(spark, three_pages, tmp_path):
    """Records are written by the tasks that read them; `gather` puts days together."""
    flat = pages.flatten_cells(pages.read_pages(spark, three_pages)).repartition(3).localCheckpoint()
    tracker, stages = spark.sparkContext.statusTracker(), {}
    for gather in (False, True):
        group, out = f"landing-{gather}", str(tmp_path / f"landed-{gather}")
        spark.sparkContext.setJobGroup(group, "")
        pages.land_records(flat, out, **({"gather": True} if gather else {}))
        spark.sparkContext.setJobGroup("other", "")
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages[gather] = len({s for job in jobs for s in job.stageIds})
        assert numbers(pages.read_landed(spark, out)) == ["INC1", "INC2", "INC3"]
    assert stages[False] == 1 < stages[True]


def test_tickets_by_page_are_the_tickets_and_exchange_texts_once(spark):
    from conftest import SMALL

    from deskweave.plans import catalog, desk_tables

    plain = desk_tables.incidents(spark, SMALL)
    paged = desk_tables.incidents_by_page(spark, SMALL)
    assert paged.where(F.col("page") != F.floor(F.col("doc_id") / 200)).isEmpty()
    assert paged.drop("page").exceptAll(plain).isEmpty() and plain.exceptAll(paged.drop("page")).isEmpty()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.page_cells(spark, SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    nodes = [n for n in plan.split("\n\n") if ") Exchange\n" in n]
    assert nodes and sum("description#" in n for n in nodes) == 1


def test_other_table(spark, three_pages, tmp_path):
    out = str(tmp_path / "landed")
    pages.land_records(pages.flatten_cells(pages.read_pages(spark, three_pages)), out)
    got = pages.read_table(spark, out, F.col("number") > "INC1", ["number", "state"])
    assert got.columns == ["number", "state"] and numbers(got) == ["INC2", "INC3"]


# --- scope ------------------------------------------------------------------


@pytest.fixture
def tickets(spark):
    rows = [
        ("a", "6", "grp1", "ci1", "2024-03-01 10:15:00"),
        ("b", "7", "grp2", "ci1", "2024-03-01 10:30:00"),
        ("c", "7", "grp3", "ci1", "2024-03-01 10:30:00"),
        ("d", "2", "grp1", "ci1", "2024-03-01 10:30:00"),
        ("e", "6", "grp1", "ci9", "2024-03-01 10:14:59"),
        ("f", "6", "grp1", "ci1", None),
    ]
    schema = "number string, state string, assignment_group string, cmdb_ci string, t string"
    return spark.createDataFrame(rows, schema).withColumn(
        "updated_at", F.col("t").try_cast("timestamp_ntz")
    )


def test_scope_clauses(tickets):
    full = Scope(groups=["grp1", "grp2"], items=["ci1", "ci2"])
    assert numbers(in_scope(tickets, Scope())) == ["a", "b", "c", "e", "f"]
    assert numbers(in_scope(tickets, full)) == ["a", "b", "f"]
    assert numbers(in_scope(tickets, full, "2024-03-01 10:30:00")) == ["b"]
    assert numbers(in_scope(tickets, full, "2024-03-01 10:30:00", 15)) == ["a", "b"]
    assert numbers(in_scope(tickets, Scope(), "2024-03-01")) == ["a", "b", "c", "e"]


def test_scope_guards():
    with pytest.raises(ValueError):
        Scope(closed_states=())
    with pytest.raises(ValueError):
        Scope(groups=["g"]).require_filters()
    with pytest.raises(ValueError):
        Scope(items=["i"]).require_filters()
    assert Scope(groups=["g"], items=["i"]).require_filters().groups == ["g"]


def test_group_table(spark, tickets, tmp_path):
    path = tmp_path / "groups.txt"
    path.write_text("# comment\n#\nHD One    | grp1\n HD Two | grp2 \n\n")
    groups = lists.read_groups(spark, str(path))
    assert sorted(map(tuple, groups.collect())) == [("HD One", "grp1"), ("HD Two", "grp2")]
    chosen = scope.in_groups(tickets, groups)
    assert numbers(chosen) == ["a", "b", "d", "e", "f"]
    labels = scope.with_group_labels(tickets, groups).where("number in ('b', 'c')")
    assert sorted((r["number"], r["group_label"]) for r in labels.collect()) == [
        ("b", "HD Two"),
        ("c", None),
    ]


def test_find_groups(spark):
    rows = [("1", "B team", True), ("2", "A team", True), ("3", "A old", False), ("4", "C", True)]
    groups = spark.createDataFrame(rows, "sys_id string, name string, active boolean")

    def keys(df):
        return [r["sys_id"] for r in df.collect()]

    assert keys(scope.find_groups(groups, ["team", "A"])) == ["2", "1"]
    assert keys(scope.find_groups(groups, everything=True)) == ["2", "1", "4"]
    assert keys(scope.find_groups(groups, [])) == []


def test_evaluation_set(spark, tmp_path):
    path = tmp_path / "set.csv"
    path.write_text(
        '"# title, with comma"\n"#"\n"question","expectedResponse"\n'
        '"Perche\' \'X\'?","Risposta, con virgola"\n"Secondo\n""caso""","ok"\n'
    )
    got = lists.read_evaluation_set(spark, str(path)).collect()
    assert [tuple(r) for r in got] == [
        ("Perche' 'X'?", "Risposta, con virgola"),
        ('Secondo\n"caso"', "ok"),
    ]


# --- marks and space --------------------------------------------------------


def test_marks(spark, tmp_path):
    store = MarkStore(spark, str(tmp_path / "mark"))
    assert store.read() is None
    store.write("2024-03-01 10:30:00")
    store.write("2024-02-01 00:00:00")  # a mark may move back
    assert store.read() == "2024-02-01 00:00:00"


def test_mark_of_a_plain_file(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "watermark.json").write_text('{"watermark": "2026-06-06 19:05:44"}')
    store = MarkStore(spark, str(tmp_path / "state"))
    assert store.read() == "2026-06-06 19:05:44"
    store.write("2026-06-07 00:00:00")
    assert store.read() == "2026-06-07 00:00:00"


@pytest.mark.parametrize(
    "a, b, expected",
    [("10:00", "11:00", "11:00"), ("12:00", "11:00", "12:00"), (None, "11:00", "11:00"),
     ("11:00", None, "11:00"), (None, None, None)],
)
def test_later_mark(a, b, expected):
    day = "2024-03-01 "
    got = later_mark(a and day + a + ":00", b and day + b + ":00")
    assert got == (expected and day + expected + ":00")


def test_plans_start_no_job(spark, tickets):
    """Building joins and searches reads no data."""
    from deskweave.operators import search

    group = "plan-only"
    spark.sparkContext.setJobGroup(group, "")
    groups = tickets.select(F.col("assignment_group").alias("sys_id"), F.lit("n").alias("name"))
    scope.with_group_labels(scope.in_groups(tickets, groups), groups)
    docs = tickets.select(F.col("number").alias("id"), F.col("t").alias("content"))
    questions = tickets.select(F.lit(1).alias("qid"), F.col("t").alias("question"))
    search.rank_text(docs, questions, 2, ("content",))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0


def test_shared_folder_must_be_set(spark):
    assert shared_dir(spark)

    class Unset:
        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError):
        shared_dir(Unset)
