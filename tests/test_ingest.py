import shutil

import pytest
from pyspark.sql import functions as F

from deskweave.operators import masking
from deskweave.operators.corpus import Corpus
from deskweave.operators.documents import to_documents, with_content
from deskweave.operators.embedding import hash_embed
from deskweave.operators.schema import MASKED_OK, corpus_schema
from deskweave.operators.scope import Scope
from deskweave.plans.ingest import Options, run_ingest
from deskweave.sources.marks import MarkStore
from deskweave.sources.pages import RECORD_SCHEMA
from deskweave.sources.quarantine import Quarantine
from deskweave.streaming.ingest_stream import ingest_stream, stream_landed

BASE = "https://desk.example.com"


def tickets(spark, *changes):
    """Flat records; each change overrides the defaults of one ticket."""
    base = {
        "sys_id": "k77",
        "number": "REQ40",
        "short_description": "Posta ferma",
        "description": "La casella non riceve da ieri",
        "close_notes": "Nuova chiave, pwd = Tulipano9, consegnata",
        "work_notes": "Aperta la sessione posta/Rovo55@mx2:993 sul relay",
        "comments": "Di nuovo tutto a posto",
        "assignment_group": "g-mail",
        "assignment_group_name": "HD Mail",
        "priority": "3 - Moderate",
        "impact": "3 - Low",
        "urgency": "2 - Medium",
        "closed_at": "2023-11-20 17:30:00",
        "sys_updated_on": "2023-11-20 18:00:00",
        "state": "7",
    }
    rows = []
    for change in changes:
        row = {**base, **change}
        rows.append(tuple(row.get(f.name) for f in RECORD_SCHEMA.fields[:-1]))
    shape = ", ".join(f"{f.name} string" for f in RECORD_SCHEMA.fields[:-1])
    return spark.createDataFrame(rows, shape).withColumn(
        "updated_at", F.col("sys_updated_on").try_cast("timestamp_ntz")
    )


def ticket(number, updated, **more):
    return {"number": number, "sys_id": number.lower(), "sys_updated_on": updated, **more}


@pytest.fixture
def home(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "corpus"), corpus_schema(16))
    return corpus, MarkStore(spark, str(tmp_path / "mark"))


def keys(corpus):
    return sorted(r["id"] for r in corpus.read().select("id").collect())


# --- documents --------------------------------------------------------------


def test_document_of_the_fixture(spark):
    row = to_documents(tickets(spark, {}), BASE).first()
    assert (row["id"], row["number"]) == ("REQ40", "REQ40")
    assert row["assignment_group_name"] == "HD Mail" and row["priority"] == "3 - Moderate"
    assert str(row["closed_at"]) == "2023-11-20 17:30:00"
    assert "Tulipano9" not in row["content"] + row["resolution"]
    assert "Rovo55" not in row["content"] + row["work_notes"] and "posta/" in row["work_notes"]
    assert row["content"].startswith("Ticket REQ40 | Gruppo: HD Mail | Chiuso: 2023-11-20 |")
    assert row["url"].endswith("sys_id=k77") and row["url"] in row["content"]


def test_no_link_without_base(spark):
    row = to_documents(tickets(spark, {})).first()
    assert row["url"] == "" and "Link:" not in row["content"]


def test_texts_are_cut_only_when_asked(spark):
    long = {"description": "à" * 20_000, "comments": "c" * 40_000}
    whole = to_documents(tickets(spark, long)).first()
    assert whole["description"] == "à" * 20_000 and whole["content"].endswith("c" * 40_000)
    row = to_documents(tickets(spark, long), max_bytes=30_000).first()
    assert row["description"] == "à" * 15_000
    assert len(row["content"].encode()) <= 30_000 and row["content"].endswith("à")


def test_empty_content_is_dropped(spark):
    blank = {f.name: None for f in RECORD_SCHEMA.fields[:-1]}
    only_group = {**blank, "assignment_group_name": "HD"}
    docs = with_content(to_documents(tickets(spark, {}, blank, only_group)))
    assert sorted(r["content"][:6] for r in docs.collect()) == ["Gruppo", "Ticket"]


def test_filters_do_not_repeat_the_regexes(spark):
    docs = with_content(to_documents(tickets(spark, {}))).where("priority = '3 - Moderate'")
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("IDENTIFIED\\s") <= 5  # once per text column


# --- runs -------------------------------------------------------------------

T1, T2, T3 = "2024-03-01 10:00:00", "2024-03-01 10:20:00", "2024-03-01 11:00:00"


def test_first_run_is_full_then_delta(spark, home):
    corpus, marks = home
    rows = tickets(spark, ticket("A", T1), ticket("B", T2))
    first = run_ingest(rows, corpus, marks)
    assert (first.mode, first.read, first.written, first.new_watermark) == ("full", 2, 2, T2)
    more = tickets(spark, ticket("A", T1), ticket("B", T2), ticket("C", T3))
    second = run_ingest(more, corpus, marks)
    # the overlap of 15 minutes reads B again, but not A
    assert (second.mode, second.read, second.previous_watermark) == ("delta", 2, T2)
    assert marks.read() == T3 and keys(corpus) == ["A", "B", "C"]


def test_delta_over_nothing_new_keeps_the_mark(spark, home):
    corpus, marks = home
    marks.write(T3)
    stats = run_ingest(tickets(spark, ticket("A", T1)), corpus, marks)
    assert (stats.read, stats.written, stats.new_watermark) == (0, 0, T3)
    assert marks.read() == T3


def test_full_replaces_the_mark(spark, home):
    corpus, marks = home
    marks.write(T3)
    rows = tickets(spark, ticket("A", T1), ticket("B", T2))
    stats = run_ingest(rows, corpus, marks, full=True, backfill_from=T2, max_records=1)
    assert (stats.mode, stats.read, stats.previous_watermark) == ("full", 1, None)
    assert marks.read() == T1 and keys(corpus) == ["A"]


def test_backfill_does_not_save_the_mark(spark, home):
    corpus, marks = home
    marks.write(T1)
    rows = tickets(spark, ticket("A", T1), ticket("B", T2), ticket("C", T3))
    stats = run_ingest(rows, corpus, marks, backfill_from=T2)
    assert (stats.mode, stats.read, stats.new_watermark) == ("backfill", 2, T3)
    assert marks.read() == T1 and keys(corpus) == ["B", "C"]


def test_scope_and_undated_rows(spark, home):
    corpus, marks = home
    rows = tickets(
        spark,
        ticket("A", T1),
        ticket("B", T2, state="2"),
        ticket("C", T2, assignment_group="other"),
        ticket("D", None),
    )
    stats = run_ingest(rows, corpus, marks, Options(scope=Scope(groups=["g-mail"])))
    assert (stats.read, stats.undated, stats.new_watermark) == (2, 1, T1)
    assert keys(corpus) == ["A", "D"]


def test_skipped_rows_still_move_the_mark(spark, home):
    corpus, marks = home
    blank = {f.name: None for f in RECORD_SCHEMA.fields[:-1]}
    rows = tickets(spark, ticket("A", T1), {**blank, "state": "7", "sys_updated_on": T3})
    stats = run_ingest(rows, corpus, marks)
    assert (stats.read, stats.transformed, stats.skipped_empty) == (2, 1, 1)
    assert marks.read() == T3 and keys(corpus) == ["A"]


def test_only_the_latest_version_is_processed(spark, home):
    corpus, marks = home
    rows = tickets(spark, ticket("A", T1, priority="old"), ticket("A", T2, priority="new"))
    stats = run_ingest(rows, corpus, marks)
    assert (stats.read, stats.written) == (2, 1)
    assert corpus.read().first()["priority"] == "new"


def test_masking_and_vectors_in_a_run(spark, home):
    corpus, marks = home
    rows = tickets(
        spark,
        ticket("A", T1, comments="scrivi a m@x.it e m@x.it"),
        ticket("B", T2),
    )
    options = Options(
        mask=masking.mask_by_pattern, embed=lambda df: hash_embed(df, dimensions=16)
    )
    stats = run_ingest(rows, corpus, marks, options)
    assert (stats.pii_values_masked, stats.pii_occurrences_masked, stats.pii_docs_with_pii) == (1, 2, 1)
    stored = {r["id"]: r for r in corpus.read().collect()}
    assert "m@x.it" not in stored["A"]["content"] and "m@x.it" in stored["A"]["comments"]
    assert all(len(r["contentVector"]) == 16 and r[MASKED_OK] for r in stored.values())
    assert stats.to_frame(spark).first()["written"] == 2


def test_rows_without_vector_are_not_written_but_move_the_mark(spark, home):
    corpus, marks = home
    rows = tickets(spark, ticket("A", T1), ticket("B", T2))
    options = Options(
        embed=lambda df: df.withColumn(
            "contentVector", F.when(F.col("id") == "A", F.array(F.lit(1.0).cast("float")))
        )
    )
    stats = run_ingest(rows, corpus, marks, options)
    assert (stats.transformed, stats.written, marks.read()) == (2, 1, T2)


@pytest.mark.parametrize("policy, expected", [("keep", ["A", "B"]), ("quarantine", ["B"])])
def test_failed_masking(spark, home, policy, expected):
    corpus, marks = home

    def make():
        def detect(texts, languages):
            if any("broken" in t for t in texts):
                raise RuntimeError
            return [[] for _ in texts]

        return detect

    rows = tickets(spark, ticket("A", T1, comments="broken"), ticket("B", T2))
    options = Options(
        mask=lambda df: masking.mask_by_detector(df, make), on_mask_failure=policy
    )
    stats = run_ingest(rows, corpus, marks, options)
    assert stats.pii_failures == 1 and keys(corpus) == expected


# --- streaming --------------------------------------------------------------


def test_stream_merges_late_and_redelivered_rows(spark, home, tmp_path):
    corpus, marks = home
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")

    def arrive(*changes):
        columns = RECORD_SCHEMA.names
        tickets(spark, *changes).select(*columns).coalesce(1).write.mode("append").parquet(landed)

    def run():
        source = stream_landed(spark, landed, RECORD_SCHEMA, max_files=1)
        ingest_stream(source, corpus, checkpoint, Options(base_url=BASE), marks).awaitTermination()

    arrive(ticket("A", T2, priority="first"), ticket("B", T2))
    arrive(ticket("A", T1, priority="late"), ticket("C", T1))
    run()
    assert keys(corpus) == ["A", "B", "C"] and marks.read() == T2
    arrive(ticket("A", T3, priority="newest"), ticket("D", None))
    run()
    run()
    assert keys(corpus) == ["A", "B", "C", "D"] and marks.read() == T3
    before = sorted(map(str, corpus.read().collect()))
    assert "newest" in str(before) and "late" not in str(before)

    # a lost commit file makes Spark deliver the last batch again
    last = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    shutil.move(last, tmp_path / "lost")
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        shutil.move(crc, tmp_path / "lost.crc")
    run()
    assert sorted(map(str, corpus.read().collect())) == before


def test_other_streams_and_a_recreated_corpus_lose_nothing(spark, home, tmp_path):
    corpus, _ = home

    def run(name, *changes):
        landed = str(tmp_path / name)
        tickets(spark, *changes).select(*RECORD_SCHEMA.names).write.parquet(landed)
        source = stream_landed(spark, landed, RECORD_SCHEMA)
        ingest_stream(source, corpus, str(tmp_path / f"checkpoint-{name}")).awaitTermination()

    run("first", ticket("A", T1))
    run("second", ticket("B", T1))
    assert keys(corpus) == ["A", "B"]
    corpus.recreate(confirmed=True)
    run("third", ticket("C", T1))
    assert keys(corpus) == ["C"]


# --- quarantine -------------------------------------------------------------


def _detector(*refused):
    def make():
        def detect(texts, languages):
            if any(word in t for t in texts for word in refused):
                raise RuntimeError
            return [[w for w in t.split() if "@" in w] for t in texts]

        return detect

    return make


def _held(quarantine):
    return sorted((r["number"], r["attempts"]) for r in quarantine.read().collect())


def test_quarantine_is_driven_again(spark, home, tmp_path):
    corpus, marks = home
    quarantine = Quarantine(spark, str(tmp_path / "held"))

    def options(*refused):
        def mask(df):
            return masking.mask_by_detector(df, _detector(*refused))

        return Options(base_url=BASE, mask=mask, quarantine=quarantine, on_mask_failure="quarantine")

    rows = tickets(
        spark,
        ticket("A", T1, comments="broken a@b.c"),
        ticket("B", T1, comments="worse"),
        ticket("C", T2, comments="good x@y.z"),
    )
    stats = run_ingest(rows, corpus, marks, options("broken", "worse"))
    assert (stats.written, stats.pii_failures, keys(corpus)) == (1, 2, ["C"]) and marks.read() == T2
    assert _held(quarantine) == [("A", 1), ("B", 1)]

    # nothing new; B still fails, A passes
    run_ingest(rows.where("false"), corpus, marks, options("worse"))
    assert keys(corpus) == ["A", "C"] and _held(quarantine) == [("B", 2)]

    # a newer version of B passes and replaces the one held
    newer = tickets(spark, ticket("B", T2, comments="mended", priority="1 - Critical"))
    run_ingest(newer, corpus, marks, options("worse"))
    assert keys(corpus) == ["A", "B", "C"] and _held(quarantine) == []
    found = {r["id"]: r for r in corpus.read().collect()}
    assert found["B"]["priority"] == "1 - Critical" and "a@b.c" not in found["A"]["content"]


def test_a_run_that_dies_after_the_merge_loses_nothing(spark, home, tmp_path, monkeypatch):
    corpus, marks = home
    quarantine = Quarantine(spark, str(tmp_path / "held"))

    def options(*refused):
        def mask(df):
            return masking.mask_by_detector(df, _detector(*refused))

        return Options(base_url=BASE, mask=mask, quarantine=quarantine)

    rows = tickets(spark, ticket("A", T1, comments="broken"), ticket("B", T2))
    run_ingest(rows, corpus, marks, options("broken"))
    real, calls = Quarantine.write, []

    def dies(self, held):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        real(self, held)

    more = tickets(spark, ticket("C", T2, comments="broken"), ticket("D", T2))
    monkeypatch.setattr(Quarantine, "write", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_ingest(more, corpus, marks, options("nothing like it"))
    monkeypatch.setattr(Quarantine, "write", real)
    run_ingest(more, corpus, marks, options("nothing like it"))
    assert keys(corpus) == ["A", "B", "C", "D"] and _held(quarantine) == []


def test_quarantine_of_a_stream(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "corpus"), corpus_schema(16))
    quarantine, landed = Quarantine(spark, str(tmp_path / "held")), str(tmp_path / "landed")

    def run(*refused):
        def mask(df):
            return masking.mask_by_detector(df, _detector(*refused))

        stream = stream_landed(spark, landed, RECORD_SCHEMA)
        chosen = Options(base_url=BASE, mask=mask, quarantine=quarantine)
        ingest_stream(stream, corpus, str(tmp_path / "checkpoint"), chosen).awaitTermination()

    tickets(spark, ticket("A", T1, comments="broken"), ticket("B", T2)).select(*RECORD_SCHEMA.names).write.parquet(landed)
    run("broken")
    assert keys(corpus) == ["B"] and _held(quarantine) == [("A", 1)]
    tickets(spark, ticket("C", T2)).select(*RECORD_SCHEMA.names).write.mode("append").parquet(landed)
    run()
    assert keys(corpus) == ["A", "B", "C"] and _held(quarantine) == []


def test_only_repeated_keys_are_exchanged(spark):
    from deskweave.plans.ingest import newest_records

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    once = tickets(spark, ticket("A", T1), ticket("B", T2), ticket("C", None))
    found = newest_records(once, Options())
    assert "Exchange" not in plan(found) and found.count() == 3
    several = once.unionByName(tickets(spark, ticket("A", T3), ticket("C", T1), ticket("C", T2)))
    newest = newest_records(several, Options())
    got = sorted((r["_key"], r["sys_updated_on"]) for r in newest.collect())
    assert got == [("A", T3), ("B", T2), ("C", T2)]


def test_counters_with_repeated_keys(spark, home):
    corpus, marks = home
    blank = {f.name: None for f in RECORD_SCHEMA.fields[:-1]}
    rows = tickets(spark, ticket("A", T1), ticket("A", T2), ticket("B", None), {**blank, "state": "7"})
    stats = run_ingest(rows, corpus, marks)
    assert (stats.read, stats.written, stats.skipped_empty, stats.undated) == (4, 2, 1, 2)
    assert marks.read() == T2 and keys(corpus) == ["A", "B"]


def test_held_records_are_written_once(spark, home, tmp_path):
    """A first failure makes one snapshot, a run that lets go two, one without any none."""
    corpus, marks = home
    quarantine = Quarantine(spark, str(tmp_path / "held"))

    def run(bad, *rows):
        def mask(df):
            return masking._masked(df, "content", F.array(), ~F.col("number").isin(bad))

        chosen = Options(base_url=BASE, mask=mask, quarantine=quarantine, on_mask_failure="quarantine")
        run_ingest(tickets(spark, *rows), corpus, marks, chosen, full=True)
        return quarantine._snapshots()

    assert run(["A"], ticket("A", T1), ticket("B", T1)) == [1]
    assert _held(quarantine) == [("A", 1)] and keys(corpus) == ["B"]
    assert run([], ticket("B", T1)) == [1, 2, 3]
    assert _held(quarantine) == [] and keys(corpus) == ["A", "B"]
    assert run([], ticket("C", T1)) == [1, 2, 3]


def test_second_delivery_comes_from_the_first(spark, monkeypatch):
    from conftest import SMALL
    from deskweave.plans import catalog

    read = []
    real = catalog._redelivered
    monkeypatch.setattr(catalog, "_redelivered", lambda rows: read.extend(rows.inputFiles()) or real(rows))
    assert catalog.stream_restart_state(spark, SMALL).count() > 0
    assert read and all("/first/" in f for f in read)
