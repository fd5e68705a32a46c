"""The state that passes on changed versions only."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from deskweave.operators.corpus import Corpus
from deskweave.operators.schema import MASKED_OK, corpus_schema
from deskweave.plans.ingest import Options
from deskweave.sources.marks import MarkStore
from deskweave.sources.pages import RECORD_SCHEMA
from deskweave.streaming.changes import _Newest, version_counts
from deskweave.streaming.ingest_stream import ingest_stream, stream_landed
from test_ingest import BASE, T1, T2, T3, ticket, tickets


@pytest.fixture
def desk(spark, tmp_path):
    class Desk:
        landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")
        corpora = {on: Corpus(spark, str(tmp_path / f"corpus-{on}"), corpus_schema(16)) for on in (True, False)}
        masked, marks = [], None

        def run(self, only_changed):
            def mask(df):
                if only_changed:
                    self.masked.append(sorted(r["id"] for r in df.select("id").collect()))
                return df.withColumns({MASKED_OK: F.lit(True), "_pii_occurrences": F.lit(0), "_pii_values": F.lit(0)})

            ingest_stream(
                stream_landed(spark, self.landed, RECORD_SCHEMA),
                self.corpora[only_changed],
                self.checkpoint if only_changed else f"{self.checkpoint}-plain",
                Options(base_url=BASE, mask=mask),
                self.marks if only_changed else None,
                only_changed=only_changed,
            ).awaitTermination()

        def arrive(self, *changes):
            rows = tickets(spark, *changes).select(*RECORD_SCHEMA.names)
            rows.write.mode("append").parquet(self.landed)
            self.masked.clear()
            self.run(True)
            self.run(False)
            on, off = (sorted(map(str, self.corpora[x].read().collect())) for x in (True, False))
            assert on == off
            return self.masked[0] if self.masked else []

        def counts(self):
            return {r["key"]: tuple(r)[1:] for r in version_counts(spark, self.checkpoint).collect()}

    return Desk()


def test_only_changes_go_on(desk):
    first = (ticket("A", T2), ticket("A", T1, priority="old"), ticket("B", None), ticket("C", T2))
    assert desk.arrive(*first) == ["A", "B", "C"]
    assert desk.counts() == {"A": (1, 0, 0), "B": (0, 1, 0), "C": (0, 0, 0)}
    # the same again, an older one, an undated one
    again = (ticket("A", T2), ticket("B", None), ticket("C", T1, priority="late"), ticket("C", None))
    assert desk.arrive(*again) == []
    assert desk.counts() == {"A": (1, 0, 1), "B": (0, 2, 1), "C": (2, 1, 0)}
    # newer, dated for the first time, same time with another content, and a new one
    more = (ticket("A", T3), ticket("B", T1), ticket("C", T2, priority="other"), ticket("D", T1))
    assert desk.arrive(*more) == ["A", "B", "C", "D"]
    assert desk.counts()["C"] == (2, 1, 0)



def test_a_run_that_dies_after_the_merge_counts_nothing_twice(desk, spark, tmp_path):
    class Dying(MarkStore):
        def write(self, mark):
            raise RuntimeError("dies")

    desk.arrive(ticket("A", T1))
    rows = tickets(spark, ticket("A", T2), ticket("A", T1), ticket("B", None)).select(*RECORD_SCHEMA.names)
    rows.write.mode("append").parquet(desk.landed)
    desk.marks = Dying(spark, str(tmp_path / "mark"))
    with pytest.raises(StreamingQueryException):
        desk.run(True)
    before = sorted(map(str, desk.corpora[True].read().collect()))
    desk.marks = MarkStore(spark, str(tmp_path / "mark"))
    desk.run(True)
    assert sorted(map(str, desk.corpora[True].read().collect())) == before
    assert desk.marks.read() == T2 and desk.counts() == {"A": (1, 0, 0), "B": (0, 1, 0)}


def test_rows_of_a_key_are_handled_one_by_one_without_frames():
    class Kept:
        value, asked = None, 0

        def get(self):
            self.asked += 1
            return self.value

        def update(self, value):
            self.value = value

    newest = _Newest(["sys_id", "number", "state"])
    newest.state = Kept()

    def arrive(*rows):
        return list(newest.handleInputRows(("A",), (Row(*r) for r in rows), None))

    undated = -(2**63)
    first = [("1", "A", "6", "A", "d1", 5), (None, "A", "7", "A", "d2", 7), ("0", "A", "8", "A", "d3", 7)]
    [out] = arrive(*first, ("9", "A", "9", "A", "d4", undated))
    assert out.asDict() == {"sys_id": "0", "number": "A", "state": "8"}
    assert newest.state.value == (7, "d3", 3, 1, 0)
    assert arrive(first[2]) == [] and newest.state.value == (7, "d3", 3, 1, 1)
    assert arrive(first[0]) == [] and newest.state.value == (7, "d3", 4, 1, 1)
    assert newest.state.asked == 3  # one call of the state store for what is known


def test_a_delivery_without_news_is_not_counted_without_a_mark(desk, spark, monkeypatch):
    from deskweave.plans import ingest

    desk.arrive(ticket("A", T1))
    rows = tickets(spark, ticket("A", T1)).select(*RECORD_SCHEMA.names)
    rows.write.mode("append").parquet(desk.landed)
    passes = []
    counters = ingest._counters
    monkeypatch.setattr(ingest, "_counters", lambda options: passes.append(1) or counters(options))
    desk.run(True)
    assert len(passes) == 1  # those observed while preparing; a second pass asks the state again
    assert desk.counts() == {"A": (0, 0, 1)} and desk.corpora[True].read().count() == 1
