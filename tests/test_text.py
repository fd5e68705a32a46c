import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskweave.functions import cells, dates, text

BASE = "https://acme.desk.example"


@pytest.mark.parametrize(
    "given_, expected",
    [("INC0012345", "INC0012345"), ("INC/00:12 345", "INC_00_12_345"), (" INC-1= ", "INC-1=")],
)
def test_document_key(one, given_, expected):
    assert one(text.document_key(F.col("x")), x=given_) == expected


@pytest.mark.parametrize(
    "given_, expected",
    [
        ("2024-03-01 09:00:00", "2024-03-01T09:00:00Z"),
        ("2024-3-1 9:0:0", "2024-03-01T09:00:00Z"),
        ("", None),
        (None, None),
        ("not-a-date", None),
        ("2024-13-01 09:00:00", None),
        ("24-03-01 09:00:00", None),
        ("2024-03-01", None),
    ],
)
def test_iso_date(one, given_, expected):
    assert one(dates.gmt_to_iso_z(F.col("x")), x=given_) == expected


def test_overlap_and_mark(one):
    def back(x):
        return one(dates.format_gmt(dates.minus_minutes(dates.parse_mark(F.col("x")), 15)), x=x)

    assert back("2024-03-01 10:30:00") == "2024-03-01 10:15:00"
    assert back("2024-03-01") == "2024-02-29 23:45:00"
    assert back(None) is None


def test_truncate_bytes(one):
    assert len(one(text.truncate_bytes(F.col("x"), 1000), x="x" * 100_000)) == 1000
    assert one(text.truncate_bytes(F.col("x"), 101), x="à" * 1000) == "à" * 50
    assert one(text.truncate_bytes(F.col("x"), 101), x="breve") == "breve"
    assert one(text.truncate_bytes(F.col("x"), 2), x="𝄞x") == ""
    assert one(text.truncate_bytes(F.col("x")), x=None) is None


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aà€𝄞\n", max_size=40), min_size=1, max_size=8), st.integers(3, 60))
def test_truncate_bytes_like_python(spark, texts, limit):
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in rows.select(text.truncate_bytes(F.col("x"), limit)).collect()]
    assert got == [t.encode()[:limit].decode(errors="ignore") for t in texts]


def test_strip_removes_all_blanks(one):
    padded = " \x1c\t a b \r\n\x85 "
    assert one(text.strip(F.col("x")), x=padded) == padded.strip() == "a b"


def test_url(one):
    def url(base, key, number):
        return one(text.ticket_url(base, F.col("k"), F.col("n")), k=key, n=number)

    assert url(BASE + "/", "abc", "INC1") == BASE + "/nav_to.do?uri=incident.do?sys_id=abc"
    assert url(BASE, "", "INC1") == BASE + "/incident.do?sysparm_query=number=INC1"
    assert url(BASE, "", "") == ""
    assert url("", "abc", "INC1") == ""


def test_header(one):
    line = text.header(F.col("n"), F.col("g"), F.col("d"), F.col("u"))
    full = one(line, n="INC1", g="HD L2", d="2024-03-01", u="http://x")
    assert full == "Ticket INC1 | Gruppo: HD L2 | Chiuso: 2024-03-01 | Link: http://x"
    assert one(line, n="INC1", g="", d=None, u="") == "Ticket INC1"
    assert one(line, n="", g="", d=None, u="") == ""


def test_content(one):
    parts = {k: F.col(k) for k in text.PART_LABELS}
    values = dict(short_description="p", description="d", resolution="r")
    got = one(
        text.content(F.col("h"), parts), h="H", work_notes="wn", comments="cm", **values
    )
    assert got == (
        "H\n\nProblema: p\n\nDescrizione: d\n\nRisoluzione: r\n\n"
        "Note di lavorazione: wn\n\nCommenti: cm"
    )
    got = one(text.content(F.col("h"), parts), h="", work_notes="", comments="", **values)
    assert got == "Problema: p\n\nDescrizione: d\n\nRisoluzione: r"


def test_preview(one):
    assert one(text.preview(F.col("x"), 5), x="ab\r\ncdef") == "ab  c […]"
    assert one(text.preview(F.col("x"), 5), x="ab\nc") == "ab c"


def test_model_input_limits(one):
    assert len(one(text.truncate_chars(F.col("x"), 10), x="A" * 5000)) == 10
    assert one(text.truncate_tokens(F.col("x"), 3), x="a  b\nc d") == "a b c"
    assert one(text.truncate_tokens(F.col("x"), 4), x="a  b\nc d") == "a  b\nc d"


# --- cells ------------------------------------------------------------------


@pytest.mark.parametrize(
    "cell, value, label",
    [
        ({"value": " v ", "display_value": "d "}, "v", "d"),
        (" bare ", "bare", "bare"),
        ({"value": None, "display_value": "d"}, "", "d"),
        ({}, "", ""),
        (None, "", ""),
        (5, "", ""),
        ("{not json", "{not json", "{not json"),
    ],
)
def test_cells(one, cell, value, label):
    raw = F.parse_json(F.col("x"))
    body = json.dumps(cell)
    assert one(cells.cell_value(raw), x=body) == value
    assert one(cells.cell_label(raw), x=body) == label
    assert one(cells.value_or_label(raw), x=body) == (value or label)
    assert one(cells.label_or_value(raw), x=body) == (label or value)


def test_absent_cell_is_empty(one):
    assert one(cells.cell_value(F.parse_json(F.col("x"))), x=None) == ""


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('{"pii": ["a", " ", "b"]}', ["a", "b"]),
        ('{"pii": [{"type": "name", "value": "Mario Rossi"}]}', ["Mario Rossi"]),
        ('{"pii": [{"text": "t"}, {"pii": "p"}, {"value": "", "text": "u"}]}', ["t", "p", "u"]),
        ('{"pii": [1, null, {"value": 2}]}', []),
        ('{"pii": []}', []),
        ("{}", []),
        ("[]", []),
        ("not json", []),
        (None, []),
    ],
)
def test_json_values(one, reply, expected):
    assert one(cells.json_values(F.col("x")), x=reply) == expected
