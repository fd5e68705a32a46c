import pytest
from pyspark.sql import functions as F

from deskweave.functions.personal_data import (
    confident_spans,
    detect_spans,
    mask_order,
    route_language,
)
from deskweave.operators import masking
from deskweave.operators.schema import MASKED_OK

NAMES = ("Mario Rossi", "Andrea Di Cosmo")


def names_detector(names=NAMES):
    def make():
        def detect(texts, languages):
            return [[n for n in names if n in t] for t in texts]

        return detect

    return make


def broken_detector():
    def make():
        def detect(texts, languages):
            raise RuntimeError("service down")

        return detect

    return make


def _masked(spark, texts, make=None, **options):
    rows = spark.createDataFrame([(t,) for t in texts], "content string")
    return masking.mask_by_detector(rows, make or names_detector(), **options)


def test_masks_all_occurrences_and_counts(spark):
    out = _masked(
        spark, ["Mario Rossi ha aperto, poi Mario Rossi ha chiuso", "nessun dato sensibile qui"]
    )
    assert [r["content"] for r in out.collect()] == [
        "[PII] ha aperto, poi [PII] ha chiuso",
        "nessun dato sensibile qui",
    ]
    counts = out.agg(*masking.mask_counters()).first().asDict()
    assert counts == {
        "pii_values_masked": 1,
        "pii_occurrences_masked": 2,
        "pii_docs_with_pii": 1,
        "pii_failures": 0,
    }


def test_empty_and_null(spark):
    assert [r["content"] for r in _masked(spark, ["", None]).collect()] == ["", ""]


def test_failing_detector_keeps_the_text_and_flags_it(spark):
    out = _masked(spark, ["Mario Rossi"], broken_detector())
    row = out.first()
    assert (row["content"], row[MASKED_OK]) == ("Mario Rossi", False)
    good, held = masking.split_unmasked(out)
    assert (good.count(), held.count()) == (0, 1)
    assert out.agg(*masking.mask_counters()).first()["pii_failures"] == 1


def test_one_bad_text_does_not_spoil_its_batch(spark):
    def make():
        def detect(texts, languages):
            if any("bad" in t for t in texts):
                raise RuntimeError
            return [["x"] for _ in texts]

        return detect

    rows = spark.createDataFrame([(i, f"x {t}") for i, t in enumerate(["a", "bad", "b"])], "i int, content string")
    out = masking.mask_by_detector(rows.coalesce(1), make).orderBy("i").collect()
    assert [r["content"] for r in out] == ["[PII] a", "x bad", "[PII] b"]
    assert [r[MASKED_OK] for r in out] == [True, False, True]


def test_values_behind_the_call_limit_are_found(spark):
    body = "x" * 990 + NAMES[0] + "y" * 2500 + NAMES[1]
    row = _masked(spark, [body], call_chars=1000).first()
    assert row["content"] == "x" * 990 + "[PII]" + "y" * 2500 + "[PII]"


def test_windows_cover_the_text():
    import random

    rng = random.Random(1)
    for size in (6, 10, 30):
        body = "".join(rng.choice("abc  \n") for _ in range(300)) + "z" * 50
        windows = masking.text_windows(body, size, 5)
        for word in body.split():
            assert any(word in w.split() for w in windows)  # no word is cut, however long
        starts = [i for i in range(len(body) - 5) if i == 0 or body[i - 1].isspace()]
        assert all(any(body[i : i + 5] in w for w in windows) for i in starts)
    assert masking.text_windows("", 5) == [""] and masking.text_windows("ab", 5) == ["ab"]


def test_language_is_passed_on(spark):
    def make():
        def detect(texts, languages):
            return [[lang] for lang in languages]

        return detect

    rows = spark.createDataFrame([("it en", "en"), ("it en", "de"), ("it en", None)], "content string, lang string")
    out = masking.mask_by_detector(rows, make, language=F.col("lang"))
    assert [r["content"] for r in out.collect()] == ["it [PII]", "[PII] en", "[PII] en"]


def test_route_language(one):
    assert [one(route_language(F.col("x")), x=v) for v in ("en", "fr", None)] == ["en", "it", "it"]


def test_longest_value_first(spark, one):
    values = F.array(*[F.lit(v) for v in ("Mario", "Mario Rossi", " ", "Mario", "b", "a")])
    assert one(mask_order(values), x="") == ["Mario Rossi", "Mario", "a", "b"]
    rows = spark.createDataFrame([("Mario Rossi e Mario",)], "content string")
    row = masking.mask_by_values(rows, F.array(F.lit("Mario"), F.lit("Mario Rossi"))).first()
    assert (row["content"], row[masking.OCCURRENCES]) == ("[PII] e [PII]", 2)


def test_covered_value_counts_as_value_but_not_as_occurrence(spark):
    rows = spark.createDataFrame([("Mario Rossi",)], "content string")
    row = masking.mask_by_values(rows, F.array(F.lit("Mario"), F.lit("Mario Rossi"))).first()
    assert (row[masking.VALUES], row[masking.OCCURRENCES]) == (2, 1)


def test_several_columns_add_up(spark):
    rows = spark.createDataFrame([("a@b.it", "c@d.it x@y.it")], "content string, title string")
    row = masking.mask_by_pattern(rows, ["content", "title"]).first()
    assert (row["content"], row["title"]) == ("[PII]", "[PII] [PII]")
    assert (row[masking.VALUES], row[masking.OCCURRENCES]) == (3, 3)


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("scrivi a m.rossi@mail.example.com ora", "EMAIL_ADDRESS", "m.rossi@mail.example.com"),
        ("tel +39 (02) 555-1234 ok", "PHONE_NUMBER", "+39 (02) 555-1234"),
        ("IBAN IT60X0542811101000000123456", "IBAN_CODE", "IT60X0542811101000000123456"[:24]),
        ("CF RSSMRA85T10A562S.", "IT_FISCAL_CODE", "RSSMRA85T10A562S"),
    ],
)
def test_entity_patterns(one, text, kind, value):
    spans = one(detect_spans(F.col("x")), x=text)
    assert [(s["type"], s["value"]) for s in spans if s["type"] == kind] == [(kind, value)]


def test_thresholds(one):
    spans = detect_spans(F.col("x"), thresholds={"PHONE_NUMBER": 0.9})
    assert one(spans, x="tel +39 02 555 1234") == []
    offered = F.array(
        *[
            F.struct(F.lit(t).alias("type"), F.lit("v").alias("value"), F.lit(s).alias("score"))
            for t, s in (("PERSON", 0.4), ("PERSON", 0.3), ("OTHER", 0.5), ("OTHER", 0.4))
        ]
    )
    kept = one(confident_spans(offered), x="")
    assert [(s["type"], s["score"]) for s in kept] == [("PERSON", 0.4), ("OTHER", 0.5)]


def test_a_text_that_fails_in_one_window_counts_nothing(spark):
    """A long text takes several calls; if one of them fails, what others found is not masked."""
    from deskweave.operators import masking
    from deskweave.plans.catalog import SECRET_WORD, make_failing_detector

    text = "a.b@c.de " + "word " * 6000 + SECRET_WORD + "end"
    rows = spark.createDataFrame([(text,), ("x a.b@c.de",)], "text string")
    got = masking.mask_by_detector(rows, make_failing_detector, ["text"]).collect()
    said = {r["_pii_ok"]: (r["text"], r[masking.VALUES], r[masking.OCCURRENCES]) for r in got}
    assert said[False] == (text, 0, 0)
    assert said[True] == ("x [PII]", 1, 1)
