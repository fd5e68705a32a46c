import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskweave.functions.redaction import DEFAULT_RULES, MASK, Rule, redact, redact_columns
from deskweave.operators.masking import mask_by_values

CASES = [
    ("nuova chiave: password=Tulipano9 da ieri", "nuova chiave: password=[REDACTED] da ieri"),
    ("Pwd : k3y-9", "Pwd=[REDACTED]"),
    ("PASS = 'a b' x", "PASS=[REDACTED] x"),
    ("create role app identified by Rovo55;", "create role app identified by [REDACTED];"),
    ("IDENTIFIED  BY values 'T:00ff' account unlock", "IDENTIFIED  BY [REDACTED] account unlock"),
    ("aperto con posta/Rovo55@mx2.lan:993/inbox ok", "aperto con posta/[REDACTED]@mx2.lan:993/inbox ok"),
    ("", ""),
    (None, ""),
    ("Niente da nascondere in questa frase.",) * 2,
    ("bypass: x",) * 2,
    ("àpassword=x",) * 2,
    ("password\u00a0= x", "password=[REDACTED]"),
    ("paſsword=x", "paſsword=[REDACTED]"),
    ("İDENTIFIED BY x", "İDENTIFIED BY [REDACTED]"),
    ("elenco/lia.verdi@posta.example", "elenco/[REDACTED]@posta.example"),
]


@pytest.mark.parametrize("given_, expected", CASES)
def test_default_rules(one, given_, expected):
    assert one(redact(F.col("x")), x=given_) == expected


def test_stepwise_redaction_is_the_same(spark):
    rows = spark.createDataFrame([(a, b) for a, b in CASES], "x string, expected string")
    got = redact_columns(rows.withColumn("y", F.col("x")), ["x", "y"])
    assert got.where("x <> expected or y <> expected").count() == 0


def _python_rules():
    """The same rules in Python's own regex engine, as the reading of the rules."""
    for rule in DEFAULT_RULES:
        template = re.sub(r"\$(\d)", r"\\\1", rule.replacement)
        yield re.compile(rule.pattern, re.IGNORECASE), template


PIECES = ["password", "PWD", "pass", ":", "=", " ", "'", '"', "/", "@", "IDENTIFIED", "BY",
          "VALUES", "x1", "è", " ", "\n", ";", "a.b", "scott"]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=5, max_size=20))
def test_like_python_and_idempotent(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    once = redact(F.col("x"))
    got = rows.select(once.alias("a"), redact(once).alias("b")).collect()
    for body, row in zip(texts, got):
        for pattern, template in _python_rules():
            body = pattern.sub(template, body)
        assert row["a"] == body
        assert row["b"] == row["a"]


def test_custom_rules_replace_the_defaults(one):
    rule = Rule.from_python("email", r"[\w.+-]+@[\w-]+\.[\w.-]+", MASK)
    text = "scrivi a mario.rossi@example.com, password=x"
    assert one(redact(F.col("x"), [rule]), x=text) == "scrivi a [REDACTED], password=x"
    assert one(redact(F.col("x"), []), x=text) == text


def test_python_templates_are_translated(one):
    rule = Rule.from_python("swap", r"(?P<a>\d+)-(?P<b>\d+)", r"\g<b>$\1")
    assert one(redact(F.col("x"), [rule]), x="12-34") == "34$12"


def test_secrets_first_then_values(spark):
    rows = spark.createDataFrame(
        [("Ticket gestito da Andrea Di Cosmo con password=Segreta1",)], "content string"
    )
    step = redact_columns(rows, ["content"])
    out = mask_by_values(step, F.array(F.lit("Andrea Di Cosmo"))).first()["content"]
    assert out == "Ticket gestito da [PII] con password=[REDACTED]"
