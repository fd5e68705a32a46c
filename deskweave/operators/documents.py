"""Flat records -> one citable, redacted document per ticket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_gmt
from ..functions.redaction import DEFAULT_RULES, Rule, redact_columns
from ..functions.text import (
    content,
    document_key,
    header,
    or_empty,
    strip,
    ticket_url,
    truncate_bytes,
)
from .once import with_columns_once
from .schema import UPDATED

FREE_TEXT = {
    "short_description": "short_description",
    "description": "description",
    "resolution": "close_notes",
    "work_notes": "work_notes",
    "comments": "comments",
}
RECORD_KEY = "_sys_id"


def to_documents(
    records: DataFrame,
    base_url: str = "",
    rules: Sequence[Rule] = DEFAULT_RULES,
    max_bytes: int | None = None,
) -> DataFrame:
    """Redact, then compose from the whole texts; with `max_bytes` cut the texts to it.

    The projections are kept apart so that each redacted text is computed once and
    shared by its own column and by `content`.
    """
    cleaned = records.select(
        strip(or_empty(F.col("number"))).alias("number"),
        strip(or_empty(F.col("sys_id"))).alias(RECORD_KEY),
        *[strip(or_empty(F.col(src))).alias(name) for name, src in FREE_TEXT.items()],
        *[
            strip(or_empty(F.col(c))).alias(c)
            for c in ("assignment_group", "assignment_group_name", "priority", "impact", "urgency")
        ],
        parse_gmt(strip(F.col("closed_at"))).alias("closed_at"),
        F.col("updated_at").alias(UPDATED),
    )
    redacted = redact_columns(cleaned, list(FREE_TEXT), rules)
    with_url = redacted.withColumn(
        "url", ticket_url(base_url, F.col(RECORD_KEY), F.col("number"))
    )
    line = header(
        F.col("number"),
        F.col("assignment_group_name"),
        F.date_format("closed_at", "yyyy-MM-dd"),
        F.col("url"),
    )
    composed = with_columns_once(
        with_url,
        {
            **{name: F.col(name) for name in FREE_TEXT},
            "content": content(line, {name: F.col(name) for name in FREE_TEXT}),
        },
    )
    cut = ("description", "resolution", "work_notes", "comments", "content")
    return composed.select(
        document_key(F.col("number")).alias("id"),
        "number",
        "url",
        "short_description",
        *[
            (F.col(name) if max_bytes is None else truncate_bytes(F.col(name), max_bytes)).alias(name)
            for name in cut
        ],
        "assignment_group",
        "assignment_group_name",
        "priority",
        "impact",
        "urgency",
        "closed_at",
        UPDATED,
        RECORD_KEY,
    )


def with_content(documents: DataFrame) -> DataFrame:
    """Drop documents whose content is empty."""
    return documents.where(F.col("content") != "")


def with_vector(documents: DataFrame) -> DataFrame:
    """Drop documents that have no vector."""
    return documents.where(F.size("contentVector") > 0)


def blank_record(base_url: str = ""):
    """Condition: a flat record whose document would have empty content."""
    texts = ["number", "assignment_group_name", *FREE_TEXT.values(), *(["sys_id"] if base_url else [])]
    empty = parse_gmt(strip(F.col("closed_at"))).isNull()
    for name in texts:
        empty &= strip(or_empty(F.col(name))) == ""
    return empty
