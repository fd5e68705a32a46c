"""Personal-data detection by pattern, and masking of detected values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import or_empty, strip

MASK = "[PII]"

# Entity types looked for, and the confidence each must reach.
THRESHOLDS = {
    "PERSON": 0.4,
    "EMAIL_ADDRESS": 0.5,
    "PHONE_NUMBER": 0.4,
    "IBAN_CODE": 0.5,
    "IT_FISCAL_CODE": 0.5,
}
DEFAULT_THRESHOLD = 0.5
LANGUAGES = ("it", "en")


@dataclass(frozen=True)
class EntityPattern:
    entity: str
    regex: str
    score: float
    literal: str | None = None  # occurs in every match, tested before the regex


# PERSON has no pattern: names come from a detector (see operators.masking).
ENTITY_PATTERNS: tuple[EntityPattern, ...] = (
    EntityPattern(
        "EMAIL_ADDRESS", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", 1.0, "@"
    ),
    EntityPattern(
        "PHONE_NUMBER",
        r"\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9](?:[ .\-]?[0-9]){5,11}",
        0.4,
        "+",
    ),
    EntityPattern("IBAN_CODE", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}", 0.6),
    EntityPattern(
        "IT_FISCAL_CODE",
        r"[A-Z]{6}[0-9]{2}[ABCDEHLMPRST][0-9]{2}[A-Z][0-9]{3}[A-Z]",
        0.8,
    ),
)


def route_language(lang: Column, languages: Sequence[str] = LANGUAGES) -> Column:
    """Keep a supported language, send any other (or none) to the first one."""
    return F.when(lang.isin(*languages), lang).otherwise(F.lit(languages[0]))


def detect_spans(
    c: Column,
    patterns: Sequence[EntityPattern] = ENTITY_PATTERNS,
    thresholds: Mapping[str, float] = THRESHOLDS,
) -> Column:
    """array<struct<type, value, score>> of pattern hits that reach their threshold."""
    text = or_empty(c)

    def spans_of(p: EntityPattern) -> Column:
        hits = F.regexp_extract_all(text, F.lit(p.regex), F.lit(0))
        if p.literal is not None:
            none = F.array().cast("array<string>")
            hits = F.when(text.contains(p.literal), hits).otherwise(none)
        return F.transform(
            hits,
            lambda v: F.struct(
                F.lit(p.entity).alias("type"), v.alias("value"), F.lit(p.score).alias("score")
            ),
        )

    hits = [
        spans_of(p)
        for p in patterns
        if p.score >= thresholds.get(p.entity, DEFAULT_THRESHOLD)
    ]
    if not hits:
        return F.array().cast("array<struct<type:string,value:string,score:double>>")
    return F.concat(*hits)


def confident_spans(spans: Column, thresholds: Mapping[str, float] = THRESHOLDS) -> Column:
    """Drop spans (from any detector) whose score is below the type's threshold."""
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    return F.filter(
        spans,
        lambda s: s["score"]
        >= F.coalesce(F.try_element_at(limits, s["type"]), F.lit(DEFAULT_THRESHOLD)),
    )


def span_values(spans: Column) -> Column:
    return F.transform(spans, lambda s: s["value"])


def mask_order(values: Column) -> Column:
    """Distinct non-blank values, longest first, ties by value."""
    kept = F.array_distinct(
        F.filter(values, lambda v: v.isNotNull() & (strip(v) != ""))
    )
    keyed = F.sort_array(
        F.transform(kept, lambda v: F.struct((-F.length(v)).alias("k"), v.alias("v")))
    )
    return F.coalesce(
        F.transform(keyed, lambda s: s["v"]), F.array().cast("array<string>")
    )


def mask_values(c: Column, ordered: Column, mask: str = MASK) -> Column:
    """struct<text, occurrences>: every value of `ordered` replaced, in that order.

    Occurrences are counted on the progressively masked text, so a value already
    covered by a longer one does not count again.
    """
    start = F.struct(or_empty(c).alias("text"), F.lit(0).cast("bigint").alias("occurrences"))

    def step(acc: Column, value: Column) -> Column:
        gone = F.length(acc["text"]) - F.length(F.replace(acc["text"], value, F.lit("")))
        return F.struct(
            F.replace(acc["text"], value, F.lit(mask)).alias("text"),
            (acc["occurrences"] + F.floor(gone / F.length(value))).cast("bigint").alias(
                "occurrences"
            ),
        )

    return F.aggregate(ordered, start, step)
