"""Personal-data masking of documents, by patterns or by an external detector.

A detector is a plain callable built once per Python task:

    detector(texts: list[str], languages: list[str]) -> list[list[str]]

It only sees the text column; every other column stays in the JVM, where the found
values are then masked.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.personal_data import (
    LANGUAGES,
    THRESHOLDS,
    detect_spans,
    mask_order,
    mask_values,
    route_language,
    span_values,
)
from ..functions.text import or_empty
from .names import find_names
from .once import with_columns_once
from .schema import MASKED_OK

Detector = Callable[[list[str], list[str]], list[list[str]]]

# Fixed value: characters of one detector call. Longer texts take several calls
# over overlapping windows, so that the whole text is looked at.
CALL_CHARS = 24_000
WINDOW_OVERLAP = 200
CALL_TEXTS = 16

VALUES = "_pii_values"
OCCURRENCES = "_pii_occurrences"


def text_windows(text: str, size: int = CALL_CHARS, overlap: int = WINDOW_OVERLAP) -> list[str]:
    """Consecutive windows over the whole text, cut at white space.

    A value without white space, however long, and a value with white space of up to
    `overlap` characters lie entirely inside at least one of them.
    """
    windows, start = [], 0
    while True:
        end = min(len(text), start + size)
        while end < len(text) and not text[end].isspace():
            end += 1
        windows.append(text[start:end])
        if end == len(text):
            return windows
        # back to the beginning of a word, if there is one in reach
        last, start = start, max(start + 1, end - overlap)
        back = start
        while back > last + 1 and back > start - overlap and not text[back - 1].isspace():
            back -= 1
        start = back if text[back - 1].isspace() else start


def _values_of(
    detector: Detector, texts: list[str], languages: list[str], attempts: int
) -> tuple[list[list[str]], list[bool]]:
    """One batched call; on error every text is tried again alone."""
    try:
        found = detector(texts, languages)
        if len(found) != len(texts):
            raise ValueError("a detector must return one list per text")
        return [list(v) for v in found], [True] * len(texts)
    except Exception as error:  # any error of an external model; every text gets its own call
        logging.getLogger("deskweave").warning("detector call failed: %r", error)
    values, oks = [], []
    for text, language in zip(texts, languages):
        for _ in range(attempts):
            try:
                values.append(list(detector([text], [language])[0]))
                oks.append(True)
                break
            except Exception as error:
                logging.getLogger("deskweave").warning("detector failed on a text: %r", error)
        else:
            values.append([])
            oks.append(False)
    return values, oks


def detect_with(
    make_detector: Callable[[], Detector],
    text: Column,
    language: Column | None = None,
    call_texts: int = CALL_TEXTS,
    call_chars: int = CALL_CHARS,
    attempts: int = 1,
) -> Column:
    """struct<values, ok> from an external detector, in Arrow batches."""

    @F.pandas_udf("values array<string>, ok boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        detector = make_detector()
        for texts, languages in batches:
            found: list[list[str]] = [[] for _ in range(len(texts))]
            good = [True] * len(texts)
            calls = [
                (row, window, lang)
                for row, (body, lang) in enumerate(zip(texts, languages))
                if body
                for window in text_windows(body, call_chars)
            ]
            for at in range(0, len(calls), call_texts):
                part = calls[at : at + call_texts]
                values, oks = _values_of(
                    detector, [w for _, w, _ in part], [g for _, _, g in part], attempts
                )
                for (row, _, _), value, ok in zip(part, values, oks):
                    found[row].extend(value)
                    good[row] = good[row] and ok
            # of a text that failed in one window nothing is masked, so nothing counts
            found = [values if ok else [] for values, ok in zip(found, good)]
            yield pd.DataFrame({"values": found, "ok": good})

    lang = F.lit(LANGUAGES[0]) if language is None else route_language(language)
    # non-deterministic: the optimizer must neither repeat nor move the calls
    return run.asNondeterministic()(text, lang)


def _masked(df: DataFrame, column: str, values: Column, ok: Column) -> DataFrame:
    """Mask one column; values and occurrences add up over repeated use."""
    step = df.withColumns({"_found": mask_order(values), "_good": ok})
    step = with_columns_once(step, {"_masked": mask_values(F.col(column), F.col("_found"))})
    before = set(df.columns)
    count = F.size("_found").cast("bigint")
    return step.withColumns(
        {
            column: F.when(F.col("_good"), F.col("_masked.text")).otherwise(
                or_empty(F.col(column))
            ),
            VALUES: (F.col(VALUES) + count) if VALUES in before else count,
            OCCURRENCES: (F.col(OCCURRENCES) + F.col("_masked.occurrences"))
            if OCCURRENCES in before
            else F.col("_masked.occurrences"),
            MASKED_OK: (F.col(MASKED_OK) & F.col("_good"))
            if MASKED_OK in before
            else F.col("_good"),
        }
    ).drop("_found", "_good", "_masked")


def mask_by_pattern(df: DataFrame, columns: Sequence[str] = ("content",)) -> DataFrame:
    """Mask what the entity patterns find; runs without Python."""
    for column in columns:
        found = span_values(detect_spans(F.col(column)))
        df = _masked(df, column, found, F.lit(True))
    return df


def mask_by_detector(
    df: DataFrame,
    make_detector: Callable[[], Detector],
    columns: Sequence[str] = ("content",),
    language: Column | None = None,
    **options,
) -> DataFrame:
    """Mask what a detector finds. A text whose calls keep failing stays as it is and
    is marked by `_pii_ok = false`."""
    for column in columns:
        step = df.withColumn(
            "_detected", detect_with(make_detector, F.col(column), language, **options)
        )
        df = _masked(step, column, F.col("_detected.values"), F.col("_detected.ok")).drop(
            "_detected"
        )
    return df


def mask_by_values(df: DataFrame, values: Column, column: str = "content") -> DataFrame:
    """Mask values that are already at hand, e.g. parsed from landed model replies."""
    return _masked(df, column, values, F.lit(True))


def detect_names(
    rows: DataFrame,
    names: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLDS["PERSON"],
) -> DataFrame:
    """PERSON hits of a name dictionary (name, score): key, value, hits, score.

    Names may have several words, apostrophes and hyphens; what counts is the leftmost and
    longest name, see `names.find_names`.
    """
    found = find_names(rows, names, text, key, threshold)
    return found.groupBy(key, "value").agg(F.sum("copies").alias("hits"), F.max("score").alias("score"))


def split_unmasked(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit to write, rows held back because detection failed)."""
    return df.where(F.col(MASKED_OK)), df.where(~F.col(MASKED_OK))


def mask_counters() -> list[Column]:
    """Aggregates over masked rows: values, occurrences, documents, failures."""
    return [
        F.coalesce(F.sum(VALUES), F.lit(0)).cast("bigint").alias("pii_values_masked"),
        F.coalesce(F.sum(OCCURRENCES), F.lit(0)).cast("bigint").alias("pii_occurrences_masked"),
        F.count_if(F.col(OCCURRENCES) > 0).alias("pii_docs_with_pii"),
        F.count_if(~F.col(MASKED_OK)).alias("pii_failures"),
    ]
