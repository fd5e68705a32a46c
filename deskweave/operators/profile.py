"""Profiles and summaries used to decide what is worth indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import label_or_value
from ..functions.text import one_line, or_empty, preview
from ..sources.lists import MAX_QUESTION_CHARS, MAX_QUESTIONS

PREVIEW_CHARS = 80


def field_states(
    records: DataFrame,
    fields: Sequence[str],
    preview_chars: int = PREVIEW_CHARS,
    by: Sequence[str] = (),
    sketches: bool = False,
) -> DataFrame:
    """Mergeable state of each field, a row per field and group of `by`.

    All fields are aggregated at once, so a row is neither repeated per field nor sorted;
    only the results, a row per group, are turned into rows per field.
    """
    kinds = dict(records.dtypes)
    texts, states = [], []
    for i, name in enumerate(fields):
        present, text = F.lit(False), F.lit("")
        if name in kinds:
            cell = F.col(name)
            present = cell.isNotNull()
            shown = label_or_value(cell) if kinds[name] == "variant" else cell.cast("string")
            text = one_line(or_empty(shown))
        texts += [present.alias(f"_p{i}"), text.alias(f"_t{i}")]
        text, length = F.col(f"_t{i}"), F.length(f"_t{i}")
        filled = length > 0
        # one character more than is shown tells whether there are more
        start = F.substring(text, 1, preview_chars + 1)
        state = {
            "present": F.count_if(F.col(f"_p{i}")),
            "filled": F.count_if(filled),
            "max_length": F.max(length).cast("bigint"),
            "chars": F.sum(length),
            "example": F.min(F.when(filled, preview(start, preview_chars))),
        }
        if sketches:
            state["values_sketch"] = F.hll_sketch_agg(F.when(filled, text))
            state["lengths_sketch"] = F.kll_sketch_agg_bigint(F.when(filled, length.cast("bigint")))
        states.append(F.struct(*[c.alias(n) for n, c in state.items()]).alias(f"_f{i}"))
    wide = records.select(*by, *texts).groupBy(*by)
    wide = wide.agg(F.count(F.lit(1)).alias("records"), *states).where("records > 0")
    rows = [
        F.struct(F.lit(name).alias("field"), F.col("records"), *[F.col(f"_f{i}.{n}") for n in state])
        for i, name in enumerate(fields)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def merged_profile(states: DataFrame, sketches: bool = False) -> DataFrame:
    """Profile out of the states of any parts of a table."""
    totals = [
        F.sum("records").alias("records"),
        F.sum("present").alias("present"),
        F.sum("filled").alias("filled"),
        F.max("max_length").alias("max_length"),
        F.round(F.sum("chars") / F.sum("records"), 6).alias("avg_length"),
        F.min("example").alias("example"),
    ]
    if not sketches:
        return states.groupBy("field").agg(*totals)
    merged = states.groupBy("field").agg(
        *totals,
        F.hll_sketch_estimate(F.hll_union_agg("values_sketch")).alias("approx_values"),
        F.kll_merge_agg_bigint(F.when(F.col("filled") > 0, F.col("lengths_sketch"))).alias("_lengths"),
    )
    median = F.when(F.col("filled") > 0, F.kll_sketch_get_quantile_bigint("_lengths", F.lit(0.5)))
    return merged.withColumn("median_length", median).drop("_lengths")


def field_profile(
    records: DataFrame, fields: Sequence[str] | None = None, preview_chars: int = PREVIEW_CHARS
) -> DataFrame:
    """Per field: rows that have it, filled rows, lengths, and one example.

    Takes landed records (VARIANT cells) or any table of text columns.
    """
    fields = list(dict.fromkeys(fields or records.columns))
    states = field_states(records, fields, preview_chars)
    average = F.round(F.col("chars") / F.col("records"), 6).alias("avg_length")
    return states.select("field", "records", "present", "filled", "max_length", average, "example")


def sample_summary(records: DataFrame) -> DataFrame:
    """Rows of a sample and the newest update among them."""
    return records.agg(
        F.count(F.lit(1)).alias("records"), F.max("updated_at").alias("last_update")
    )


def evaluation_limits(questions: DataFrame, text: str = "question") -> DataFrame:
    """One row: size of a question set and whether it keeps the limits."""
    chars = F.length(text)
    summary = questions.agg(
        F.count(F.lit(1)).alias("questions"),
        F.max(chars).cast("bigint").alias("longest"),
        F.count_if(chars > MAX_QUESTION_CHARS).alias("too_long"),
    )
    return summary.withColumn(
        "within_limits", (F.col("questions") <= MAX_QUESTIONS) & (F.col("too_long") == 0)
    )
