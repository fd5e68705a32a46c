"""Columns that are too expensive to compute twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like withColumns, but later filters on these columns are not rewritten into
    their expressions.

    Catalyst moves a filter below a projection by repeating the expression in the
    filter. For a document composed from redacted texts that repeats every regex many
    times over. It does not do so for the output of a generator, hence the one-element
    array; filters on all other columns still reach the scan.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(packed)))
