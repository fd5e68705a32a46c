"""Reading the corpus: counts, lookups, visible columns, filters, sorts, facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import all_of
from .schema import corpus_schema, flag, flagged

FACETS = ("assignment_group_name", "priority", "impact", "urgency")


def _declared(df: DataFrame) -> dict[str, T.StructField]:
    """Fields with flags: those of the table when it has them, else the declared ones."""
    known = {f.name: f for f in corpus_schema().fields}
    return {f.name: (f if f.metadata else known.get(f.name, f)) for f in df.schema.fields}


def count_documents(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("documents"))


def by_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col("id") == key)


def get_document(df: DataFrame, key: str) -> Row:
    """The visible document with this key; KeyError when there is none."""
    rows = by_key(visible(df), key).take(1)
    if not rows:
        raise KeyError(key)
    return rows[0]


def visible(df: DataFrame) -> DataFrame:
    """Only the columns a reader may see."""
    fields = _declared(df)
    return df.select(
        *[c for c in df.columns if not c.startswith("_") and flag(fields[c], "retrievable")]
    )


def select_sorted(
    df: DataFrame,
    equals: Mapping[str, Sequence[str]] | None = None,
    sort: Sequence[tuple[str, bool]] = (),
    between: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """Filter by values or ranges and sort, on fields flagged for it only.

    `sort` is a list of (field, descending).
    """
    schema = T.StructType(list(_declared(df).values()))
    may_filter, may_sort = set(flagged(schema, "filterable")), set(flagged(schema, "sortable"))
    equals, between = equals or {}, between or {}
    refused = [c for c in [*equals, *between] if c not in may_filter]
    refused += [c for c, _ in sort if c not in may_sort]
    if refused:
        raise ValueError(f"fields not flagged for this use: {refused}")
    clauses = [F.col(c).isin(*values) for c, values in equals.items()]
    for c, (low, high) in between.items():
        if low is not None:
            clauses.append(F.col(c) >= low)
        if high is not None:
            clauses.append(F.col(c) < high)
    rows = df.where(all_of(clauses))
    if sort:
        order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in sort]
        rows = rows.orderBy(*order, "id")
    return rows


def facets(
    df: DataFrame, fields: Sequence[str] = FACETS, by: Sequence[str] = ()
) -> DataFrame:
    """(facet, value, documents) of all fields in one pass over the table, per `by`."""
    grouped = df.groupingSets([[*by, f] for f in fields], *by, *fields).agg(
        F.count(F.lit(1)).alias("documents"), F.grouping_id().alias("_set")
    )
    width = len(fields)
    # bit i (from the left) of the grouping id is 0 for the field of the set
    ids = {((1 << width) - 1) ^ (1 << (width - 1 - i)): f for i, f in enumerate(fields)}
    name = F.coalesce(*[F.when(F.col("_set") == i, F.lit(f)) for i, f in ids.items()])
    value = F.coalesce(*[F.when(F.col("_set") == i, F.col(f)) for i, f in ids.items()])
    return grouped.select(*by, name.alias("facet"), value.alias("value"), "documents")
