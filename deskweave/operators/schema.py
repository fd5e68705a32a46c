"""The corpus schema as data: types, and per-field flags kept as column metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fields of a document with the flags declared for them.
# key / searchable / filterable / sortable / facetable / retrievable; a flag that is
# not declared is left out, and an undeclared "retrievable" counts as true.
FIELD_FLAGS: dict[str, dict[str, bool]] = {
    "id": {
        "key": True,
        "searchable": False,
        "filterable": True,
        "sortable": False,
        "facetable": False,
    },
    "number": {"searchable": True, "filterable": True, "sortable": True, "retrievable": True},
    "url": {"searchable": False, "retrievable": True},
    "short_description": {"searchable": True, "retrievable": True},
    "description": {"searchable": True, "retrievable": False},
    "resolution": {"searchable": True, "retrievable": False},
    "work_notes": {"searchable": True, "retrievable": False},
    "comments": {"searchable": True, "retrievable": False},
    "content": {"searchable": True, "retrievable": True},
    "assignment_group": {"filterable": True, "retrievable": True},
    "assignment_group_name": {
        "searchable": True,
        "filterable": True,
        "facetable": True,
        "retrievable": True,
    },
    "priority": {"filterable": True, "facetable": True, "retrievable": True},
    "impact": {"filterable": True, "facetable": True, "retrievable": True},
    "urgency": {"filterable": True, "facetable": True, "retrievable": True},
    "closed_at": {"filterable": True, "sortable": True, "retrievable": True},
    "contentVector": {"searchable": True, "retrievable": False},
}
VECTOR_FIELD = "contentVector"
DEFAULT_DIMENSIONS = 1536
_FLAGS = ("key", "searchable", "filterable", "sortable", "facetable", "retrievable")

# Technical columns stored with a document; never shown to a reader of the corpus.
UPDATED = "_updated_at"
MASKED_OK = "_pii_ok"


def corpus_schema(dimensions: int = DEFAULT_DIMENSIONS) -> T.StructType:
    fields = []
    for name, flags in FIELD_FLAGS.items():
        meta: dict = dict(flags)
        kind: T.DataType = T.StringType()
        if name == "closed_at":
            kind = T.TimestampNTZType()
        elif name == VECTOR_FIELD:
            kind = T.ArrayType(T.FloatType())
            meta["dimensions"] = dimensions
        fields.append(T.StructField(name, kind, True, meta))
    hidden = {"retrievable": False}
    fields.append(T.StructField(UPDATED, T.TimestampNTZType(), True, hidden))
    fields.append(T.StructField(MASKED_OK, T.BooleanType(), True, hidden))
    return T.StructType(fields)


def flag(field: T.StructField, name: str) -> bool:
    """Declared flag, with the default the store applies to undeclared ones."""
    return bool(field.metadata.get(name, name == "retrievable"))


def flagged(schema: T.StructType, name: str) -> list[str]:
    return [f.name for f in schema.fields if flag(f, name)]


def describe_schema(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per field: type, dimensions and the six flags."""
    rows = [
        (f.name, f.dataType.simpleString(), f.metadata.get("dimensions"))
        + tuple(flag(f, name) for name in _FLAGS)
        for f in schema.fields
        if not f.name.startswith("_")
    ]
    flags = ", ".join(f"`{name}` boolean" for name in _FLAGS)
    return spark.createDataFrame(rows, f"name string, type string, dimensions int, {flags}")


def evolved_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """`new` when it only adds fields to `old`; dropped or retyped fields are refused."""
    wanted = {f.name: f for f in new.fields}
    dropped = [f.name for f in old.fields if f.name not in wanted]
    retyped = [
        f.name
        for f in old.fields
        if f.name in wanted and wanted[f.name].dataType != f.dataType
    ]
    if dropped or retyped:
        raise ValueError(f"schema can only grow; dropped: {dropped}, retyped: {retyped}")
    kept = [wanted[f.name] for f in old.fields]
    known = set(old.names)
    return T.StructType(kept + [f for f in new.fields if f.name not in known])
