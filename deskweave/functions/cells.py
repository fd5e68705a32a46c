"""Cells of a landed record: {"value", "display_value"}, a bare string, or nothing.

Cells are read as VARIANT, so the JSON is parsed once and the two shapes can be
told apart without guessing from the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_present, or_empty, strip


def _text_at(cell: Column, path: str) -> Column:
    """String at `path`, null when something else (or nothing) is there."""
    kind = F.schema_of_variant(F.try_variant_get(cell, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(cell, path, "string"))


def _cell_text(cell: Column, field: str) -> Column:
    kind = F.schema_of_variant(cell)
    picked = F.when(
        kind.startswith("OBJECT"), F.try_variant_get(cell, f"$.{field}", "string")
    ).when(kind == "STRING", F.try_variant_get(cell, "$", "string"))
    return strip(or_empty(picked))


def cell_value(cell: Column) -> Column:
    """Raw value of a cell, '' when there is none."""
    return _cell_text(cell, "value")


def cell_label(cell: Column) -> Column:
    """Readable value of a cell, '' when there is none."""
    return _cell_text(cell, "display_value")


def value_or_label(cell: Column) -> Column:
    return first_present(cell_value(cell), cell_label(cell))


def label_or_value(cell: Column) -> Column:
    return first_present(cell_label(cell), cell_value(cell))


def json_values(reply: Column, key: str = "pii") -> Column:
    """Values listed in a model reply {"<key>": [...]}.

    Items are strings or objects holding the string under value, text or pii.
    Blank items, items of another type and unreadable replies give nothing.
    """
    listed = F.try_variant_get(F.try_parse_json(reply), f"$.{key}", "array<variant>")

    def item_text(item: Column) -> Column:
        names = ("$", "$.value", "$.text", "$.pii")
        return F.coalesce(*[F.nullif(_text_at(item, n), F.lit("")) for n in names])

    found = F.filter(
        F.transform(listed, lambda item: item_text(item)),
        lambda v: v.isNotNull() & (strip(v) != ""),
    )
    return F.coalesce(found, F.array().cast("array<string>"))
