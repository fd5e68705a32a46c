"""String helpers: trimming, keys, links, headers, content, truncation, previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip() removes (Spark's trim removes blanks only).
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Limits and labels that decide what a document looks like.
MAX_FIELD_BYTES = 30_000
PREVIEW_MARK = " […]"
PART_LABELS = {
    "short_description": "Problema",
    "description": "Descrizione",
    "resolution": "Risoluzione",
    "work_notes": "Note di lavorazione",
    "comments": "Commenti",
}


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(BLANKS))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_present(*cols: Column) -> Column:
    """First argument that is neither null nor empty, otherwise ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def document_key(number: Column) -> Column:
    """Ticket number -> corpus key: anything outside [A-Za-z0-9_-=] becomes '_'."""
    return F.regexp_replace(strip(number), r"[^A-Za-z0-9_\-=]", "_")


def ticket_url(base_url: str, sys_id: Column, number: Column) -> Column:
    """Deep link by record key, else a lookup by number, else ''."""
    base = base_url.rstrip("/")
    if not base:
        return F.lit("")
    by_key = F.concat(F.lit(f"{base}/nav_to.do?uri=incident.do?sys_id="), sys_id)
    by_number = F.concat(F.lit(f"{base}/incident.do?sysparm_query=number="), number)
    return F.when(sys_id != "", by_key).when(number != "", by_number).otherwise("")


def _when_filled(c: Column, shown: Column) -> Column:
    return F.when(c != "", shown)


def header(number: Column, group_name: Column, closed_day: Column, url: Column) -> Column:
    """Citation line; absent parts are left out (concat_ws skips nulls)."""
    return F.concat_ws(
        " | ",
        _when_filled(number, F.concat(F.lit("Ticket "), number)),
        _when_filled(group_name, F.concat(F.lit("Gruppo: "), group_name)),
        _when_filled(closed_day, F.concat(F.lit("Chiuso: "), closed_day)),
        _when_filled(url, F.concat(F.lit("Link: "), url)),
    )


def content(header_line: Column, parts: dict[str, Column]) -> Column:
    """Header plus the labelled non-empty parts, separated by blank lines."""
    labelled = [
        _when_filled(parts[name], F.concat(F.lit(f"{label}: "), parts[name]))
        for name, label in PART_LABELS.items()
        if name in parts
    ]
    return strip(F.concat_ws("\n\n", _when_filled(header_line, header_line), *labelled))


def truncate_bytes(c: Column, max_bytes: int = MAX_FIELD_BYTES) -> Column:
    """Longest prefix of at most `max_bytes` UTF-8 bytes that splits no character.

    A UTF-8 character has at most four bytes, so one of the four cuts is valid.
    Only values over the limit evaluate the candidates.
    """
    raw = F.encode(c, "UTF-8")
    cuts = [
        F.try_validate_utf8(F.substring(raw, 1, max_bytes - k).cast("string"))
        for k in range(min(4, max_bytes + 1))
    ]
    return F.when(F.octet_length(c) <= max_bytes, c).otherwise(F.coalesce(*cuts))


def truncate_chars(c: Column, max_chars: int) -> Column:
    return F.when(F.length(c) > max_chars, F.substring(c, 1, max_chars)).otherwise(c)


def truncate_tokens(c: Column, max_tokens: int) -> Column:
    """Keep the first `max_tokens` blank-separated tokens of a model input."""
    tokens = F.split(c, r"(?U)\s+")
    return F.when(
        F.size(tokens) > max_tokens,
        F.array_join(F.slice(tokens, 1, max_tokens), " "),
    ).otherwise(c)


def one_line(c: Column) -> Column:
    return F.translate(c, "\r\n", "  ")


def preview(c: Column, max_chars: int) -> Column:
    """One-line preview with a mark where text was cut."""
    flat = one_line(c)
    return F.when(
        F.length(flat) > max_chars,
        F.concat(F.substring(flat, 1, max_chars), F.lit(PREVIEW_MARK)),
    ).otherwise(flat)


def words(c: Column) -> Column:
    """Lower-cased runs of letters and digits, the unit of full-text search."""
    parts = F.split(F.lower(or_empty(c)), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
