"""Source date-times are GMT text; inside Spark they are timestamp_ntz, free of zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GMT_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
_MARK_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}(\s+\d{1,2}:\d{1,2}:\d{1,2})?$"


def parse_gmt(c: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS' -> timestamp_ntz; blank or unreadable -> null."""
    return F.when(c.rlike(_GMT_TEXT), c.try_cast("timestamp_ntz"))


def parse_mark(c: Column) -> Column:
    """Like parse_gmt, and a date alone means midnight."""
    return F.when(c.rlike(_MARK_TEXT), c.try_cast("timestamp_ntz"))


def format_gmt(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def iso_z(ts: Column) -> Column:
    """Timestamp -> ISO 8601 text with a Z suffix, null stays null."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def gmt_to_iso_z(c: Column) -> Column:
    return iso_z(parse_gmt(c))


def minus_minutes(ts: Column, minutes: int) -> Column:
    """Move a mark back by the read overlap; null stays null."""
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))
