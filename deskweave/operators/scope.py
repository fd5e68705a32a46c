"""Which records belong to a run: states, groups, items, and the delta predicate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minus_minutes, parse_mark
from ..functions.text import all_of, any_of

# States that mean closed, and the minutes a delta reads back.
CLOSED_STATES = ("6", "7")
OVERLAP_MINUTES = 15


@dataclass(frozen=True)
class Scope:
    closed_states: Sequence[str] = CLOSED_STATES
    groups: Sequence[str] = field(default_factory=tuple)
    items: Sequence[str] = field(default_factory=tuple)
    overlap_minutes: int = OVERLAP_MINUTES

    def __post_init__(self) -> None:
        if not self.closed_states:
            raise ValueError("closed_states must not be empty")

    def require_filters(self) -> Scope:
        """Refuse an unscoped run: both optional lists must be given."""
        for name in ("groups", "items"):
            if not getattr(self, name):
                raise ValueError(f"{name} is empty: refusing to extract without this filter")
        return self

    def condition(self) -> Column:
        """State clause, plus one clause per list that is not empty."""
        clauses = [F.col("state").isin(*self.closed_states)]
        if self.groups:
            clauses.append(F.col("assignment_group").isin(*self.groups))
        if self.items:
            clauses.append(F.col("cmdb_ci").isin(*self.items))
        return all_of(clauses)


def since(mark: str, overlap_minutes: int = 0, column: str = "updated_at") -> Column:
    """Rows updated at or after the mark, moved back by the overlap."""
    return F.col(column) >= minus_minutes(parse_mark(F.lit(mark)), overlap_minutes)


def in_scope(
    records: DataFrame, scope: Scope, mark: str | None = None, overlap_minutes: int = 0
) -> DataFrame:
    """Scope filter, and the delta predicate when there is a mark."""
    chosen = records.where(scope.condition())
    return changed_since(chosen, mark, overlap_minutes) if mark else chosen


def changed_since(records: DataFrame, mark: str, overlap_minutes: int = 0) -> DataFrame:
    """Rows at or after the mark. Landed records are kept by update day: days before the mark
    are not listed. Undated rows never match."""
    chosen = records.where(since(mark, overlap_minutes))
    if "updated_day" in records.columns:
        bound = minus_minutes(parse_mark(F.lit(mark)), overlap_minutes)
        chosen = chosen.where(F.col("updated_day") >= F.to_date(bound))
    return chosen


def in_groups(records: DataFrame, groups: DataFrame, key: str = "sys_id") -> DataFrame:
    """Scope by a group table instead of a list."""
    keys = groups.select(F.col(key).alias("assignment_group")).distinct()
    return records.join(keys, "assignment_group", "left_semi")


def with_group_labels(records: DataFrame, groups: DataFrame) -> DataFrame:
    """Attach the readable group name; records of unknown groups keep null."""
    labels = groups.select(
        F.col("sys_id").alias("assignment_group"), F.col("name").alias("group_label")
    ).dropDuplicates(["assignment_group"])
    return records.join(labels, "assignment_group", "left")


def find_groups(groups: DataFrame, terms: Sequence[str] = (), everything: bool = False) -> DataFrame:
    """Active groups whose name contains one of the terms, by name."""
    clauses = [F.col("active")]
    if not everything:
        clauses.append(any_of([F.col("name").contains(t) for t in terms]))
    return groups.where(all_of(clauses)).orderBy("name", "sys_id")


def by_number(records: DataFrame, number: str) -> DataFrame:
    return records.where(F.col("number") == number)


def first_by_update(records: DataFrame, n: int) -> DataFrame:
    """First n rows in update order (undated first); ties by record key."""
    return records.orderBy(F.asc_nulls_first("updated_at"), "sys_id", "number").limit(n)
