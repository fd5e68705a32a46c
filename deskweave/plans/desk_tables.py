"""Ticket records derived from the generic test tables.

documents give the ticket texts and groups, orders the state and priority, events the
times and severities, conversations the journals. Orders and events, of which there are
more, are dealt to the tickets by their keys, and each ticket takes the dearest order and
the event of most value of its own. Only the tables whose columns are asked for are
joined. All joins are left joins on unique keys, so the number of tickets does not depend
on the columns. Tickets that are to be put into pages are joined by page, so that their
texts are exchanged once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import format_gmt

BASE_URL = "https://desk.example.com"
PAGE_RECORDS = 200

FROM_ORDERS = ("state", "priority", "cmdb_ci")
FROM_EVENTS = ("impact", "urgency", "closed_at", "resolved_at", "sys_updated_on", "updated_at")
FROM_CONVERSATIONS = ("close_notes", "work_notes", "comments")
FROM_DOCUMENTS = (
    "doc_id",
    "sys_id",
    "number",
    "short_description",
    "description",
    "assignment_group",
    "assignment_group_name",
)
ALL_COLUMNS = FROM_DOCUMENTS + FROM_ORDERS + FROM_EVENTS + FROM_CONVERSATIONS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return table(spark, sf_dir, "documents")


def ticket_number(doc_id: Column) -> Column:
    """INC0000042; every 50th number has a slash and a blank, to be cleaned for the key."""
    plain = F.format_string("%07d", doc_id)
    return F.when(doc_id % 50 == 7, F.concat(F.lit("INC/"), plain, F.lit(" A"))).otherwise(
        F.concat(F.lit("INC"), plain)
    )


def secret(doc_id: Column) -> Column:
    """A credential of one of three kinds, or none."""
    text = doc_id.cast("string")
    return (
        F.when(doc_id % 4 == 0, F.concat(F.lit(" password=P"), text))
        .when(doc_id % 4 == 1, F.concat(F.lit(" IDENTIFIED BY Pw"), text, F.lit(";")))
        .when(doc_id % 4 == 2, F.concat(F.lit(" scott/Tiger"), text, F.lit("@db:1521/SALES")))
        .otherwise("")
    )


def _journals(conversations: DataFrame) -> DataFrame:
    """One row per conversation with all its turns, in order; bounded by the conversation."""

    def of(role: str) -> Column:
        turns = F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))
        return F.array_join(F.transform(F.array_sort(turns), lambda t: t["text"]), "|")

    last = F.when(F.col("role") == "assistant", F.struct("turn", "text"))
    return conversations.groupBy(F.col("conv_id").alias("journal_id")).agg(
        F.max(last)["text"].alias("close_notes"),
        of("assistant").alias("work_notes"),
        of("user").alias("comments"),
    )


def _one_each(rows: DataFrame, key: str, weight: str, documents: Column) -> DataFrame:
    """All rows dealt to the tickets by key; each ticket keeps the one of most weight."""
    best = F.max_by(F.struct(*rows.columns), F.struct(weight, key))
    return rows.groupBy((F.col(key) % documents).alias("doc_id")).agg(best.alias("r"))


def _parts(
    spark: SparkSession, sf_dir: str, wanted: set[str]
) -> tuple[DataFrame, list[DataFrame]]:
    """What the documents give, and what the other tables give to some doc_id, a row for each."""
    doc_id, parts = F.col("doc_id"), []
    documents = texts(spark, sf_dir)
    tickets = documents.agg(F.count(F.lit(1))).scalar()
    rows = documents.select(
        doc_id,
        F.md5(doc_id.cast("string")).alias("sys_id"),
        ticket_number(doc_id).alias("number"),
        F.concat_ws(" ", F.lit("Report from"), "source", F.lit("in"), "lang").alias(
            "short_description"
        ),
        F.concat(F.col("text"), secret(doc_id)).alias("description"),
        F.col("source").alias("assignment_group"),
        F.concat(F.lit("HD "), F.col("source")).alias("assignment_group_name"),
    )
    if wanted & set(FROM_ORDERS):
        used = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
        orders = table(spark, sf_dir, "orders").select(*used)
        orders = _one_each(orders, "o_orderkey", "o_totalprice", tickets)
        orders = orders.select("doc_id", "r.*").select(
            "doc_id",
            F.when(F.col("o_orderstatus") == "F", "6")
            .when(F.col("o_orderstatus") == "P", "7")
            .otherwise("2")
            .alias("state"),
            F.col("o_orderpriority").alias("priority"),
            F.concat(F.lit("ci"), (F.col("o_custkey") % 10).cast("string")).alias("cmdb_ci"),
        )
        parts.append(orders)
    if wanted & set(FROM_EVENTS):
        event_id, text = F.col("event_id"), format_gmt(F.col("ts"))
        events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
        events = _one_each(events, "event_id", "value", tickets)
        events = events.select("doc_id", "r.*").select(
            "doc_id",
            F.col("event_type").alias("impact"),
            F.when(F.col("value") < 10, "1 - High")
            .when(F.col("value") < 50, "2 - Medium")
            .otherwise("3 - Low")
            .alias("urgency"),
            F.when(event_id % 97 == 5, "not-a-date")
            .when(event_id % 97 == 6, "")
            .otherwise(text)
            .alias("closed_at"),
            text.alias("resolved_at"),
            text.alias("sys_updated_on"),
            F.col("ts").alias("updated_at"),
        )
        parts.append(events)
    if wanted & set(FROM_CONVERSATIONS):
        conversations = table(spark, sf_dir, "conversations")
        count = conversations.agg(F.count_distinct("conv_id")).scalar()
        # journals go to the tickets' numbers, so that ticket texts are dealt once, by doc_id
        numbers = documents.select(doc_id, (doc_id % count).alias("journal_id")).distinct()
        journals = numbers.join(_journals(conversations), "journal_id").drop("journal_id")
        parts.append(journals)
    return rows, parts


def incidents(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = ALL_COLUMNS
) -> DataFrame:
    """Flat ticket records with the columns asked for."""
    rows, parts = _parts(spark, sf_dir, set(columns))
    for part in parts:
        rows = rows.join(part, "doc_id", "left")
    return rows.select(*columns)


def incidents_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat ticket records with all columns, and `page`, by which they are dealt.

    What the other tables give comes as one map per page, of at most 200 tickets, so the
    records are joined and then grouped by page in one exchange of the texts.
    """
    page = F.floor(F.col("doc_id") / PAGE_RECORDS).alias("page")
    rows, parts = _parts(spark, sf_dir, set(ALL_COLUMNS))
    rows = rows.select(page, "*")
    for part in parts:
        given = F.struct(*[c for c in part.columns if c != "doc_id"])
        each = F.map_from_entries(F.collect_list(F.struct("doc_id", given))).alias("given")
        held = part.where("doc_id IS NOT NULL").groupBy(page).agg(each)
        own = F.try_element_at(F.col("given"), F.col("doc_id")).alias("own")
        rows = rows.join(held, "page", "left").select(*rows.columns, own).select(*rows.columns, "own.*")
    return rows.select("page", *ALL_COLUMNS)


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group dimension: one row per source of the documents."""
    return (
        table(spark, sf_dir, "documents")
        .groupBy(F.col("source").alias("sys_id"))
        .agg(F.count(F.lit(1)).alias("tickets"))
        .select(
            "sys_id",
            F.concat(F.lit("HD "), F.col("sys_id")).alias("name"),
            (~F.col("sys_id").contains("5")).alias("active"),
        )
    )
