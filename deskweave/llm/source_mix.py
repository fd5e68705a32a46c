"""Systematic sampling of documents to target weights per source (native).

Every source gets a share of the corpus by weight, capped at a multiple of its own size; what
the cap cuts off is shared again among the other sources. A document then expects
`target / source size` copies. Within a source the expected copies are summed in the order of
(size, hash of the id); one random offset per source is added, and a document is emitted once
for every integer its interval crosses. Ordering by size makes the words taken follow the
target closely.

Ranks never need a source in one task: documents are ranked in groups of one source, one size
and one of 4096 hash bins, and the groups are counted and summed in two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix"

_GROUP = ("_source", "_size", "_bin")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """One row per source: `_source`, `source_size`, `target`.

    `sizes` has `_source` and `_size`. Weights repeat over the sources in code point order,
    null last. With the sources ordered by cap / weight, the level that the rest would share
    grows as long as the next source is capped and falls afterwards, so its maximum is the
    level of all uncapped sources. The windows run over one row per source.
    """
    totals = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at.cast("int"))
    cap = (F.col("source_size") * max_copies).cast("double")
    by_ratio = Window.orderBy("_ratio", F.col("_source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(after)
    return (
        totals.withColumns({"_weight": weight, "_cap": cap})
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(whole))
        .select(
            "_source",
            "source_size",
            F.least("_cap", F.col("_level") * F.col("_weight")).alias("target"),
        )
    )


def _offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\0"))))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("double") / float(2**24)


def with_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """`docs` (columns `keep`, all by default) with `size`, `source_size`, `target`, `copies`.

    Null texts have size 0, a null source is a source of its own. Repeated rows are rows like
    any other and share the expected copies. Sources without words get no copies. Columns of
    `docs` named like one of the four new ones are replaced. An empty table gives no rows.
    """
    made = ("size", "source_size", "target", "copies")
    kept = [c for c in (keep or docs.columns) if c not in made]
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_doc"),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("_key"),
    ).withColumn("_bin", F.substring("_key", 1, 3))

    groups = stored(row.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_n")), "mix")
    in_size = Window.partitionBy("_source", "_size").orderBy("_bin")
    in_source = Window.partitionBy("_source").orderBy("_size")
    rows_before = (Window.unboundedPreceding, -1)
    sizes = (
        groups.groupBy("_source", "_size")
        .agg(F.sum("_n").alias("_n"))
        .withColumn(
            "_smaller", F.coalesce(F.sum("_n").over(in_source.rowsBetween(*rows_before)), F.lit(0))
        )
        .drop("_n")
    )
    targets = source_targets(
        groups.select("_source", (F.col("_size") * F.col("_n")).alias("_size")), weights, max_copies
    )
    starts = (
        groups.withColumn(
            "_earlier", F.coalesce(F.sum("_n").over(in_size.rowsBetween(*rows_before)), F.lit(0))
        )
        .join(
            sizes.withColumnsRenamed({"_source": "s_source", "_size": "s_size"}),
            F.col("_source").eqNullSafe(F.col("s_source")) & (F.col("_size") == F.col("s_size")),
        )
        .join(
            targets.withColumnRenamed("_source", "t_source"),
            F.col("_source").eqNullSafe(F.col("t_source")),
        )
        .select(
            F.col("_source").alias("g_source"),
            F.col("_size").alias("g_size"),
            F.col("_bin").alias("g_bin"),
            (F.col("_smaller") + F.col("_earlier")).alias("_start"),
            "source_size",
            "target",
        )
    )
    in_group = Window.partitionBy(*_GROUP).orderBy("_key", *_tie_break(row))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = F.col("_start") + F.col("_row")
    offset = _offset(F.col("_source"), seed)
    copies = F.floor(offset + upto * rate) - F.floor(offset + (upto - 1) * rate)
    return (
        row.withColumn("_row", F.row_number().over(in_group))
        .join(
            starts,
            F.col("_source").eqNullSafe(F.col("g_source"))
            & (F.col("_size") == F.col("g_size"))
            & (F.col("_bin") == F.col("g_bin")),
        )
        .select(
            "_doc.*",
            F.col("_size").alias("size"),
            F.col("source_size"),
            F.col("target"),
            F.least(copies, F.lit(max_copies)).cast("long").alias("copies"),
        )
    )


def _tie_break(row: DataFrame) -> list[Column]:
    """A fixed order of rows that share id and size; map columns cannot be hashed."""
    fields = row.schema["_doc"].dataType.fields
    plain = [f.name for f in fields if f.dataType.typeName() not in ("map", "variant")]
    return [F.xxhash64(*[F.col(f"_doc.`{c}`") for c in plain])] if plain else []


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as its copies say, in the columns of `docs`."""
    found = with_copies(docs, **options)
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return found.withColumn("_copy", times).select(*docs.columns)
