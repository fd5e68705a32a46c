"""Connected components by alternating large-star and small-star rounds (native).

Each round rewires edges towards the smallest neighbour until every component is a star
around its smallest node. Minima are pre-aggregated before the shuffle, and the join that
follows has one row per node on its right side, so a node with very many edges is split by
Spark's skew handling. Rounds are stored in the shared folder; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored

MAX_ROUNDS = 60


def _with_min(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with `m`, the smallest of a and all its b."""
    lowest = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    joined = edges.join(lowest, F.col("a") == F.col("n"))
    return joined.select("a", "b", F.least("a", "m").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _with_min(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    small = _with_min(down)
    moved = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = small.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `edges` (a, b): root is the smallest node reachable.

    Loops and repeated edges do no harm; edges with a null end are ignored; an empty table
    gives no rows.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, seen = stored(down.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        mark = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen, earlier = tuple(mark), state
        state = stored(_round(earlier), "edges")
        drop_stored(earlier)
    else:
        raise RuntimeError(f"components not found in {MAX_ROUNDS} rounds")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
