"""Top-k over vectors for many queries at once: exact, and by an index of cells.

Exact: the queries are sent to all tasks in blocks of a counted size; each task multiplies its
rows with a block and passes on the k best of each query.

Index: k-means centres are fitted on a bounded sample, every row is stored in the folder of its
nearest centre, and a search joins queries and rows of the nearest cells only. How many cells
that takes depends on the vectors, so it is measured on the sample when the index is built: few
where vectors lie in clusters, about half where they point everywhere. Rows of a cell
are joined in slices, queries in parts, so that neither a hot cell nor many queries of one
place grow what a task holds.

Scores are cosines rounded to six digits; ties go by key. Vectors that are missing, empty, of
length zero or of another size than the queries are passed over, and so are rows without a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import VECTOR_FIELD
from .search import DIGITS, TOP

BLOCK_QUERIES = 2_048  # queries sent to all tasks at once, and
BLOCK_BYTES = 32 * 2**20  # their size
ROWS_AT_ONCE = 1_024  # rows multiplied at once, and
SCORES_AT_ONCE = 2**18  # scores, so that more queries make fewer rows
SAMPLE_ROWS = 20_000  # on which centres are fitted
MAX_CELLS = 1_024
SLICE_ROWS, PART_QUERIES = 8_192, 4_096  # of a cell that meet in one task
ITERATIONS = 8
RECALL = 0.95  # that the number of cells a search reads is chosen for
TRIED_QUERIES, TRIED_ROWS, TRIED_BYTES = 256, 5_000, 64 * 2**20  # of the sample, to choose it


def _units(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, and which rows of the column they are."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    usable = lengths == size if size else lengths > 0
    if not usable.any():
        return np.empty((0, size or 0)), np.flatnonzero(usable)
    values = pc.list_flatten(column.filter(pa.array(usable))).to_numpy(zero_copy_only=False)
    block = values.astype(np.float64).reshape(usable.sum(), -1)
    norms = np.linalg.norm(block, axis=1)
    good = np.isfinite(norms) & (norms > 0)
    return block[good] / norms[good, None], np.flatnonzero(usable)[good]


class _Best:
    """The k best (score, key) of each query among the rows seen so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, -np.inf)
        self.query = np.empty(0, np.int64)
        self.score, self.key = np.empty(0), None

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        """`scores` has a row per key and a column per query."""
        row, query = np.nonzero(scores >= self.least)
        if not len(row):
            return
        found = keys[row]
        key = found if self.key is None else np.concatenate([self.key, found])
        query = np.concatenate([self.query, query])
        score = np.concatenate([self.score, scores[row, query[len(self.query) :]]])
        order = np.lexsort((key, -score, query))
        query, score, key = query[order], score[order], key[order]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(query)) + 1))
        place = np.arange(len(query)) - np.repeat(starts, np.diff([*starts, len(query)]))
        last = place == self.k - 1
        self.least[query[last]] = score[last]
        self.query, self.score, self.key = query[place < self.k], score[place < self.k], key[place < self.k]


def _keys(column: pa.Array) -> np.ndarray:
    """Sortable keys; text sorts by code point, as Spark sorts it."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.array(column.cast(pa.string()).to_pylist(), dtype=str)


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _compare(held: _Best, keys: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> None:
    step = max(1, min(ROWS_AT_ONCE, SCORES_AT_ONCE // max(1, len(wanted))))
    for at in range(0, len(rows), step):
        scores = np.round(rows[at : at + step] @ wanted.T, DIGITS) + 0.0
        held.add(scores, keys[at : at + step])


def nearest_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    key: str = "id",
    column: str = VECTOR_FIELD,
    query_key: str = "qid",
    query_column: str = VECTOR_FIELD,
) -> DataFrame:
    """Exact top-k of every query: qid, rank, key, score.

    Blocks of queries are taken in the order of their keys; a block is bounded by a number and
    by bytes, and all rows are read once per block. A query that is itself a row finds itself.
    """
    asked = queries.select(F.col(query_key).alias("qid"), F.col(query_column).alias("v"))
    asked = asked.where(F.col("qid").isNotNull() & F.col("v").isNotNull())
    size = asked.agg(F.mode(F.size("v"))).first()[0]
    rows = vectors.select(F.col(key).alias("key"), F.col(column).alias("v")).where(F.col("key").isNotNull())
    types = (asked.schema["qid"].dataType, rows.schema["key"].dataType)
    schema = T.StructType(
        [T.StructField("qid", types[0]), T.StructField("key", types[1]), T.StructField("score", T.DoubleType())]
    )
    spark = vectors.sparkSession
    found = spark.createDataFrame([], schema)
    per_block = max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * (size or 1))))
    last = None
    while size:
        left = asked if last is None else asked.where(F.col("qid") > F.lit(last))
        block = left.orderBy("qid").limit(per_block).toArrow()
        if not block.num_rows:
            break
        last = block.column(0)[-1].as_py()
        wanted, own = _units(block.column(1).combine_chunks(), size)
        names = block.column(0).combine_chunks().take(pa.array(own))
        found = found.unionByName(_block(rows, wanted, names, k, schema))
    return _top(found, k).select("qid", "rank", F.col("key").alias(key), "score")


def _block(rows: DataFrame, wanted: np.ndarray, names: pa.Array, k: int, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = _Best(len(wanted), k), None
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                keys, column = batch.column(0).slice(at, ROWS_AT_ONCE), batch.column(1).slice(at, ROWS_AT_ONCE)
                units, own = _units(column, wanted.shape[1])
                if len(own) and len(wanted):
                    _compare(held, _keys(keys.take(pa.array(own))), units, wanted)
        if held.key is not None:
            yield pa.record_batch(
                [names.take(pa.array(held.query)), pa.array(held.key).cast(kind), pa.array(held.score)],
                ["qid", "key", "score"],
            )

    return rows.mapInArrow(run, schema)


def cells_needed(units: np.ndarray, centres: np.ndarray, k: int, target: float) -> int:
    """Nearest cells to read so that a share `target` of the k nearest rows is found."""
    asked = units[:TRIED_QUERIES]
    near = np.argsort(-(asked @ units.T), axis=1, kind="stable")[:, :k]
    order = np.argsort(-(asked @ centres.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None], axis=1)
    cell = (units @ centres.T).argmax(axis=1)
    # the own row is no evidence
    reached = np.sort(np.take_along_axis(place, cell[near[:, 1:]], axis=1).ravel())
    return int(reached[min(len(reached) - 1, int(np.ceil(target * len(reached))))]) + 1 if len(reached) else 1


class VectorIndex:
    """Vectors stored by cell below `path`: `rows/cell=...` and `centres`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(
        self,
        vectors: DataFrame,
        key: str = "id",
        column: str = VECTOR_FIELD,
        cells: int | None = None,
        sample_rows: int = SAMPLE_ROWS,
        target: float = RECALL,
    ) -> VectorIndex:
        """Fit centres on at most `sample_rows` rows, those of the smallest key hash, and store
        every row in its cell. Without `cells` there are about the square root of the number of
        rows, MAX_CELLS at most. The most frequent vector size counts. `target` is the recall
        for which the number of cells to read is chosen on the sample."""
        rows = vectors.select(F.col(key).alias("key"), F.col(column).alias("v"))
        rows = rows.where(F.col("key").isNotNull() & (F.size("v") > 0))
        known = rows.agg(F.count(F.lit(1)).alias("n"), F.mode(F.size("v")).alias("size")).first()
        size = known["size"] or 0
        rows = rows.where(F.size("v") == size)
        wanted = cells or max(1, min(MAX_CELLS, round(known["n"] ** 0.5)))
        sample = rows.orderBy(F.xxhash64("key"), "key")
        centres = self._centres(sample.limit(sample_rows), wanted) if size else np.empty((0, 0))
        probes = 0
        if len(centres):
            tried = min(TRIED_ROWS, TRIED_BYTES // (8 * size) + 1)
            units, _ = _units(sample.limit(tried).select("v").toArrow().column(0).combine_chunks(), size)
            probes = cells_needed(units, centres, TOP, target)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units, own = _units(batch.column(1), size)
                cell = np.zeros(len(own), np.int32)
                for at in range(0, len(own), ROWS_AT_ONCE):
                    cell[at : at + ROWS_AT_ONCE] = (units[at : at + ROWS_AT_ONCE] @ centres.T).argmax(axis=1)
                kept = batch.take(pa.array(own))
                yield pa.record_batch([*kept.columns, pa.array(cell)], ["key", "v", "cell"])

        schema = rows.withColumn("cell", F.lit(0)).schema
        placed = rows.mapInArrow(assign, schema) if len(centres) else self.spark.createDataFrame([], schema)
        placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/rows")
        sizes = self.spark.read.schema(schema).parquet(f"{self.path}/rows").groupBy("cell").count()
        held = {r["cell"]: r["count"] for r in sizes.collect()}  # one row a cell
        table = [(i, held.get(i, 0), probes, c.tolist()) for i, c in enumerate(centres)]
        frame = self.spark.createDataFrame(table, "cell int, n long, probes int, centre array<double>")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centres")
        return self

    def _centres(self, sample: DataFrame, cells: int) -> np.ndarray:
        """Unit centres by k-means on the sphere."""
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        sample = sample.withColumn("norm", norm)
        sample = sample.where("norm > 0 AND norm < double('infinity')")
        unit = F.transform("v", lambda x: x.cast("double") / F.col("norm"))
        # enough partitions to share the work of a step, few enough for a small sample
        sample = sample.select(array_to_vector(unit).alias("features")).repartition(8).cache()
        if sample.isEmpty():
            return np.empty((0, 0))
        model = KMeans(k=min(cells, sample.count()), seed=42, maxIter=ITERATIONS, distanceMeasure="cosine").fit(sample)
        sample.unpersist()
        centres = np.array(model.clusterCenters())
        return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)

    def _table(self) -> list[T.Row]:
        """Cells, their rows and centres: MAX_CELLS rows unless more were asked for."""
        return self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()

    def search(
        self,
        queries: DataFrame,
        k: int = TOP,
        probes: int | None = None,
        query_key: str = "qid",
        query_column: str = VECTOR_FIELD,
    ) -> DataFrame:
        """Top-k of every query among the nearest cells: qid, rank, key, score.

        `probes` is the number of cells to read, by default what the build found to reach the
        recall. With all cells the result is exact.
        """
        table = self._table()
        stored = self.spark.read.parquet(f"{self.path}/rows") if any(r["n"] for r in table) else None
        asked = queries.select(F.col(query_key).alias("qid"), F.col(query_column).alias("v"))
        asked = asked.where(F.col("qid").isNotNull() & F.col("v").isNotNull())
        if stored is None:
            none = asked.select("qid", F.lit(0).alias("rank"), F.lit(None).alias("key"), F.lit(0.0).alias("score"))
            return none.where(F.lit(False))
        centres = np.array([r["centre"] for r in table])
        number = min(probes or table[0]["probes"], len(table))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units, own = _units(batch.column(1), centres.shape[1])
                order = np.argsort(-(units @ centres.T), axis=1, kind="stable")[:, :number]
                rows = batch.take(pa.array(np.repeat(own, number)))
                cell = pa.array(order.ravel().astype(np.int32))
                yield pa.record_batch([*rows.columns, cell], ["qid", "v", "cell"])

        routed = asked.mapInArrow(route, asked.withColumn("cell", F.lit(0)).schema)
        asking = {r["cell"]: r["count"] for r in routed.groupBy("cell").count().collect()}
        cut = [
            (r["cell"], -(-r["n"] // SLICE_ROWS), -(-asking[r["cell"]] // PART_QUERIES))
            for r in table
            if r["n"] and r["cell"] in asking
        ]
        pieces = F.broadcast(self.spark.createDataFrame(cut, "cell int, slices int, parts int"))  # a row a cell

        def dealt(df: DataFrame, name: str, own: str, across: str) -> DataFrame:
            """Each row in its own piece of the cell, once for each piece of the other side."""
            each = F.explode(F.sequence(F.lit(0), F.col(across) - 1))
            placed = df.join(pieces, "cell").withColumn("own", F.pmod(F.xxhash64(name), F.col(own)).cast("int"))
            return placed.withColumn("other", each).select(name, "v", "cell", "own", "other")

        cells = [c for c, _, _ in cut]
        there = dealt(stored.where(F.col("cell").isin(cells)), "key", "slices", "parts")
        there = there.select("key", "v", "cell", F.col("own").alias("slice"), F.col("other").alias("part"))
        here = dealt(routed, "qid", "parts", "slices")
        here = here.select("qid", "v", "cell", F.col("other").alias("slice"), F.col("own").alias("part"))

        def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
            wanted, own = _units(asked.column("v").combine_chunks(), centres.shape[1])
            units, used = _units(rows.column("v").combine_chunks(), centres.shape[1])
            names, keys = asked.column("qid").combine_chunks().take(pa.array(own)), rows.column("key").combine_chunks()
            held = _Best(len(wanted), k)
            if len(own) and len(used):
                _compare(held, _keys(keys.take(pa.array(used))), units, wanted)
            found = pa.array([] if held.key is None else held.key).cast(keys.type)
            return pa.table({"qid": names.take(pa.array(held.query)), "key": found, "score": pa.array(held.score)})

        schema = T.StructType([asked.schema["qid"], stored.schema["key"], T.StructField("score", T.DoubleType())])
        groups = [df.groupBy("cell", "slice", "part") for df in (here, there)]
        found = groups[0].cogroup(groups[1]).applyInArrow(meet, schema)
        return _top(found, k).select("qid", "rank", "key", "score")


def recall(found: DataFrame, exact: DataFrame, key: str = "key") -> float:
    """Share of the exact neighbours that were found; a neighbour of an equal score counts too."""
    least = exact.groupBy("qid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("k"))
    hits = found.join(least, "qid").where(F.col("score") >= F.col("least")).groupBy("qid", "k").count()
    hit = hits.agg(F.sum(F.least("count", "k"))).first()[0] or 0
    return hit / max(1, exact.count())
