"""Token counts as rollups that are maintained by deltas.

A batch of changes (new, revised and deleted documents) adds signed rows to totals by source,
language and tokenizer version. A ledger keeps the counts of every document, so that a
revision or deletion takes back exactly what the document had added. Totals are sums of the
committed deltas; documents are never counted again.

Each batch has a number and three folders: its counted changes, its ledger rows (each with what
it replaces), then its delta. The delta's `_SUCCESS` file commits the batch. A batch that is committed is skipped when it comes again;
what an interrupted attempt left is overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.space import path_exists
from .common import word_count

BPE_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BPE_NAME = "byte_bpe_50k"
GROUP = ("source", "lang", "tokenizer")
KEY = ("doc_id", "text_key", "tokenizer")
STATE = ("source", "lang", "tokens", "copies")
LEDGER = """doc_id long, text_key string, tokenizer string, source string, lang string, tokens long,
copies long, old_source string, old_lang string, old_tokens long, old_copies long, batch long"""
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"

# (a table with a `text` column, name of the new column, whether to keep the text)
Counter = Callable[[DataFrame, str, bool], DataFrame]


def count_words(rows: DataFrame, column: str, keep_text: bool) -> DataFrame:
    """Words between white space."""
    counted = rows.withColumn(column, word_count(F.col("text")))
    return counted if keep_text else counted.drop("text")


def count_bpe(path: str = BPE_PATH, name: str = BPE_NAME) -> Counter:
    """Tokens of a byte-level BPE vocabulary (a rank file that Spark can read)."""

    def counter(rows: DataFrame, column: str, keep_text: bool) -> DataFrame:
        from public_tokenizers import PATTERN

        spark = rows.sparkSession
        ranks = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
        others = [c for c in rows.columns if c != "text"]
        kept = [*others, "text"] if keep_text else others

        def encoding():
            import base64

            import tiktoken
            from tiktoken.registry import ENCODINGS  # kept by the worker between tasks

            if name not in ENCODINGS:
                pairs = (line.split() for line in ranks.splitlines())
                ENCODINGS[name] = tiktoken.Encoding(
                    name,
                    pat_str=PATTERN,
                    mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
                    special_tokens={},
                )
            return ENCODINGS[name]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encode = encoding().encode_ordinary
            for batch in batches:
                texts = batch.columns[-1].to_pylist()
                sizes = pa.array([len(encode(t)) if t else 0 for t in texts], pa.int64())
                yield pa.record_batch([*batch.columns[: len(kept)], sizes], [*kept, column])

        schema = rows.select(*kept, F.lit(0).cast("long").alias(column)).schema
        return rows.select(*others, "text").mapInArrow(run, schema)

    return counter


class Rollup:
    """Totals of one corpus below `path`, for tokenizers by version name."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, Counter]):
        self.spark, self.path, self.tokenizers = spark, path.rstrip("/"), tokenizers

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def committed(self, batch: int) -> bool:
        return path_exists(self.spark, self._folder("delta", batch) + "/_SUCCESS")

    def _batches(self) -> list[int]:
        """Numbers of the committed batches, by listing the folders."""
        from ..sources.space import hadoop_path

        fs, root = hadoop_path(self.spark, f"{self.path}/delta")
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        return [b for b in sorted(int(n.partition("=")[2]) for n in names) if self.committed(b)]

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders = [self._folder(kind, b) for b in self._batches()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def ledger(self, touched: DataFrame | None = None) -> DataFrame:
        """The state of every document (of those `touched`) as of its last batch; `copies` is 0
        where it is deleted, `text_key` is null where it has an id."""
        rows = self._read("ledger", LEDGER)
        if touched is not None:
            named, same = _same(rows, touched.select(*KEY))
            rows = rows.join(named, same, "left_semi")
        last = F.max_by(F.struct(*STATE), "batch")  # combined before the shuffle
        return rows.groupBy(*KEY).agg(last.alias("s")).select(*KEY, "s.*")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens: sums of all committed deltas."""
        summed = self._read("delta", DELTA).groupBy(*GROUP).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        return summed.where("docs <> 0")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch (doc_id, source, lang, text, deleted); False if it was applied before.

        A document not deleted is new or revised. Batches are applied in the order of their
        numbers. Of several rows of one id in a batch a deletion goes first, then the text
        with the greatest MD5 counts, then the greatest source and language. Every row without
        id is a document of its own, known by source, language and text: a batch adds one copy
        for each row and takes one back for each deleted row, down to none. Texts are counted
        where they are read; only numbers are shuffled, equal keys are combined before. A null
        text has no tokens; null sources and languages are groups of their own. Other columns
        are ignored. An empty batch commits and changes nothing. Of the ledger only the rows of
        touched documents are grouped.
        """
        if self.committed(batch):
            return False
        rows = changes.select(
            F.col("doc_id").cast("long"), "source", "lang", "text",
            F.coalesce("deleted", F.lit(False)).alias("deleted"),
            F.md5("text").alias("key"),
        )
        names = list(self.tokenizers)
        for i, name in enumerate(names):
            rows = self.tokenizers[name](rows, f"n{i}", i < len(names) - 1)
        own = F.when(F.col("doc_id").isNull(), F.md5(F.to_json(F.struct("source", "lang", "key"))))
        pick = F.max(F.struct("deleted", "key", "source", "lang", *[f"n{i}" for i in range(len(names))]))
        grouped = rows.groupBy("doc_id", own.alias("text_key")).agg(
            pick.alias("p"), F.sum(F.when(F.col("deleted"), -1).otherwise(1)).alias("more")
        )
        grouped.write.mode("overwrite").parquet(self._folder("changes", batch))

        each = F.array(
            *[F.struct(F.lit(n).alias("tokenizer"), F.col(f"p.n{i}").alias("tokens")) for i, n in enumerate(names)]
        )
        counted = self.spark.read.schema(grouped.schema).parquet(self._folder("changes", batch))
        counted = counted.select("doc_id", "text_key", "more", "p.deleted", "p.source", "p.lang", F.inline(each))
        before = self.ledger(counted).withColumnsRenamed({c: f"old_{c}" for c in STATE})
        earlier, same = _same(counted, before)
        old = F.coalesce("old_copies", F.lit(0))
        copies = (
            F.when(F.col("doc_id").isNull(), F.greatest(F.lit(0), old + F.col("more")))
            .when(F.col("deleted"), 0)
            .otherwise(1)
        )
        state = counted.join(earlier, same, "left").withColumn("copies", copies.cast("long"))
        state = state.withColumn("batch", F.lit(batch).cast("long"))
        names_of = [c.split()[0] for c in LEDGER.split(",")]
        state.select(*names_of).write.mode("overwrite").parquet(self._folder("ledger", batch))

        now = self.spark.read.schema(LEDGER).parquet(self._folder("ledger", batch))
        sides = [
            now.where(f"{side}copies > 0").select(
                F.col(f"{side}source").alias("source"), F.col(f"{side}lang").alias("lang"), "tokenizer",
                (F.lit(sign) * F.col(f"{side}copies")).alias("docs"),
                (F.lit(sign) * F.col(f"{side}copies") * F.col(f"{side}tokens")).alias("tokens"),
            )
            for side, sign in (("", 1), ("old_", -1))
        ]
        delta = sides[0].unionByName(sides[1]).groupBy(*GROUP).agg(
            F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens")
        )
        delta.write.mode("overwrite").parquet(self._folder("delta", batch))
        return True


def _same(left: DataFrame, right: DataFrame) -> tuple[DataFrame, Column]:
    """`right` with its keys renamed, and the condition that joins it to `left`, nulls included."""
    named = right.withColumnsRenamed({c: f"r_{c}" for c in KEY})
    return named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in KEY])
