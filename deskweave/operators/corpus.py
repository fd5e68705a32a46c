"""The keyed corpus: latest version per key, column-wise upsert, stored as Parquet.

A corpus is a snapshot in hash buckets of the key, and a pointer that names the folders of
each bucket. An upsert writes only to the buckets that hold one of its keys, then moves the
pointer; readers never see a half-written table, and a killed writer leaves only folders that
no pointer names. One writer at a time. Where a table format with MERGE INTO is at hand it can
take this place.

A small corpus is merged at once: its touched buckets are read and written anew. To a large one
an upsert adds a folder per bucket, and a reader takes the newest version of each key. The last
folders of a bucket are put together when they outweigh the one before them `FAN` times, so
that a row is written again a logarithmic number of times, however small the batches are.
"""

from __future__ import annotations

import json
from collections.abc import Container, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.space import hadoop_path, stored
from .documents import RECORD_KEY
from .schema import UPDATED, evolved_schema

BUCKETS = 16
KEPT_POINTERS = 3
MERGE_BELOW = 64 << 20  # bytes; a smaller corpus is merged at once
FAN = 8  # folders are put together when they outweigh the one before them so many times
COMPRESSION = "zstd"
_BUCKET, _KEY, _TIME, _SEQ = "_bucket", "_key", "_time", "_seq"
_POINTER = (
    "schema string, buckets int, folders map<string,bigint>, batches map<string,bigint>, "
    "earlier map<string,array<bigint>>, supplied array<string>"
)


def latest_per_key(
    documents: DataFrame, key: str = "id", order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the newest by update time, undated ones last.

    Spark puts a partial group limit before the shuffle, so of a key with very many
    versions each task passes on a single row.
    """
    if order is None:
        order = [F.col(UPDATED).desc_nulls_last()]
        order += [F.col(c).desc() for c in (RECORD_KEY, "number") if c in documents.columns]
    ranked = documents.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def key_collisions(documents: DataFrame) -> DataFrame:
    """Keys that several different ticket numbers were mapped to."""
    return (
        documents.select("id", "number")
        .distinct()
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("numbers"), F.min("number").alias("first_number"))
        .where("numbers > 1")
    )


def _paired(stored: DataFrame, incoming: DataFrame, key: str, updated: str) -> DataFrame:
    """Stored and incoming rows side by side, with a `takes_new` decision.

    The incoming version is taken unless the stored one is dated and newer. Columns
    are renamed, not packed into structs, so that unused ones are pruned at the scan.
    """
    old = stored.select(*[F.col(c).alias(c if c == key else f"old_{c}") for c in stored.columns])
    new = incoming.select(
        *[F.col(c).alias(c if c == key else f"new_{c}") for c in incoming.columns]
    )
    both = new.withColumn("in_new", F.lit(True)).join(
        old.withColumn("in_old", F.lit(True)), key, "full_outer"
    )
    wins = F.lit(True)
    if updated in incoming.columns and updated in stored.columns:
        newer = F.col(f"new_{updated}") >= F.col(f"old_{updated}")
        wins = F.col(f"old_{updated}").isNull() | F.coalesce(newer, F.lit(False))
    is_new, is_old = F.col("in_new").isNotNull(), F.col("in_old").isNotNull()
    return both.withColumn("takes_new", is_new & (~is_old | wins))


def _all_columns(stored: DataFrame, incoming: DataFrame) -> list[str]:
    return stored.columns + [c for c in incoming.columns if c not in stored.columns]


def merge_versions(
    stored: DataFrame, incoming: DataFrame, key: str = "id", updated: str = UPDATED
) -> DataFrame:
    """Column-wise upsert of rows that are unique by key on both sides.

    Of a taken version every supplied column is used, nulls included; columns that
    were not supplied keep the stored value.
    """
    both = _paired(stored, incoming, key, updated)

    def pick(name: str) -> Column:
        if name == key:
            return F.col(key)
        old = F.col(f"old_{name}") if name in stored.columns else F.lit(None)
        if name not in incoming.columns:
            return old.alias(name)
        return F.when(F.col("takes_new"), F.col(f"new_{name}")).otherwise(old).alias(name)

    return both.select(*[pick(name) for name in _all_columns(stored, incoming)])


def _shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`; columns not in `df` become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(
                f.name, metadata=f.metadata
            )
            for f in schema.fields
        ]
    )


def _bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


class Corpus:
    """A keyed table at `path`.

    `buckets` is fixed when the corpus is created; choose it so that a bucket is some files
    large. Pointers carry the last batch of each stream that was merged, so that a batch
    delivered again is skipped; `recreate` forgets them with the data. A corpus of less than
    `merge_below` bytes is merged by each upsert, a larger one by its readers.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        buckets: int = BUCKETS,
        merge_below: int = MERGE_BELOW,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.declared = schema
        self.buckets = buckets
        self.merge_below = merge_below

    # --- pointer ---------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        fs, root = hadoop_path(self.spark, f"{self.path}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []

    def _versions(self) -> list[int]:
        """Committed versions, in order."""
        found = []
        for name in self._names("pointer"):
            fs, done = hadoop_path(self.spark, f"{self.path}/pointer/{name}/_SUCCESS")
            if fs.exists(done):
                found.append(int(name))
        return sorted(found)

    def _last(self) -> tuple[int, T.Row] | None:
        versions = self._versions()
        if not versions:
            return None
        path = f"{self.path}/pointer/{versions[-1]}"
        return versions[-1], self.spark.read.schema(_POINTER).json(path).first()

    def _point(
        self,
        version: int,
        schema: T.StructType,
        buckets: int,
        parts: dict[int, list[int]],
        batches: dict[str, int],
        supplied: Sequence[str] | None,
    ) -> None:
        last = {str(b): p[-1] for b, p in parts.items()}  # keys of JSON maps are text
        earlier = {str(b): p[:-1] for b, p in parts.items() if len(p) > 1}
        row = [(schema.json(), buckets, last, batches, earlier, supplied)]
        pointer = self.spark.createDataFrame(row, _POINTER).coalesce(1)
        pointer.write.mode("overwrite").json(f"{self.path}/pointer/{version}")

    @staticmethod
    def _parts(pointer: T.Row) -> dict[int, list[int]]:
        """The folders of each bucket, by the order in which they were written."""
        earlier = pointer["earlier"] or {}
        return {
            int(b): [*earlier.get(b, []), v] for b, v in sorted((pointer["folders"] or {}).items())
        }

    def _clean(self) -> None:
        """Delete folders that only pointers before the last few name."""
        versions = self._versions()[-KEPT_POINTERS:]
        pointers = [f"{self.path}/pointer/{v}" for v in versions]
        rows = self.spark.read.schema(_POINTER).json(pointers).collect()
        named = {(b, v) for row in rows for b, p in self._parts(row).items() for v in p}
        for version in self._names("data"):
            own = {b for b, v in named if v == int(version)}
            for name in self._names(f"data/{version}"):
                if name.startswith(f"{_BUCKET}=") and int(name.partition("=")[2]) not in own:
                    self._delete(f"data/{version}/{name}")
            if not own and int(version) not in versions:
                self._delete(f"data/{version}")
        for version in self._names("pointer"):
            if int(version) < versions[0]:
                self._delete(f"pointer/{version}")
        for version in self._names("staged"):
            self._delete(f"staged/{version}")

    def _delete(self, folder: str) -> None:
        fs, path = hadoop_path(self.spark, f"{self.path}/{folder}")
        fs.delete(path, True)

    def merged(self, stream: str, batch: int) -> bool:
        """True when this batch of a stream is in the corpus already."""
        last = self._last()
        return last is not None and (last[1]["batches"] or {}).get(stream, -1) >= batch

    # --- table -----------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._versions())

    def ensure(self) -> None:
        """Create an empty corpus when there is none, otherwise do nothing."""
        if not self.exists():
            self._point(0, self.declared, self.buckets, {}, {}, [])

    def recreate(self, confirmed: bool = False) -> None:
        """Start over with an empty corpus; data and merged batches are lost to readers."""
        if not confirmed:
            raise ValueError("recreate drops all documents: pass confirmed=True")
        last = self._last()
        self._point(0 if last is None else last[0] + 1, self.declared, self.buckets, {}, {}, [])

    def evolve(self, schema: T.StructType) -> None:
        """Add fields. Old rows read null there until they are written again."""
        last = self._last()
        if last is None:
            self.declared = schema
            self.ensure()
            return
        version, row = last
        self.declared = evolved_schema(self._schema_of(row), schema)
        parts, batches = self._parts(row), row["batches"] or {}
        self._point(version + 1, self.declared, row["buckets"], parts, batches, row["supplied"])

    @staticmethod
    def _schema_of(pointer: T.Row) -> T.StructType:
        return T.StructType.fromJson(json.loads(pointer["schema"]))

    def read(self, *columns: Column | str) -> DataFrame:
        """The newest version of each key, or row-wise `columns` of it.

        Such columns are computed where a row is stored, so that of long texts only what is
        asked for is moved when versions of a key are brought together.
        """
        last = self._last()
        if last is None:
            raise FileNotFoundError(f"no corpus at {self.path}")
        return self._read(last[1], columns=columns or self._schema_of(last[1]).names)

    def bucket_versions(self) -> dict[int, int]:
        """The version in which each bucket was written last; buckets without rows are left out."""
        last = self._last()
        return {} if last is None else {int(b): v for b, v in (last[1]["folders"] or {}).items()}

    def read_buckets(self, numbers: Iterable[int]) -> DataFrame:
        """Rows of some buckets, with the bucket's number as `_bucket`."""
        _, pointer = self._last()
        rows = self._read(pointer, set(numbers))
        return rows.withColumn(_BUCKET, _bucket_of(pointer["buckets"]))

    def _read(
        self, pointer: T.Row, only: Container[int] | None = None, columns: Sequence[Column | str] = ()
    ) -> DataFrame:
        parts = {b: p for b, p in self._parts(pointer).items() if only is None or b in only}
        return self._rows(self._schema_of(pointer), parts, columns)

    def _rows(
        self, schema: T.StructType, parts: dict[int, list[int]], columns: Sequence[Column | str] = ()
    ) -> DataFrame:
        """The newest version of each key in these folders.

        An upsert supplies all columns that earlier ones supplied, or is merged at once, so
        the newest version has all values that are known. Whole rows are not exchanged to find it:
        which versions are outdated follows from keys and times, and these are left out of the files.
        """
        whole, columns = not columns, columns or schema.names
        single = [(b, p[0]) for b, p in parts.items() if len(p) == 1]
        found = [] if parts and not single else [self._files(schema, single).select(*columns)]
        files = {
            v: self._files(schema, [(b, v) for b, p in parts.items() if len(p) > 1 and v in p])
            for v in sorted({v for p in parts.values() if len(p) > 1 for v in p})
        }
        order = [F.col(_TIME).desc_nulls_last(), F.col(_SEQ).desc()]
        marks = [F.col("id").alias(_KEY), F.col(UPDATED).alias(_TIME)]
        if files and whole:
            narrow = [rows.select(*marks, F.lit(v).alias(_SEQ)) for v, rows in files.items()]
            first = F.first(_SEQ).over(Window.partitionBy(_KEY).orderBy(*order))
            ranked = reduce(DataFrame.unionByName, narrow).withColumn("_first", first)
            outdated = stored(ranked.where(F.col(_SEQ) != F.col("_first")).select(_KEY, _SEQ), "outdated")
            for v, rows in files.items():
                own = outdated.where(F.col(_SEQ) == v).select(_KEY)
                found.append(rows.join(own, F.col("id").eqNullSafe(F.col(_KEY)), "left_anti"))
        elif files:
            several = [rows.select(*columns, *marks, F.lit(v).alias(_SEQ)) for v, rows in files.items()]
            newest = latest_per_key(reduce(DataFrame.unionByName, several), _KEY, order)
            found.append(newest.drop(_KEY, _TIME, _SEQ))
        return reduce(DataFrame.unionByName, found)

    def _files(self, schema: T.StructType, folders: Sequence[tuple[int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        # reading with the pointer's schema fills fields that older files do not have
        paths = [f"{self.path}/data/{v}/{_BUCKET}={b}" for b, v in folders]
        return self.spark.read.schema(schema).parquet(*paths)

    def _bytes(self, bucket: int, version: int) -> int:
        fs, path = hadoop_path(self.spark, f"{self.path}/data/{version}/{_BUCKET}={bucket}")
        return fs.getContentSummary(path).getLength()

    def _write(
        self, rows: DataFrame, schema: T.StructType, folder: str, buckets: int, dealt: bool = False
    ) -> list[int]:
        """Write rows by bucket of the key; returns the buckets that got some.

        Rows `dealt` by key already are written where they are, a file per task and bucket.
        """
        shaped = _shaped(rows, schema).withColumn(_BUCKET, _bucket_of(buckets))
        if not dealt:  # files by bucket; large buckets are split and small ones put together
            shaped = shaped.hint("rebalance", _BUCKET)
        writer = shaped.write.mode("overwrite").option("compression", COMPRESSION)
        writer.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        names = [n for n in self._names(folder) if n.startswith(f"{_BUCKET}=")]
        return sorted(int(n.partition("=")[2]) for n in names)

    def _put_together(self, schema: T.StructType, buckets: int, parts: dict[int, list[int]], version: int) -> bool:
        """Write the last folders of buckets as one where they outweigh the folder before them."""
        joined = {}
        for bucket, folders in parts.items():
            sizes = [self._bytes(bucket, v) for v in folders] if len(folders) > FAN else []
            for at, size in enumerate(sizes):
                if sum(sizes[at + 1 :]) >= FAN * size:
                    joined[bucket] = folders[at:]
                    break
        if joined:
            self._write(self._rows(schema, joined), schema, f"data/{version}", buckets)
            for bucket, folders in joined.items():
                parts[bucket] = [*parts[bucket][: -len(folders)], version]
        return bool(joined)

    def upsert(
        self, documents: DataFrame, batch: tuple[str, int] | None = None, unique: bool = False
    ) -> int:
        """Merge documents by key; returns the number of keys written.

        The incoming rows are written before the merge: what an external model computed for
        them is not computed again by the merge or by a lost executor. A `batch` (stream,
        number) that was merged before is skipped, so replays are harmless. Rows that are
        already one per key (`unique`) are not ranked again.
        """
        if batch is not None and self.merged(*batch):
            return 0
        self.ensure()
        last, pointer = self._last()
        version, buckets = last + 1, pointer["buckets"]
        schema, parts = self._schema_of(pointer), self._parts(pointer)
        batches = dict(pointer["batches"] or {})
        newest = documents if unique else latest_per_key(documents)
        supplied = T.StructType([f for f in schema.fields if f.name in documents.columns])
        fresh = not parts
        # the newest version stands for its key only if it has all that earlier ones have
        known = schema.names if pointer["supplied"] is None else pointer["supplied"]
        added = UPDATED in supplied.names and set(known) <= set(supplied.names)
        added = added and self._reaches(parts, self.merge_below)
        kept = fresh or added
        target = f"data/{version}" if kept else f"staged/{version}"
        touched = self._write(newest, schema if kept else supplied, target, buckets, dealt=True)
        incoming = self.spark.read.schema(supplied).parquet(
            *[f"{self.path}/{target}/{_BUCKET}={b}" for b in touched]
        ) if touched else self.spark.createDataFrame([], supplied)
        if touched and not kept:
            merged = merge_versions(self._read(pointer, touched), incoming)
            self._write(merged, schema, f"data/{version}", buckets)
        parts |= {b: [*(parts.get(b, []) if added else []), version] for b in touched}
        if batch is not None:
            batches[batch[0]] = batch[1]
        count = incoming.count()
        if added and self._put_together(schema, buckets, parts, version + 1):
            version += 1
        known = sorted({*known, *supplied.names}) if touched else known
        self._point(version, schema, buckets, parts, batches, known)
        self._clean()
        return count

    def _reaches(self, parts: dict[int, list[int]], size: int) -> bool:
        """True if these folders hold so many bytes."""
        held = 0
        for bucket, folders in parts.items():
            held += sum(self._bytes(bucket, v) for v in folders)
            if held >= size:
                return bool(parts)
        return False
