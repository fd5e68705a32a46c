"""Changed versions of a stream of records: one small state per ticket.

The state of a key is the time and the digest of its newest version, and how many rows came
late, undated or unchanged; never a text. A row goes on only if the corpus would take it and it
says something new, so redaction, masking and models run once per changed version. Keys are never
forgotten: Spark runs an expiring state on and on, so a stream that takes what is there and
stops would not end.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import document_key, or_empty, strip

_KEY, _DIGEST, _MICROS = "_key", "_digest", "_micros"
_UNDATED = -(2**63)  # sorts before every time
_STATE = "micros bigint, digest string, late bigint, undated bigint, unchanged bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# logs of RocksDB take the space they need; set aside, it is many times that of small states
_SETTINGS = {_PROVIDER: _ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
STATE_NAME = "newest"


class _Newest(StatefulProcessor):
    """Passes on the newest row of a key and batch when it changes what is known.

    Rows are handled one by one, never as a frame: a key has few rows, and a frame for each key
    costs far more than its rows.
    """

    def __init__(self, columns: list[str]) -> None:
        self.columns = columns
        self.order = [columns.index("sys_id"), columns.index("number")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(STATE_NAME, _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        micros, digest, late, undated, unchanged = self.state.get() or (None, None, 0, 0, 0)
        best, first, total = None, None, 0
        width = len(self.columns)
        # one after the other, so that a key with very many rows holds one of them; by place,
        # since Spark does not hand over the names of computed columns
        for row in rows:
            total += 1
            undated += row[width + 2] == _UNDATED
            ids = [(row[i] is not None, row[i] or "") for i in self.order]  # nulls last
            place = (row[width + 2], *ids, row[width + 1])
            if first is None or place > first:
                best, first = row, place
        if best is None:
            return
        now, says = first[0], first[-1]
        changed = micros is None or now > micros or (now == micros and says != digest)
        if changed:
            late += total - 1
        elif now == micros:
            unchanged, late = unchanged + 1, late + total - 1
        else:
            late += total
        newest = (now, says) if changed else (micros, digest)
        self.state.update((*newest, late, undated, unchanged))
        if changed:
            yield Row(*self.columns)(*best[:width])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which this operator needs."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def changed_versions(records: DataFrame) -> DataFrame:
    """Of a stream of flat records those that are new or changed versions of their ticket.

    A row that is older than the known version, or undated beside a dated one, does not go
    on; nor does a row of the same time and the same content. Of the rows of a batch the
    newest goes on, by the order of the batch ingest. Start the stream inside `rocksdb_state`.
    """
    names = records.columns
    # by position: names first, then key, digest and time
    keyed = records.withColumns(
        {
            _KEY: document_key(strip(or_empty(F.col("number")))),
            _DIGEST: F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256),
            _MICROS: F.coalesce(
                F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(_UNDATED)
            ),
        }
    )
    return keyed.groupBy(_KEY).transformWithState(
        _Newest(names),
        outputStructType=records.schema,
        outputMode="Update",
        timeMode="None",
    )


def version_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per ticket key the rows that came late, undated or unchanged, from the state itself.

    The state is committed with its batch, so a batch or task that ran twice counts once.
    """
    with rocksdb_state(spark):
        state = spark.read.format("statestore").option("stateVarName", STATE_NAME).load(checkpoint)
    kept = state.select(F.col(f"key.{_KEY}").alias("key"), "value.*")
    return kept.select("key", "late", "undated", "unchanged")
