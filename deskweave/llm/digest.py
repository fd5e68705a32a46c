"""Document fingerprints from improbable features.

Every window of 24 bytes has an entropy; how rare its entropy is in the whole corpus gives its
rank. In every run of 32 windows the rarest one (the leftmost of equals) scores a point, and
windows with enough points are the features of a text. Features are inserted into chained
Bloom filters, and two fingerprints are compared by the overlap of their filters' bits, from
what chance gives (0) to the most possible (1).

All texts of an Arrow batch are worked on as one byte array. Entropies follow from how often
the byte that leaves and the byte that enters occur in the window, so no window is counted
anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 24  # bytes of a feature
RUN = 32  # windows that compete for a point
POINTS = 16  # points that make a window a feature
FEW = 8  # with fewer features, every window with a point is one
BINS = 1000  # entropy classes
FILTER_BITS = 2048
HASHES = 5
PER_FILTER = 160  # features of one filter
CHUNK = 1 << 18  # bytes worked on at once
_COUNTS = np.arange(WINDOW + 2, dtype=np.float64)
_TERM = _COUNTS * np.log2(np.maximum(_COUNTS, 1))  # n log2 n


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy class (0 .. BINS - 1) of the window at each position of a byte array."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    ahead = np.ones(len(data), np.uint8)  # occurrences of a byte in the window it begins
    behind = np.zeros(len(data), np.uint8)  # its occurrences in the WINDOW - 1 bytes before
    for lag in range(1, WINDOW):
        equal = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[:-lag] += equal
        behind[lag:] += equal
    leaving, entering = ahead[: n - 1], behind[WINDOW:]
    step = _TERM[leaving - 1] - _TERM[leaving] + _TERM[entering + 1] - _TERM[entering]
    first = _TERM[np.bincount(data[:WINDOW])].sum()
    total = first + np.concatenate(([0.0], np.cumsum(step)))
    value = (np.log2(WINDOW) - total / WINDOW) / np.log2(WINDOW)
    return np.clip((value * BINS + 1e-6).astype(np.int32), 0, BINS - 1)


def _features(rank: np.ndarray, size: int) -> np.ndarray:
    """Positions of the features of one text of `size` windows, in order."""
    key = (rank.astype(np.int64) << 40) + np.arange(size)
    run = min(RUN, size)
    low, span = key, 1
    while span * 2 <= run:
        low, span = np.minimum(low[: len(low) - span], low[span:]), span * 2
    if run > span:
        low = np.minimum(low[: size - run + 1], low[run - span : run - span + size - run + 1])
    at = low & ((1 << 40) - 1)
    points = np.bincount(at, minlength=size)
    chosen = np.flatnonzero(points >= POINTS)
    return chosen if len(chosen) >= FEW else np.flatnonzero(points)


def digest(blob: bytes, rank_of: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """Chained Bloom filters of a text, one row of FILTER_BITS / 8 bytes each.

    A text shorter than a window is one feature; an empty one has no filter.
    """
    if not blob:
        return np.zeros((0, FILTER_BITS // 8), np.uint8)
    if len(blob) < WINDOW:
        features = [blob]
    else:
        if classes is None:
            classes = _all_entropies([blob])[0]
        at = _features(rank_of[classes], len(classes))
        features = [blob[i : i + WINDOW] for i in at.tolist()]
    hashes = b"".join(hashlib.sha1(f).digest() for f in features)
    bits = np.frombuffer(hashes, ">u4").reshape(-1, HASHES) % FILTER_BITS
    chain = np.arange(len(features)) // PER_FILTER
    filters = np.zeros((chain[-1] + 1, FILTER_BITS), bool)
    filters[np.repeat(chain, HASHES), bits.ravel()] = True
    return np.packbits(filters, axis=1)


def as_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: mean over the shorter chain of the best normalised overlap with the other one,
    weighted by the filters' bits.

    The overlap of two filters is their common bits less those expected by chance, over the
    most that is possible less those.
    """
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(len(b) == 0)
    ones_a, ones_b = np.bitwise_count(a).sum(axis=1), np.bitwise_count(b).sum(axis=1)
    best = []
    for own, n in zip(a, ones_a.astype(float), strict=True):
        common = np.bitwise_count(own & b).sum(axis=1)
        chance, most = n * ones_b / FILTER_BITS, np.minimum(n, ones_b)
        best.append(((common - chance) / np.maximum(most - chance, 1e-9)).max())
    return float(np.clip(np.average(best, weights=ones_a), 0.0, 1.0))


def _all_entropies(blobs: list[bytes]) -> list[np.ndarray]:
    """Entropy classes of every text; texts are put together up to CHUNK bytes."""
    found: list[np.ndarray] = []
    group: list[bytes] = []

    def flush() -> None:
        if len(group) == 1 and len(group[0]) > 2 * CHUNK:
            data, parts = np.frombuffer(group[0], np.uint8), []
            for at in range(0, len(data) - WINDOW + 1, CHUNK):
                parts.append(entropies(data[at : at + CHUNK + WINDOW - 1]))
            found.append(np.concatenate(parts))
        else:
            classes, at = entropies(np.frombuffer(b"".join(group), np.uint8)), 0
            for blob in group:
                found.append(classes[at : at + max(0, len(blob) - WINDOW + 1)])
                at += len(blob)
        group.clear()

    size = 0
    for blob in blobs:
        if group and size + len(blob) > CHUNK:
            flush()
            size = 0
        group.append(blob)
        size += len(blob)
    if group:
        flush()
    return found


def _blob(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def class_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of the whole corpus have each entropy class (BINS numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            for classes in _all_entropies([_blob(t) for t in batch.column(0).to_pylist()]):
                counts += np.bincount(classes, minlength=BINS)
        yield pa.record_batch([pa.array(np.arange(BINS)), pa.array(counts)], ["bin", "n"])

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bin long, n long")
    counts = np.zeros(BINS, np.int64)
    for row in found.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row["bin"]] = row["n"]
    return counts


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the rarest first; unseen classes are the rarest of all."""
    order = np.lexsort((np.arange(len(counts)), counts))
    rank = np.empty(len(counts), np.int32)
    rank[order] = np.arange(len(counts))
    return rank


def fingerprints(docs: DataFrame, rank_of: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` without the text, with `fingerprint`. Null texts count as empty."""
    names = [c for c in docs.columns if c not in (text, "fingerprint")]
    columns = [F.col(f"`{c}`") for c in names]
    schema = docs.select(*columns, F.lit("").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            blobs = [_blob(t) for t in texts.to_pylist()]
            made = [
                as_text(digest(b, rank_of, c)) for b, c in zip(blobs, _all_entropies(blobs), strict=True)
            ]
            yield pa.record_batch([*rest, pa.array(made, pa.string())], [*names, "fingerprint"])

    return docs.select(*columns, F.col(f"`{text}`")).mapInArrow(run, schema)


# --- every text against an edited one and against the next one ----------------------

NEIGHBOURS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _edges_above(edges: list[int], value: Column) -> Column:
    """How many of the falling `edges` lie above a value, looked up in two steps."""
    if not edges:
        return F.lit(0)
    width = max(1, round(len(edges) ** 0.5))
    groups = [edges[i : i + width] for i in range(0, len(edges), width)]
    reached = F.size(F.filter(F.lit([g[0] for g in groups]), lambda e: e > value))
    group = F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(reached, F.lit(1)))
    return F.when(reached == 0, 0).otherwise((reached - 1) * width + F.size(F.filter(group, lambda e: e > value)))


def _in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Documents by descending id in partitions; each ends with the first of the next one.

    Ranges come from approximate quantiles of the ids; rows without an id are split by the hash
    of their text, as many ranges as their share needs. The first document of a range (of the
    highest range: of the whole order) is sent to the range before it as well, as a guest.
    """
    quantiles = F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)
    known = docs.agg(quantiles.alias("bounds"), F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("n")).first()
    edges = sorted(set(known["bounds"] or []), reverse=True)
    nameless = max(1, round(parts * (1 - known["named"] / max(1, known["n"]))))
    ranged = docs.withColumn("tie", F.xxhash64("text"))
    share = ((F.col("tie").cast("double") + 2.0**63) / 2.0**64 * nameless).cast("int")
    last = F.lit(len(edges) + 1) + F.least(share, F.lit(nameless - 1))
    above = _edges_above(edges, F.col("doc_id"))
    ranged = ranged.withColumn("range", F.when(F.col("doc_id").isNull(), last).otherwise(above))
    order = (F.col("doc_id").desc_nulls_last(), F.col("tie"))
    down = F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1))
    first_id = F.struct(down.alias("i"), "tie")
    heads = sorted(
        (r["range"], r["head"]["i"], r["head"]["tie"])
        for r in ranged.groupBy("range").agg(F.min(first_id).alias("head")).collect()
    )
    # one row a range: the first document's place, and the range that has it as its guest
    table = [(number, low, tie, heads[k - 1][0]) for k, (number, low, tie) in enumerate(heads)]
    firsts = docs.sparkSession.createDataFrame(table, "range int, low long, first long, goes_to int")
    own = ranged.withColumn("guest", F.lit(False))
    is_head = (down == F.col("low")) & (F.col("tie") == F.col("first"))
    guests = ranged.join(F.broadcast(firsts), "range").where(is_head)
    guests = guests.select(*docs.columns, "tie", F.col("goes_to").alias("range"), F.lit(True).alias("guest"))
    dealt = own.unionByName(guests).repartitionById(parts, F.col("range") % parts)
    return dealt.sortWithinPartitions("range", "guest", *order).select(
        "range", "guest", "doc_id", "text"
    )


def neighbour_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its fingerprint and how like it is to an edited text and to the next text.

    The edited text has its last third (code points) replaced by the beginning of the next
    document by descending id; the document after the last is the first. Null texts count as
    empty; null ids come last; rows that share an id follow each other in the order of their
    texts' hashes. A single row is its own next one. Other columns are ignored.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    rank_of = ranks(class_counts(rows))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def report(now: list[tuple], following: list[tuple]) -> pa.RecordBatch:
        """Rows of `now`, each with the next row in `following`."""
        edited = []
        for (_, own), (_, later) in zip(now, following, strict=True):
            k = len(own) // 3
            edited.append(own[: len(own) - k] + later[:k])
        texts = [t for _, t in now] + [following[-1][1]] + edited
        blobs = [_blob(t) for t in texts]
        made = [digest(b, rank_of, c) for b, c in zip(blobs, _all_entropies(blobs), strict=True)]
        n = len(now)
        own, changed = made[:n], made[n + 1 :]
        return pa.record_batch(
            [
                pa.array([i for i, _ in now], pa.int64()),
                pa.array([len(t) for _, t in now], pa.int64()),
                pa.array([hashlib.sha256(_blob(t)).hexdigest() for t in edited]),
                pa.array([as_text(d) for d in own], pa.string()),
                pa.array([as_text(d) for d in changed], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(made[:n], made[1 : n + 1], strict=True)], pa.float64()),
            ],
            [part.split()[0] for part in NEIGHBOURS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = at = 0
        for batch in batches:
            for number, guest, key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((key, value))
                size += len(value)
                if guest:
                    if len(held) > 1:  # rows equal to the first guest follow it alone
                        yield report(held[:-1], held[1:])
                    held, size = [], 0
                elif size > 4 * CHUNK and len(held) > 1:
                    yield report(held[:-1], held[1:])
                    held, size = held[-1:], len(value)
                at = number
        assert not held, f"range {at} has no following document"

    return _in_order(rows, parts).mapInArrow(run, NEIGHBOURS)
