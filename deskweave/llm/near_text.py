"""Near-duplicate texts by exact Jaccard similarity of their word shingles.

Candidates come from banded MinHash: a text has BANDS values, each made of ROWS minima over
its set of shingles. Two texts of similarity s have an equal value in at least one band with
probability 1 - (1 - s^ROWS)^BANDS, which is 1 - 7e-5 at 0.8. Texts with one set of shingles
are one node; only numbers are shuffled to find candidates.

A bucket of an equal value is never compared pair by pair. Its members are sorted by TAIL
further minima, as in a prefix tree that splits the bucket until few texts are left, and each
meets the WINDOW members before it. Of those it offers the BEST by the similarity that two
64-byte signatures show, if they lie in different groups so far. Offers are verified by the
exact Jaccard similarity of the two sets before they become links; links become groups by
distributed connected components, and the next round offers only what still lies apart. Offers
follow from the groups, so once a round that verified all its offers has linked nothing, another
one would only repeat them, and the search ends. So the work of a round grows with the number of
texts, however large a bucket is and wherever the similarities of its members lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored
from .components import components

BANDS, ROWS = 24, 5
MINIMA = 128  # at least BANDS * ROWS; four bits of each make the signature
TAIL = 8  # further minima that sort a bucket
WINDOW, BEST = 64, 2  # members before a member that it meets, and offers it makes
FIRST = 2  # offers of a text in the first round; later ones take all that is left
PART = 2_000  # shingles hashed at once
SLACK = 1e-9  # of comparisons with the similarity

_random = np.random.default_rng(42)
_FLIPS = _random.integers(0, 2**32, (MINIMA, 1), np.uint32)
_FACTORS = _random.integers(0, 2**32, (MINIMA, 1), np.uint32) | np.uint32(1)
_JOIN = _random.integers(0, 2**64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_BAND = _random.integers(0, 2**64, BANDS, np.uint64)
_PLACES = _random.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
_FOLLOWING = (np.arange(1, BANDS + 1)[:, None] * ROWS + np.arange(TAIL)) % MINIMA
_WEIGHTS = np.uint64(1) << (np.uint64(8) * np.arange(TAIL - 1, -1, -1, dtype=np.uint64))
_NIBBLES = np.uint64(0x1111111111111111)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text; none if it has no word.

    Words are separated by ASCII white space and A-Z are lower-cased. A text of fewer words
    than a shingle is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = max(1, len(words) - shingle + 1)
    total = np.zeros(size, np.uint64)
    for k in range(min(shingle, len(words))):
        total += hashes[k : k + size] * _PLACES[k]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(total)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MINIMA smallest values of a set that is not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(MINIMA, 2**32 - 1, np.uint32)
    for at in range(0, len(x), PART):
        mixed = x[None, at : at + PART] ^ _FLIPS
        mixed *= _FACTORS
        np.minimum(lowest, mixed.min(axis=1), out=lowest)
    return lowest


def band_values(lowest: np.ndarray) -> np.ndarray:
    """One value per band."""
    rows = lowest[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    return (rows * _JOIN).sum(axis=1, dtype=np.uint64) + _BAND


def _mixed(lowest: np.ndarray) -> np.ndarray:
    """The minima with all bits stirred, since small numbers are likelier."""
    return (lowest * np.uint32(0x9E3779B1)) >> np.uint32(24)


def tails(lowest: np.ndarray) -> np.ndarray:
    """Per band a number that sorts its members by TAIL further minima, a byte of each."""
    return (_mixed(lowest)[_FOLLOWING].astype(np.uint64) * _WEIGHTS).sum(axis=1, dtype=np.uint64)


def signature(lowest: np.ndarray) -> bytes:
    """Four bits of each of the minima."""
    nibbles = (_mixed(lowest) & np.uint32(15)).astype(np.uint8)
    return (nibbles[0::2] | nibbles[1::2] << 4).tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of signatures given as rows of 64-bit numbers."""
    apart = a ^ b
    apart |= apart >> np.uint64(2)
    apart |= apart >> np.uint64(1)
    apart &= _NIBBLES
    unequal = np.bitwise_count(apart).sum(axis=1, dtype=np.int64) / MINIMA
    return 1 - unequal * 16 / 15


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; 1 if both are empty."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common) if len(a) or len(b) else 1.0


def _with_sketch(rows: DataFrame, shingle: int) -> DataFrame:
    """`rows` (without `text`) with `node`, one per set of shingles, and what finds candidates:
    its `size`, `signature`, `bands` and `tails`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            nodes, sizes, marks, values, orders = [], [], [], [], []
            for text in texts:
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sizes.append(len(hashes))
                lowest = minima(hashes) if len(hashes) else None
                marks.append(signature(lowest) if len(hashes) else b"")
                if len(hashes):
                    values.append(band_values(lowest))
                    orders.append(tails(lowest))
            offsets = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) > 0) * BANDS)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate(x or [np.empty(0, np.uint64)]).view(np.int64))
                )
                for x in (values, orders)
            ]
            yield pa.record_batch(
                [
                    *rest, pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()), *lists,
                ],
                [*names, "node", "size", "signature", "bands", "tails"],
            )

    kept = rows.drop("text")
    names = kept.columns
    number = F.lit(0).cast("long")
    added = {"node": number, "size": number, "signature": F.lit(b""), "bands": F.array(number), "tails": F.array(number)}
    return rows.select(*names, "text").mapInArrow(run, kept.withColumns(added).schema)


def _offers(nodes: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b, alike) among `nodes` (node, size, signature, bands, tails, root) of
    different roots, both ways round."""
    members = (
        nodes.select("node", "root", "size", "signature", F.explode(F.arrays_zip("bands", "tails")).alias("at"))
        .select(F.col("at.bands").alias("v"), F.col("at.tails").alias("tail"), "node", "root", "size", "signature")
        .repartitionByRange("v", "tail", "node")
        .sortWithinPartitions("v", "tail", "node")
    )
    spread = (similarity * (1 - similarity) / MINIMA) ** 0.5 * 16 / 15
    least = similarity - 4 * spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            v, node, root, size = (batch.column(i).to_numpy() for i in (0, 2, 3, 4))
            marks = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(-1, MINIMA // 16)
            old = 0 if held is None else len(held[0])
            if old:
                v, node, root, size, marks = (np.concatenate(x) for x in zip(held, (v, node, root, size, marks)))
            held = [x[-WINDOW:] for x in (v, node, root, size, marks)]
            score = np.full((BEST, len(v)), -1.0)
            other = np.zeros((BEST, len(v)), np.int64)
            for k in range(1, min(WINDOW, len(v) - 1) + 1):
                start = max(old, k)
                same = np.flatnonzero(v[start:] == v[start - k : len(v) - k]) + start
                if not len(same):
                    break
                low, high = np.minimum(size[same], size[same - k]), np.maximum(size[same], size[same - k])
                same = same[(root[same] != root[same - k]) & (low >= high * (similarity - SLACK))]
                now = likeness(marks[same], marks[same - k])
                fit = now >= least
                now, who, same = now[fit], node[same[fit] - k], same[fit]
                for place in range(BEST):
                    better = now > score[place, same]
                    at = same[better]
                    now[better], score[place, at] = score[place, at], now[better]
                    who[better], other[place, at] = other[place, at], who[better]
            found = [np.flatnonzero(score[place] >= 0) for place in range(BEST)]
            a = np.concatenate([node[i] for i in found])
            b = np.concatenate([other[p, i] for p, i in enumerate(found)])
            alike = np.concatenate([score[p, i] for p, i in enumerate(found)])
            ends = (np.concatenate(x) for x in ((a, b), (b, a), (alike, alike)))
            yield pa.record_batch([pa.array(x) for x in ends], ["a", "b", "alike"])

    found = members.mapInArrow(run, "a long, b long, alike double")
    return stored(found.distinct(), "offers")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of `pairs` (a, b) whose texts reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = [(None, np.empty(0, np.uint64))] * 2
        for batch in batches:
            near = []
            for i in range(batch.num_rows):
                for side in range(2):
                    node = batch.column(side)[i].as_py()
                    if held[side][0] != node:
                        held[side] = node, shingle_set(batch.column(2 + side)[i].as_py(), shingle)
                near.append(jaccard(held[0][1], held[1][1]) >= similarity - SLACK)
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("first"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("second"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "first", "second")
    return stored(both.mapInArrow(run, "a long, b long"), "near-links")


def _labelled(nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """`nodes` with `root`, their group so far; a node without a link is its own."""
    if roots is None:
        return nodes.withColumn("root", F.col("node"))
    named = roots.withColumnRenamed("node", "at")
    joined = nodes.join(named, F.col("node") == F.col("at"), "left").drop("at")
    return joined.withColumn("root", F.coalesce("root", "node"))


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Groups after more `links`: only the groups that they touch are linked anew."""
    if roots is None:
        return stored(components(links), "roots")
    ends = links
    for end in ("a", "b"):
        named = roots.select(F.col("node").alias(end), "root")
        ends = ends.join(named, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    merged = stored(components(ends), "merged")
    renamed = merged.select(F.col("node").alias("root"), F.col("root").alias("now"))
    moved = roots.join(renamed, "root", "left").select("node", F.coalesce("now", "root").alias("root"))
    fresh = merged.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return stored(moved.unionByName(fresh), "roots")


def _known_pairs(sketches: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs (a, b) of `keys` as nodes, a < b."""
    pairs, at = keys, sketches.where("size > 0").groupBy("key").agg(F.first("node").alias("node"))
    for end in ("a", "b"):
        named = at.select(F.col("key").alias(end), F.col("node").alias(f"{end}_node"))
        pairs = pairs.join(named, end)
    ends = (f("a_node", "b_node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b")))
    return stored(pairs.select(*ends).where("a <> b").distinct(), "known")


def near_groups(
    docs: DataFrame,
    doc_id: str,
    text: str,
    shingle: int,
    similarity: float,
    known: Callable[[DataFrame], DataFrame] | None = None,
    apart: Callable[[DataFrame, float], DataFrame] | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, key, group.

    A group holds the documents reachable over pairs whose sets of shingles have at least the
    Jaccard `similarity`; texts without words form one group. `key` is the MD5 of the text.
    Null texts count as empty; null and repeated ids do not matter to groups, other columns
    are ignored, an empty table gives no rows. `known` gives, for rows of key and text, pairs
    (a, b) of keys that are verified beside the candidates found here. `apart` is asked once no
    candidate links anything more: for (key, node, size, root) it gives all further pairs (a, b) of
    nodes of different roots that are to be verified.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    sketches = stored(_with_sketch(rows, shingle), "sketches")
    one = F.first(F.struct("size", "signature", "bands", "tails"))  # equal in all rows of a node
    nodes = sketches.where("size > 0").groupBy("node").agg(one.alias("n")).select("node", "n.*")
    nodes = stored(nodes, "nodes")
    more = None if known is None else _known_pairs(sketches, known(rows))

    def texts_of(chosen: DataFrame) -> DataFrame:
        keys = sketches.join(chosen, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
        found = rows.select("key", "text").join(keys, "key").dropDuplicates(["node"]).select("node", "text")
        return stored(found, "candidates")

    roots = tested = texts = None
    linked = True
    while linked:
        offers = _offers(_labelled(nodes, roots), similarity)
        chosen = offers if tested is None else offers.join(tested, ["a", "b"], "left_anti")
        if tested is None:
            best = Window.partitionBy("a").orderBy(F.desc("alike"), "b")
            chosen = chosen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= FIRST)
        pairs = chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        if tested is None and more is not None:
            pairs = pairs.unionByName(more)
        pairs = stored(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            linked = False
        else:
            if tested is None:
                active = offers.select(F.col("a").alias("node"))
                if more is not None:
                    active = active.union(more.select("a")).union(more.select("b"))
                active = active.distinct()
                nodes = stored(nodes.join(active, "node", "left_semi"), "nodes")
                texts = texts_of(active)
            drop_stored(offers)
            found = _verified(pairs, texts, shingle, similarity)
            linked = not found.isEmpty() or tested is None  # the first round holds offers back
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            tested = both if tested is None else tested.unionByName(both)
            if roots is None or not found.isEmpty():
                roots = _joined(roots, found)
        if not linked and apart is not None:
            placed = sketches.where("size > 0").select("key", "node", "size").distinct()
            left = stored(apart(_labelled(placed, roots), similarity), "apart")
            apart = None
            if not left.isEmpty():
                ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
                found = _verified(left, texts_of(ends), shingle, similarity)
                if not found.isEmpty():
                    roots = _joined(roots, found)
                    linked = tested is not None  # offers follow from the groups
    grouped = _labelled(sketches.select("doc_id", "key", "node"), roots)
    return grouped.select("doc_id", "key", F.col("root").alias("group"))
