"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 4 of 64 bits have a common variant that differs from
each in at most 2 bits. So every distinct fingerprint stands for its ball of 2081 variants
(0, 1 or 2 bits flipped), equal variants are brought together, and fingerprints that meet are
verified and linked.

The balls are dealt by the first `prefix_bits` bits of the variants: a fingerprint is sent
once to each prefix at most 2 flips away (79 rows for 12 bits), together standing for all its
variants there, and the receiver writes them out. This is the shuffle of all variants with the
part that a receiver can compute itself left out; it moves 79 numbers a fingerprint instead of
2081. A prefix with many fingerprints is worked off in parts by its next bits, so memory does
not grow with it.

Members of a variant are linked to one of them, never pairwise; links become groups by
distributed connected components. Links of pairs whose prefixes differ in at most 2 bits are
reported only where one of the two has its own prefix, as they meet there too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .near_text import SLACK, near_groups

SHINGLE = 4
SEED = 42
RADIUS = 4  # linked at so many differing bits or fewer
PREFIX_BITS = 12
PART = 4_000_000  # variants written out at once
DEDUP_SHINGLE, DEDUP_SIMILARITY = 5, 0.8  # words and Jaccard similarity of `deduplicate`


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; 0 if it has no word.

    Words are separated by ASCII white space and A-Z are lower-cased; every occurrence of a
    shingle counts. A bit is set if it is set in over half the shingles' hashes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = len(words)
    if size <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, size) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))[: size - shingle + 1].tolist()
    ends = stops[shingle - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 50_000):
        spans = zip(starts[at : at + 50_000], ends[at : at + 50_000], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts), bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`docs` (without the text) with `fp`, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.record_batch([*rest, pa.array(values.view(np.int64))], [*names, "fp"])

    kept = docs.drop(text)
    names = kept.columns
    schema = kept.withColumn("fp", F.lit(0).cast("long")).schema
    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`")).mapInArrow(run, schema)


_MASKS: dict[tuple[int, int], np.ndarray] = {}


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks of `bits` bits with at most `most` set."""
    if (bits, most) not in _MASKS:
        chosen = (c for k in range(most + 1) for c in combinations(range(bits), k))
        _MASKS[bits, most] = np.array([sum(1 << b for b in c) for c in chosen], np.uint64)
    return _MASKS[bits, most]


def _write_out(low: np.ndarray, left: np.ndarray, bits: int, members: np.ndarray, first: np.ndarray):
    """Stars (centre, member) of the variants that several members have.

    Members with `first` come first in their variant and become its centre.
    """
    for key, owner in _variants(low, left, bits, members, first):
        same = np.concatenate(([False], key[1:] == key[:-1]))
        centre = owner[np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))]
        pairs = np.unique(np.stack([centre[same], owner[same]], axis=1), axis=0)
        yield pairs[pairs[:, 0] != pairs[:, 1]]


def _variants(low: np.ndarray, left: np.ndarray, bits: int, members: np.ndarray, first: np.ndarray):
    """Sorted variants and the member each belongs to, in parts; equal ones are in one part.

    `low` are the last `bits` bits of the members' fingerprints, `left` the flips each may
    still make there. Members with `first` come first in their variant.
    """
    sizes = np.array([1, 1 + bits, 1 + bits + bits * (bits - 1) // 2])
    if len(low) < 2:
        return
    if sizes[left].sum() > PART and bits > 8:
        top, rest = low >> np.uint64(bits - 4), low & np.uint64((1 << (bits - 4)) - 1)
        for part in range(16):
            after = left - np.bitwise_count(top ^ np.uint64(part)).astype(np.int64)
            here = after >= 0
            yield from _variants(rest[here], after[here], bits - 4, members[here], first[here])
        return
    keys, owners = [], []
    for radius in range(3):
        here = left == radius
        masks = _flips(bits, radius)
        keys.append((low[here, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(members[here], len(masks)))
    later = np.concatenate([np.repeat(~first[left == r], sizes[r]) for r in range(3)])
    key = (np.concatenate(keys) << np.uint64(1)) | later.astype(np.uint64)
    owner = np.concatenate(owners)
    order = np.argsort(key)
    yield key[order] >> np.uint64(1), owner[order]


def _forest(pairs: np.ndarray, size: int) -> np.ndarray:
    """The smallest member reachable from each of `size` members."""
    root = np.arange(size)
    a, b = pairs[:, 0], pairs[:, 1]
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def link_prefix(prefix: int, fps: np.ndarray, prefix_bits: int = PREFIX_BITS) -> np.ndarray:
    """Links (fp, smaller fp) among fingerprints dealt to one prefix."""
    fps = np.unique(fps)
    bits = 64 - prefix_bits
    own = fps >> np.uint64(bits)
    away = np.bitwise_count(own ^ np.uint64(prefix)).astype(np.int64)
    low = fps & np.uint64((1 << bits) - 1)
    found = [
        p
        for p in _write_out(low, RADIUS // 2 - away, bits, np.arange(len(fps)), away == 0)
        if len(p)
    ]
    if not found:
        return np.empty((0, 2), np.uint64)
    pairs = np.unique(np.concatenate(found), axis=0)
    a, b = fps[pairs[:, 0]], fps[pairs[:, 1]]
    near = np.bitwise_count(a ^ b) <= RADIUS
    apart = np.bitwise_count((a ^ b) >> np.uint64(bits)) > RADIUS // 2
    pairs = pairs[near & (apart | (away[pairs[:, 0]] == 0) | (away[pairs[:, 1]] == 0))]
    root = _forest(pairs, len(fps))
    linked = root != np.arange(len(fps))
    return np.stack([fps[linked], fps[root[linked]]], axis=1)


def pairs_prefix(
    prefix: int, fps: np.ndarray, groups: np.ndarray, prefix_bits: int = PREFIX_BITS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of all rows (fingerprint, group) dealt to one prefix that lie within the radius
    in different groups, in parts of bounded size; a pair may come more than once.

    Rows of one group are never paired, so a large group costs its size and not its square.
    """
    bits = 64 - prefix_bits
    away = np.bitwise_count((fps >> np.uint64(bits)) ^ np.uint64(prefix)).astype(np.int64)
    low = fps & np.uint64((1 << bits) - 1)
    for key, owner in _variants(low, RADIUS // 2 - away, bits, np.arange(len(fps)), away == 0):
        order = np.lexsort((groups[owner], key))
        key, owner = key[order], owner[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        apart = new | np.concatenate(([True], groups[owner][1:] != groups[owner][:-1]))
        # each row meets the rows of its variant behind its own group
        ends = np.append(np.flatnonzero(new)[1:], len(key))[np.cumsum(new) - 1]
        behind = np.append(np.flatnonzero(apart)[1:], len(key))[np.cumsum(apart) - 1]
        count = ends - behind
        rows = np.flatnonzero(count)
        total = np.cumsum(count[rows])
        at = 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PART, "right")))
            some = rows[at:stop]
            shift = np.arange(count[some].sum()) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            a, b = np.repeat(owner[some], count[some]), owner[np.repeat(behind[some], count[some]) + shift]
            far = np.bitwise_count((fps[a] ^ fps[b]) >> np.uint64(bits)) > RADIUS // 2
            kept = far | (away[a] == 0) | (away[b] == 0)
            pairs = np.unique(np.stack([a[kept], b[kept]], axis=1), axis=0)
            yield pairs[:, 0], pairs[:, 1]
            at = stop


def _by_prefix(rows: DataFrame, work, schema: str, prefix_bits: int) -> DataFrame:
    """`work` (prefix, columns of numbers) on the `rows` (fp, ...) dealt to each prefix."""
    masks = (_flips(prefix_bits, RADIUS // 2) << np.uint64(64 - prefix_bits)).view(np.int64)
    prefix = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), 64 - prefix_bits)
    dealt = (
        rows.select("*", F.explode(F.lit(masks.tolist())).alias("mask"))
        .select(prefix.alias("prefix"), *rows.columns)
        .repartition("prefix")
        .sortWithinPartitions("prefix")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            prefixes = batch.column(0).to_numpy()
            columns = np.stack([c.to_numpy() for c in batch.columns[1:]])
            cuts = np.flatnonzero(np.diff(prefixes)) + 1
            for part, start in zip(np.split(columns, cuts, axis=1), [0, *cuts], strict=True):
                if part.shape[1] and prefixes[start] != at:
                    yield from flush(at, held)
                    held, at = [], prefixes[start]
                held.append(part)
        yield from flush(at, held)

    def flush(prefix, held) -> Iterator[pa.RecordBatch]:
        if held:
            for found in work(int(prefix), *np.concatenate(held, axis=1)):
                yield pa.record_batch([pa.array(c) for c in found], names)

    names = [c.split()[0] for c in schema.split(", ")]
    return dealt.mapInArrow(run, schema)


def links(fps: DataFrame, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of `fp` within the radius."""

    def work(prefix: int, own: np.ndarray) -> Iterator[np.ndarray]:
        yield link_prefix(prefix, own.view(np.uint64), prefix_bits).view(np.int64).T

    return _by_prefix(fps.select("fp").distinct(), work, "a long, b long", prefix_bits)


def pairs_apart(rows: DataFrame, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """All pairs (a_fp, a_group, b_fp, b_group) of distinct `rows` (fp, group) within the radius,
    equal fingerprints too, that lie in different groups; once each, one way round."""

    def work(prefix: int, own: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for a, b in pairs_prefix(prefix, own.view(np.uint64), groups, prefix_bits):
            low, high = np.where(groups[a] < groups[b], a, b), np.where(groups[a] < groups[b], b, a)
            yield own[low], groups[low], own[high], groups[high]

    schema = "a_fp long, a_group long, b_fp long, b_group long"
    return _by_prefix(rows.select("fp", "group").distinct(), work, schema, prefix_bits).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of `docs`: doc_id, key, fp, component_id.

    component_id is the smallest doc_id of the documents reachable over links (null ids are
    passed over; null if there is no other). `key` is the MD5 of the text. Null and empty texts
    and texts without words have fingerprint 0 and are linked like any other; repeated rows
    share their component. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    fps = stored(with_fingerprint(rows, "text", shingle), "fingerprints")
    roots = components(links(fps))
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labelled = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = labelled.join(smallest, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "key", "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def linked_texts(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of text hashes that connect what `near_duplicates` brings together, out of
    `rows` (key, text): texts of one fingerprint one after the other, and a text of each of two
    linked fingerprints.
    """
    return TextLinks().connecting(rows)


class TextLinks:
    """What operator 1 links, as pairs of texts: first those that connect all (`connecting`), and,
    as such a pair may fail its verification where others of its texts would pass, all those
    that lie in different groups still (`apart`)."""

    def connecting(self, rows: DataFrame) -> DataFrame:
        """Pairs (a, b) of text hashes out of `rows` (key, text), see `linked_texts`."""
        fps = stored(with_fingerprint(rows.select("key", "text")).distinct(), "fingerprints")
        self.fps = fps
        before = F.lag("key").over(Window.partitionBy("fp").orderBy("key"))
        alike = fps.select(before.alias("a"), F.col("key").alias("b")).where("a IS NOT NULL")
        firsts = fps.groupBy("fp").agg(F.min("key").alias("first"))
        pairs = links(fps)
        for end in ("a", "b"):
            named = firsts.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_key"))
            pairs = pairs.join(named, end)
        return alike.unionByName(pairs.select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))

    def apart(self, grouped: DataFrame, similarity: float) -> DataFrame:
        """All pairs (a, b) of nodes of different groups that operator 1 links, out of `grouped`
        (key, node, size, root); without those whose sizes rule the similarity out."""
        placed = self.fps.join(grouped, "key")
        placed = placed.select("fp", F.col("root").alias("group"), "node", "size").distinct()
        pairs = pairs_apart(placed)
        for end in ("a", "b"):
            pairs = pairs.join(placed.toDF(*[f"{end}_{c}" for c in placed.columns]), [f"{end}_fp", f"{end}_group"])
        near = F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * (similarity - SLACK)
        ends = (f("a_node", "b_node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b")))
        return pairs.where(near).select(*ends).distinct()


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = DEDUP_SHINGLE,
    similarity: float = DEDUP_SIMILARITY,
) -> DataFrame:
    """One document of each group of near-duplicates, in the columns of `docs`.

    Every pair that operator 1 links is verified, or lies in one group already: documents are linked if the sets of their word shingles
    have at least this Jaccard similarity. Such documents whose fingerprints differ in more bits
    than operator 1 allows are found beside it (see `near_text`).
    The document with the smallest id stays (null last, then by text hash); of repeated rows
    one stays.
    """
    linked = TextLinks()
    found = near_groups(docs, doc_id, text, shingle, similarity, linked.connecting, linked.apart)
    by_id = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    kept = found.groupBy("group").agg(F.min(by_id).alias("k")).select("k.*")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(f"`{doc_id}`").alias("_id"),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_key"),
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key"))
    one = rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_key"])
    return one.select("_doc.*")
