"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is coded byte by byte; every byte is a path of binary decisions in a Huffman tree that
belongs to the byte before it, so that common bytes take few decisions. Several predictors,
one per context, give the odds of each decision from the counts of the whole training corpus,
kept in hashed tables. A gate (whether the longest context was seen) chooses one of two
sets of weights; the weighted odds give the probability, and the weights are refined from block to
block of each text. The probabilities of all decisions multiply to that of the text.

Beside it stands the add-one unigram score of the text's words.

Counts are additive: tasks count their part of the corpus, and the tables are summed in
blocks. Tables have a fixed size; the vocabulary grows with the corpus and is never collected:
only its most frequent words (at most `HEAD`) go to all tasks, the others are joined.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

HELD_OUT_OF, HELD_OUT = 7, 2
HEAD = 100_000  # words sent to every task
ORDERS = (3, 5)  # bytes of the hashed contexts; the trees stand for the context of one byte
TABLE_BITS = 21
BLOCK_BITS = 14
SCALE = 15.0  # odds are kept as int8
STEP = 512  # decisions between two refinements
RATE = 0.003
START = (0.4, 0.6)  # weights of the contexts at the start of a text
GROUP = 300_000  # bytes worked on at once
CHUNK = 16_384  # bytes of them whose decisions are worked out at once
PAD = max(ORDERS) + 1
END = b"\0"


def held_out(doc_id: Column) -> Column:
    left = F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(left == HELD_OUT, F.lit(False))


def _blob(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


# --- decisions ----------------------------------------------------------------------


class Trees:
    """Huffman trees, one per preceding byte, as tables of paths.

    `code[p * 256 + b]` gives where the path of byte b after byte p begins in `steps`, `size`
    how long it is. A step is twice its node plus the bit; nodes are numbered over all trees.
    """

    def __init__(self, pairs: np.ndarray):
        steps: list[int] = []
        self.code = np.zeros(65536, np.int32)
        self.size = np.zeros(65536, np.int32)
        for before, counts in enumerate(pairs.reshape(256, 256).tolist()):
            heap = [(n + 1, b, b) for b, n in enumerate(counts)]
            heapq.heapify(heap)
            above: dict[int, tuple[int, int]] = {}
            inner = 256
            while len(heap) > 1:
                a, b = heapq.heappop(heap), heapq.heappop(heap)
                above[a[2]], above[b[2]] = (inner, 0), (inner, 1)
                heapq.heappush(heap, (a[0] + b[0], inner, inner))
                inner += 1
            for b in range(256):
                path, at = [], b
                while at in above:
                    at, bit = above[at]
                    path.append(2 * (before * 255 + at - 256) + bit)
                self.code[before * 256 + b] = len(steps)
                self.size[before * 256 + b] = len(path)
                steps += reversed(path)
        self.steps = np.array(steps, np.uint32)


def _joined(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with PAD zeros before each; start and length (with end) of each."""
    data = np.frombuffer(END * PAD + (END * PAD).join(blobs) + END * PAD, np.uint8)
    sizes = np.array([len(b) for b in blobs], np.int64)
    starts = PAD + np.cumsum(sizes + PAD) - (sizes + PAD)
    return data, starts, sizes + 1


def pair_counts(blobs: list[bytes]) -> np.ndarray:
    data, starts, sizes = _joined(blobs)
    real = np.zeros(len(data), bool)
    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        real[s : s + n] = True
    code = data[:-1].astype(np.int64) * 256 + data[1:]
    return np.bincount(code[real[1:]], minlength=65536)


def decisions(trees: Trees, blobs: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Table slots of every decision per context, its bit, and decisions per text."""
    data, starts, sizes = _joined(blobs)
    at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    wide = data.astype(np.int32)
    pair = (wide[:-1] * 256 + wide[1:])[at - 1]
    size = trees.size[pair]
    upto = np.cumsum(size)
    first = trees.code[pair] - (upto - size)
    contexts = []
    recent = np.zeros(len(data), np.uint64)
    for back in range(1, max(ORDERS) + 1):
        recent[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * (back - 1))
        if back in ORDERS:
            mixed = (recent * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
            contexts.append(mixed.astype(np.uint32)[at])
    slots = [np.empty(upto[-1], np.int64) for _ in ORDERS]
    bits = np.empty(upto[-1], np.uint8)
    for start in range(0, len(pair), CHUNK):  # so few that they stay in the processor's cache
        part, last = slice(start, start + CHUNK), min(start + CHUNK, len(pair)) - 1
        here = slice(upto[start] - size[start], upto[last])
        owner = np.repeat(np.arange(last + 1 - start), size[part])  # the byte of each decision
        step = first[part].take(owner, mode="clip")
        step += np.arange(here.start, here.stop)
        step = trees.steps.take(step, mode="clip")
        bits[here] = step & np.uint32(1)
        step >>= np.uint32(1)  # the node
        step *= np.uint32(0x9E3779B1)
        for context, slot in zip(contexts, slots, strict=True):
            mixed = context[part].take(owner, mode="clip")
            mixed ^= step
            mixed *= np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0xC2B2AE35)
            mixed >>= np.uint32(32 - TABLE_BITS)
            slot[here] = mixed
    ends = np.concatenate(([0], upto[np.cumsum(sizes) - 1]))
    return slots, bits, np.diff(ends)


def count_decisions(trees: Trees, blobs: list[bytes], tables: list[np.ndarray]) -> None:
    slots, bits, _ = decisions(trees, blobs)
    for slot, table in zip(slots, tables, strict=True):
        np.add.at(table, slot * 2 + bits, np.uint32(1))


def empty_tables() -> list[np.ndarray]:
    """Counts of both outcomes per slot, for each context."""
    return [np.zeros(2 << b, np.uint32) for b in [TABLE_BITS] * len(ORDERS)]


def odds(counts: np.ndarray) -> np.ndarray:
    """Scaled log odds of each slot as int8; 0 where nothing was seen."""
    pair = counts.reshape(-1, 2).astype(np.float32)
    value = np.log((pair[:, 1] + 0.2) / (pair[:, 0] + 0.2)) * SCALE
    kept = np.clip(np.round(value), -127, 127).astype(np.int8)
    kept[(kept == 0) & (pair.sum(axis=1) > 0)] = 1
    return kept


# --- mixing ---------------------------------------------------------------------------


def _in_blocks(values: np.ndarray, counts: np.ndarray, origin: np.ndarray, blocks: int) -> np.ndarray:
    """Values of all texts in rows of STEP; each text begins a row, the rest of its last is 0."""
    padded = np.zeros(blocks * STEP, values.dtype)
    ends = np.cumsum(counts)
    for to, end, size in zip((origin * STEP).tolist(), ends.tolist(), counts.tolist(), strict=True):
        padded[to : to + size] = values[end - size : end]
    return padded.reshape(blocks, STEP)


def text_bits(trees: Trees, tables: list[np.ndarray], blobs: list[bytes]) -> np.ndarray:
    """Bits that the mixed model spends on each text, its end included.

    All texts advance together, a block of decisions at a time; each has weights of its own.
    """
    slots, bits, counts = decisions(trees, blobs)
    blocks = -(-counts // STEP)
    origin, n = np.cumsum(blocks) - blocks, int(blocks.sum())
    # odds of the outcome that came true, so that padding (0) costs one bit and moves nothing
    sign = bits.astype(np.float32) * np.float32(2 / SCALE) - np.float32(1 / SCALE)
    odds_of = [table.take(slot, mode="clip") for slot, table in zip(slots, tables, strict=True)]
    # the longest context has odds only where it was seen, so the gate opens its weight always,
    # and of the others their odds where it was seen are kept apart
    gate, signed = odds_of[-1] != 0, [value * sign for value in odds_of]
    longest = _in_blocks(signed.pop(), counts, origin, n)
    x = [_in_blocks(value, counts, origin, n) for value in signed]
    gated = [_in_blocks(value * gate, counts, origin, n) for value in signed]

    order = np.argsort(-blocks, kind="stable")
    steps = int(blocks[order[0]])
    active = np.searchsorted(-blocks[order], -np.arange(1, steps + 1), side="right")
    closed = np.tile(np.array(START, np.float32), (len(blobs), 1))  # longest context not seen
    opened = closed.copy()
    spent = np.zeros(len(blobs))
    for s in range(steps):
        m = active[s]
        rows = origin[order[:m]] + s
        long_odds, inputs = longest[rows], [(every[rows], seen[rows]) for every, seen in zip(x, gated, strict=True)]
        more = opened[:m] - closed[:m]
        margin = long_odds * opened[:m, -1:]
        for k, (every, seen) in enumerate(inputs):
            margin += every * closed[:m, k, None]
            margin += seen * more[:, k, None]
        against = np.exp(np.negative(np.maximum(margin, -80, out=margin), out=margin), out=margin)
        whole = 1 + against
        error = np.divide(against, whole, out=against)
        spent[order[:m]] += np.log(whole, out=whole).sum(axis=1, dtype=np.float64)
        for k, (every, seen) in enumerate(inputs):
            open_ = np.vecdot(error, seen)
            opened[:m, k] += RATE * open_
            closed[:m, k] += RATE * (np.vecdot(error, every) - open_)
        opened[:m, -1] += RATE * np.vecdot(error, long_odds)
    return spent / math.log(2) - (blocks * STEP - counts)


def _groups(blobs: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts of about GROUP bytes; a text is never cut."""
    held, size = [], 0
    for blob in blobs:
        if held and size + len(blob) > GROUP:
            yield held
            held, size = [], 0
        held.append(blob)
        size += len(blob) + 1
    if held:
        yield held


# --- the corpus -------------------------------------------------------------------------


def learn_trees(texts: DataFrame) -> Trees:
    """Trees from the byte pairs of all texts (at most 65,536 sums reach the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, np.int64)
        for batch in batches:
            for group in _groups([_blob(t) for t in batch.column(0).to_pylist()]):
                total += pair_counts(group)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["pair", "n"])

    pairs = np.zeros(65536, np.int64)
    sums = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for row in sums.collect():
        pairs[row["pair"]] = row["n"]
    return Trees(pairs)


def learn_tables(texts: DataFrame, trees: Trees) -> list[np.ndarray]:
    """Tables of odds from the decisions of all texts.

    Each task sends its counts in compressed blocks; blocks are summed where they meet, one
    after the other, so that a task holds its blocks once, however many parts there are.
    """
    size = 2 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = empty_tables()
        for batch in batches:
            for group in _groups([_blob(t) for t in batch.column(0).to_pylist()]):
                count_decisions(trees, group, tables)
        for k, table in enumerate(tables):
            for b in range(len(table) // size):
                part = table[b * size : (b + 1) * size]
                if part.any():
                    packed = pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())
                    yield pa.record_batch([pa.array([k]), pa.array([b]), packed], ["k", "b", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, b, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint32)
                if (k, b) in sums:
                    sums[k, b] += part
                else:
                    sums[k, b] = part.astype(np.int64)
        for (k, b), counts in sums.items():
            packed = pa.array([zlib.compress(odds(counts).tobytes(), 1)], pa.binary())
            yield pa.record_batch([pa.array([k]), pa.array([b]), packed], ["k", "b", "odds"])

    parts = texts.mapInArrow(count, "k long, b long, counts binary").repartition("k", "b")
    tables = [np.zeros(len(t) // 2, np.int8) for t in empty_tables()]
    for row in parts.mapInArrow(add, "k long, b long, odds binary").collect():
        at = row["b"] << BLOCK_BITS
        tables[row["k"]][at : at + (1 << BLOCK_BITS)] = np.frombuffer(zlib.decompress(row["odds"]), np.int8)
    return tables


def word_counts(texts: DataFrame) -> DataFrame:
    """`token`, `c` over all texts; the end of a text is the empty token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(_blob(text).split())
                counts[b""] += 1
            if len(counts) > 500_000:
                yield flush(counts)
        yield flush(counts)

    def flush(counts: Counter[bytes]) -> pa.RecordBatch:
        batch = pa.record_batch(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["token", "c"]
        )
        counts.clear()
        return batch

    counted = texts.mapInArrow(run, "token binary, c long")
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame, most: int) -> tuple[int, dict[bytes, int]]:
    """The least power of two that at most `most` words reach, and those words' counts."""
    power = F.floor(F.log2("c"))
    sizes = {r["p"]: r["n"] for r in counts.groupBy(power.alias("p")).agg(F.count("c").alias("n")).collect()}
    reached, least = 0, 1
    for p in sorted(sizes, reverse=True):
        reached += sizes[p]
        if reached > most:
            least = 2 ** (p + 1)
            break
    return least, {bytes(r["token"]): r["c"] for r in counts.where(F.col("c") >= least).collect()}


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows that are not held out and scores all. Null texts count as
    empty; a null id is not held out. Scores are log10 probabilities, ends included. Without
    any training row all words are unknown. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    training = rows.where(~held_out(F.col("doc_id"))).select("text")
    counts = stored(word_counts(training), "words")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    least, frequent = _head(counts, head)
    trees = learn_trees(training)
    tables = learn_tables(training, trees)
    floor = math.log10(n + v + 1)
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
        "score double, rest array<struct<token:binary,tf:long>>"
    )
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rest"]
    pair = pa.struct([("token", pa.binary()), ("tf", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = {t: math.log10(c + 1) - floor for t, c in frequent.items()}
        for batch in batches:
            blobs = [_blob(t) for t in batch.column(3).to_pylist()]
            bits = np.concatenate([text_bits(trees, tables, g) for g in _groups(blobs)] or [[]])
            tokens, known, base, rest, rest_tf, sizes = [], [], [], [], [], []
            for blob in blobs:
                words = Counter(blob.split())
                words[b""] = 1
                distinct, tfs = list(words), list(words.values())
                found = list(map(logs.get, distinct))
                left = [i for i, log in enumerate(found) if log is None] if None in found else []
                for i in left:
                    found[i] = 0.0
                rest += [distinct[i] for i in left]
                rest_tf += [tfs[i] for i in left]
                total = words.total()
                tokens.append(total)
                known.append(total - sum(tfs[i] for i in left))
                base.append(math.sumprod(tfs, found))
                sizes.append(len(left))
            inner = pa.StructArray.from_arrays(
                [pa.array(rest, pa.binary()), pa.array(rest_tf, pa.int64())],
                fields=list(pair),
            )
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                    pa.array(-bits * math.log10(2), pa.float64()), pa.ListArray.from_arrays(offsets, inner),
                ],
                names,
            )

    source = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    scored = stored(source.mapInArrow(run, schema), "scored")
    rare = counts.where(F.col("c") < least).select("token", "c")
    c = F.coalesce("c", F.lit(0))
    joined = (
        scored.select("row", F.inline("rest"))
        .join(rare, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("more_known"),
            F.sum(F.col("tf") * (F.log10(c + 1) - F.lit(floor))).alias("more_base"),
        )
    )
    return scored.drop("rest").join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
