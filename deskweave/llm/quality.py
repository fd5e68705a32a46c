"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded from character-class trigrams and word
statistics by a learned layer; gated attention weighs the passages, and a logistic layer
scores the weighted sum. Only document labels are needed.

The model is fitted with numpy on a sample of at most about `sample_rows` labelled documents;
scoring reads whole texts of all documents in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 800  # bytes of a passage, about
TRIGRAMS = 256
STATS = 12
WIDTH = TRIGRAMS + STATS
HIDDEN = 32
GATE = 16
SAMPLE_ROWS = 6000
EPOCHS = 12
THRESHOLD = 0.3
HELD_OUT_OF = 5
GROUP = 2_000_000  # bytes encoded at once

# space, line end, lower, upper, digit, beyond ASCII, and one class per group of marks
_MARKS = (".,;:", "!?", "\"'`", "()[]{}<>", "|/\\", "#$%&*", "@_~^", "+-=")


def _class_table() -> np.ndarray:
    table = np.full(256, 14, np.uint8)
    table[[9, 11, 12, 32]] = 0
    table[[10, 13]] = 1
    table[97:123] = 2
    table[65:91] = 3
    table[48:58] = 4
    table[128:] = 5
    for i, marks in enumerate(_MARKS):
        table[[ord(c) for c in marks]] = 6 + i
    return table


def _by_passage(values: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(passage, weights=values, minlength=n)


def _word_stats(
    data: np.ndarray, kind: np.ndarray, at: np.ndarray, passage: np.ndarray, n: int
) -> list[np.ndarray]:
    """Word lengths and repeated words per passage; a word belongs to where it starts.

    `at` are positions in the text: no word goes on into the next text.
    """
    inside = kind > 1
    joined = np.concatenate(([False], inside[:-1] & inside[1:] & (at[1:] > 0), [False]))
    starts = np.flatnonzero(inside & ~joined[:-1])
    stops = np.flatnonzero(inside & ~joined[1:]) + 1
    if not len(starts):
        return [np.zeros(n)] * 5
    weight = np.power(np.uint64(0x9E3779B97F4A7C15), np.arange(64, dtype=np.uint64))
    length = stops - starts
    offset = np.zeros(len(data), np.int64)
    offset[inside] = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    coded = (data.astype(np.uint64) + np.uint64(1)) * weight[offset & 63]
    code = np.add.reduceat(np.where(inside, coded, np.uint64(0)), starts)
    where = passage[starts]
    words = np.bincount(where, minlength=n)
    some = np.maximum(words, 1)
    mean = np.bincount(where, weights=length, minlength=n) / some
    square = np.bincount(where, weights=length.astype(float) ** 2, minlength=n) / some
    again = np.zeros(len(code), bool)
    again[1:] = (code[1:] == code[:-1]) & (where[1:] == where[:-1])
    key = code + (where.astype(np.uint64) << np.uint64(32)) * weight[1]
    order = np.argsort(key)
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    distinct = np.bincount(where[order], weights=fresh, minlength=n)
    return [
        np.log1p(words) / 5,
        mean / 8,
        np.sqrt(np.maximum(square - mean**2, 0)) / 6,
        distinct / some,
        np.bincount(where, weights=again, minlength=n) / some,
    ]


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and the number of passages of each text.

    A text is cut into equal passages of about PASSAGE bytes, an empty or null one has a
    single passage of zeros.
    """
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(b) for b in blobs], np.int64)
    counts = np.maximum(1, np.round(sizes / PASSAGE).astype(np.int64))
    n = int(counts.sum())
    data = np.frombuffer(b"".join(blobs), np.uint8)
    features = np.zeros((n, WIDTH), np.float32)
    if not len(data):
        return features, counts
    at = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(np.cumsum(counts) - counts, sizes)
    passage += at * np.repeat(counts, sizes) // np.repeat(sizes, sizes)
    kind = _class_table()[data]
    length = np.maximum(size := np.bincount(passage, minlength=n), 1)
    wide = kind.astype(np.int64)
    code = (wide[:-2] * 225 + wide[1:-1] * 15 + wide[2:]) * 40503 >> 5 & (TRIGRAMS - 1)
    same = passage[:-2] == passage[2:]
    grams = np.bincount(
        passage[:-2][same] * TRIGRAMS + code[same], minlength=n * TRIGRAMS
    ).reshape(n, TRIGRAMS)
    features[:, :TRIGRAMS] = np.sqrt(grams / length[:, None])
    stats = [_by_passage(kind == k, passage, n) / length for k in (0, 1, 3, 4, 5)]
    stats += [_by_passage((kind >= 6), passage, n) / length, np.log1p(size) / 8]
    stats += _word_stats(data, kind, at, passage, n)
    features[:, TRIGRAMS:] = np.stack(stats, axis=1)
    return features, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(model: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Passage encodings h, attention a, document vectors z, probabilities p."""
    starts = np.cumsum(counts) - counts
    h = np.tanh(x @ model["E"] + model["e"])
    v, u = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    raw = (v * u) @ model["w"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), counts))
    a = raw / np.repeat(np.add.reduceat(raw, starts), counts)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": _sigmoid(z @ model["c"] + model["b"])}


def _gradients(
    model: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray, y: np.ndarray
) -> dict[str, np.ndarray]:
    f = _forward(model, x, counts)
    starts = np.cumsum(counts) - counts
    error = (f["p"] - y) / len(y)
    dz = np.repeat(error[:, None] * model["c"], counts, axis=0)
    da = (dz * f["h"]).sum(axis=1)
    draw = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), counts))
    dgate = draw[:, None] * model["w"]
    dv = dgate * f["u"] * (1 - f["v"] ** 2)
    du = dgate * f["v"] * f["u"] * (1 - f["u"])
    dh = f["a"][:, None] * dz + dv @ model["V"].T + du @ model["U"].T
    de = dh * (1 - f["h"] ** 2)
    return {
        "E": x.T @ de,
        "e": de.sum(axis=0),
        "V": f["h"].T @ dv,
        "U": f["h"].T @ du,
        "w": (f["v"] * f["u"]).T @ draw,
        "c": f["z"].T @ error,
        "b": error.sum(keepdims=True),
    }


def fit(
    bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, seed: int = 1
) -> dict[str, np.ndarray]:
    """Model fitted by Adam on bags of passage features and their 0/1 labels.

    Features are standardised inside the first layer. Without any bag the model scores 0.5.
    """
    rng = np.random.default_rng(seed)
    shapes = {"E": (WIDTH, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}
    model = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in shapes.items()}
    model |= {"e": np.zeros(HIDDEN), "b": np.zeros(1)}
    if not bags:
        return model | {"c": np.zeros(HIDDEN)}
    every = np.concatenate(bags).astype(np.float64)
    mean, scale = every.mean(axis=0), 1 / (every.std(axis=0) + 0.02)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = 0.004 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            counts = np.array([len(bags[i]) for i in chosen])
            x = (np.concatenate([bags[i] for i in chosen]) - mean) * scale
            step += 1
            for k, g in _gradients(model, x, counts, labels[chosen]).items():
                g = g + 1e-4 * model[k]
                m, s = moments[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                model[k] = model[k] - rate * (m / (1 - 0.9**step)) / (
                    np.sqrt(s / (1 - 0.999**step)) + 1e-8
                )
    model["e"] = model["e"] - (mean * scale) @ model["E"]
    model["E"] = scale[:, None] * model["E"]
    return {k: v.astype(np.float32) for k, v in model.items()}


def score_texts(model: dict[str, np.ndarray], texts: list[str | None]) -> np.ndarray:
    """Probability of label 1 for each text."""
    scores, held, size = [], [], 0
    for text in [*texts, None]:  # the last one only closes the last group
        held.append(text)
        size += len(text or "")
        if size > GROUP or len(held) == 2000 or len(scores) + len(held) == len(texts) + 1:
            scores.extend(_forward(model, *encode(held))["p"].tolist())
            held, size = [], 0
    return np.array(scores[: len(texts)], np.float64)


def held_out(doc_id: Column, one_of: int = HELD_OUT_OF) -> Column:
    """Whether a document is kept out of the fit: crc32 of the id as text divides by `one_of`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % one_of == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, np.ndarray]:
    """Fit on about `sample_rows` labelled documents that are not held out, chosen by id hash.

    Null labels are skipped. Passages are encoded in the tasks; the driver gets the features.
    """
    marked = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_y"))
    marked = marked.where(F.col("_y").isNotNull() & ~held_out(F.col("_id")))
    share = min(1.0, sample_rows / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    joined = rows.join(F.broadcast(chosen), "_id").select("_id", "_y", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encode([t.as_py()])[0].astype(np.float16).tobytes() for t in batch.column(2)]
            ids, ys = batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.float64())
            yield pa.record_batch([ids, ys, pa.array(bags, pa.binary())], ["id", "y", "bag"])

    found = sorted(joined.mapInArrow(run, "id long, y double, bag binary").collect())
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, WIDTH).astype(np.float32) for r in found]
    return fit(bags, np.array([r["y"] for r in found]))


def score(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """`docs` without the text, with `score` (0 to 1). Empty and null texts get a score too."""
    names = [c for c in docs.columns if c not in (text, "score")]
    columns = [F.col(f"`{c}`") for c in names]
    schema = docs.select(*columns, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            scores = score_texts(model, texts.to_pylist())
            yield pa.record_batch([*rest, pa.array(scores)], [*names, "score"])

    return docs.select(*columns, F.col(f"`{text}`")).mapInArrow(run, schema)


def keep_good(
    docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, in the columns of `docs`."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{text}`").alias("_text")
    )
    return score(packed, model, "_text").where(F.col("score") >= threshold).select("_doc.*")
