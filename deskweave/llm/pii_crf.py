"""Personal data by patterns and a linear-chain conditional random field.

Patterns give the base spans. A CRF over the word shapes of white-space tokens is trained from
a small labelled table and decoded by Viterbi in numpy batches; what it finds beside the base
spans is added. Documents are decoded whole: all texts of a batch advance together, token by
token, and leave when they end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# label 0 is "no entity"; kind k begins with 2k + 1 and goes on with 2k + 2
LABELS = 2 * len(KINDS) + 1
SHAPES = 1 << 12
FEATURES = ("shape", "before", "after", "pair", "ends")
SAMPLE_ROWS = 1200
SAMPLE_CHARS = 50_000  # of a document in the sample
EPOCHS = 4
BATCH_TOKENS = 400_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[tuple[int, int]]:
    """Address spans. Each `@` is tried once, so long runs of letters cost no more."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1, start):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        else:
            last = max(last, at)
        at = text.find("@", max(at + 1, last))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start."""
    found = [(0, *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NO_DIGIT.sub("", m[0])
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


# --- tokens and features ------------------------------------------------------


def _kind_table() -> np.ndarray:
    table = np.full(128, 9, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[65:91] = 1
    table[97:123] = 2
    table[48:58] = 3
    for i, c in enumerate("@.-+("):
        table[ord(c)] = 4 + i
    table[ord(")")] = 8
    return table


def tokens(texts: list[str]) -> dict[str, np.ndarray]:
    """White-space tokens of all texts: doc, start, end (code points), features, trims.

    `first` and `last` are the token without marks at its ends. Code points of all texts are
    worked on as one array.
    """
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    table = _kind_table()
    kind = np.where(points < 128, table[np.minimum(points, 127)], 2).astype(np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    origin = np.cumsum(sizes) - sizes
    inside = np.concatenate(([0], (kind > 0).view(np.int8), [0]))
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(origin, start, side="right") - 1
    n = len(start)
    if not n:
        none = np.zeros(0, np.int64)
        return {"doc": none, "start": none, "end": none, "first": none, "last": none,
                "features": np.zeros((len(FEATURES), 0), np.int64)}
    # runs of one kind; the length of digit runs counts, up to 20
    turn = np.ones(len(kind), bool)
    turn[1:] = kind[1:] != kind[:-1]
    run = np.flatnonzero(turn)
    length = np.diff(np.append(run, len(kind)))
    code = kind[run].astype(np.uint64) * np.uint64(32)
    code += np.where(kind[run] == 3, np.minimum(length, 20), np.minimum(length, 2)).astype(np.uint64)
    first_run = np.searchsorted(run, start)
    stop_run = np.searchsorted(run, end)
    weight = np.power(np.uint64(0x9E3779B97F4A7C15), np.arange(32, dtype=np.uint64))
    token_of = np.repeat(np.arange(n), stop_run - first_run)
    place = np.arange(len(token_of)) - np.repeat(
        np.cumsum(stop_run - first_run) - (stop_run - first_run), stop_run - first_run
    )
    which = np.repeat(first_run, stop_run - first_run) + place
    mixed = (code[which] + np.uint64(7)) * weight[place & 31]
    shape = np.add.reduceat(mixed, np.cumsum(stop_run - first_run) - (stop_run - first_run))
    shape = _fold(shape)
    new = np.ones(n, bool)
    new[1:] = doc[1:] != doc[:-1]
    before = np.where(new, 0, np.concatenate(([0], shape[:-1])))
    after = np.where(np.append(new[1:], True), 1, np.append(shape[1:], 1))
    pair = _fold((before.astype(np.uint64) << np.uint64(16)) + shape.astype(np.uint64))
    ends = kind[start].astype(np.int64) * 16 + kind[end - 1]
    # ends without marks: the outermost letters, digits and "+"
    solid = (kind >= 1) & (kind <= 3) | (kind == 7)
    at = np.where(solid, np.arange(len(kind)), len(kind))
    first = np.minimum.reduceat(at, start)
    first = np.where((first >= start) & (first < end), first, start)
    at = np.where(solid, np.arange(len(kind)), -1)
    last = np.maximum.reduceat(np.where(kind > 0, at, -1), start) + 1
    last = np.where((last > start) & (last <= end), last, end)
    shift = origin[doc]
    return {
        "doc": doc, "start": start - shift, "end": end - shift,
        "first": first - shift, "last": last - shift,
        "features": np.stack([shape, before, after, pair, ends]),
    }


def _fold(code: np.ndarray) -> np.ndarray:
    mixed = code * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(40)) & np.uint64(SHAPES - 1)).astype(np.int64)


def gold_labels(found: dict[str, np.ndarray], spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Labels of the tokens that overlap the documents' labelled spans."""
    labels = np.zeros(len(found["doc"]), np.int64)
    begins = np.searchsorted(found["doc"], np.arange(len(spans) + 1))
    for d, own in enumerate(spans):
        lo, hi = begins[d], begins[d + 1]
        for kind, start, end in own:
            a = lo + np.searchsorted(found["end"][lo:hi], start, side="right")
            b = lo + np.searchsorted(found["start"][lo:hi], end, side="left")
            if a < b and not labels[a:b].any():
                labels[a] = 2 * kind + 1
                labels[a + 1 : b] = 2 * kind + 2
    return labels


# --- the chain ----------------------------------------------------------------


def _lanes(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every document's tokens, the longest first."""
    cuts = np.flatnonzero(np.diff(doc)) + 1
    starts = np.concatenate(([0], cuts)) if len(doc) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(doc)))
    order = np.argsort(-lengths, kind="stable")
    return starts[order], lengths[order]


def _emissions(model: dict[str, np.ndarray], features: np.ndarray) -> np.ndarray:
    total = model["bias"] + model[FEATURES[0]][features[0]]
    for name, row in zip(FEATURES[1:], features[1:], strict=True):
        total += model[name][row]
    return total


def viterbi(model: dict[str, np.ndarray], found: dict[str, np.ndarray]) -> np.ndarray:
    """Best label sequence of every document."""
    emit = _emissions(model, found["features"])
    starts, lengths = _lanes(found["doc"])
    best = np.zeros(len(emit), np.int64)
    if not len(emit):
        return best
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    score = emit[starts] + model["start"]
    back = []
    for t in range(1, lengths[0]):
        m = active[t]
        options = score[:m, :, None] + model["move"]
        back.append(options.argmax(axis=1).astype(np.int8))
        score[:m] = options.max(axis=1) + emit[starts[:m] + t]
    label = score.argmax(axis=1)
    for t in range(lengths[0] - 1, 0, -1):
        m = active[t]
        best[starts[:m] + t] = label[:m]
        label[:m] = back[t - 1][np.arange(m), label[:m]]
    best[starts] = label
    return best


def _expected(model: dict[str, np.ndarray], emit: np.ndarray, doc: np.ndarray):
    """Label probabilities of every token and the expected number of every transition.

    Forward and backward sums are scaled to 1 at every token.
    """
    starts, lengths = _lanes(doc)
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    move = np.exp(model["move"])
    emit[starts] += model["start"]
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    ahead, behind, scale = np.empty_like(emit), np.ones_like(emit), np.empty((len(emit), 1))
    for t in range(lengths[0]):
        at = starts[: active[t]] + t
        now = (ahead[at - 1] @ move) * emit[at] if t else emit[at]
        scale[at] = now.sum(axis=1, keepdims=True)
        ahead[at] = now / scale[at]
    moves = np.zeros_like(move)
    for t in range(lengths[0] - 1, 0, -1):
        at = starts[: active[t]] + t
        later = emit[at] * behind[at] / scale[at]
        behind[at - 1] = later @ move.T
        moves += (ahead[at - 1].T @ later) * move
    return ahead * behind, moves, starts


def fit(
    texts: list[str], spans: list[list[tuple[int, int, int]]], epochs: int = EPOCHS,
    batch: int = 64, seed: int = 1,
) -> dict[str, np.ndarray]:
    """Maximum-likelihood CRF by Adagrad on labelled texts; without texts it labels nothing."""
    sizes = {"shape": SHAPES, "before": SHAPES, "after": SHAPES, "pair": SHAPES, "ends": 256}
    model = {k: np.zeros((n, LABELS), np.float64) for k, n in sizes.items()}
    model |= {"bias": np.zeros(LABELS), "start": np.zeros(LABELS), "move": np.zeros((LABELS, LABELS))}
    model["bias"][0] = 1.0
    model["move"][:, 2::2] = -8.0  # an entity goes on only after its own kind
    for k in range(1, LABELS, 2):
        model["move"][k : k + 2, k + 1] = 0.0
    model["start"][2::2] = -8.0
    seen = {k: np.full_like(v, 1.0) for k, v in model.items()}
    rng = np.random.default_rng(seed)
    by_length = sorted(range(len(texts)), key=lambda i: len(texts[i]))  # alike advance together
    batches = [by_length[at : at + batch] for at in range(0, len(texts), batch)]
    for _ in range(epochs):
        for number in rng.permutation(len(batches)):
            chosen = batches[number]
            found = tokens([texts[i] for i in chosen])
            if not len(found["doc"]):
                continue
            gold = gold_labels(found, [spans[i] for i in chosen])
            emit = _emissions(model, found["features"])
            wanted, moves, starts = _expected(model, emit, found["doc"])
            error = -wanted
            error[np.arange(len(gold)), gold] += 1
            follows = found["doc"][1:] == found["doc"][:-1]
            real = np.bincount(
                gold[:-1][follows] * LABELS + gold[1:][follows], minlength=LABELS**2
            ).reshape(LABELS, LABELS)
            change = {"bias": error.sum(axis=0), "start": error[starts].sum(axis=0), "move": real - moves}
            for name, row in zip(FEATURES, found["features"], strict=True):
                change[name] = np.stack(
                    [np.bincount(row, weights=e, minlength=sizes[name]) for e in error.T], axis=1
                )
            for k, g in change.items():
                g = g - 1e-4 * model[k]
                seen[k] += g * g
                model[k] += 0.5 * g / np.sqrt(seen[k])
    return {k: v.astype(np.float32) for k, v in model.items()}


# --- finding --------------------------------------------------------------------


def added_spans(
    model: dict[str, np.ndarray], texts: list[str], base: list[list[tuple[int, int, int]]]
) -> list[list[tuple[int, int, int]]]:
    """Spans the chain finds that touch no base span, without marks at their ends."""
    found = tokens(texts)
    label = viterbi(model, found)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    marked = np.flatnonzero(label)
    i = 0
    while i < len(marked):
        a = b = marked[i]
        kind = (label[a] - 1) // 2
        while (
            i + 1 < len(marked) and marked[i + 1] == b + 1
            and label[b + 1] == 2 * kind + 2 and found["doc"][b + 1] == found["doc"][a]
        ):
            i, b = i + 1, b + 1
        i += 1
        d, start, end = found["doc"][a], int(found["first"][a]), int(found["last"][b])
        if start < end and not any(s < end and start < e for _, s, e in base[d]):
            added[d].append((int(kind), start, end))
    return added


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded size; a text is never cut."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > 4 * BATCH_TOKENS:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def find(model: dict[str, np.ndarray], texts: list[str | None]):
    """Base spans and added spans of every text."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) for t in texts]
    added: list[list[tuple[int, int, int]]] = []
    for a, b in _groups(texts):
        added += added_spans(model, texts[a:b], base[a:b])
    return base, added


def labelled_table(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """A small labelled table: at most `rows` documents of SAMPLE_CHARS characters or less, with
    base spans.

    Chosen by the hash of id and text, so null and repeated ids count as any others; of equal
    rows one is taken.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    own = own.where(F.length("text") <= SAMPLE_CHARS).withColumn("_h", F.xxhash64("doc_id", "text"))
    last = own.select("_h").distinct().orderBy("_h").limit(rows).agg(F.max("_h")).first()[0]
    chosen = own.where(F.col("_h") <= F.lit(last).cast("long")).dropDuplicates(["_h"]).drop("_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[list(s) for s in base_spans(t.as_py())] for t in batch.column(1)]
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.record_batch([*batch.columns, pa.array(spans, kind)], ["doc_id", "text", "spans"])

    schema = chosen.withColumn("spans", F.array().cast("array<array<bigint>>")).schema
    return chosen.mapInArrow(run, schema)


def train(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Fit on a small labelled table (text, spans of kind number, start, end)."""
    rows = sorted(labelled.select("text", "spans").collect(), key=lambda r: (r["text"], r["spans"]))
    return fit([r["text"] for r in rows], [[tuple(s) for s in r["spans"]] for r in rows])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def detect(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """`docs` without the text, with n_<kind> and base_sha256 of the base spans and all `spans`.

    Null and empty texts have no spans.
    """
    counts = [f"n_{k}" for k in KINDS]
    made = [*counts, "base_sha256", "spans"]
    names = [c for c in docs.columns if c not in (text, *made)]
    columns = [F.col(f"`{c}`") for c in names]
    zero = [F.lit(0).cast("long").alias(c) for c in counts]
    schema = docs.select(*columns, *zero, F.lit("").alias("base_sha256"), F.lit("").alias("spans")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            base, added = find(model, texts.to_pylist())
            numbers = [[sum(k == i for k, _, _ in b) for b in base] for i in range(len(KINDS))]
            digests = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            spans = [_joined(b + a) for b, a in zip(base, added, strict=True)]
            made = [pa.array(c, pa.int64()) for c in numbers] + [pa.array(digests), pa.array(spans)]
            yield pa.record_batch([*rest, *made], [*names, *counts, "base_sha256", "spans"])

    return docs.select(*columns, F.col(f"`{text}`")).mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """`text` with every span replaced by its kind; overlapping spans become one."""
    pieces, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
        end = -end
        if start >= at:
            pieces += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def mask(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """`docs` with all found spans masked in the text; null texts stay null."""
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            base, added = find(model, texts)
            clean = [
                None if t is None else masked(t, b + a)
                for t, b, a in zip(texts, base, added, strict=True)
            ]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, pa.string())
            yield pa.record_batch(columns, names)

    return docs.mapInArrow(run, docs.schema)
