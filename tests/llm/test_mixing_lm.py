import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import mixing_lm as lm

TEXTS = [b"the cat and the dog", b"", b"the end", b"\xc3\xa9t\xc3\xa9 \x00 x", b"a" * 3000]


def trained(texts):
    trees = lm.Trees(lm.pair_counts(texts))
    tables = lm.empty_tables()
    lm.count_decisions(trees, texts, tables)
    return trees, [lm.odds(t) for t in tables]


def test_paths_are_complete_prefix_codes():
    trees = lm.Trees(lm.pair_counts(TEXTS))
    for before in (0, ord("t"), 255):
        size = trees.size[before * 256 : before * 256 + 256]
        assert math.isclose((2.0 ** -size.astype(float)).sum(), 1.0)
        paths = {tuple(trees.steps[c : c + s]) for c, s in
                 zip(trees.code[before * 256 : before * 256 + 256], size, strict=True)}
        assert len(paths) == 256


def test_bits_against_one_text_at_a_time():
    trees, tables = trained(TEXTS * 3)
    whole = lm.text_bits(trees, tables, TEXTS)
    alone = [lm.text_bits(trees, tables, [t])[0] for t in TEXTS]
    assert np.allclose(whole, alone, rtol=1e-4) and (whole > 0).all()


def test_probabilities_sum_to_one():
    """Over all bytes that may follow a text's beginning."""
    trees, tables = trained([b"abab abba aabb " * 20])
    blobs = [bytes([b]) for b in range(1, 256)]
    first = 2.0 ** -lm.text_bits(trees, tables, [b""])[0]
    # P(byte) = P(byte, end) / P(end | byte); the end's share comes from two-byte texts
    total = first
    for blob in blobs:
        both = 2.0 ** -lm.text_bits(trees, tables, [blob + bytes([b]) for b in (97, 98)])
        assert both.sum() <= 1
    total += sum(2.0 ** -lm.text_bits(trees, tables, [b])[0] for b in blobs)
    assert 0 < total <= 1.0001


def test_learned_text_takes_fewer_bits():
    trees, tables = trained([b"the cat sat on the mat. " * 40])
    known, other = lm.text_bits(trees, tables, [b"the cat sat on the mat. " * 4, b"zq vx jk wq pz gh. " * 5])
    assert known < 0.2 * other


def plain_base(docs):
    counts = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*(t or "").encode().lower().split(), b""])
    n, v = counts.total(), len(counts)
    out = []
    for i, t in docs:
        words = [*(t or "").encode().lower().split(), b""]
        out.append((
            i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(words),
            sum(counts[w] > 0 for w in words), n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 6),
        ))
    return sorted(out, key=repr)


def rows_of(df):
    keep = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return sorted(((*(r[c] for c in keep), round(r["base_score"], 6)) for r in df.collect()), key=repr)


def test_base_against_brute_force(spark, make_docs, some_docs):
    docs = [(i, t) for i, t, _ in some_docs] + [(None, "Null id"), (10**9, None), (1, ""), (3, "x" * 5000)]
    table = make_docs(docs).withColumns({c: F.lit(1) for c in ("row", "token", "c", "score", "rest")})
    for head in (lm.HEAD, 50, 0):
        assert rows_of(lm.score(table, head=head)) == plain_base(docs)


def test_score_is_the_models(spark, make_docs):
    docs = [(i, "the cat sat on the mat " * (i + 1)) for i in range(12)]
    got = {r["doc_id"]: r["score"] for r in lm.score(make_docs(docs)).collect()}
    blobs = [lm._blob(t) for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    trees, tables = trained(blobs)
    want = -lm.text_bits(trees, tables, [lm._blob(t) for _, t in docs]) * math.log10(2)
    assert np.allclose([got[i] for i, _ in docs], want, rtol=1e-4)


def test_no_training_rows_and_no_rows(spark, make_docs):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = lm.score(make_docs([(held, "a b")])).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert row["score"] < 0
    assert lm.score(make_docs([])).count() == 0


def test_the_gate_chooses_the_weights_of_every_decision():
    """Bits against a plain decision-by-decision mixing of two weight sets."""
    rng = np.random.default_rng(3)
    blobs = [bytes(rng.integers(97, 101, n, np.uint8)) for n in (0, 3, 700, 40_000)]
    trees = lm.Trees(sum(lm.pair_counts([b]) for b in blobs))
    counts = lm.empty_tables()
    lm.count_decisions(trees, blobs[2:3], counts)
    tables = [lm.odds(c) for c in counts]
    assert lm.CHUNK < len(blobs[3])
    for blob, bits in zip(blobs, lm.text_bits(trees, tables, blobs), strict=True):
        slots, outcome, _ = lm.decisions(trees, [blob])
        sign = (2.0 * outcome - 1) / lm.SCALE
        x = np.stack([t[s] * sign for t, s in zip(tables, slots, strict=True)])
        seen = tables[-1][slots[-1]] != 0
        weights = {True: np.array(lm.START), False: np.array(lm.START)}
        spent = 0.0
        for at in range(0, len(outcome), lm.STEP):
            part, gate = x[:, at : at + lm.STEP], seen[at : at + lm.STEP]
            margin = np.where(gate, weights[True] @ part, weights[False] @ part)
            error = 1 / (1 + np.exp(margin))
            spent += np.log2(1 + np.exp(-margin)).sum()
            for side in weights:
                weights[side] = weights[side] + lm.RATE * (part * error)[:, gate == side].sum(axis=1)
        assert abs(spent - bits) <= 1e-4 * max(1, spent)


def test_decisions_are_worked_out_in_parts(monkeypatch):
    blobs = [b"some words and more words " * 40, b"", b"x"]
    trees = lm.Trees(sum(lm.pair_counts([b]) for b in blobs))
    whole = lm.decisions(trees, blobs)
    monkeypatch.setattr(lm, "CHUNK", 7)
    parts = lm.decisions(trees, blobs)
    assert all((a == b).all() for a, b in zip(whole[0], parts[0], strict=True))
    assert (whole[1] == parts[1]).all() and (whole[2] == parts[2]).all()
