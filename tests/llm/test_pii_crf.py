import hashlib
import re
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_data import make_docs  # noqa: F401

from deskweave.llm import pii_crf

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                double = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(double) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@given(st.lists(st.sampled_from([*"a0149@.-+ ()%x,é", "4111 1111 1111 1111", "10.0.0.255", "+1 (555) 555-1234", "a@b.c"]), max_size=25).map("".join))
@settings(deadline=None, max_examples=400)
def test_base_spans(text):
    assert pii_crf.base_spans(text) == plain(text)


def test_long_runs_take_no_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "a@" * 100_000, "1." * 100_000):
        pii_crf.base_spans(text)


def test_tokens_of_several_texts():
    texts = ["", "One (two), 3", "\n", "é+4"]
    found = pii_crf.tokens(texts)
    cut = [(int(d), texts[d][s:e], texts[d][f:t]) for d, s, e, f, t in
           zip(*(found[k] for k in ("doc", "start", "end", "first", "last")), strict=True)]
    assert cut == [(1, "One", "One"), (1, "(two),", "two"), (1, "3", "3"), (3, "é+4", "é+4")]
    assert pii_crf.tokens(["", " "])["doc"].size == 0


def test_viterbi_and_sums_against_all_sequences():
    rng = np.random.default_rng(3)
    model = {k: rng.normal(size=(n, pii_crf.LABELS)) for k, n in
             (("shape", pii_crf.SHAPES), ("before", pii_crf.SHAPES), ("after", pii_crf.SHAPES), ("pair", pii_crf.SHAPES), ("ends", 256))}
    model |= {"bias": rng.normal(size=9), "start": rng.normal(size=9), "move": rng.normal(size=(9, 9))}
    found = pii_crf.tokens(["Ab 12 c@d", "", "x", "+1 99."])
    best = pii_crf.viterbi(model, found)
    emit = pii_crf._emissions(model, found["features"])
    wanted, moves, _ = pii_crf._expected(model, emit.copy(), found["doc"])
    total = np.zeros((9, 9))
    for d in (0, 2, 3):
        own = np.flatnonzero(found["doc"] == d)
        scores = {}
        for path in product(range(9), repeat=len(own)):
            value = model["start"][path[0]] + sum(emit[t, y] for t, y in zip(own, path, strict=True))
            scores[path] = value + sum(model["move"][a, b] for a, b in zip(path, path[1:]))
        assert max(scores, key=scores.get) == tuple(best[own])
        z = sum(np.exp(v) for v in scores.values())
        share = np.zeros((len(own), 9))
        for path, v in scores.items():
            for t, y in enumerate(path):
                share[t, y] += np.exp(v) / z
            for a, b in zip(path, path[1:]):
                total[a, b] += np.exp(v) / z
        assert np.allclose(share, wanted[own], atol=1e-9)
    assert np.allclose(total, moves, atol=1e-9)


def test_chain_finds_held_out_entities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    model = pii_crf.fit(texts[:700], [pii_crf.base_spans(t) for t in texts[:700]])
    rest = texts[700:]
    gold = [set(pii_crf.base_spans(t)) for t in rest]
    guess = [set(s) for s in pii_crf.added_spans(model, rest, [[] for _ in rest])]
    hits = sum(len(a & b) for a, b in zip(gold, guess, strict=True))
    assert hits >= 0.6 * sum(map(len, gold)) and hits >= 0.85 * sum(map(len, guess))


def test_query_columns_and_masks(spark, make_docs):
    text = "é mail bob@x.org, 10.0.0.1 or 4111 1111 1111 1111."
    docs = make_docs([(1, text), (2, None), (3, ""), (None, text), (1, text)])
    docs = docs.withColumns({c: F.lit("z") for c in ("spans", "n_ip", "kind")})
    model = pii_crf.train(pii_crf.labelled_table(docs))
    rows = pii_crf.detect(docs, model).collect()
    base = "email:7:16,ip:18:26,card:30:49"
    for r in rows:
        if r["doc_id"] in (1, None):
            assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 0)
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
            assert set(base.split(",")) <= set(r["spans"].split(","))
        else:
            assert r["spans"] == "" and r["n_email"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii_crf.mask(docs, model).collect()}
    assert clean[1] == "é mail [EMAIL], [IP] or [CARD]." and clean[2] is None and clean[3] == ""
    assert pii_crf.mask(docs, model).columns == docs.columns
    none = docs.where("false")
    assert pii_crf.detect(none, pii_crf.train(pii_crf.labelled_table(none))).count() == 0


def test_masked_merges_overlaps():
    assert pii_crf.masked("abcdef", [(0, 1, 3), (3, 2, 5)]) == "a[EMAIL]f"


def test_the_sample_is_bounded_whatever_the_ids(make_docs):
    rows = [(None, f"text {i} a@b{i}.org") for i in range(300)] + [(7, f"other {i}") for i in range(300)]
    rows += [(i, "same") for i in range(50)] + [(3, "same")] * 30 + [(1, "x" * 60_000)]
    chosen = pii_crf.labelled_table(make_docs(rows), rows=100).collect()
    assert len(chosen) == 100 and {r["doc_id"] is None for r in chosen} == {True, False}
    everything = pii_crf.labelled_table(make_docs(rows), rows=10**6).collect()
    assert len(everything) == 650 and max(len(r["text"]) for r in everything) <= pii_crf.SAMPLE_CHARS
    assert pii_crf.labelled_table(make_docs([])).count() == 0
