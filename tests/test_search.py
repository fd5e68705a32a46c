import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskweave.functions.vectors import cosine
from deskweave.operators import embedding, search
from deskweave.operators.profile import evaluation_limits, field_profile

DOCS = [
    ("d1", "Errore stampa", "la stampante non stampa, errore di rete"),
    ("d2", "Rete lenta", "la rete è lenta: rete, rete e ancora rete"),
    ("d3", "Password scaduta", "cambio password utente"),
    ("d4", "Errore", ""),
    ("d5", "Errore stampa", "la stampante non stampa, errore di rete"),
    ("d6", None, "altro testo senza parole cercate"),
]
QUESTIONS = [(1, "errore di RETE?"), (2, "password"), (3, "parola-assente xyz"), (4, "la la rete lenta")]
FIELDS = ("short_description", "content")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id string, short_description string, content string")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(QUESTIONS, "qid bigint, question string")


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def brute_force(k, fields=FIELDS):
    """BM25 by the book, one document and one question at a time."""
    out = []
    parts = {f: {d[0]: tokens(d[1 + FIELDS.index(f)]) for d in DOCS} for f in fields}
    for qid, question in QUESTIONS:
        scores = Counter()
        for field in fields:
            bags = parts[field]
            avg = sum(map(len, bags.values())) / len(bags)
            for term in set(tokens(question)):
                df = sum(term in bag for bag in bags.values())
                for key, bag in bags.items():
                    tf = bag.count(term)
                    if tf:
                        idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
                        scores[key] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / avg))
        best = sorted(((-round(s, 6), key) for key, s in scores.items()))[:k]
        out += [(qid, key, i + 1, -s) for i, (s, key) in enumerate(best)]
    return sorted(out)


def ranked(df):
    return sorted((r["qid"], r["id"], r["rank"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("k", [1, 2, 5])
def test_bm25_like_brute_force(docs, questions, k):
    got = ranked(search.rank_text(docs, questions, k, FIELDS))
    assert [g[:3] for g in got] == [e[:3] for e in brute_force(k)]
    assert np.allclose([g[3] for g in got], [e[3] for e in brute_force(k)], atol=1e-6)


def test_search_projection(docs):
    named = docs.withColumns(
        {"number": F.upper("id"), "assignment_group_name": F.lit("HD")}
    )
    got = search.search(named, "password", 3, FIELDS).collect()
    assert [(r["rank"], r["number"], r["short_description"]) for r in got] == [
        (1, "D3", "Password scaduta")
    ]
    assert search.search(named, "???", 3, FIELDS).collect() == []


# --- vectors ----------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    data = [(f"v{i:03d}", [float(x) for x in row]) for i, row in enumerate(rng.normal(size=(300, 16)))]
    data += [("zero", [0.0] * 16), ("none", None), ("short", [1.0, 2.0])]
    return spark.createDataFrame(data, "id string, contentVector array<float>")


def by_numpy(vectors, query, k):
    out = []
    for r in vectors.collect():
        v = np.array(r["contentVector"] if r["contentVector"] is not None else [], dtype=float)
        if len(v) == len(query) and np.linalg.norm(v) > 0:
            s = float(v @ query / np.linalg.norm(v) / np.linalg.norm(query))
            out.append((-round(s, 6), r["id"]))
    return [key for _, key in sorted(out)[:k]]


def test_nearest_like_numpy(vectors):
    query = np.random.default_rng(1).normal(size=16)
    got = [r["id"] for r in search.nearest(vectors, query.tolist(), 10).collect()]
    assert got == by_numpy(vectors, query, 10)
    everything = search.nearest(vectors, query.tolist(), 1000)
    assert everything.count() == 300


def test_cosine_column(spark):
    row = spark.range(1).select(
        cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("a"),
        cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("b"),
    ).first()
    assert row["a"] == pytest.approx(2**-0.5) and row["b"] is None


def test_hash_vectors(spark):
    rows = spark.createDataFrame([("a", "Rete, rete!"), ("b", "rete"), ("c", ""), ("d", None)], "id string, content string")
    got = {r["id"]: r["contentVector"] for r in embedding.hash_embed(rows, dimensions=32).collect()}
    assert got["a"] == got["b"] and len(got["a"]) == 32
    assert sum(x * x for x in got["a"]) == pytest.approx(1.0)
    assert got["c"] is None and got["d"] is None


def test_hash_vectors_like_a_plain_count(spark, monkeypatch):
    """More rows than are counted at once, words beyond those whose hashes are kept."""
    import hashlib

    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [[f"w{n}é" for n in rng.integers(0, 40, rng.integers(0, 9))] for _ in range(600)]

    def plain(words, dimensions):
        counts = np.zeros(dimensions)
        for w in words:
            counts[int(hashlib.md5(w.encode()).hexdigest()[:6], 16) % dimensions] += 1
        return (counts / np.sqrt((counts * counts).sum())).tolist() if words else None

    rows = spark.createDataFrame([(i, " ,".join(t)) for i, t in enumerate(texts)], "id int, content string")
    got = {r["id"]: r["contentVector"] for r in embedding.hash_embed(rows, "content", 24, "double").collect()}
    assert got == {i: plain(t, 24) for i, t in enumerate(texts)}
    monkeypatch.setattr(embedding, "KNOWN_WORDS", 5)
    known = {}
    for _ in range(2):
        assert embedding._hash_vectors(pa.array(texts), 24, known).to_pylist() == [plain(t, 24) for t in texts]
    assert len(known) <= 40


def test_vector_search_stores_no_texts(spark):
    from pathlib import Path

    from conftest import SMALL
    from deskweave.plans import catalog
    from deskweave.sources.space import shared_dir

    held = set(Path(shared_dir(spark)).glob("deskweave/*"))
    assert catalog.vector_text_topk(spark, SMALL).count() == 10
    assert set(Path(shared_dir(spark)).glob("deskweave/*")) == held


def test_text_query_uses_the_document_space(docs):
    def embed(df, column):
        return embedding.hash_embed(df, column, 64)

    found = search.nearest_text(embed(docs, "content"), "cambio password utente", embed, 1)
    assert found.first()["id"] == "d3" and found.first()["score"] == 1.0
    with pytest.raises(ValueError):
        search.nearest_text(embed(docs, "content"), "?!", embed)


def test_embed_documents(spark):
    def make():
        def embed(texts):
            assert 0 < len(texts) <= 2
            return [[float(len(t)), 1.0, 0.0, 0.0] for t in texts]

        return embed

    rows = spark.createDataFrame([("ciao",), ("mondo",), ("",), (None,), ("A" * 5000,)], "content string")
    got = embedding.embed_documents(rows.coalesce(1), make, call_texts=2, max_chars=5000)
    assert [r["contentVector"] and r["contentVector"][0] for r in got.collect()] == [4, 5, None, None, 5000]
    check = embedding.check_vectors(got, 4).first()
    assert (check["documents"], check["vectors"], check["wrong_length"]) == (5, 3, 0)
    assert embedding.check_vectors(got, 5).first()["wrong_length"] == 3


def test_long_texts_are_embedded_whole(spark):
    def make():
        return lambda texts: [[float(t.count("a")), float(t.count("b"))] for t in texts]

    rows = spark.createDataFrame([("a" * 10 + "b" * 5,), ("a" * 10,)], "content string")
    got = [r["contentVector"] for r in embedding.embed_documents(rows.coalesce(1), make, max_chars=10).collect()]
    mean = np.array([100.0, 25.0]) / 15
    assert np.allclose(got[0], mean / np.linalg.norm(mean)) and got[1] == [10.0, 0.0]


def test_tokenizer_windows(spark):
    class Blanks:
        def encode(self, text):
            return text.split()

        def decode(self, tokens):
            return " ".join(tokens)

    blanks = Blanks

    def make():
        return lambda texts: [[float(len(t.split()))] for t in texts]

    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = spark.createDataFrame([("parola " * 50,), ("parola " * 120,)], "content string")
    got = embedding.embed_documents(rows.coalesce(1), make, make_tokenizer=lambda: blanks(), max_tokens=50)
    assert [r["contentVector"] for r in got.collect()] == [[50.0], [1.0]]


def test_model_errors_are_tried_again_then_raised(spark):
    def flaky():
        calls = []

        def embed(texts):
            calls.append(1)
            if len(calls) < 3:
                raise RuntimeError("busy")
            return [[1.0] for _ in texts]

        return embed

    rows = spark.createDataFrame([("x",)], "content string")
    assert embedding.embed_documents(rows, flaky).first()["contentVector"] == [1.0]
    with pytest.raises(Exception, match="busy"):
        embedding.embed_documents(rows, flaky, attempts=2).collect()


# --- profiles ---------------------------------------------------------------


def test_field_profile(spark):
    rows = spark.createDataFrame([("a\nb", None), ("x" * 90, ""), ("", "v")], "t string, u string")
    got = {r["field"]: r for r in field_profile(rows, ["t", "u", "absent"]).collect()}
    assert (got["t"]["present"], got["t"]["filled"], got["t"]["max_length"]) == (3, 2, 90)
    assert got["t"]["example"] == "a b"
    assert (got["u"]["present"], got["u"]["filled"], got["u"]["example"]) == (2, 1, "v")
    assert (got["absent"]["records"], got["absent"]["present"]) == (3, 0)


def test_profile_of_landed_cells(spark):
    rows = spark.createDataFrame(
        [('{"value": "1", "display_value": "uno"}',), ('"bare"',), (None,)], "c string"
    ).select(F.parse_json("c").alias("category"))
    row = field_profile(rows).first()
    assert (row["present"], row["filled"], row["max_length"], row["example"]) == (2, 2, 4, "bare")


@pytest.mark.parametrize("count, chars, good", [(100, 500, True), (101, 5, False), (3, 501, False)])
def test_evaluation_limits(spark, count, chars, good):
    rows = spark.range(count).select(F.repeat(F.lit("x"), F.lit(chars)).alias("question"))
    row = evaluation_limits(rows).first()
    assert (row["questions"], row["longest"], row["within_limits"]) == (count, chars, good)
