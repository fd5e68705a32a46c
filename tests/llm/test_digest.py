import hashlib

import numpy as np
from pyspark.sql import functions as F

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import digest


def plain_entropy(window):
    share = np.bincount(np.frombuffer(window, np.uint8)) / len(window)
    share = share[share > 0]
    return -(share * np.log2(share)).sum() / np.log2(len(window))


def test_entropies_against_brute_force():
    rng = np.random.default_rng(0)
    data = rng.choice(np.frombuffer(b"aabcdefgh .", np.uint8), 700)
    blob = data.tobytes()
    want = [min(digest.BINS - 1, int(plain_entropy(blob[i : i + digest.WINDOW]) * digest.BINS + 1e-6))
            for i in range(len(blob) - digest.WINDOW + 1)]
    assert np.abs(digest.entropies(data) - want).max() <= 1
    texts = [blob, b"", b"short", blob[:60], blob[5:]]
    kept, digest.CHUNK = digest.CHUNK, 100
    parts = digest._all_entropies(texts)
    digest.CHUNK = kept
    for text, part in zip(texts, parts, strict=True):
        assert np.array_equal(part, digest.entropies(np.frombuffer(text, np.uint8)))


def test_features_are_leftmost_rarest():
    rank = np.array([5, 3, 3, 9, 1, 1, 8] * 30, np.int32)
    at = [min(range(i, i + digest.RUN), key=lambda j: (rank[j], j)) for i in range(len(rank) - digest.RUN + 1)]
    points = np.bincount(at, minlength=len(rank))
    want = np.flatnonzero(points >= digest.POINTS)
    want = want if len(want) >= digest.FEW else np.flatnonzero(points)
    assert np.array_equal(digest._features(rank, len(rank)), want)


def test_likeness():
    rank = np.arange(digest.BINS, dtype=np.int32)
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, 6).tolist()) for _ in range(3000)]
    a, b = b" ".join(words[:2000]), b" ".join(words[2000:])
    own = digest.digest(a, rank)
    assert len(own) > 1 and digest.likeness(own, own) == 1.0
    near = digest.digest(a[: len(a) * 2 // 3] + b[: len(a) // 3], rank)
    assert digest.likeness(own, near) > 0.4 > 0.2 > digest.likeness(own, digest.digest(b, rank))
    none = digest.digest(b"", rank)
    assert digest.likeness(none, none) == 1.0 and digest.likeness(none, own) == 0.0
    assert digest.digest(b"x", rank).shape == (1, digest.FILTER_BITS // 8)


def plain_report(docs):
    order = sorted((d for d in docs if d[0] is not None), key=lambda d: -d[0])
    order += [d for d in docs if d[0] is None]
    out = []
    for (i, t), (_, later) in zip(order, order[1:] + order[:1], strict=True):
        t, later = t or "", later or ""
        k = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - k] + later[:k]).encode()).hexdigest()))
    return out


def test_report_against_brute_force(spark, make_docs, some_docs):
    docs = [(i, t) for i, t, _ in some_docs] + [(None, "without id"), (10**15, None), (-5, "é" * 10)]
    docs = make_docs(docs).withColumns({c: F.lit(1) for c in ("range", "guest", "tie", "fingerprint")})
    rows = digest.neighbour_report(docs).collect()
    got = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr)
    assert got == sorted(plain_report([(r["doc_id"], r["text"]) for r in docs.collect()]), key=repr)
    same = {r["doc_id"]: r["fingerprint"] for r in rows}
    rank_of = digest.ranks(digest.class_counts(docs))
    for r in digest.fingerprints(docs.select("doc_id", "text"), rank_of).collect():
        assert same[r["doc_id"]] == r["fingerprint"]
    long = [r for r in rows if r["n_chars"] >= 1000]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.97 * len(long)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_repeated_single_and_no_rows(spark, make_docs):
    rows = digest.neighbour_report(make_docs([(1, "same text " * 9)] * 3 + [(2, "other")])).collect()
    assert len(rows) == 4
    rows = digest.neighbour_report(make_docs([(1, "alone " * 50)])).collect()
    assert len(rows) == 1 and rows[0]["near_next"] == 1.0
    assert digest.neighbour_report(make_docs([])).count() == 0
    assert {r["doc_id"] for r in digest.neighbour_report(make_docs([(None, "a"), (None, None)])).collect()} == {None}


def test_rows_without_id_are_split_by_text(spark, make_docs):
    docs = make_docs([(None, f"text number {i} " * (i % 7)) for i in range(60)] + [(i, f"named {i}") for i in range(30)])
    ties = {r["text"]: r["tie"] for r in docs.select("text", F.xxhash64("text").alias("tie")).collect()}
    order = sorted((r["doc_id"] is None, -(r["doc_id"] or 0), ties[r["text"]], r["text"]) for r in docs.collect())
    want = []
    for (_, down, _, t), (*_, later) in zip(order, order[1:] + order[:1], strict=True):
        k = len(t) // 3
        want.append((len(t), hashlib.sha256((t[: len(t) - k] + later[:k]).encode()).hexdigest()))
    got = [(r["n_chars"], r["edited_sha256"]) for r in digest.neighbour_report(docs).collect()]
    assert sorted(got) == sorted(want)
    ranges = digest._in_order(docs.select("doc_id", "text"), 9).where("doc_id is null and not guest")
    assert ranges.select("range").distinct().count() > 3


def test_plans_with_many_partitions(spark, make_docs):
    edges = list(range(9000, 0, -3))
    above = digest._edges_above(edges, F.col("id"))
    assert spark.range(-5, 9010).where(above != F.greatest(F.lit(0), F.least(F.lit(3000), F.floor((9002 - F.col("id")) / 3)))).count() == 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3000)
    try:
        docs = make_docs([(i, "some text") for i in range(9000)]).coalesce(2)
        plan = digest._in_order(docs.select("doc_id", "text"), 3000)._jdf.queryExecution().executedPlan().toString()
        assert "range" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
