import zlib

import numpy as np
from pyspark.sql import functions as F

from llm_data import make_docs  # noqa: F401

from deskweave.llm import quality


def test_gradients():
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    x = rng.normal(size=(8, quality.WIDTH))
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fit([x[:3].astype(np.float32)], np.array([1.0]), epochs=0)
    model = {k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in model.items()}

    def loss(m):
        p = quality._forward(m, x, counts)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, grad in quality._gradients(model, x, counts, y).items():
        at = tuple(rng.integers(0, n) for n in model[name].shape)
        up, down = ({**model, name: model[name].copy()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - grad[at]) < 1e-6


def test_passages_cover_the_text():
    texts = ["", None, "a", "Word " * 1000, "é" * 900]
    features, counts = quality.encode(texts)
    assert counts.tolist() == [1, 1, 1, 6, 2] and len(features) == 11
    assert not features[:2].any() and features[2:].any(axis=1).all()
    alone = np.concatenate([quality.encode([t])[0] for t in texts])
    assert np.allclose(alone, features, atol=1e-6)


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    model = quality.fit([rng.normal(size=(2, quality.WIDTH)).astype(np.float32)] * 4, np.array([1, 0, 1, 0.0]), 1)
    texts = ["one", None, "two three " * 500, "x!" * 99] * 3
    assert np.allclose(quality.score_texts(model, texts), [quality.score_texts(model, [t])[0] for t in texts], atol=1e-5)
    assert len(quality.score_texts(model, [])) == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    scored = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum((r["score"] >= quality.THRESHOLD) == (r["quality"] == 1) for r in held)
    assert right >= 0.97 * len(held)


def test_learns_only_from_rows_not_held_out(spark, make_docs):
    docs = make_docs([(i, "good text here " * 20) for i in range(40)])
    rows = [(i, int(zlib.crc32(str(i).encode()) % 5 != 0)) for i in range(40)] + [(1, None), (None, 0)]
    model = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    scores = [r["score"] for r in quality.score(docs, model).collect()]
    assert min(scores) > 0.5  # every label it may see is 1


def test_odd_tables(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs([(1, None), (2, ""), (None, "x"), (3, "long " * 50_000), (3, "x")])
    docs = docs.withColumns({c: F.lit("z") for c in ("score", "_doc", "_text", "_y")})
    model = quality.train(docs, labels)
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.keep_good(docs, model, threshold=0.6).count() == 0
    assert quality.score(docs.where("false"), model).count() == 0
