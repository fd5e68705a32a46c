import numpy as np
import pytest

from conftest import SMALL
from deskweave.operators import vector_index
from deskweave.operators.vector_index import VectorIndex, nearest_batch, recall
from deskweave.plans import catalog

SCHEMA = "id string, contentVector array<float>"


def brute(rows, queries, k):
    """(qid, rank, id, score), scores rounded, ties by key."""
    out = []
    for qid, q in queries:
        scored = []
        for key, v in rows:
            if key is not None and v is not None and len(v) == len(q) and np.linalg.norm(v) > 0:
                v, u = np.array(v, np.float32).astype(float), np.array(q, np.float32).astype(float)
                scored.append((-round(float(v @ u / np.linalg.norm(v) / np.linalg.norm(u)), 6), key))
        out += [(qid, i + 1, key, -s) for i, (s, key) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 6))
    rows = [(f"k{i}", (centres[i % 9] + 0.3 * rng.normal(size=6)).tolist()) for i in range(700)]
    rows += [(f"same{i}", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(40)]
    rows += [("none", None), ("short", [1.0]), ("zero", [0.0] * 6), (None, [1.0] * 6)]
    queries = [(i, rows[i * 37][1]) for i in range(18)] + [(99, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])]
    return rows, queries


def frames(spark, data):
    rows, queries = data
    asked = spark.createDataFrame(queries, "qid int, contentVector array<float>")
    return spark.createDataFrame(rows, SCHEMA).repartition(5), asked


def got(df, key):
    return sorted((r["qid"], r["rank"], r[key], r["score"]) for r in df.collect())


def near(a, b):
    return [x[:3] for x in a] == [x[:3] for x in b] and np.allclose([x[3] for x in a], [x[3] for x in b], atol=2e-6)


@pytest.mark.parametrize("block, at_once", [(2048, 1024), (4, 7)])
def test_exact_batch_against_brute_force(spark, data, monkeypatch, block, at_once):
    monkeypatch.setattr(vector_index, "BLOCK_QUERIES", block)
    monkeypatch.setattr(vector_index, "ROWS_AT_ONCE", at_once)
    vectors, asked = frames(spark, data)
    assert near(got(nearest_batch(vectors, asked, 7), "id"), brute(*data, 7))


def test_all_cells_are_exact(spark, data, tmp_path, monkeypatch):
    """Slices and parts of cells give the rows of brute force."""
    monkeypatch.setattr(vector_index, "SLICE_ROWS", 30)
    monkeypatch.setattr(vector_index, "PART_QUERIES", 3)
    vectors, asked = frames(spark, data)
    index = VectorIndex(spark, str(tmp_path / "i")).build(vectors, cells=6)
    assert near(got(index.search(asked, 7, probes=6), "key"), brute(*data, 7))


def test_recall_and_pruning(spark, tmp_path):
    vectors, asked = catalog._asked(spark, SMALL.replace("sf0.001", "sf0.1"))
    index = VectorIndex(spark, str(tmp_path / "i")).build(vectors, "vec_id", "embedding")
    found = index.search(asked, 10, query_column="embedding")
    exact = nearest_batch(vectors, asked, 10, "vec_id", "embedding", "qid", "embedding")
    assert recall(found, exact) >= 0.9
    stored = spark.read.parquet(f"{index.path}/rows")
    assert stored.count() == vectors.count()
    assert index._table()[0]["probes"] < len(index._table())
    one = index.search(asked.limit(1), 10, probes=2, query_column="embedding")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_nothing_stored_or_asked(spark, data, tmp_path):
    vectors, asked = frames(spark, data)
    index = VectorIndex(spark, str(tmp_path / "i")).build(vectors.limit(0))
    assert index.search(asked).count() == 0
    assert nearest_batch(vectors.limit(0), asked).count() == 0
    assert nearest_batch(vectors, asked.limit(0)).count() == 0


def test_few_cells_where_vectors_cluster():
    rng = np.random.default_rng(3)
    centres = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    rows = np.repeat(centres, 50, axis=0) + 0.02 * rng.normal(size=(1000, 20))
    rows = rng.permutation(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    assert vector_index.cells_needed(rows, centres, 5, 0.95) == 1


def test_memory_does_not_follow_the_queries():
    """Scores of many queries are held for fewer rows at once; the result is the same."""
    import tracemalloc

    rng = np.random.default_rng(8)
    rows, wanted = rng.normal(size=(2048, 8)), rng.normal(size=(2048, 8))
    rows, wanted = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rows, wanted))
    held = vector_index._Best(len(wanted), 3)
    tracemalloc.start()
    vector_index._compare(held, np.arange(len(rows)), rows, wanted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    scores = np.round(rows @ wanted.T, vector_index.DIGITS) + 0.0
    best = np.lexsort((np.broadcast_to(np.arange(2048)[:, None], scores.shape), -scores), axis=0)[:3]
    order = np.lexsort((held.key, -held.score, held.query))
    assert (held.key[order].reshape(-1, 3) == best.T).all()
