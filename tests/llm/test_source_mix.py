import math

from pyspark.sql import functions as F

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import source_mix


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cap, share the excess again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


def sized(docs):
    return [(i, len((t or "").encode().split()), s) for i, t, s in docs]


def check(spark, make_docs, docs):
    got = source_mix.with_copies(make_docs(docs)).collect()
    assert len(got) == len(docs)
    sizes, counts = {}, {}
    for _, n, s in sized(docs):
        sizes[s] = sizes.get(s, 0) + n
        counts[s] = counts.get(s, 0) + 1
    want = plain_targets(sizes)
    taken, copies = {}, {}
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["copies"] <= 3
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        copies[s] = copies.get(s, 0) + r["copies"]
    for s in sizes:
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert abs(copies[s] - rate * counts[s]) <= 1
        largest = max(n for _, n, x in sized(docs) if x == s)
        assert abs(taken[s] - want[s]) <= 3 * largest
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["copies"]) for r in got)


def test_given_table(spark, make_docs, some_docs):
    first = check(spark, make_docs, some_docs)
    assert first == check(spark, make_docs, some_docs[::-1])


def test_odd_rows(spark, make_docs):
    docs = [(i, "a b c " * (i % 7), None if i % 5 == 0 else "hot") for i in range(300)]
    docs += [(1000, None, "nothing"), (1001, "", "nothing"), (None, "x y", "hot"), (None, "x y", None)]
    docs += [(2000, "same text", "copies")] * 40
    check(spark, make_docs, docs)


def test_mix_repeats_rows(spark, make_docs):
    docs = make_docs([(i, "w " * 10, "big" if i else "small") for i in range(50)])
    docs = docs.withColumns({c: F.lit(i) for i, c in enumerate(("size", "copies", "_doc", "_source", "target"))})
    mixed = source_mix.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.where("source = 'small'").count() == 3
    assert set(r["doc_id"] for r in mixed.collect()) <= set(range(50))


def test_empty(spark, make_docs):
    assert source_mix.with_copies(make_docs([])).count() == 0
    assert source_mix.mix(make_docs([(1, None, "a")])).count() == 0
