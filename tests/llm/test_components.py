import random

from deskweave.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_paths_stars_and_random_graphs(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)]
    loose = [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(200)]
    loose = [(a, b) for a, b in loose if a != b]
    edges = path + star + star + loose
    got = components(spark.createDataFrame([*edges, (5, 5), (None, 3)], "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == plain(edges)
    assert len(got) == len(plain(edges))


def test_empty_and_text_nodes(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
    got = components(spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")).collect()
    assert {tuple(r) for r in got} == {("a", "a"), ("b", "a"), ("c", "a")}
