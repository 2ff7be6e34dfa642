import random

from shelf.llm.components import connected_components


def test_components_match_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(150)] + [(7, 7), (None, 3), (3, None)] * 2
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert sorted(tuple(r) for r in got) == sorted((x, root(x)) for x in parent)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
