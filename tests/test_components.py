import random

from vacantis.operators.components import connected_components


def components_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r["node"]: r["component"] for r in connected_components(df).collect()}


def test_random_graph_chain_and_hub(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    edges += [(i, i + 1) for i in range(200, 230)]  # a long chain
    edges += [(500, i) for i in range(501, 560)] + [(501, 500), (501, 500)]  # a hub, and edges given twice
    edges += [(900, 900), (None, 3), (4, None)]
    assert run(spark, edges) == components_of(edges)


def test_two_parents_are_joined(spark):
    edges = [(5, 1), (5, 3), (6, 2), (6, 3)]
    assert set(run(spark, edges).values()) == {1}


def test_no_edges(spark):
    assert run(spark, []) == {}
