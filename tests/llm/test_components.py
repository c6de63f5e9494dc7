import random

from gridcube.llm.components import connected_components


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def test_random_graphs_chain_and_star(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(2000, 2000 + i) for i in range(1, 300)]
    loose = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges = [e for e in chain + star + loose if e[0] != e[1]]
    rng.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges + edges[:9], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == brute(edges)
    assert got.count() == len(brute(edges))


def test_nulls_loops_and_no_edges(spark):
    df = spark.createDataFrame([("x", None), (None, "y"), ("z", "z")], "a string, b string")
    assert connected_components(df).count() == 0
    assert connected_components(df.limit(0)).columns == ["node", "root"]
