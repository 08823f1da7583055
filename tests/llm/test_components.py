"""Components against union-find, with hubs over the limit and long chains."""

import random

from millrace.llm import components as C


def by_hand(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def check(spark, edges):
    got = [(r["node"], r["root"]) for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == by_hand(edges)


def test_hubs_chains_and_pairs(spark):
    r = random.Random(3)
    hub = [(0, k) for k in range(1, 2_500)]
    far = [(5_000 + k, 9_999) for k in range(1_500)]  # the hub has the largest number
    chain = [(10_000 + k, 10_001 + k) for k in range(60)]
    some = [(20_000 + r.randrange(300), 20_000 + r.randrange(300)) for _ in range(200)]
    edges = hub + far + chain + some + [(30_000, 30_000), (2_400, 5_100)] + hub[:50]
    r.shuffle(edges)
    check(spark, edges)


def test_a_key_over_the_limit_is_not_shuffled(spark):
    left = spark.createDataFrame([(7, k) for k in range(60)] + [(k, k) for k in range(100, 140)] + [(8, 1)], "key long, v long")
    right = spark.createDataFrame([(7, "hub")] + [(k, "one") for k in range(100, 130)], "key long, name string")
    for how in ("inner", "left"):
        got, want = C.look_up(left, right, "key", 50, how), left.join(right, "key", how)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    hot = C.look_up(left, right, "key", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in hot and "LeftAnti" in hot


def test_no_links(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []
