import random

import pytest

from wayforge.llm import graph
from wayforge.llm.common import Staging
from wayforge.llm.graph import connected_components, may_hold, membership_filter


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    return {x: root(x) for x in parent if root(x) != x}


@pytest.mark.parametrize("edges_a_task", [400_000, 20])
def test_components(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(graph, "EDGES", edges_a_task)
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(5000, i) for i in range(5001, 5200)]
    edges = chain + star + [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(7, 7), (1, 2), (2, 1)]
    rng.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), Staging(spark, "test")).distinct().collect()
    assert {r.node: r.component for r in got} == brute(edges) and len(got) == len({r.node for r in got})
    assert connected_components(spark.createDataFrame([], "u long, v long"), Staging(spark, "test")).count() == 0


def test_filter_never_misses(spark):
    keys = spark.range(0, 5000, 7)
    out = may_hold(spark.range(6000), "id", membership_filter(keys, "id"))
    held = {r.id for r in out.where("_maybe").collect()}
    assert set(range(0, 5000, 7)) <= held and len(held) < 900 and out.count() == 6000
    assert may_hold(spark.range(5), "id", membership_filter(keys.limit(0), "id")).where("_maybe").count() == 0


def test_filter_of_any_size_never_misses(spark):
    bits = graph.filter_bits(10**6)
    assert graph.filter_bits(10) == graph.LEAST_BITS and graph.filter_bits(10**12) == graph.MOST_BITS and bits >= 8 * 10**6
    out = may_hold(spark.range(3000), "id", membership_filter(spark.range(0, 3000, 5), "id", bits), bits)
    assert {r.id for r in out.where("_maybe").collect()} >= set(range(0, 3000, 5))
