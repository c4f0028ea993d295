"""Components of random graphs, chains and stars against a union-find."""

import random

import pytest

from blockpulse.llm.components import smallest_ids
from blockpulse.llm.scratch import Scratch


def expected(nodes, links):
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


GRAPHS = {
    "none": [],
    "chain": [(i, i + 1) for i in range(200)],
    "star_of_largest": [(i, 250) for i in range(100)],
    "clique": [(i, j) for i in range(20) for j in range(i + 1, 20)],
    "random": [tuple(sorted(random.Random(5).sample(range(k, k + 60), 2))) for k in range(0, 200, 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    links = sorted(set(GRAPHS[name]))
    nodes = range(-3, 300)
    frame = spark.createDataFrame([(n, n + 1000) for n in nodes], "node long, id long")
    found = smallest_ids(frame, spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()
    want = expected(nodes, links)
    assert {r.node: r.component_id for r in found} == {n: want[n] + 1000 for n in nodes}
    assert len(found) == len(nodes)
