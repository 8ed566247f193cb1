"""Components of random graphs, long paths, stars and repeated edges against a plain search."""

import random

import pytest

from seriesloom.llm.components import components


def smallest(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    label = {}
    for start in sorted(near):
        if start not in label:
            stack = [start]
            while stack:
                x = stack.pop()
                if x not in label:
                    label[x] = start
                    stack += near[x]
    return label


def graphs():
    rng = random.Random(1)
    order = list(range(400))
    rng.shuffle(order)
    yield "path", [(order[i], order[i + 1]) for i in range(399)]
    yield "sorted path", [(i, i + 1) for i in range(300)]
    yield "star", [(7, i) for i in range(200)] + [(500, 600), (600, 500), (9, 9), (9, 9)]
    yield "random", [(rng.randint(0, 900), rng.randint(0, 900)) for _ in range(420)]
    yield "loop alone", [(3, 3)]


@pytest.mark.parametrize("name, edges", list(graphs()))
def test_components(spark, name, edges):
    as_bytes = [(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in edges]
    got = components(spark.createDataFrame(as_bytes, "a binary, b binary").repartition(3)).collect()
    found = {int.from_bytes(r.id): int.from_bytes(r.label) for r in got}
    linked = [(a, b) for a, b in edges if a != b]
    assert len(got) == len(found) and found == smallest(linked)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a binary, b binary")).collect() == []
