import random

import pytest

from tarmac.llm.components import components


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in range(1, 30)] + [(100, 101)],
        "star": [(7, i) for i in range(20, 60)] + [(3, 7), (70, 71)],
        "random": [(draw.randrange(60), draw.randrange(60)) for _ in range(40)],
        "none": [],
    }[shape]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    loops = {a for a, b in edges if a == b}
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in found.items()} == {k: v for k, v in label.items() if k in found}
    assert set(label) - set(found) <= loops
