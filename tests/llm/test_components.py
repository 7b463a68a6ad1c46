"""Connected components against union-find."""
import random

import pytest

from chartgrid.llm.components import components


def brute(links):
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def chain(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return list(zip(ids, ids[1:]))


CASES = {
    "chain": chain(150, 1),
    "star of the largest": [(999, i) for i in range(200)],
    "star of the smallest": [(-5, i) for i in range(200)],
    "both directions and repeats": [(1, 2), (2, 1), (1, 2), (3, 2), (3, 3), (8, 9), (9, 8)],
    "two stars and a bridge": [(500, i) for i in range(50)] + [(600, i) for i in range(100, 150)] + [(149, 49)],
    "null ends and loops": [(None, 1), (2, None), (4, 4), (None, None), (5, 6)],
    "random": [(random.Random(i).randrange(300), random.Random(-i).randrange(300)) for i in range(1, 200)],
    "far ids": [(2**62, -2**62), (2**62, 0), (7, 2**61)],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equal_to_union_find(spark, name):
    links = CASES[name]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == brute(links)
    assert len(rows) == len({r.node for r in rows})
