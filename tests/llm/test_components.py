import random

import pytest

from shiftledger.llm.components import connected_components


def falling(n):
    return [0, *range(n, 0, -1)]


def shuffled(n):
    path = list(range(n))
    random.Random(n).shuffle(path)
    return path


@pytest.mark.parametrize("path", [falling(1200), shuffled(1500)], ids=["falling", "random"])
def test_long_chains(spark, path):
    links = [*zip(path, path[1:]), (5000, 5000), (7001, 7000), (7000, 7001)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in found) == [
        *((n, 0) for n in sorted(path)), (5000, 5000), (7000, 7000), (7001, 7000)
    ]
