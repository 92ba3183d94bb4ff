import random

from tallyquill.llm.components import components


def brute(links):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {x: find(x) for x in top}


def test_stars_chains_and_random_links(spark):
    """A hub of thousands of links, a chain, cliques, repeated and reversed links, and links among strangers."""
    rnd = random.Random(6)
    links = [(9_000 - i, 5) for i in range(1, 3_000)] + [(20_000 + i, 20_001 + i) for i in range(60)] + [(a, b) for a in range(30_000, 30_020) for b in range(30_000, 30_020) if a != b]
    links += [(rnd.randrange(40_000, 46_000), rnd.randrange(40_000, 46_000)) for _ in range(4_000)] + [(5, 8_999)] * 3
    links = [(a, b) for a, b in links if a != b]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
