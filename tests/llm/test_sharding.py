import random
from collections import Counter

import pytest

from sentilake.llm.sharding import communication_matrix, draw_hypergeometric, shuffle_into_shards
from tests.llm.helpers import edge_documents, empty_documents


@pytest.mark.parametrize("good,bad,drawn", [(5, 5, 4), (3, 20, 10), (0, 7, 3), (7, 0, 3), (30, 2, 31)])
def test_draws_follow_the_hypergeometric_law(good, bad, drawn):
    from math import comb
    rng, n = random.Random(3), 20_000
    got = Counter(draw_hypergeometric(rng, good, bad, drawn) for _ in range(n))
    for k in range(max(0, drawn - bad), min(good, drawn) + 1):
        p = comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn)
        assert abs(got[k] / n - p) < 0.015
    assert sum(got.values()) == n and all(max(0, drawn - bad) <= k <= min(good, drawn) for k in got)


def test_large_draw_is_in_range():
    assert 4.99e8 < draw_hypergeometric(random.Random(1), 10 ** 9, 10 ** 9, 10 ** 9) < 5.01e8


def test_matrix_sums():
    counts = [10, 0, 7, 33, 1]
    m = communication_matrix(counts, 4, 9)
    assert [sum(r) for r in m] == counts
    columns = [sum(c) for c in zip(*m)]
    assert sum(columns) == 51 and max(columns) - min(columns) <= 1


def test_edge_rows_are_dealt_whole(spark):
    docs = edge_documents(spark)
    got = shuffle_into_shards(docs, 8).collect()
    assert Counter(tuple(r["row"]) for r in got) == Counter(tuple(r) for r in docs.collect())
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    assert got and shuffle_into_shards(empty_documents(spark), 8).count() == 0


def test_shuffle_is_uniform(spark):
    """Chi-square of where rows go, over many seeds: any row to any shard alike."""
    rows = spark.range(16).repartition(3)
    seen = Counter()
    for seed in range(24):
        for r in shuffle_into_shards(rows, 4, seed).collect():
            seen[r["row"]["id"] % 4, r["shard"]] += 1
    expected = 24 * 16 / 16
    assert sum((seen[a, b] - expected) ** 2 / expected for a in range(4) for b in range(4)) < 37
