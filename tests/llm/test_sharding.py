import random
import zlib
from collections import Counter, defaultdict

import pytest

from sqlloom.llm import sharding


def check(rows, got, shards):
    raw = [((t or "").encode()) for _, t, *_ in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((row[0], len(b) + 1, zlib.crc32(b)) for row, b in zip(rows, raw))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    where = defaultdict(set)
    for r in got:
        where[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())  # equal texts stay together


def test_edge_rows(edge_docs, edge_rows):
    check(edge_rows, sharding.assign(edge_docs, shards=8).collect(), 8)


def test_near_equal_bytes_with_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randint(0, 400)) for i in range(3_000)] + [(9_000 + i, "hot") for i in range(1_500)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=8, grain=256, bundles=256).collect()
    check(rows, got, 8)
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    assert max(sums.values()) - min(sums.values()) <= 0.01 * sum(sums.values()) / 8


def test_fixed_capacity(spark):
    rows = [(i, "y" * (i % 50)) for i in range(400)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), capacity=2_000).collect()
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    assert max(sums.values()) <= 2_000 and len(sums) <= -(-sum(sums.values()) // 2_000) + 1


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_bin(seed):
    rnd = random.Random(seed)
    sizes = sorted((rnd.randint(1, 60) for _ in range(3_000)), reverse=True)
    free: list[int] = []
    expected = []
    for size in sizes:
        fitting = [(c, b) for b, c in enumerate(free) if c >= size]
        if fitting:
            b = min(fitting)[1]
        else:
            free.append(100)
            b = len(free) - 1
        free[b] -= size
        expected.append(b)
    assert sharding.best_fit(sizes, 100) == expected
    assert max(sharding.least_capacity(sizes, 8)) == 7


def test_empty_table(no_docs):
    assert sharding.assign(no_docs, shards=8).count() == 0
