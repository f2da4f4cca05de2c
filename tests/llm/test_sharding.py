import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedwright.llm import sharding


def one_by_one(sizes, capacity):
    """Best fit decreasing, group by group: the bins' contents."""
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= s]
        if fits:
            max(fits, key=sum).append(s)
        else:
            bins.append([s])
    return bins


def contents(sizes, counts, places, bins):
    out = [[] for _ in range(bins)]
    ends = {}
    for i, rank, first, each in sorted(places):
        ends.setdefault(i, []).append((rank, first, each))
    for i, at in ends.items():
        for (rank, first, each), end in zip(at, [*(r for r, _, _ in at[1:]), counts[i]], strict=True):
            for r in range(rank, end):
                out[first + (r - rank) // each].append(sizes[i])
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(1, 60))
def test_histogram_packing_is_best_fit_decreasing(items, capacity):
    hist = sorted(Counter(items).items(), reverse=True)
    sizes, counts = [s for s, _ in hist], [n for _, n in hist]
    places, bins = sharding.best_fit_decreasing(sizes, counts, capacity)
    got = contents(sizes, counts, places, bins)
    assert Counter(x for b in got for x in b) == Counter(items)
    assert all(sum(b) <= capacity or len(b) == 1 for b in got)
    assert sorted(map(sum, got)) == sorted(map(sum, one_by_one(items, capacity)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.booleans()), max_size=120))
def test_tree_keeps_the_tightest_room(steps):
    tree, model = sharding.Rooms(), set()
    for key, add in steps:
        if add and key not in model:
            tree.add(key, (key, 1))
            model.add(key)
        elif not add:
            tree.remove(key)
            model.discard(key)
        for size in (0, key, key + 1):
            node = tree.tightest(size)
            assert (node.key if node else None) == min((k for k in model if k >= size), default=None)

    def depth(t):
        return 0 if t is None else 1 + max(depth(t.left), depth(t.right))
    assert depth(tree.root) <= 2 * (len(model) + 1).bit_length()


def test_near_equal_shards_and_groups_beyond_the_mean():
    r = random.Random(3)
    items = [900_000, 300_000, *(r.randrange(1, 2000) for _ in range(3000))]
    hist = sorted(Counter(items).items(), reverse=True)
    sizes, counts = [s for s, _ in hist], [n for _, n in hist]
    places, _ = sharding.least_capacity(sizes, counts, 16)
    sums = [sum(b) for b in contents(sizes, counts, places, 16)]
    assert sum(sums) == sum(items) and sums[:2] == [900_000, 300_000]
    assert max(sums[2:]) - min(sums[2:]) <= 16


def check(rows, got):
    assert Counter((g.doc_id, g.size, g.text_crc32) for g in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, shard_of = defaultdict(list), {}
    for g in got:
        slots[g.shard].append((g.slot, g.doc_id))
        assert shard_of.setdefault((g.text_crc32, g.size), g.shard) == g.shard  # equal texts stay together
    for shard, s in slots.items():
        assert 0 <= shard < 16 and sorted(x for x, _ in s) == list(range(len(s)))
        ids = [i for _, i in sorted(s) if i is not None]
        assert ids == sorted(ids)


def test_documents(spark):
    r = random.Random(5)
    texts = ["w" * r.randrange(1, 900) + str(i) for i in range(600)] + ["copy"] * 500 + ["", None, "é" * 50, "é" * 50, "x" * 200_000]
    rows = list(enumerate(texts)) + [(None, "a"), (None, "a"), (None, None), (7, "again"), (7, "again"), (7, "other")]
    df = spark.createDataFrame([(i, t, "x", 1, 2, b"z") for i, t in rows],
                               "doc_id long, text string, shard string, size int, part int, digest binary").repartition(5)
    got = sharding.shard_digest(df).collect()
    check(rows, got)
    assert {(g.law, g.grown_shard) for g in got} == {("bytes", None)}
    sums = Counter()
    for g in got:
        sums[g.shard] += g.size
    sums = sorted(sums.values())
    assert len(sums) == 16 and sums[-1] == 200_001 and sums[-2] - sums[0] <= 64


def test_capacity_and_wrong_arguments(spark):
    rows = [(i, "t" * (i % 30) + str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign(df, shards=None, capacity=100).collect()
    bins = defaultdict(int)
    for g in got:
        bins[g.shard] += g.size
    assert max(bins.values()) <= 100 and len(got) == 300
    assert sorted(bins.values()) == sorted(map(sum, one_by_one([g.size for g in got], 100)))
    with pytest.raises(ValueError):
        sharding.assign(df, shards=3, capacity=4)
    with pytest.raises(ValueError):
        sharding.assign(df, shards=None)


def test_empty_table_and_few_groups(spark):
    schema = "doc_id long, text string"
    assert sharding.shard_digest(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a"), (2, "a"), (3, "b")]
    check(rows, sharding.shard_digest(spark.createDataFrame(rows, schema)).collect())
