"""Overlap joins by brute force: repeated rows, long and empty intervals, positions below 0, hot bins."""

import random
from collections import Counter

import pytest
from cohortry.operators import intervals


def sides(n=120, m=40):
    rng = random.Random(4)
    size = lambda: rng.choice([0, 1, 5, 40, 900, 30_000])
    left = [(rng.choice("ab"), s := rng.randrange(-200, 5_000), s + size()) for _ in range(n)]
    left += left[:15] + [("hot", 10, 20)] * 60  # rows that stand twice, and one that stands often
    right = [(rng.choice("abc"), s := rng.randrange(-500, 5_000), s + size(), i) for i in range(m)] + [("hot", 0, 15, 98), ("hot", 19, 1_000_000, 99), ("hot", 20, 30, 97)]
    return left, right + right[:5]


@pytest.mark.parametrize("few", [dict(), dict(rows_per_task=7), dict(small_right=True)])
def test_overlaps_equal_brute_force(spark, few):
    left, right = sides()
    a, b = spark.createDataFrame(left, "k string, start long, end long").repartition(3), spark.createDataFrame(right, "k string, r_start long, r_end long, id int")
    share = lambda x, y: x[0] == y[0] and x[1] < y[2] and x[2] > y[1] and x[1] < x[2] and y[1] < y[2]
    pairs = intervals.overlap_join(a, b, ["k"], width=100, **few)
    assert set(pairs.columns) == {"k", "start", "end", "r_start", "r_end", "id"}
    assert Counter((r.k, r.start, r.end, r.id) for r in pairs.collect()) == Counter((*x, y[3]) for x in left for y in right if share(x, y))
    semi = intervals.overlap_join(a, b, ["k"], width=100, how="left_semi", **few)
    assert Counter(map(tuple, semi.collect())) == Counter(x for x in left if any(share(x, y) for y in right))
    assert intervals.overlap_join(a, b.limit(0), ["k"], how="left_semi", **few).count() == 0 and intervals.overlap_join(a.limit(0), b, ["k"], **few).count() == 0


def test_near_keeps_rows_that_stand_twice(spark):
    a = spark.createDataFrame([(1, 100, 200), (1, 100, 200), (1, 5_000, 5_100)], "k int, start long, end long")
    anchors = spark.createDataFrame([(1, 250, 300), (1, 260, 310)], "k int, r_start long, r_end long")
    assert [tuple(r) for r in intervals.near(a, anchors, ["k"], 100).collect()] == [(1, 100, 200)] * 2


@pytest.mark.parametrize("few", [dict(), dict(rows_per_task=25)])
def test_binned_depth_equals_brute_force(spark, few):
    """Intervals that overlap, are empty, lie below 0, on the edges of blocks of bins, or without an end or a group."""
    left, _ = sides()
    left += [(None, 5, 17), ("a", 790, 810), ("a", 800, 800), ("a", 1600, 1610), ("b", 10, None), ("b", None, 20), ("b", 90, 60)]
    want = Counter()
    for k, s, e in left:
        if s is not None and e is not None:
            for x in range(s, e):
                want[k, x // 10] += 3
    df = spark.createDataFrame([(*x, 3) for x in left], "k string, seg_start long, seg_end long, depth int").repartition(3)
    got = [tuple(r) for r in intervals.binned_depth(df, ["k"], 10, **few).collect()]
    assert len(got) == len(want) and {(k, b): n for k, b, n in got} == want
