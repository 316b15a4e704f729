"""Tree operators and numbering by brute force: cycles, orphans, several roots, hot parents, equal rows."""

import random

import pytest
from cohortry.operators import hierarchy, numbering, skew
from pyspark.sql import functions as F


def nearest_by_hand(parent, marks):
    out = {}
    for v in parent:
        at, seen = v, set()
        while at is not None and at not in marks and at not in seen:
            seen.add(at)
            at = parent.get(at)
            at = None if at == v and at not in marks else at
        out[v] = at if at in marks else None
    return out


@pytest.mark.parametrize("fits", [True, False])
def test_nearest_marked(spark, monkeypatch, fits):
    monkeypatch.setattr(hierarchy, "small", lambda df: fits)
    rng = random.Random(1)
    parent = {v: rng.randrange(v) if v and v % 9 else None for v in range(150)}  # several roots
    parent |= {v: 0 for v in range(200, 260)}  # one parent of many
    parent |= {300: 301, 301: 302, 302: 300, 303: 300, 400: 400, 401: 999}  # a cycle, a root that points at itself, a parent that is no node
    marks = {3, 4, 50, 120, 301, 400}
    tree = spark.createDataFrame(list(parent.items()), "node long, parent long")
    got = hierarchy.nearest_marked(tree, spark.createDataFrame([(m,) for m in marks], "node long"))
    assert {r.node: r.found for r in got.collect()} == nearest_by_hand({v: None if p == v else p for v, p in parent.items()}, marks)
    assert hierarchy.nearest_marked(tree.limit(0), tree.limit(0).select("node")).count() == 0


def tour_by_hand(rows):
    """rows of one group: (node, parent, order)."""
    known = {v for v, _, _ in rows}
    rows = sorted(rows, key=lambda r: r[2])
    roots = [v for v, p, _ in rows if p not in known] or [rows[0][0]]
    parent = {v: p for v, p, _ in rows if v not in roots}
    enter, leave, at = {}, {}, 0

    def walk(v):
        nonlocal at
        enter[v] = at
        at += 1
        for w, _, _ in rows:
            if parent.get(w) == v and w not in enter:
                walk(w)
        leave[v] = at

    for r in roots:
        walk(r)
    return {v: (enter.get(v), leave.get(v)) for v in known}


def test_tour_places_all_groups_at_once(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(6):
        one = [(f"n{v}", f"n{rng.randrange(v)}" if v and rng.random() < 0.9 else rng.choice([None, "lost"]), rng.random()) for v in range(rng.choice([1, 5, 40]))]
        one += [("a", "b", 5.0), ("b", "a", 6.0), ("c", "b", 7.0)] if g % 2 else []
        rows += [(g, *r) for r in one]
        want |= {(g, v): places for v, places in tour_by_hand(one).items()}
    rows += [(9, "x", "y", 2.0), (9, "y", "x", 1.0)]  # without a root the first begins
    want |= {(9, "y"): (0, 2), (9, "x"): (1, 2)}
    df = spark.createDataFrame(rows, "g int, v string, p string, o double")
    assert {(r.g, r.v): (r.enter, r.leave) for r in hierarchy.tour(df, ["g"], "v", "p", ["o"]).collect()} == want


def test_numbers_and_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), rng.choice([1, 2, None, 7]), rng.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, o int, v long").repartition(5)
    placed = numbering.numbered(df, ["o", "v"], by=["k"]).collect()
    key = lambda r: ((r.o is not None, r.o or 0), r.v)
    for k in ("hot", "a", None):
        held = sorted((r for r in placed if r.k == k), key=lambda r: r.number)
        assert [r.number for r in held] == list(range(1, len(held) + 1)) and [key(r) for r in held] == sorted(map(key, held))
    every = numbering.numbered(df, [F.col("v").desc()]).collect()
    assert sorted(r.number for r in every) == list(range(1, 501))
    assert [r.v for r in sorted(every, key=lambda r: r.number)] == sorted((r[2] for r in rows), reverse=True)
    summed = numbering.running(df, ["k"], ["o", "v"], {"n": F.lit(1), "total": F.col("v")}).collect()
    for k in ("hot", "a", None):
        held, total = sorted((r for r in summed if r.k == k), key=lambda r: r.n), 0
        for i, r in enumerate(held, 1):
            total += r.v
            assert (r.n, r.total) == (i, total)
    assert numbering.numbered(df.limit(0), ["o"]).count() == 0 and numbering.running(df.limit(0), ["k"], ["o"], {"n": F.lit(1)}).count() == 0
    plan = numbering.numbered(df, ["o"])._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_lookup_meets_heavy_and_light_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(1000)] + [(-1, None), (-2, "none")], "i int, k string")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("w")).where("k <> 'none'").withColumn("v", F.length("k"))
    got = skew.lookup(left, right, ["k"], "w", 1002)
    assert got.count() == 1000 and all(r.v == len(r.k) for r in got.collect())
    assert skew.lookup(left, right, ["k"], "w", 1002, how="left").count() == 1002
