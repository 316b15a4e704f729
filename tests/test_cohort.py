"""Cohort tables, checks in one pass, order statistics and tolerant numbers by brute force."""

import math
import random
import statistics

import pytest
from cohortry.functions import scalars as fn
from cohortry.operators import checks, cohort, counting
from pyspark.sql import functions as F


def test_best_interval_in_place(spark):
    rng = random.Random(1)
    table = [("b", 100, 250), ("a", 200, 400), ("c", 390, 1000), ("d", 2000, 2100), ("e", 0, 90)]
    rows = [(i, s := rng.randrange(-50, 2300), s + rng.choice([0, 1, 60, 500, 3000])) for i in range(300)] + [(300, 150, 300)]
    df = spark.createDataFrame(rows, "i int, start long, end long")
    got = {r.i: (r.best.label, r.best.bases) if r.best else None for r in df.select("i", cohort.best_interval(F.col("start"), F.col("end"), table).alias("best")).collect()}
    for i, s, e in rows:
        shared = [(-(min(e, b) - max(s, a)), n) for n, a, b in table if min(e, b) > max(s, a)]
        assert got[i] == ((min(shared)[1], -min(shared)[0]) if shared else None), (s, e)
    assert got[300] == ("a", 100)  # ties go to the first label


def test_carrier_calls_in_place(spark):
    panel = {"0": "G0", "1": "G1", "2": "G0"}
    rows = [(5, 3, None, "attributed", "0", ["G0"]), (5, 5, 1, "ambiguous", "0", ["G0", "G1"]), (5, None, 5, "ambiguous", "0", ["G0"]), (None, None, None, None, None, None), (None, 2, None, "attributed", "1", ["G1"])]
    df = spark.createDataFrame(rows, "a int, b int, c int, call string, top string, genera array<string>")
    for r in df.withColumn("x", cohort.carrier_call(dict(zip(panel, [F.col("a"), F.col("b"), F.col("c")], strict=True)), panel)).collect():
        assert (r.x.call, r.x.top, r.x.genera) == (r.call, r.top, r.genera)


def test_summary_names_what_is_missing(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    one, two = spark.createDataFrame([("a", 1), ("b", 2), ("z", 9)], "s string, x int"), spark.createDataFrame([("a", None, 4)], "s string, y int, w int")
    sources = {"first": (F.col("x").isNotNull(), ["x"]), "second": (F.col("w") > 3, ["y", "w"])}
    got = sorted(map(tuple, cohort.summary(expected, "s", [one, two], sources).collect()))
    assert got == [("a", 1, None, 4, ""), ("b", 2, None, None, "second"), ("c", None, None, None, "first;second")]
    with pytest.raises(Exception, match="more than one row for a"):
        cohort.summary(expected, "s", [one.unionByName(one), two], sources).collect()


def test_cohort_tallies(spark):
    rows = [("on_auto_bwa_mem", 4, "stable"), (" off_requested ", None, "unstable"), ("NA", 1, None), (None, 2, "stable"), ("", None, None)]
    r = cohort.tallied(spark.createDataFrame(rows, "m string, a int, t string"), ["a"], "m", "t").first()
    assert tuple(r) == (3, 7, 2, 1, 1, True, 3, 2, 1)
    assert tuple(cohort.tallied(spark.createDataFrame(rows, "m string, a int, t string").limit(0), ["a"], "m", "t").first()) == (0, 0, 0, 0, 0, False, 0, 0, 0)


def test_tables_that_break_rules_are_refused_with_all_of_them(spark):
    df = spark.createDataFrame([(1, 2, "x"), (3, 2, None), (None, 5, "x")], "a int, b int, k string")
    rules = {"a over b": F.col("a") > F.col("b"), "no key": F.col("k").isNull()}
    with pytest.raises(ValueError, match=r"a over b: 1 rows.*; no key: 1 rows"):
        checks.passed(df, rules)
    assert sorted(r.b for r in checks.passed(df, {"never": F.col("b") > 9}).collect()) == [2, 2, 5]
    assert sorted(map(tuple, checks.broken_rules(df, ["b"], rules).collect())) == [(2, "a over b"), (2, "no key")]


def test_id_problems_and_missing_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b c",), ("b c",), (None,), ("ok",)], "id string")
    assert {(r.value, r.rows, r.problems) for r in checks.id_problems(df, "id", "[a-z]+").collect()} == {("a", 2, "repeated"), ("b c", 2, "malformed;repeated"), (None, 1, "malformed")}
    held = spark.createDataFrame([("s", "x"), ("s", "y"), ("t", "q"), (None, "x")], "k string, label string")
    dims = spark.createDataFrame([(v,) for v in "xyz"] * 2, "label string")
    assert {tuple(r) for r in checks.missing(held, ["k"], "label", dims).collect()} == {("s", "z"), ("t", "x"), ("t", "y"), ("t", "z"), (None, "y"), (None, "z")}


@pytest.mark.parametrize("buffered", [100_000, 0])
def test_order_statistics(spark, monkeypatch, buffered):
    monkeypatch.setattr(counting, "BUFFERED", buffered)
    rng = random.Random(5)
    groups = {"a": [rng.choice([0.5, 1.25, -3.0, 7.0]) for _ in range(101)], "b": [rng.random() for _ in range(40)], "c": [2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("d", None)], "k string, v double").repartition(4)
    got = {r.k: r for r in counting.five_numbers(df, ["k"], "v").collect()}
    numbers = {r.k: r for r in counting.summary_numbers(df, ["k"], "v", 0.95).collect()}
    assert set(got) == set(numbers) == set(groups)
    for k, vs in groups.items():
        quartiles = statistics.quantiles(vs, n=4, method="inclusive") if len(vs) > 1 else vs * 3
        assert (got[k].low, got[k].high) == (min(vs), max(vs))
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip((got[k].q1, got[k].median, got[k].q3), quartiles, strict=True))
        assert numbers[k].quantile == sorted(vs)[int(0.95 * (len(vs) - 1))] and math.isclose(numbers[k].median, statistics.median(vs))
    if not buffered:
        assert "percentile" not in counting.quantiles(df, ["k"], "v", {"q": 0.5})._jdf.queryExecution().toString()


def test_tolerant_numbers(spark):
    texts = ["12", " -7 ", "1_000", "1__0", "_1", "3.5", "1e3", ".5", "5.", "inf", "-Infinity", "nan", "", "NA", "0x10", None, "9" * 30, "+4"]

    def either(kind, text):
        try:
            return kind(text)
        except (TypeError, ValueError):
            return kind(0)

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.int_or_zero(F.col("t")).alias("i"), fn.float_or_zero(F.col("t")).alias("f")).collect()
    for r in got:
        whole = either(int, r.t)
        assert r.i == (whole if abs(whole) < 2**63 else 0) and (r.f == either(float, r.t) or math.isnan(r.f) and r.t == "nan"), r


def test_score_threshold_of_the_aligner(spark):
    lines = {"bwa mem -t 4 -T 20 r": "20", "x 'bwa' mem -T15": "15", "/a/bwa-mem2 mem r -T -3 -T 9": "-3", "bwa mem r": "default", "bwa mem -T": "unparsed", "bwa mem -T x": "unparsed", "bwa aln -T 3": None, "mem bwa": None, "": None, "bwa -T 3 mem": None}
    got = spark.createDataFrame([(k,) for k in lines], "cl string").select("cl", fn.bwa_min_score(F.col("cl")).alias("s")).collect()
    assert {r.cl: r.s for r in got} == lines
