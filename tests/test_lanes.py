"""Golden cases of the cohort's lanes."""

import pytest
from cohortry.functions import scalars as fn
from cohortry.operators import checks, intervals, lanes, ranking, rules
from pyspark.sql import functions as F


def one(df, column):
    return {r[0]: r[1] for r in df.select(df.columns[0], column.alias("got")).collect()}


def test_fates_of_evaluated_reads(spark):
    cases = [("survived", True, True, "confirmed_true", True, True), ("missing_from_arm_b", False, False, None, False, True), ("unaligned", False, True, "ambiguous", False, True), ("missing_from_arm_a", False, True, "confirmed_true", True, False), ("lost", False, True, "ambiguous", True, True), ("unaligned", False, True, "ambiguous", False, False)]
    df = spark.createDataFrame(cases, "want string, survives boolean, listed boolean, c string, scored boolean, in_a boolean")
    assert df.where(~rules.read_fate(F.col("survives"), F.col("listed"), F.col("c"), F.col("scored"), F.col("in_a")).eqNullSafe(F.col("want"))).count() == 0


def test_retention_leaves_out_what_was_not_measured(spark):
    fates = spark.createDataFrame([("s", f) for f in ["survived"] * 66 + ["missing_from_arm_b"] * 34] + [("e", "unaligned")], "sample string, fate string")
    got = {r["sample"]: r for r in lanes.retention(fates, ["sample"]).collect()}
    assert (got["s"].retention, got["s"].retention_if_unmeasured_lost, got["s"].unmeasured_fraction, got["s"].n_measured) == (1.0, 0.66, 0.34, 66)
    assert (got["e"].retention, got["e"].n_measured) == (0.0, 0)


def test_absorbers_are_named_and_flagged(spark):
    rows = [("s", "d1", None, "ambiguous", 1.0)] * 3 + [("s", "", "d2", "confirmed_decoy", -50.0), ("s", None, None, "confirmed_true", None), ("s", "", "", "ambiguous", None)]
    lost = spark.createDataFrame(rows, "sample string, b1 string, b2 string, c string, lead double")
    named = lost.select("sample", rules.absorber(F.col("b1"), F.col("b2"), F.col("c")).alias("absorber"), rules.near_threshold(F.col("c"), F.col("lead"), 5).alias("near"))
    got = {r.absorber: (r.reads, r.near_threshold, r.flagged) for r in lanes.absorbers(named, ["sample"], share=0.4).collect()}
    assert got == {"d1": (3, 3, True), "d2": (1, 0, False), "arm_a_not_confirmed": (1, 0, False), "no_decoy_alignment": (1, 1, False)}


@pytest.mark.parametrize("parts", [1, 5])
def test_carrier_calls_and_verdicts(spark, parts):
    panel = spark.createDataFrame([("a1", "A", "G"), ("a2", "A", "G"), ("b", "B", "G"), ("c", "C", "H")], "contig string, carrier string, genus string")
    reads = [("r1", "a1", 90), ("r1", "a2", 95), ("r1", "b", 80), ("r2", "a1", 90), ("r2", "b", 90), ("r3", "a1", 90), ("r3", "c", 90), ("r4", "x", 50), ("r5", "a1", None), ("r6", "a1", 90), ("r6", "b", 88)]
    df = spark.createDataFrame([("s", r, c, a, True) for r, c, a in reads] + [("s", "r7", "a1", 9, False)], "sample string, read string, contig string, score int, mapped boolean").repartition(parts)
    calls = lanes.carrier_reads(df, panel, ["sample", "read"], least_lead=5)
    got = {r.read: (r.call, r.top, r.lead, r.genera) for r in calls.collect()}
    assert got == {"r1": ("attributed", "A", 15, ["G"]), "r2": ("ambiguous", "A", 0, ["G"]), "r3": ("ambiguous", "A", 0, ["G", "H"]), "r4": ("off_map", None, None, None), "r5": ("unmapped", None, None, None), "r6": ("ambiguous", "A", 2, ["G"]), "r7": ("unmapped", None, None, None)}
    row = lanes.carrier_summary(calls, ["sample"]).first()
    assert (row.n_attributed, row.n_ambiguous, row.n_off_map, row.top_carrier, row.top_genus_reads, row.tied_genus_sets, row.verdict) == (1, 3, 1, "A", 3, "G+H:1", "CARRIER_UNDETERMINED")
    cases = [("CARRIER_ATTRIBUTED", 10, 8, 0, 0, 10), ("CARRIER_GENUS_ONLY", 10, 7, 10, 8, 20), ("CARRIER_UNDETERMINED", 0, 0, 9, 9, 9), ("CARRIER_AMBIGUOUS", 0, 0, 0, 0, 10)]
    df = spark.createDataFrame(cases, "want string, a int, t int, g int, tg int, m int")
    assert df.where(rules.carrier_verdict(*map(F.col, ("a", "t", "g", "tg", "m"))) != F.col("want")).count() == 0


def test_locus_classes_and_hypotheses(spark):
    many = [f"clb{chr(65 + i)}" for i in range(19)]
    cases = [(None, [], "multi_gene"), ("clbS_only_possible_resistance", ["clbS"], "multi_gene"), ("isolated_or_low_evidence_clb_hits", ["clbA", "clbB"], "multi_gene"), ("hmm_candidate_locus_not_confirmed", many, "negative"), ("hmm_candidate_locus_not_confirmed", many, None), ("partial_pks_candidate", many[:14], "multi_gene"), ("near_complete_pks_candidate", many[:15], "multi_gene"), ("complete_pks_candidate", many, "multi_gene")]
    df = spark.createDataFrame(cases, "want string, genes array<string>, tier string")
    assert df.where(~rules.locus_class(F.col("genes"), F.col("tier"), ["multi_gene"]).eqNullSafe(F.col("want"))).count() == 0
    bins = spark.createDataFrame([("s", "p", ["clbA", "clbB", "clbC"], "multi_gene", 0, False, True, True), ("s", "r", [], "negative", 2, False, True, True), ("s", "q", ["clbS"], "negative", 1, True, True, True), ("t", "u", [], "negative", 1, False, True, False)], "sample string, bin string, genes array<string>, tier string, prophages int, protected boolean, rec_a boolean, lex_a boolean")
    got = sorted((r.producer, r.recipient, r.hypothesis) for r in lanes.interactions(bins, ["sample"], biosynthetic=["clbB"], positive=["multi_gene"]).collect())
    assert got == [("p", "q", "lower"), ("p", "r", "plausible")]


def test_provirus_floor(spark):
    rows = [("1", "Provirus", "3000", "2", "9-5"), ("2", "provirus", "2999.9", "2", "1-2"), ("3", "provirus", "4000", "NA", "1-2"), ("4", "provirus", "4000", "3", "NA"), ("5", "linear", "4000", "3", "1-2"), ("6", "provirus", None, "3", "1-2")]
    df = spark.createDataFrame(rows, "k string, topology string, length string, n_hallmarks string, coordinates string")
    assert [(r.k, r.start, r.end) for r in lanes.provirus(df).collect()] == [("1", 5, 9)]


def test_reference_calls(spark):
    rows = [("s", "r1", "B2", 0, 90, 88, 90), ("s", "r1", "B2", 50, 90, 40, 40), ("s", "r2", "B2", 0, 89, 87, 89), ("s", "r3", "D", 0, 40, 40, 40), ("t", "r1", "B2", 0, 90, 90, 90), ("t", "r3", "D", 0, 90, 89, 90), ("u", "r1", "B2", 0, 30, 30, 30)]
    hits = spark.createDataFrame(rows, "sample string, reference string, group string, start int, end int, matches int, block int")
    got = {r["sample"]: (r.reference, r.consensus, r.status, r.runner_ups) for r in lanes.reference_call(lanes.reference_ranking(hits, ["sample"], 100), ["sample"]).collect()}
    assert got == {"s": ("r1", "B2", "confident", "r2;r3"), "t": ("r1", "ambiguous", "ambiguous", "r3"), "u": ("r1", "B2", "unresolved", "")}


def test_reports_refuse_two_rows_for_a_sample(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "sample string")
    qc = spark.createDataFrame([("a", 1), ("z", 3)], "sample string, reads int")
    assert sorted((r["sample"], r.reads, r.missing) for r in lanes.report(expected, {"qc": qc}, "sample").collect()) == [("a", 1, ""), ("b", None, "qc")]
    with pytest.raises(Exception, match="more than one row"):
        lanes.report(expected, {"qc": qc.union(qc)}, "sample").collect()


def test_stages_states_and_robustness(spark):
    df = spark.createDataFrame([("a", 10, 8, None, 4), ("b", 10, 12, 6, 0), ("c", 0, 0, 0, 0)], "k string, one int, two int, three int, four int")
    assert sorted((r.k, r.stage, r.removed) for r in lanes.stage_rates(df, ["k"], ["one", "two", "three", "four"]).collect()) == [("a", "two", 0.2), ("b", "four", 1.0), ("b", "three", 0.5)]
    state = spark.createDataFrame([("x", 1, None, None, None), ("y", 1, 2, None, "positive"), ("z", 1, 2, None, None), ("w", None, None, "cohort", None)], "k string, a int, b int, excluded string, outcome string")
    assert one(state, lanes.terminal_state(state, {"first": ["a"], "second": ["b"]}, "excluded", "outcome")) == {"x": "failed_at_second", "y": "completed_positive", "z": "completed_untiered", "w": "excluded_cohort"}
    tiers = spark.createDataFrame([("a", "multi_gene", "multi_gene"), ("b", "multi_gene", "negative"), ("c", "untiered", "negative"), ("d", None, None)], "k string, raw string, other string")
    assert one(tiers, rules.robustness(F.col("raw"), [F.col("other")])) == {"a": "stable", "b": "unstable", "c": None, "d": None}
    assert one(tiers, rules.outcome(F.col("raw"))) == {"a": "positive", "b": "positive", "c": "untiered", "d": "untiered"}


def test_header_evidence(spark):
    rows = [("yes", [("x", "/opt/bwa mem ref"), ("bwa", None)]), ("yes", [("s", "sentieon bwa mem -t 1")]), ("no_cl", [("bwa", None), ("bwa", "bwa aln x")]), ("not_mem", [("BWA", "bwa aln mem.fa")]), ("no", [("minimap2", "minimap2 mem")]), ("no", [])]
    df = spark.createDataFrame(rows, "want string, p array<struct<pn:string,cl:string>>")
    assert df.where(fn.bwa_evidence(F.col("p")) != F.col("want")).count() == 0
    with pytest.raises(Exception, match="without its command"):
        df.where("want = 'no_cl'").select(rules.low_score_state(F.lit("auto"), F.col("want"))).collect()


def test_samples_of_every_kth_row_in_parts(spark):
    df = spark.createDataFrame([("a", i) for i in range(103)] + [("b", i) for i in range(5)], "k string, v int").repartition(7)
    whole = sorted(map(tuple, ranking.every_kth(df, ["k"], [F.col("v")], 10).collect()))
    assert whole == sorted(map(tuple, ranking.every_kth(df, ["k"], [F.col("v")], 10, F.floor(F.col("v") / 9)).collect())) == [("a", i) for i in range(0, 110, 11) if i < 103] + [("b", i) for i in range(5)]


def test_missing_labels_of_any_number(spark):
    df = spark.createDataFrame([("s", "x"), ("s", "odd"), ("t", "y")], "k string, g string")
    genes = spark.createDataFrame([("x",), ("y",)], "g string")
    assert sorted(map(tuple, checks.missing(df, ["k"], "g", genes).collect())) == [("s", "y"), ("t", "x")]
    many = spark.range(12_000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("g"))
    assert checks.missing(many.where("g <> 'g7'").withColumn("k", F.lit("s")), ["k"], "g", many).collect() == [("s", "g7")]


def test_union_of_repeated_starts(spark):
    df = spark.createDataFrame([("x", 0, 5)] * 1000 + [("x", 0, 9), ("x", 3, 4), ("x", 20, 22)], "k string, start int, end int")
    assert intervals.union_length(df, ["k"]).first().union_bases == 11
