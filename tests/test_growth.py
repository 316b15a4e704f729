"""What goes to the driver or into one task does not grow with the tables: seen in the plans of small ones."""

import re

import pytest
from pyspark.sql import functions as F

from cohortry.functions import scalars as fn
from cohortry.operators import hierarchy, intervals
from cohortry.plans import cohort_queries, registry

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_nodes_are_not_broadcast(spark, monkeypatch):
    """The joins of the rounds of a tour, and those before and after them, are shuffled, whatever size Spark takes the files for."""
    plans, real = {}, hierarchy.staged

    def kept(df, name):
        plans.setdefault(name, []).append(physical(df))
        return real(df, name)

    monkeypatch.setattr(hierarchy, "staged", kept)
    k = F.col("id")
    tree = spark.range(200).select((k % 2).alias("g"), k.alias("node"), F.when(k >= 2, F.floor(k / 20) * 2 + k % 2).alias("parent"))
    places = hierarchy.tour(tree, ["g"], "node", "parent", ["node"])
    assert len(plans["tour"]) > 5
    for plan in [*plans["siblings"], *plans["tour"]]:
        assert "SortMergeJoin" in plan or "Union" not in plan and "Join" not in plan
        assert "BroadcastHashJoin" not in plan
    assert sorted(r.enter for r in places.where("g = 1").collect()) == list(range(100))


def test_a_cigar_is_made_and_checked_once_a_row(spark):
    """Not once for each number that is read from it, and without an array of steps."""
    plan = physical(registry.queries()["p6_cigars_of_columns"](spark, SF))
    assert plan.count("raise_error") == 1 and "zip_with" not in plan
    texts = ["5S10M2I3D4=1X2H", "12M", "3H4S7M100N8M1P2S9H", "2S3H"]
    df = spark.createDataFrame([(t,) for t in texts], "cigar string")
    got = {r.cigar: tuple(r)[1:] for r in df.select("cigar", *[c.alias(k) for k, c in fn.cigar_numbers(F.col("cigar")).items()]).collect()}
    for t in texts:
        steps = [(int(n), op) for n, op in re.findall(r"(\d+)(.)", t)]
        total = lambda ops: sum(n for n, op in steps if op in ops)  # noqa: E731, B023
        ends = [sum(int(n) for n in re.findall(r"\d+", m[0])) if (m := re.search(p, t)) else 0 for p in (r"^(\d+[SH])+", r"(\d+[SH])+$")]
        assert got[t] == (total("M=XID"), total("M=XISH"), total("M=XDN"), *ends)
    for bad in ("12M3", "", "M", "12M*", None):
        with pytest.raises(Exception, match="not a CIGAR"):
            spark.createDataFrame([(bad,)], "c string").select(fn.strict_cigar(F.col("c"))).collect()


def test_a_command_line_is_searched_and_not_taken_apart(spark):
    plan = physical(registry.queries()["p19_min_score"](spark, SF))
    assert "lambda" not in plan and "split(" not in plan

    def brute(line):
        words = line.split()
        bare = lambda w: w.strip("'\"").rsplit("/", 1)[-1]
        at = next((i for i in range(len(words) - 1) if bare(words[i]) in ("bwa", "bwa-mem2") and words[i + 1] == "mem"), None)
        if at is None:
            return None
        rest = words[at + 2 :]
        flag = next((i for i, w in enumerate(rest) if re.fullmatch(r"-T(-?[0-9]+)?", w)), None)
        if flag is None:
            return "default"
        value = rest[flag][2:] or (rest[flag + 1] if flag + 1 < len(rest) else "")
        return value if re.fullmatch(r"-?[0-9]+", value) else "unparsed"

    heads = ["bwa mem", "/a/b/bwa mem", "'bwa' mem", "'/a/bwa-mem2'  mem", "x/'bwa mem", "sh -c /o/bwa\tmem", "bwa aln bwa mem", "bwa bwa mem", "xbwa mem", "bwa mem2", "bwa-mem2 'mem", "bwa", "bwax/bwa mem", "bwa mem mem"]
    tails = ["", " ", " -T 3", " -T3", " -T", " -T ", " -T -4 x", " -T-4", " -Tx -T 5", " -T x -T 5", " -T -T3", " a-T 7", " -T 3x", " -T3 -T 9", " -t 8 r.fa -T\t\t12", " ref.fa", "\n-T 6", " -T " + "9" * 120, " -T" + "9" * 120]
    lines = [h + t for h in heads for t in tails]
    got = {r.cl: r.s for r in spark.createDataFrame([(x,) for x in lines], "cl string").select("cl", fn.bwa_min_score(F.col("cl")).alias("s")).collect()}
    assert got == {x: brute(x) for x in lines}


def test_reads_meet_genes_in_place(spark):
    """A read is shuffled once, for its place in its fragment, and no pairs of reads and genes are grouped."""
    plan = physical(registry.queries()["w2_largest_overlap_no_ties"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan and "Join" not in plan


def test_ties_are_marked_in_place(spark):
    table = [("a", 0, 100), ("b", 50, 150), ("c", 120, 300)]
    spans = {(0, 40): True, (60, 90): False, (60, 120): True, (130, 140): False, (125, 150): False, (40, 60): True, (300, 310): None}
    df = spark.createDataFrame([tuple(map(int, s)) for s in spans], "start long, end long")
    from cohortry.operators import cohort

    got = {(r.start, r.end): r.b and (r.b.label, r.b.once) for r in df.select("start", "end", cohort.best_interval(F.col("start"), F.col("end"), table, mark="once").alias("b")).collect()}
    for (s, e), _ in spans.items():
        shared = {n: min(e, y) - max(s, x) for n, x, y in table if min(e, y) > max(s, x)}
        most = [n for n in sorted(shared) if shared[n] == max(shared.values())]
        assert got[(s, e)] == ((most[0], len(most) == 1) if most else None)


def test_reads_meet_their_fragments_once(spark, monkeypatch):
    """r11 joins reads with nothing: genes and statuses are found in place, and one shuffle brings a fragment together."""
    plans, real = {}, cohort_queries.staged
    monkeypatch.setattr(cohort_queries, "staged", lambda df, name: plans.update({name: physical(df)}) or real(df, name))
    registry.queries()["r11_locus_verdict"](spark, SF)
    assert plans["spans"].count("Exchange hashpartitioning") == 1 and "Join" not in plans["spans"]


def test_rows_of_fragments_are_narrow(spark, monkeypatch):
    """What is summed over a sample does not go through its fragments, of which there are about as many as reads; the roll-up makes
    no bins, carriers or draws."""
    from cohortry.operators import cohort
    from cohortry.plans import cohort_summary

    held = {}
    real = cohort.grouped
    monkeypatch.setattr(cohort, "grouped", lambda df, sets: held.update({k: list(v[1]) for k, v in sets.items()}) or real(df, sets))
    monkeypatch.setattr(cohort, "recomputed", lambda *_, **__: pytest.fail("draws of the challenge"))
    assert registry.queries()["a34_qc_rollup"](spark, SF).count() == 1
    assert set(held) == {"sample", "fragment", "position"}
    assert len(held["fragment"]) <= 12 and not {"n", "passed", *cohort_summary.RESCUED} & set(held["fragment"])


def test_depths_of_bins_are_summed_without_a_sweep(spark):
    """No rows for positions and no window over a sample; in tasks of bounded numbers of reads that lie together, whatever order the
    files have, before the sums are shuffled; and in rows of many bins."""
    plan = physical(registry.queries()["a5_binned_depth"](spark, SF))
    assert "Window" not in plan and plan.count("Exchange") == 1 and "_block" in re.search(r"hashpartitioning\((.*?)\)", plan)[1]
    k = F.col("id")
    reads = spark.range(1000).select((k % 50).alias("sample_id"), (k * 7919 % 5000).alias("seg_start"), (k * 7919 % 5000 + 120).alias("seg_end"), F.lit(1).alias("depth"))
    bins = intervals.binned_depth(reads, ["sample_id"], 50, rows_per_task=100)
    assert re.search(r"rangepartitioning\(sample_id.*, seg_start.*, 10\)", physical(bins))
    assert bins.agg(F.sum("depth_sum")).first()[0] == 120_000


def test_a_sweep_counts_ends_in_tasks_of_bounded_rows(spark):
    """Starts and ends are counted in tasks of so many intervals, not of as many as a file's split holds; runs are the same."""
    k = F.col("id")
    reads = spark.range(1000).select((k % 3).alias("g"), (k * 7919 % 900).alias("start"), (k * 7919 % 900 + k % 40).alias("end"))
    runs = intervals.depth_segments(reads, ["g"], rows_per_task=100)
    assert re.search(r"rangepartitioning\(g.*, start.*, 10\)", physical(runs))
    depth = {}
    for r in reads.collect():
        for x in range(r.start, r.end):
            depth[r.g, x] = depth.get((r.g, x), 0) + 1
    assert {(r.g, x): r.depth for r in runs.collect() for x in range(r.seg_start, r.seg_end)} == depth
