"""Golden cases of the evidence operators, and the registered queries against their SQL."""

import os

import duckdb
import pytest
from cohortry.functions import scalars as fn
from cohortry.operators import checks, counting, hierarchy, intervals, ranking, rules
from cohortry.plans import cohort_queries, registry
from cohortry.sources import text_tables
from cohortry.streaming.incremental import append_fragments
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = db.sql(registry.oracle_sql()[name])
    assert columns == sorted(want.columns)
    rows = want.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, rows))


def test_tiers_at_their_borders(spark):
    cases = [(0, 19, 1.0, "negative"), (1, 1, 0.0001, "localized_indeterminate"), (50, 5, 0.005, "localized_indeterminate"), (5, 3, 0.01, "multi_gene"), (30, 8, 0.075, "broad_island"), (100, 10, 0.15, "extensive_island"), (30, 8, 0.05, "multi_gene"), (100, 8, 0.15, "broad_island")]
    df = spark.createDataFrame(cases, "reads int, genes int, breadth double, want string")
    assert df.where(rules.read_tier(F.col("reads"), F.col("genes"), F.col("breadth")) != F.col("want")).count() == 0
    with pytest.raises(ValueError):
        rules.read_tier(F.lit(1), F.lit(1), F.lit(1.0), [("strong", 1, 1, 0.1), ("weak", 2, 1, 0.1)])


@pytest.mark.parametrize("parts", [1, 7])
def test_gene_assignment_and_ties(spark, parts):
    rows = [("r1", "A", 30), ("r1", "B", 70), ("r2", "A", 40), ("r2", "A", 40), ("r2", "B", 70), ("r3", "Q", 50), ("r3", "B", 50), ("r4", "A", 5)]
    df = spark.createDataFrame(rows, "read string, gene string, bases long").repartition(parts)
    first = {r.read: (r.gene, r.bases) for r in ranking.largest_overlap(df, ["read"], "gene", "bases", floor=10).collect()}
    assert first == {"r1": ("B", 70), "r2": ("A", 80), "r3": ("B", 50)}
    assert {r.read for r in ranking.largest_overlap(df, ["read"], "gene", "bases", tie="drop").collect()} == {"r1", "r2", "r4"}


def test_best_hit_is_ambiguous_only_between_genes(spark):
    rows = [("a", "A", 1e-30, 1.0, 1), ("a", "B", 1e-10, 9.0, 9), ("b", "A", 1e-5, 90.0, 5), ("b", "B", 1e-5, 110.0, 5), ("c", "A", 1e-5, 9.0, 5), ("c", "B", 1e-5, 9.0, 5), ("d", "A", 1e-5, 9.0, 5), ("d", "A", 1e-5, 9.0, 5)]
    df = spark.createDataFrame(rows, "read string, gene string, e double, score double, len int")
    got = {r.read: (r.gene, r.status) for r in ranking.best_hit(df, ["read"], "gene", [F.col("e"), F.col("score").desc(), F.col("len").desc()]).collect()}
    assert got == {"a": ("A", "assigned"), "b": ("B", "assigned"), "c": (None, "ambiguous"), "d": ("A", "assigned")}


def test_interval_union_depth_and_join(spark):
    df = spark.createDataFrame([("x", 0, 500), ("x", 200, 700), ("y", 5, 5), ("z", 1, 4), ("z", 6, 9)], "k string, start long, end long")
    assert {r.k: r.union_bases for r in intervals.union_length(df, ["k"]).collect()} == {"x": 700, "y": 0, "z": 6}
    segments = intervals.depth_segments(df, ["k"])
    assert sorted((r.seg_start, r.seg_end, r.depth) for r in segments.where("k = 'x'").collect()) == [(0, 200, 1), (200, 500, 2), (500, 700, 1)]
    other = df.select("k", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    theta = df.join(other, "k").where("start < r_end and end > r_start and end > start and r_end > r_start").count()
    assert intervals.overlap_join(df, other, ["k"], width=100).count() == theta
    assert intervals.clipped(df, 600, 650).count() == 1


def test_cigar_and_names(spark):
    df = spark.createDataFrame([("5S50M2I40M3D8M4H", 0), ("10M5", 0), ("90M2D8M10S", 16)], "cigar string, flag long")
    steps = fn.cigar_steps(F.col("cigar"))
    rows = df.select(fn.columns_of(steps).alias("c"), fn.read_length(steps).alias("l"), fn.reference_span(steps).alias("s"), fn.five_prime(F.col("flag"), F.lit(100), F.col("cigar")).alias("p")).collect()
    assert tuple(rows[0]) == (103, 109, 101, 95) and rows[1][0] is None and rows[2].p == 209
    names = spark.createDataFrame([("@r1/1 x",), ("r2 2:N:0",), ("r3",)], "h string").select(fn.read_name(F.col("h")).alias("n"), fn.mate_of(F.col("h")).alias("m")).collect()
    assert [tuple(r) for r in names] == [("r1/1", 1), ("r2", 2), ("r3", 0)]


def test_counts_quantiles_and_conflicts(spark):
    df = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3), ("s", 4)], "k string, v long")
    assert tuple(counting.five_numbers(df, ["k"], "v").first()) == ("s", 1.0, 1.75, 2.5, 3.25, 4.0)
    assert counting.nearest_rank(df, ["k"], "v", 0.5).first().quantile == 2
    wide, conflicts = counting.eav_wide(spark.createDataFrame([("s", "m", 1), ("s", "m", 1), ("s", "n", 1), ("s", "n", 2)], "k string, metric string, value long"), ["k"], "metric", "value", ["m", "n"])
    assert wide.first().m == 1 and wide.first().n is None and conflicts.count() == 1
    boot = df.withColumn("hit", F.col("v") > 1)
    one, many = (counting.bootstrap_share(boot.repartition(n), ["k"], "v", "hit", rounds=50).first() for n in (1, 5))
    assert one == many and one.low <= 0.75 <= one.high


def test_bootstrap_takes_1000_rounds_of_counts(spark, monkeypatch):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"), F.when(F.col("id") < 19_000, F.col("id") % 10 < 4).alias("hit"))
    made = counting.bootstrap_share(df.unionByName(spark.sql("SELECT 2L AS k, 1L AS v, CAST(null AS BOOLEAN) AS hit")), ["k"], "v", "hit")
    assert "InPandas" not in made._jdf.queryExecution().toString()
    got = {r.k: (r.low, r.high) for r in made.collect()}
    assert got[2] == (None, None) and got[0] != got[1]
    for k in (0, 1):  # 9,500 measured, share 0.4: 0.4 -+ 1.96 x 0.00503
        assert abs(got[k][0] - 0.39015) < 0.0015 and abs(got[k][1] - 0.40985) < 0.0015
    asked = []
    whole = counting.bootstrap_share
    monkeypatch.setattr(counting, "bootstrap_share", lambda *a, **k: asked.append(k.get("rounds", 1000)) or whole(*a, **k))
    registry.queries()["a23_bootstrap_interval"](spark, SF)
    assert asked == [1000]


def test_locus_verdict_needs_every_criterion(spark):
    genes = [f"g{i:02d}" for i in range(1, 20)]
    reads = lambda sample, n, status, names=genes, step=400: [(sample, names[i % len(names)], i * step, i * step + 150, status) for i in range(n)]
    mega = [g for g in genes if g not in cohort_queries.OTHER_GENES]
    rows = reads("whole", 100, "supporting") + reads("most", 90, "supporting") + reads("most", 10, "absorbed")
    rows += reads("seventy", 70, "supporting") + reads("seventy", 30, "unconfirmed")  # retention below 0.8
    rows += reads("gaps", 90, "supporting") + reads("gaps", 10, "missing")  # a tenth not measured
    rows += reads("few", 9, "supporting") + reads("unmeasured", 9, "supporting") + reads("unmeasured", 40, "missing")
    rows += reads("wide", 10, "supporting") + reads("wide", 2, "absorbed")  # 0.83, but its interval goes below 0.6
    rows += reads("mega", 100, "supporting", mega)  # no gene outside the megasynthases
    rows += reads("narrow", 100, "supporting", genes[:4], 1)  # few genes, narrow: two tiers lower
    df = spark.createDataFrame(rows, "sample_id string, gene string, start long, end long, status string")
    tiers = df.select("sample_id").distinct().withColumn("tier", F.when(F.col("sample_id") == "wide", "multi_gene").otherwise("extensive_island"))
    got = {r.sample_id: r for r in cohort_queries.locus_verdicts(df, tiers).collect()}
    want = {"whole": "SURVIVES", "most": "SURVIVES", "gaps": "INCOMPLETE", "few": "UNDERPOWERED", "unmeasured": "UNDERPOWERED"}
    assert {k: r.verdict for k, r in got.items()} == dict.fromkeys(["seventy", "wide", "mega", "narrow"], "NOT_DISTINGUISHABLE") | want
    assert got["wide"].retention > 0.8 and got["wide"].low < 0.6 and got["wide"]["drop"] < 2 and got["wide"].other_genes > 1
    assert got["mega"].other_genes == 0 and got["mega"]["drop"] == 0 and got["narrow"]["drop"] == 3 and got["narrow"].low == 1
    if os.path.isdir(SF):
        full, samples = registry.queries()["r11_locus_verdict"](spark, SF).collect(), registry.queries()["r1_evidence_tier"](spark, SF).count()
        assert len(full) == samples and all(r.supporting <= r.measured <= r.evaluated and r["drop"] >= 0 for r in full)


def test_contig_categories_in_order(spark):
    cases = [("chr1", "canonical"), ("22", "canonical"), ("chrY", "canonical"), ("23", "other"), ("chr0", "other"), ("chrM", "mito"), ("MT", "mito"), ("mitochondrial", "other"), ("chr1_KI270762v1_alt", "alt"), ("HLA-A*01:01", "decoy"), ("chrUn_decoy_alt", "alt")]
    cases += [("hs37d5", "decoy"), ("chrUn_KN707606v1_decoy", "decoy"), ("chrEBV", "viral"), ("NC_007605", "viral"), ("hpv16", "viral"), ("a Virus_random", "unplaced"), ("KI270728.1", "unplaced"), ("decoy_1", "other"), ("chrUn_KI270302v1", "unplaced"), ("chr1_KI270706v1_random", "unplaced"), ("GL000191.1", "unplaced"), ("x", "other")]
    df = spark.createDataFrame(cases, "name string, want string")
    assert df.where(rules.contig_category(F.col("name")) != F.col("want")).collect() == []


def test_tree_with_a_cycle(spark):
    tree = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (8, 9), (9, 8)], "node long, parent long")
    got = {(r.node, r.ancestor): r.distance for r in hierarchy.ancestors(tree).collect()}
    assert got[(3, 1)] == 2 and got[(8, 9)] == 1 and (1, 2) not in got
    assert {r.node for r in hierarchy.below(hierarchy.ancestors(tree), 1).collect()} == {1, 2, 3}


def test_constraints(spark):
    chain = spark.createDataFrame([(1, 10, None, 5), (2, 10, None, 11), (3, None, None, None)], "k int, a int, b int, c int")
    assert [r.k for r in checks.not_falling(chain, ["a", "b", "c"]).collect()] == [2]
    with pytest.raises(ValueError, match="rising"):
        checks.enforce({"rising": checks.not_falling(chain, ["a", "c"]), "none": chain.where("k > 9")})
    assert checks.missing(spark.createDataFrame([("s", "x")], "k string, g string"), ["k"], "g", spark.createDataFrame([("x",), ("y",)], "g string")).count() == 1


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t16\tc\t11\t40\t5M\t*\t0\t0\tACGTA\tIIIII\tAS:i:7\tNM:i:1\nbad\n")
    row = text_tables.sam(spark, str(tmp_path / "a.sam")).first()
    assert (row.read_id, row.start, row.tags["AS"]) == ("r1", 10, "7")
    (tmp_path / "a.gff").write_text("##gff\nc\tx\tCDS\t11\t20\t.\t+\t0\tID=1;Name=n\n##FASTA\n>c\nACGT\n")
    gene = text_tables.gff(spark, str(tmp_path / "a.gff"), "CDS").first()
    assert (gene.start, gene.end, gene.attributes["Name"]) == (10, 20, "n")
    (tmp_path / "a.fq").write_text("@r/1\nAC\n+\nII\n@s\nGT\n+\nII\n")
    assert [r.seq for r in text_tables.fastq(spark, str(tmp_path / "a.fq")).orderBy("ordinal").collect()] == ["AC", "GT"]
    text_tables.write_tsv(spark.createDataFrame([(1, None, True)], "a int, b string, c boolean"), str(tmp_path / "out"), ["c", "b", "a"])
    assert "True\tNA\t1" in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))


def test_fragments_are_added_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.tsv").write_text("sample\tmetric\tvalue\ns\tm\t1\n")
    for _ in range(2):
        append_fragments(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1


def test_recruitment_classes(spark):
    left, right = 5_001, 55_768
    cases = [
        (20_000, "60M90S", 60, 0, "rejected", "low_query_coverage"), (20_000, "150M", 60, 0, "island_internal", None), (20_000, "120M30S", 60, 0, "island_internal", None), (20_000, "119M31S", 60, 0, "rejected", "low_query_coverage"),
        (20_000, "150M", 60, 20, "rejected", "low_identity"), (20_000, "59M", 60, 0, "rejected", "short_alignment"), (left - 75, "150M", 60, 0, "boundary_spanning", None), (right - 68, "150M", 60, 0, "boundary_spanning", None),
        (left, "90S60M", 60, 0, "boundary_spanning", None), (right - 59, "60M90S", 60, 0, "boundary_spanning", None), (left + 11, "90S60M", 60, 0, "rejected", "low_query_coverage"), (left, "60M90S", 60, 0, "rejected", "low_query_coverage"),
        (left, "5S145M", 60, 0, "island_internal", None), (left - 6, "150M", 60, 0, "island_internal", None), (100, "150M", 60, 0, "flank_only", None), (left - 145, "150M", 60, 0, "flank_only", None), (20_000, "150M", 5, 0, "rejected", "low_mapq"), (20_000, "*", 60, 0, "rejected", "unmapped"),
    ]
    df = spark.createDataFrame(cases, "pos int, cigar string, mapq int, nm int, class string, reason string")
    made = df.withColumn("r", rules.recruitment_class(F.col("pos"), F.col("cigar"), F.col("mapq"), F.col("nm"), left, right))
    assert made.where(~(F.col("r.class").eqNullSafe(F.col("class")) & F.col("r.reason").eqNullSafe(F.col("reason")))).collect() == []


def test_competitive_calls_and_typing(spark):
    cases = [(None, None, None, None, "ambiguous"), (5, None, None, None, "true"), (None, None, 5, None, "decoy"), (9, 1, 9, 2, "true"), (9, 2, 9, 2, "ambiguous"), (9, None, 9, 2, "ambiguous"), (8, 0, 9, 9, "decoy")]
    df = spark.createDataFrame(cases, "a int, na int, b int, nb int, want string")
    assert df.where(rules.favoured_with_mismatches(F.col("a"), F.col("na"), F.col("b"), F.col("nb")) != F.col("want")).count() == 0
    types = spark.createDataFrame([(["1"] * 7, "131", "typed"), (["1"] * 6 + ["~2"], "131", "insufficient_loci"), (["1"] * 7, None, "novel_allele_combination")], "alleles array<string>, st string, want string")
    assert types.where(rules.typing_status(F.col("alleles"), F.col("st")) != F.col("want")).count() == 0


def test_program_chain(spark):
    rows = [("f", "sort", "align", 1), ("f", "align", None, 2), ("f", "mark", "sort", 3), ("f", "x", "y", 4), ("f", "y", "x", 5)]
    got = hierarchy.chain_order(spark.createDataFrame(rows, "file string, id string, pp string, n int"), "file", "id", "pp", "n")
    assert {r.id: r.place for r in got.collect()} == {"align": 0, "sort": 1, "mark": 2, "x": 3, "y": 4}
