"""More registered queries: cohort joins, verdicts and audits. Imported by the registry for their registration."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortry.functions import scalars as fn
from cohortry.operators import checks, cohort, counting, intervals, ranking, rules
from cohortry.plans import adapters as ad
from cohortry.plans.registry import GENE_TABLE, TIER, bootstrap_sql, query, r1
from cohortry.staging import staged

R = f"WITH {ad.READS}"


@query("j14_first_overlap", f"{R}, t(k, a, b) AS (VALUES (1, 1000, 9000), (2, 8000, 20000), (3, 19000, 50000)) SELECT read_id, min(k) AS k FROM reads JOIN t ON start < b AND \"end\" > a GROUP BY read_id")
def j14(spark, d):
    t = spark.createDataFrame([(0, 1, 1_000, 9_000), (0, 2, 8_000, 20_000), (0, 3, 19_000, 50_000)], "island int, k int, r_start long, r_end long")
    return intervals.first_overlap(ad.reads(spark, d).withColumn("island", F.lit(0)), t, ["island"], "read_id", "k", small_right=True)


ARMS = f"{ad.READS}, x AS (SELECT sample_id, fragment_id, max(CASE WHEN contig = 0 THEN score END) AS a, max(CASE WHEN contig = 1 THEN score END) AS b, max(mapq) AS q FROM reads GROUP BY ALL), s AS (SELECT sample_id, fragment_id, CASE WHEN a IS NULL AND b IS NULL THEN 'missing' WHEN a IS NULL THEN 'absorbed' WHEN b IS NULL OR a > b THEN CASE WHEN q >= 20 THEN 'supporting' ELSE 'unconfirmed' END ELSE 'absorbed' END AS status FROM x)"


def _statuses(spark, d):
    best = lambda c: F.max(F.when(F.col("contig") == c, F.col("score")))
    x = ad.reads(spark, d).groupBy("sample_id", "fragment_id").agg(best(0).alias("a"), best(1).alias("b"), F.max("mapq").alias("q"))
    return x.select("sample_id", "fragment_id", _status().alias("status"))


def _status():
    a, b = F.col("a"), F.col("b")
    return rules.cascade([(a.isNull() & b.isNull(), "missing"), (a.isNull(), "absorbed"), ((b.isNull() | (a > b)) & (F.col("q") >= 20), "supporting"), (b.isNull() | (a > b), "unconfirmed")], "absorbed")


#: Genes A, D, G, M, P, Q and S of the nineteen, which are not megasynthases.
OTHER_GENES = ["g01", "g04", "g07", "g13", "g16", "g17", "g19"]


def locus_verdicts(reads, tiers):
    """R11 in full, from assigned reads (sample_id, gene, start, end, status) and the samples' first tiers (sample_id, tier).

    Reads of status missing are not measured. The tier is taken again from the supporting reads alone, their breadth from
    the union of their intervals; retention and the lower bound of its interval are over measured reads.
    """
    kept = F.col("status") == "supporting"
    each = reads.groupBy("sample_id", "gene").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "missing").alias("m"), F.count_if(kept).alias("k"))
    seen = F.col("k") > 0
    n = each.groupBy("sample_id").agg(F.sum("n").alias("evaluated"), F.sum("m").alias("measured"), F.sum("k").alias("supporting"), F.count_if(seen).alias("genes"), F.count_if(seen & F.col("gene").isin(OTHER_GENES)).alias("other_genes"))
    low = counting.bootstrap_share(reads.withColumn("kept", F.when(F.col("status") != "missing", kept)), ["sample_id"], "start", "kept").select("sample_id", "low")
    breadth = intervals.union_length(reads.where(kept), ["sample_id"])
    n = n.join(low, "sample_id").join(breadth, "sample_id", "left").join(tiers.select("sample_id", "tier"), "sample_id")
    n = n.withColumn("retention", counting.share(F.col("supporting"), F.col("measured")))
    n = n.withColumn("kept_tier", rules.read_tier(F.col("supporting"), F.col("genes"), F.coalesce("union_bases", F.lit(0)) / ad.ISLAND))
    n = n.withColumn("drop", rules.tier_rank(F.col("tier")) - rules.tier_rank(F.col("kept_tier")))
    verdict = rules.retention_verdict(F.col("evaluated"), F.col("measured"), F.col("retention"), F.col("low"), F.col("drop"), F.col("other_genes"))
    return n.select("sample_id", "evaluated", "measured", "supporting", "retention", "low", "tier", "kept_tier", "drop", "other_genes", verdict.alias("verdict"))


R11 = f"""WITH {ad.OVERLAPS}, {ARMS[ARMS.index('x AS'):]}, spans AS (SELECT a.*, r.start, r."end", status FROM assigned AS a JOIN reads AS r USING (read_id) JOIN s ON s.sample_id = a.sample_id AND s.fragment_id = a.fragment_id),
each AS (SELECT sample_id, gene, count(*) AS n, count(*) FILTER (status <> 'missing') AS m, count(*) FILTER (status = 'supporting') AS k FROM spans GROUP BY ALL),
totals AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS evaluated, CAST(sum(m) AS BIGINT) AS measured, CAST(sum(k) AS BIGINT) AS supporting, count(*) FILTER (k > 0) AS genes, count(*) FILTER (k > 0 AND gene IN ('g01', 'g04', 'g07', 'g13', 'g16', 'g17', 'g19')) AS other_genes FROM each GROUP BY sample_id),
c AS (SELECT sample_id, CAST(sample_id AS VARCHAR) AS key, measured AS n, supporting AS hits FROM totals), {bootstrap_sql()},
kept AS (SELECT sample_id, CAST(sum(greatest("end" - greatest(start, coalesce(prev, start)), 0)) AS BIGINT) AS bases FROM (SELECT *, max("end") OVER (PARTITION BY sample_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM spans WHERE status = 'supporting') AS x GROUP BY 1),
tiers AS (SELECT sample_id, {TIER} AS tier FROM (SELECT sample_id, reads, genes, coalesce(union_bases, 0) / {ad.ISLAND} AS breadth FROM (SELECT sample_id, count(*) AS reads, count(DISTINCT gene) AS genes FROM assigned GROUP BY 1) AS y LEFT JOIN (WITH {ad.UNIONS} SELECT * FROM unions) AS u USING (sample_id)) AS z),
merged AS (SELECT s.*, CAST(supporting AS DOUBLE) / nullif(measured, 0) AS retention, low, tier, {TIER.replace('breadth', f'coalesce(bases, 0) / {ad.ISLAND}').replace('reads', 'supporting')} AS kept_tier FROM totals AS s JOIN bounds USING (sample_id) JOIN tiers USING (sample_id) LEFT JOIN kept USING (sample_id)),
ranks AS (SELECT *, list_position(['negative', 'localized_indeterminate', 'multi_gene', 'broad_island', 'extensive_island'], tier) - list_position(['negative', 'localized_indeterminate', 'multi_gene', 'broad_island', 'extensive_island'], kept_tier) AS "drop" FROM merged)
SELECT sample_id, evaluated, measured, supporting, retention, low, tier, kept_tier, "drop", other_genes, CASE WHEN evaluated < 10 OR measured < 10 THEN 'UNDERPOWERED' WHEN CAST(evaluated - measured AS DOUBLE) / evaluated > 0.05 THEN 'INCOMPLETE' WHEN retention >= 0.8 AND low >= 0.6 AND "drop" <= 1 AND other_genes >= 2 THEN 'SURVIVES' ELSE 'NOT_DISTINGUISHABLE' END AS verdict FROM ranks"""


@query("r11_locus_verdict", R11)
def r11_locus(spark, d):
    # a fragment's few reads meet once: its status goes to each in place, and each keeps its gene and its interval
    best = cohort.best_interval(F.col("start"), F.col("end"), GENE_TABLE)
    reads = ad.reads(spark, d).select("sample_id", "fragment_id", "contig", "score", "mapq", "start", "end", best["label"].alias("gene"))
    w = Window.partitionBy("sample_id", "fragment_id")
    best_of = lambda c: F.max(F.when(F.col("contig") == c, F.col("score"))).over(w)
    reads = reads.withColumns({"a": best_of(0), "b": best_of(1), "q": F.max("mapq").over(w)}).withColumn("status", _status())
    return locus_verdicts(staged(reads.where("gene IS NOT NULL").select("sample_id", "gene", "start", "end", "status"), "spans"), r1(spark, d))


@query("j20_off_map", "SELECT count(*) FILTER (n_nationkey IS NULL) AS off_map, count(*) FILTER (n_nationkey IS NOT NULL) AS mapped FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey < 4")
def j20(spark, d):
    carriers = ad.table(spark, d, "nation").where("n_regionkey < 4").select("n_nationkey")
    met = ad.table(spark, d, "supplier").join(carriers, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return met.agg(F.count_if(F.col("n_nationkey").isNull()).alias("off_map"), F.count_if(F.col("n_nationkey").isNotNull()).alias("mapped"))


@query("j25_length_mismatches", "SELECT p_partkey AS name, p_size AS here, p_partkey % 50 + 1 AS there FROM part WHERE p_size <> p_partkey % 50 + 1 ORDER BY name LIMIT 10")
def j25(spark, d):
    p = ad.table(spark, d, "part")
    one = p.select(F.col("p_partkey").alias("name"), F.col("p_size").cast("long").alias("here"))
    two = p.select(F.col("p_partkey").alias("name"), (F.col("p_partkey") % 50 + 1).alias("there"))
    return one.join(two, "name", "left").where("here <> there").orderBy("name").limit(10).select("name", F.col("here").cast("int").alias("here"), "there")


@query("j27_traced_reads", f"{R}, w AS (SELECT read_id FROM reads WHERE score < 10), st AS (SELECT 'all' AS stage, read_id, sample_id FROM reads UNION ALL SELECT 'mapq', read_id, sample_id FROM reads WHERE mapq >= 20 UNION ALL SELECT 'exact', read_id, sample_id FROM reads WHERE mapq >= 20 AND nm = 0) SELECT sample_id, stage, count(*) AS reads FROM st WHERE read_id IN (SELECT read_id FROM w) GROUP BY ALL")
def j27(spark, d):
    reads = ad.reads(spark, d)
    stages = {"all": F.lit(True), "mapq": F.col("mapq") >= 20, "exact": (F.col("mapq") >= 20) & (F.col("nm") == 0)}
    each = reads.withColumn("stage", F.explode(F.array_compact(F.array(*[F.when(c, s) for s, c in stages.items()]))))
    return each.join(reads.where("score < 10").select("read_id"), "read_id", "left_semi").groupBy("sample_id", "stage").agg(F.count(F.lit(1)).alias("reads"))


@query("a29_span", f"{R}, k AS (SELECT sample_id, contig, start, \"end\" FROM reads WHERE score > 48) SELECT sample_id, count(DISTINCT contig) AS contigs, CASE WHEN count(DISTINCT contig) = 1 THEN max(\"end\") - min(start) END AS span FROM k GROUP BY sample_id")
def a29(spark, d):
    k = ad.reads(spark, d).where("score > 48")
    return k.groupBy("sample_id").agg(F.countDistinct("contig").alias("contigs"), (F.max("end") - F.min("start")).alias("span")).select("sample_id", "contigs", F.when(F.col("contigs") == 1, F.col("span")).alias("span"))


@query("a32_fragment_fates", f"{R} SELECT fragment_id, count(*) AS reads, count(*) FILTER (mapq >= 20) AS kept, CASE WHEN count(*) = count(*) FILTER (mapq >= 20) THEN 'whole' WHEN count(*) FILTER (mapq >= 20) = 0 THEN 'lost' ELSE 'broken' END AS fate, min(read_id) FILTER (mapq < 20) AS first_lost FROM reads GROUP BY fragment_id")
def a32(spark, d):
    g = ad.reads(spark, d).groupBy("fragment_id").agg(F.count(F.lit(1)).alias("reads"), F.count_if(F.col("mapq") >= 20).alias("kept"), F.min(F.when(F.col("mapq") < 20, F.col("read_id"))).alias("first_lost"))
    return g.withColumn("fate", rules.cascade([(F.col("reads") == F.col("kept"), "whole"), (F.col("kept") == 0, "lost")], "broken"))


@query("a32_score_histogram", f"{R} SELECT score // 5 AS bin, count(*) AS reads FROM reads GROUP BY 1")
def a32h(spark, d):
    return ad.reads(spark, d).groupBy(F.floor(F.col("score") / 5).alias("bin")).agg(F.count(F.lit(1)).alias("reads"))


@query("a37_rank_maximum", f"{R}, n AS (SELECT sample_id, part % 50 AS taxon, count(*) AS reads FROM reads GROUP BY ALL) SELECT sample_id, max(reads) AS most FROM n GROUP BY sample_id HAVING max(reads) >= 2")
def a37(spark, d):
    n = ad.reads(spark, d).groupBy("sample_id", F.col("part") % 50).agg(F.count(F.lit(1)).alias("reads"))
    return n.groupBy("sample_id").agg(F.max("reads").alias("most")).where("most >= 2")


@query("r3_reads_per_million", f"{R}, n AS (SELECT sample_id, count(*) AS reads, count(*) FILTER (mapq >= 20) AS depleted FROM reads GROUP BY 1) SELECT sample_id, CASE WHEN depleted > 0 THEN reads * 1000000.0::DOUBLE / depleted END AS rpm FROM n")
def r3(spark, d):
    n = ad.reads(spark, d).groupBy("sample_id").agg(F.count(F.lit(1)).alias("reads"), F.count_if(F.col("mapq") >= 20).alias("depleted"))
    return n.select("sample_id", F.when(F.col("depleted") > 0, F.col("reads") * F.lit(1_000_000.0) / F.col("depleted")).alias("rpm"))


@query("r13_unexpected_taxon", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'high' WHEN p_size >= 20 THEN 'medium' ELSE 'low' END AS qc_status, NOT contains(p_type, 'STEEL') AS unexpected FROM part")
def r13(spark, d):
    size = F.col("p_size")
    return ad.table(spark, d, "part").select("p_partkey", rules.cascade([(size >= 40, "high"), (size >= 20, "medium")], "low").alias("qc_status"), (~F.contains("p_type", F.lit("STEEL"))).alias("unexpected"))


@query("h1_arm_confirmation", f"{R} SELECT fragment_id, coalesce(bool_or(contig = 0 AND mapq >= 30 AND score >= 20), false) AS confirmed FROM reads GROUP BY fragment_id")
def h1(spark, d):
    return ad.reads(spark, d).groupBy("fragment_id").agg(F.bool_or((F.col("contig") == 0) & (F.col("mapq") >= 30) & (F.col("score") >= 20)).alias("confirmed"))


@query("h3_residual_share", f"{R} SELECT sample_id, CAST(count(DISTINCT CASE WHEN flag & 2308 = 0 THEN fragment_id END) AS DOUBLE) / nullif(count(DISTINCT fragment_id), 0) AS share FROM reads GROUP BY sample_id")
def h3(spark, d):
    g = ad.reads(spark, d).groupBy("sample_id").agg(F.countDistinct(F.when(~fn.flagged(F.col("flag"), 2308), F.col("fragment_id"))).alias("a"), F.countDistinct("fragment_id").alias("b"))
    return g.select("sample_id", counting.share(F.col("a"), F.col("b")).alias("share"))


@query("v13_far_apart", f"{R}, n AS (SELECT sample_id, count(*) FILTER (fragment_id % 2 = 0) AS one, count(*) FILTER (fragment_id % 2 = 1) AS two FROM reads GROUP BY 1) SELECT sample_id FROM n WHERE abs(one - two) > greatest(2, one * 0.05)")
def v13(spark, d):
    n = ad.reads(spark, d).groupBy("sample_id").agg(F.count_if(F.col("fragment_id") % 2 == 0).alias("one"), F.count_if(F.col("fragment_id") % 2 == 1).alias("two"))
    return checks.far_apart(n, "one", "two").select("sample_id")


