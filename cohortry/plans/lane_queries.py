"""Queries of the cohort's lanes: carriers, specificity, bins and community, quality, reports. Imported for registration."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.functions import scalars as fn
from cohortry.operators import checks, counting, intervals, lanes, ranking, rules
from cohortry.plans import adapters as ad
from cohortry.plans.registry import _ORACLE, EVIDENCE, TIER, _assigned, query, r1
from cohortry.sources import records

R = f"WITH {ad.READS}"
#: Samples are pooled in tens, so that a pool's fragment has several records.
POOLED = f"{ad.READS}, pooled AS (SELECT *, sample_id % 10 AS pool FROM reads)"


def pooled(spark, d):
    return ad.reads(spark, d).withColumn("pool", F.col("sample_id") % 10)


def literal(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- carriers: contigs 0 to 5 are the panel, 6 is not on it; the genus of a carrier is its number modulo 3

CARRIERS = f"""{POOLED}, best AS (SELECT pool, fragment_id, contig AS carrier, max(score) AS score FROM pooled WHERE flag & 4 = 0 AND contig < 6 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS place, max(score) OVER (PARTITION BY pool, fragment_id) AS most FROM best WINDOW w AS (PARTITION BY pool, fragment_id ORDER BY score DESC, carrier)),
calls AS (SELECT pool, fragment_id, max(carrier) FILTER (place = 1) AS top, max(score) FILTER (place = 1) AS top_score, max(carrier) FILTER (place = 2) AS runner_up, max(score) FILTER (place = 2) AS runner_up_score,
  count(*) FILTER (score = most) AS within_margin, string_agg(CAST(carrier AS VARCHAR), ';' ORDER BY carrier) FILTER (score = most) AS tied, count(DISTINCT carrier % 3) FILTER (score = most) AS n_genera,
  string_agg(DISTINCT CAST(carrier % 3 AS VARCHAR), '+' ORDER BY CAST(carrier % 3 AS VARCHAR)) FILTER (score = most) AS genera FROM ranked GROUP BY pool, fragment_id),
every AS (SELECT pool, fragment_id, bool_or(flag & 4 = 0 AND contig = 6) AS off FROM pooled GROUP BY ALL),
called AS (SELECT e.pool, e.fragment_id, top, top_score, runner_up, runner_up_score, top_score - runner_up_score AS lead, within_margin, tied, n_genera, genera,
  CASE WHEN top IS NULL THEN CASE WHEN off THEN 'off_map' ELSE 'unmapped' END WHEN within_margin = 1 AND (runner_up IS NULL OR top_score - runner_up_score >= 1) THEN 'attributed' ELSE 'ambiguous' END AS call
  FROM every AS e LEFT JOIN calls AS c ON c.pool = e.pool AND c.fragment_id = e.fragment_id)"""


def _called(spark, d):
    records = pooled(spark, d).withColumn("mapped", F.col("flag").bitwiseAND(4) == 0)
    panel = spark.range(6).select(F.col("id").alias("contig"), F.col("id").alias("carrier"), (F.col("id") % 3).alias("genus"))
    return lanes.carrier_reads(records, F.broadcast(panel), ["pool", "fragment_id"])


@query("w5_carrier_ranking", f"WITH {CARRIERS} SELECT pool, fragment_id, top, top_score, runner_up, runner_up_score, lead, CAST(within_margin AS INTEGER) AS within_margin, tied, call FROM called")
def w5(spark, d):
    return _called(spark, d).select("pool", "fragment_id", "top", "top_score", "runner_up", "runner_up_score", "lead", "within_margin", F.array_join("tied", ";").alias("tied"), "call")


SUMMARY = f"""{CARRIERS}, totals AS (SELECT pool, count(*) AS n_reads, count(*) FILTER (call = 'attributed') AS n_attributed, count(*) FILTER (call = 'ambiguous') AS n_ambiguous, count(*) FILTER (call = 'unmapped') AS n_unmapped, count(*) FILTER (call = 'off_map') AS n_off_map FROM called GROUP BY pool),
c AS (SELECT pool, CAST(top AS VARCHAR) AS k, count(*) AS n FROM called WHERE call = 'attributed' GROUP BY ALL), cr AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY n DESC, k) AS i FROM c),
g AS (SELECT pool, genera AS k, count(*) AS n FROM called WHERE n_genera = 1 GROUP BY ALL), gr AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY n DESC, k) AS i FROM g),
t AS (SELECT pool, genera AS k, count(*) AS n FROM called WHERE n_genera > 1 GROUP BY ALL),
cs AS (SELECT pool, max(k) FILTER (i = 1) AS top_carrier, max(n) FILTER (i = 1) AS top_carrier_reads, max(k) FILTER (i = 2) AS runner_up_carrier, max(n) FILTER (i = 2) AS runner_up_reads, string_agg(concat(k, ':', n), ';' ORDER BY n DESC, k) AS carrier_reads FROM cr GROUP BY pool),
gs AS (SELECT pool, max(k) FILTER (i = 1) AS top_genus, max(n) FILTER (i = 1) AS top_genus_reads, CAST(sum(n) AS BIGINT) AS genus_attributed, string_agg(concat(k, ':', n), ';' ORDER BY n DESC, k) AS genus_reads FROM gr GROUP BY pool),
ts AS (SELECT pool, string_agg(concat(k, ':', n), ';' ORDER BY n DESC, k) AS tied_genus_sets FROM t GROUP BY pool),
s AS (SELECT pool, n_reads, n_attributed, n_ambiguous, n_unmapped, n_off_map, n_attributed + n_ambiguous AS n_mapped, top_carrier, coalesce(top_carrier_reads, 0) AS top_carrier_reads, runner_up_carrier, coalesce(runner_up_reads, 0) AS runner_up_reads, top_genus,
  coalesce(top_genus_reads, 0) AS top_genus_reads, coalesce(genus_attributed, 0) AS genus_attributed, coalesce(carrier_reads, '') AS carrier_reads, coalesce(genus_reads, '') AS genus_reads, coalesce(tied_genus_sets, '') AS tied_genus_sets
  FROM totals LEFT JOIN cs USING (pool) LEFT JOIN gs USING (pool) LEFT JOIN ts USING (pool))"""


@query("a21_carrier_counts", f"WITH {SUMMARY} SELECT * FROM s")
def a21(spark, d):
    return lanes.carrier_summary(_called(spark, d), ["pool"]).drop("verdict")


@query("r10_carrier_verdict", f"WITH {SUMMARY} SELECT pool, CASE WHEN n_attributed >= 10 AND top_carrier_reads >= 0.8 * n_attributed THEN 'CARRIER_ATTRIBUTED' WHEN genus_attributed >= 10 AND top_genus_reads >= 0.8 * genus_attributed THEN 'CARRIER_GENUS_ONLY' WHEN n_mapped < 10 THEN 'CARRIER_UNDETERMINED' ELSE 'CARRIER_AMBIGUOUS' END AS verdict FROM s")
def r10(spark, d):
    return lanes.carrier_summary(_called(spark, d), ["pool"]).select("pool", "verdict")


# --- specificity: arm A is contig 0, arm B the best scores of contigs 1 (true) and 2 (decoy)

FATES = f"""{POOLED}, ev AS (SELECT pool, fragment_id, max(part % 3) FILTER (contig IN (0, 3)) AS clade, max(mapq) FILTER (contig IN (0, 3)) AS confidence, max(nm) FILTER (contig IN (0, 3)) AS kmers, bool_or(contig IN (0, 3)) AS in_a,
  max(score) FILTER (contig IN (1, 4) AND flag & 4 = 0) AS t, max(score) FILTER (contig IN (2, 5) AND flag & 4 = 0) AS x, bool_or(contig IN (1, 2, 4, 5)) AS listed, max(contig) FILTER (contig IN (2, 5) AND flag & 4 = 0) AS decoy FROM pooled GROUP BY ALL),
cl AS (SELECT *, CASE WHEN t IS NULL AND x IS NULL THEN 'ambiguous' WHEN x IS NULL OR t - x > 0 THEN 'confirmed_true' WHEN t IS NULL OR t - x < 0 THEN 'confirmed_decoy' ELSE 'ambiguous' END AS classification FROM ev),
su AS (SELECT *, coalesce(clade = 1 AND confidence >= 10 AND kmers >= 2, FALSE) AS a_ok, coalesce(clade = 1 AND confidence >= 10 AND kmers >= 2, FALSE) AND listed AND classification = 'confirmed_true' AS survives FROM cl),
fates AS (SELECT *, CASE WHEN survives THEN 'survived' WHEN NOT listed THEN 'missing_from_arm_b' WHEN classification = 'ambiguous' AND t IS NULL AND x IS NULL THEN 'unaligned' WHEN NOT in_a THEN 'missing_from_arm_a' ELSE 'lost' END AS fate FROM su)"""


def _fates(spark, d):
    c, mapped = F.col("contig"), F.col("flag").bitwiseAND(4) == 0
    of = lambda f, value, *contigs: f(F.when(c.isin(*contigs), value))
    arms = pooled(spark, d).groupBy("pool", "fragment_id").agg(
        of(F.max, F.col("part") % 3, 0, 3).alias("clade"), of(F.max, F.col("mapq"), 0, 3).alias("confidence"), of(F.max, F.col("nm"), 0, 3).alias("kmers"), F.bool_or(c.isin(0, 3)).alias("in_a"),
        F.max(F.when(c.isin(1, 4) & mapped, F.col("score"))).alias("t"), F.max(F.when(c.isin(2, 5) & mapped, F.col("score"))).alias("x"), F.bool_or(c.isin(1, 2, 4, 5)).alias("listed"), F.max(F.when(c.isin(2, 5) & mapped, c)).alias("decoy"),
    )
    by_score = rules.favoured(F.col("t"), F.col("x"))
    arms = arms.withColumns({"classification": F.when(by_score == "ambiguous", by_score).otherwise(F.concat(F.lit("confirmed_"), by_score)), "a_ok": rules.clade_confirmed(F.col("clade"), F.col("confidence"), F.col("kmers"), target=1, least_confidence=10, least_kmers=2)})
    arms = arms.withColumn("survives", F.col("a_ok") & F.col("listed") & (F.col("classification") == "confirmed_true"))
    return arms.withColumn("fate", rules.read_fate(F.col("survives"), F.col("listed"), F.col("classification"), F.col("t").isNotNull() | F.col("x").isNotNull(), F.col("in_a")))


@query("j18_fragment_status", f"WITH {FATES} SELECT pool, fragment_id, fate FROM fates")
def j18(spark, d):
    return _fates(spark, d).select("pool", "fragment_id", "fate")


@query("h1_arm_a_confirms", f"WITH {FATES} SELECT pool, count(*) FILTER (a_ok) AS confirmed, count(*) FILTER (NOT a_ok) AS other FROM fates GROUP BY pool")
def h1(spark, d):
    return _fates(spark, d).groupBy("pool").agg(F.count_if("a_ok").alias("confirmed"), F.count_if(~F.col("a_ok")).alias("other"))


RETENTION = """ret AS (SELECT pool, count(*) AS n_evaluated, count(*) FILTER (fate = 'survived') AS n_survived, count(*) FILTER (fate = 'lost') AS n_lost, count(*) FILTER (fate = 'missing_from_arm_b') AS n_missing_from_arm_b, count(*) FILTER (fate = 'unaligned') AS n_unaligned,
  count(*) FILTER (fate = 'missing_from_arm_a') AS n_missing_from_arm_a, count(*) FILTER (fate IN ('survived', 'lost')) AS n_measured, coalesce(CAST(count(*) FILTER (fate = 'survived') AS DOUBLE) / nullif(count(*) FILTER (fate IN ('survived', 'lost')), 0), 0) AS retention,
  CAST(count(*) FILTER (fate = 'survived') AS DOUBLE) / count(*) AS retention_if_unmeasured_lost, CAST(count(*) FILTER (fate NOT IN ('survived', 'lost')) AS DOUBLE) / count(*) AS unmeasured_fraction FROM fates GROUP BY pool)"""


@query("a24_retention", f"WITH {FATES}, {RETENTION} SELECT * FROM ret")
def a24(spark, d):
    return lanes.retention(_fates(spark, d), ["pool"])


@query("a22_absorbers", f"WITH {FATES}, lost AS (SELECT pool, coalesce(CAST(decoy AS VARCHAR), CASE WHEN classification = 'confirmed_true' THEN 'arm_a_not_confirmed' ELSE 'no_decoy_alignment' END) AS absorber, classification = 'ambiguous' OR coalesce(abs(t - x) <= 5, FALSE) AS near FROM fates WHERE fate = 'lost'), n AS (SELECT pool, absorber, count(*) AS reads, count(*) FILTER (near) AS near_threshold FROM lost GROUP BY ALL) SELECT pool, absorber, reads, near_threshold, CAST(reads AS DOUBLE) / sum(reads) OVER (PARTITION BY pool) AS fraction, CAST(reads AS DOUBLE) / sum(reads) OVER (PARTITION BY pool) > 0.2 AND near_threshold > 0 AS flagged FROM n")
def a22(spark, d):
    lost = _fates(spark, d).where("fate = 'lost'")
    name = rules.absorber(F.col("decoy").cast("string"), F.lit(None).cast("string"), F.col("classification"))
    return lanes.absorbers(lost.select("pool", name.alias("absorber"), rules.near_threshold(F.col("classification"), F.col("t") - F.col("x"), 5).alias("near")), ["pool"])


@query("h2_recomputed_breadth", f"WITH {ad.OVERLAPS}, o AS (SELECT sample_id, CAST(sum(bases) AS BIGINT) AS bases FROM assigned GROUP BY 1), x AS (SELECT s_suppkey AS sample_id, CAST(s_nationkey AS DOUBLE) / 25 AS breadth FROM supplier WHERE s_suppkey % 2 = 0) SELECT sample_id, coalesce(breadth, least(1.0::DOUBLE, coalesce(CAST(bases AS DOUBLE), 0) / {ad.ISLAND})) AS breadth, CASE WHEN breadth IS NULL THEN 'approximate' ELSE 'exact' END AS source FROM o FULL JOIN x USING (sample_id)")
def h2(spark, d):
    exact = ad.table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("sample_id"), (F.col("s_nationkey").cast("double") / 25).alias("breadth"))
    return lanes.recomputed_breadth(_assigned(spark, d), exact, ["sample_id"], ad.ISLAND)


VARIANTS = f"{R}, v AS (SELECT sample_id, count(*) AS raw, count(*) FILTER (flag & 1024 = 0) AS dup_marked, count(DISTINCT fragment_id) AS fragment, count(DISTINCT fragment_id) FILTER (flag & 1024 = 0) AS dup_collapsed, count(DISTINCT part % 19) AS genes FROM reads WHERE mapq >= 35 AND score > 40 GROUP BY sample_id), t AS (SELECT sample_id, " + ", ".join(f"CASE WHEN {c} = 0 THEN 'negative' WHEN {c} >= 100 AND genes >= 10 THEN 'extensive_island' WHEN {c} >= 30 AND genes >= 8 THEN 'broad_island' WHEN {c} >= 5 AND genes >= 3 THEN 'multi_gene' ELSE 'localized_indeterminate' END AS {c}" for c in ("raw", "dup_marked", "fragment", "dup_collapsed")) + " FROM v)"


def _variant_tiers(spark, d):
    reads = ad.reads(spark, d).where("mapq >= 35 AND score > 40").withColumn("duplicate", F.col("flag").bitwiseAND(1024) != 0)
    n = counting.four_countings(reads, ["sample_id"], "fragment_id", "duplicate")
    genes = reads.groupBy("sample_id").agg(F.countDistinct(F.col("part") % 19).alias("genes"))
    return n.join(genes, "sample_id").select("sample_id", *[rules.read_tier(F.col(c), F.col("genes"), F.lit(1.0)).alias(c) for c in ("raw", "dup_marked", "fragment", "dup_collapsed")])


@query("r4_robustness", f"{VARIANTS} SELECT *, CASE WHEN raw = dup_marked AND raw = fragment AND raw = dup_collapsed THEN 'stable' ELSE 'unstable' END AS robustness FROM t")
def r4(spark, d):
    others = [F.col(c) for c in ("dup_marked", "fragment", "dup_collapsed")]
    return _variant_tiers(spark, d).withColumn("robustness", rules.robustness(F.col("raw"), others))


@query("h5_variant_verdict", f"{VARIANTS}, n AS (SELECT sample_id, [x FOR x IN [" + ", ".join(f"CASE WHEN {c} <> raw THEN concat('{c}: ', raw, ' -> ', {c}) END" for c in ("dup_marked", "fragment", "dup_collapsed")) + "] IF x IS NOT NULL] AS notes FROM t) SELECT sample_id, CASE WHEN len(notes) = 0 THEN 'PASS' ELSE 'FLAG' END AS verdict, array_to_string(notes, '; ') AS notes FROM n")
def h5(spark, d):
    found = rules.divergence_notes(F.col("raw"), {c: F.col(c) for c in ("dup_marked", "fragment", "dup_collapsed")})
    return _variant_tiers(spark, d).select("sample_id", found.alias("x")).select("sample_id", "x.verdict", F.array_join("x.notes", "; ").alias("notes"))


# --- references: a contig is a reference of 12,000 bases; its group is its number modulo 3, that of 6 is not known

HITS = f"{POOLED}, h AS (SELECT pool, contig AS reference, CASE WHEN contig = 6 THEN 'NA' ELSE concat('B', contig % 3) END AS grp, start % 12000 AS start, least(start % 12000 + \"end\" - start, 12000) AS \"end\", \"end\" - start - nm AS matches, \"end\" - start AS block FROM pooled WHERE mapq >= 20)"
RANKED = f"""{HITS}, u AS (SELECT pool, reference, CAST(sum(greatest("end" - greatest(start, coalesce(prev, start)), 0)) AS BIGINT) AS union_bases FROM (SELECT *, max("end") OVER (PARTITION BY pool, reference ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM h) AS x GROUP BY ALL),
m AS (SELECT pool, reference, min(grp) AS grp, CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(block) AS BIGINT) AS block FROM h GROUP BY ALL),
k AS (SELECT m.pool, m.reference, grp, CAST(union_bases AS DOUBLE) / 12000 AS coverage, CAST(matches AS DOUBLE) / block AS identity, CAST(union_bases AS DOUBLE) / 12000 * (CAST(matches AS DOUBLE) / block) AS score FROM m JOIN u ON u.pool = m.pool AND u.reference = m.reference),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY pool ORDER BY score DESC, coverage DESC, identity DESC, reference) AS INTEGER) AS place FROM k)"""


def _ranked(spark, d):
    start, size = F.col("start") % 12_000, F.col("end") - F.col("start")
    group = F.when(F.col("contig") == 6, "NA").otherwise(F.concat(F.lit("B"), (F.col("contig") % 3).cast("string")))
    hits = pooled(spark, d).where("mapq >= 20").select("pool", F.col("contig").alias("reference"), group.alias("group"), start.alias("start"), F.least(start + size, F.lit(12_000)).alias("end"), (size - F.col("nm")).alias("matches"), size.alias("block"))
    return lanes.reference_ranking(hits, ["pool"], 12_000)


@query("w8_reference_ranking", f"WITH {RANKED} SELECT pool, reference, place, coverage, identity, score FROM r")
def w8(spark, d):
    return _ranked(spark, d).select("pool", "reference", "place", "coverage", "identity", "score")


@query("a30_reference_call", f"""WITH {RANKED}, b AS (SELECT pool, reference, grp, coverage, identity, score FROM r WHERE place = 1),
n AS (SELECT r.pool, list_sort(list(DISTINCT r.grp) FILTER (place <= 5 AND r.score >= b.score * 0.98 AND r.grp <> 'NA')) AS near, max(r.score) FILTER (place = 2) AS second, max(r.score) FILTER (r.grp <> b.grp) AS other, coalesce(string_agg(CAST(r.reference AS VARCHAR), ';' ORDER BY place) FILTER (place BETWEEN 2 AND 5), '') AS runner_ups FROM r JOIN b ON b.pool = r.pool GROUP BY r.pool),
c AS (SELECT b.*, runner_ups, CASE WHEN len(near) = 1 THEN near[1] WHEN len(near) > 1 THEN 'ambiguous' ELSE 'NA' END AS consensus, score - coalesce(second, 0) AS lead, score - coalesce(other, 0) AS cross_lead FROM b JOIN n ON n.pool = b.pool)
SELECT pool, reference, grp AS "group", coverage, identity, score, runner_ups, consensus, lead, CASE WHEN coverage < 0.5 OR identity < 0.9 THEN 'unresolved' WHEN consensus = grp AND cross_lead >= 0.02 THEN 'confident' ELSE 'ambiguous' END AS status FROM c""")
def a30(spark, d):
    return lanes.reference_call(_ranked(spark, d), ["pool"])


# --- bins: a bin is a sample's contig; its genes are part % 19 with two reads at least

GENE = "concat('clb', chr(CAST(65 + part % 19 AS INTEGER)))"
#: A bin is one sample's contig; the pool is the sample itself.
ALONE = f"{ad.READS}, pooled AS (SELECT *, sample_id AS pool FROM reads)"
BINS = f"""{ALONE}, bg AS (SELECT pool, contig AS bin, {GENE} AS gene FROM pooled WHERE mapq >= 30 GROUP BY ALL HAVING count(*) >= 2), bs AS (SELECT pool, bin, list_sort(list(gene)) AS genes FROM bg GROUP BY ALL),
be AS (SELECT pool, contig AS bin, count(*) AS n, count(*) FILTER (score = 50) AS prophages, bool_or(nm = 10) AS protected, bool_or(part % 5 = 0) AS rec_a, bool_or(part % 7 = 0) AS lex_a FROM pooled GROUP BY ALL),
b AS (SELECT be.*, coalesce(genes, []) AS genes, CASE WHEN n >= 92 THEN 'broad_island' WHEN n >= 84 THEN 'multi_gene' WHEN n > 0 THEN 'localized_indeterminate' ELSE 'negative' END AS tier FROM be LEFT JOIN bs ON bs.pool = be.pool AND bs.bin = be.bin)"""
POSITIVE = [name for name, *_ in rules.TIERS]


def _alone(spark, d):
    return ad.reads(spark, d).withColumn("pool", F.col("sample_id"))


def _bins(spark, d):
    few = _alone(spark, d)
    gene = F.concat(F.lit("clb"), F.chr(65 + F.col("part") % 19))
    genes = few.where("mapq >= 30").groupBy("pool", F.col("contig").alias("bin"), gene.alias("gene")).count().where("count >= 2").groupBy("pool", "bin").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    each = few.groupBy("pool", F.col("contig").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") == 50).alias("prophages"), F.bool_or(F.col("nm") == 10).alias("protected"), F.bool_or(F.col("part") % 5 == 0).alias("rec_a"), F.bool_or(F.col("part") % 7 == 0).alias("lex_a"))
    tier = rules.cascade([(F.col("n") >= 92, "broad_island"), (F.col("n") >= 84, "multi_gene"), (F.col("n") > 0, "localized_indeterminate")], "negative")
    return each.join(genes, ["pool", "bin"], "left").withColumns({"genes": F.coalesce("genes", F.array().cast("array<string>")), "tier": tier})


@query("r12_locus_class", f"WITH {BINS} SELECT pool, bin, len(genes) AS n_genes, CASE WHEN len(genes) = 0 THEN NULL WHEN genes = ['clbS'] THEN 'clbS_only_possible_resistance' WHEN len(genes) < 3 THEN 'isolated_or_low_evidence_clb_hits' WHEN tier NOT IN ('broad_island', 'multi_gene') THEN 'hmm_candidate_locus_not_confirmed' WHEN len(genes) < 15 THEN 'partial_pks_candidate' WHEN len(genes) < 19 THEN 'near_complete_pks_candidate' ELSE 'complete_pks_candidate' END AS class FROM b".replace("len(genes) AS n_genes", "CAST(len(genes) AS INTEGER) AS n_genes"))
def r12(spark, d):
    return _bins(spark, d).select("pool", "bin", F.size("genes").alias("n_genes"), rules.locus_class(F.col("genes"), F.col("tier"), POSITIVE).alias("class"))


@query("j15_interactions", f"WITH {BINS}, p AS (SELECT pool, bin AS producer FROM b WHERE len(genes) >= 3 AND list_has_any(genes, ['clbB', 'clbC', 'clbN']) AND tier IN ('broad_island', 'multi_gene')), q AS (SELECT * FROM b WHERE prophages > 0) SELECT p.pool, producer, bin AS recipient, prophages, protected, rec_a, lex_a, CASE WHEN protected THEN 'lower' WHEN rec_a AND lex_a THEN 'plausible' ELSE 'uncertain' END AS hypothesis FROM p JOIN q ON p.pool = q.pool")
def j15(spark, d):
    return lanes.interactions(_bins(spark, d), ["pool"], biosynthetic=["clbB", "clbC", "clbN"], positive=POSITIVE)


@query("r14_bins_outcome", f"WITH {BINS}, n AS (SELECT pool, CAST(sum(n) AS BIGINT) % 3 AS contigs, count(*) % 4 AS bins, count(*) FILTER (len(genes) >= 15) AS positive FROM b GROUP BY pool) SELECT pool, CASE WHEN contigs = 0 THEN 'no_contigs' WHEN bins = 0 THEN 'contigs_no_bins' WHEN positive = 0 THEN 'bins_no_pks' ELSE 'pks_positive_bins' END AS outcome FROM n")
def r14(spark, d):
    n = _bins(spark, d).groupBy("pool").agg((F.sum("n") % 3).alias("contigs"), (F.count(F.lit(1)) % 4).alias("bins"), F.count_if(F.size("genes") >= 15).alias("positive"))
    return n.select("pool", rules.bins_outcome(F.col("contigs"), F.col("bins"), F.col("positive")).alias("outcome"))


#: Names that reach every class of contigs, and products of annotated genes.
NAMES = ["chr1", "22", "X", "chrM", "MT", "chr6_GL000250v2_alt", "HLA-A*01:01", "hs37d5", "chrUn_KN707606v1_decoy", "chrEBV", "HPV16", "GL000191.1", "KI270728.1", "chrUn_GL000195v1", "chr1_KI270706v1_random", "chr0", "contig_7", "mitochondrial"]
PRODUCTS = ["phage integrase", "site-specific recombinase XerD", "IS3 family transposase", "tRNA-Leu", "resolvase", "IS element protein", "polyketide synthase", "hypothetical protein", "Phage Recombinase"]
LIST = lambda items: "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _named(spark, d, items, out):
    return ad.table(spark, d, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, items)), (F.col("p_partkey") % len(items) + 1).cast("int")).alias(out))


@query("p13_contig_category", f"WITH n AS (SELECT p_partkey, {LIST(NAMES)}[CAST(p_partkey % {len(NAMES)} AS INTEGER) + 1] AS name FROM part) SELECT p_partkey, name, CASE WHEN regexp_matches(name, '^(chr)?([1-9]|1[0-9]|2[0-2]|X|Y)$') THEN 'canonical' WHEN regexp_matches(name, '^(chr)?(M|MT)$') THEN 'mito' WHEN suffix(name, '_alt') THEN 'alt' WHEN suffix(name, '_decoy') OR name = 'hs37d5' OR prefix(name, 'HLA-') THEN 'decoy' WHEN regexp_matches(lower(name), '^(chr)?(ebv|nc_007605|hpv|hbv|hcv|hiv|kshv|htlv|cmv|hhv|mcpyv|sv40)') THEN 'viral' WHEN suffix(name, '_random') OR regexp_matches(name, '^(chr)?Un_|^(GL|KI|JH)[0-9]') THEN 'unplaced' ELSE 'other' END AS category FROM n")
def p13(spark, d):
    return _named(spark, d, NAMES, "name").withColumn("category", rules.contig_category(F.col("name")))


@query("p20_keywords", f"WITH n AS (SELECT p_partkey, lower({LIST(PRODUCTS)}[CAST(p_partkey % {len(PRODUCTS)} AS INTEGER) + 1]) AS product FROM part) SELECT p_partkey, regexp_matches(product, 'integrase|recombinase|resolvase') AS integrase, regexp_matches(product, 'transposase|insertion element|is element') AS transposase, regexp_matches(product, 'integrase|site-specific recombinase|phage recombinase') AS mobility FROM n")
def p20(spark, d):
    product = F.col("product")
    return _named(spark, d, PRODUCTS, "product").select("p_partkey", fn.has_word(fn.INTEGRASE, product).alias("integrase"), fn.has_word(fn.TRANSPOSASE, product).alias("transposase"), fn.has_word(fn.MOBILITY, product).alias("mobility"))


@query("a26_context", f"WITH n AS (SELECT p_size AS bin, lower({LIST(PRODUCTS)}[CAST(p_partkey % {len(PRODUCTS)} AS INTEGER) + 1]) AS product, concat(p_brand, '; ', CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END) AS flank FROM part), i AS (SELECT bin, product, trim(x) AS item FROM n, unnest(string_split(flank, ';')) AS t(x)) SELECT bin, bool_or(regexp_matches(product, 'integrase|recombinase|resolvase')) AS integrase, bool_or(regexp_matches(product, 'transposase|insertion element|is element')) AS transposase, string_agg(DISTINCT item, ';' ORDER BY item) FILTER (item <> '') AS flank FROM i GROUP BY bin")
def a26(spark, d):
    rows = _named(spark, d, PRODUCTS, "product").join(ad.table(spark, d, "part").select("p_partkey", F.col("p_size").alias("bin"), F.concat("p_brand", F.lit("; "), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type"))).alias("flank")), "p_partkey")
    flags = rows.withColumns({"integrase": fn.has_word(fn.INTEGRASE, F.col("product")), "transposase": fn.has_word(fn.TRANSPOSASE, F.col("product"))})
    return lanes.context_flags(flags, ["bin"], ["integrase", "transposase"], "flank")


@query("j4_bin_summary", f"WITH {BINS}, q AS (SELECT pool, bin, n FROM b WHERE bin <> 6), t AS (SELECT pool, bin, CASE WHEN bin % 2 = 0 THEN 'o__Enterobacterales' ELSE 'unclassified' END AS taxonomy FROM b WHERE bin <> 5), x AS (SELECT pool, bin, prophages FROM b WHERE prophages > 1) SELECT q.pool, q.bin, n, taxonomy, prophages FROM q JOIN t ON t.pool = q.pool AND t.bin = q.bin LEFT JOIN x ON x.pool = q.pool AND x.bin = q.bin")
def j4(spark, d):
    b = _bins(spark, d)
    taxonomy = b.where("bin <> 5").select("pool", "bin", F.when(F.col("bin") % 2 == 0, "o__Enterobacterales").otherwise("unclassified").alias("taxonomy"))
    return lanes.bin_table(b.where("bin <> 6").select("pool", "bin", "n"), taxonomy, b.where("prophages > 1").select("pool", "bin", "prophages"), on=["pool", "bin"])


@query("r13_bin_quality", f"WITH {BINS}, t AS (SELECT pool, bin, CASE bin % 4 WHEN 0 THEN 'd__Bacteria;o__Enterobacterales' WHEN 1 THEN 'd__Bacteria;o__Bacteroidales' WHEN 2 THEN 'unclassified' ELSE 'gtdbtk_failed' END AS taxonomy, CASE WHEN n % 5 = 0 THEN 'checkm2_failed' END AS qc FROM b) SELECT pool, bin, taxonomy NOT IN ('unclassified', '', 'NA', 'gtdbtk_failed') AND NOT contains(taxonomy, 'Enterobacterales') AS unexpected, CASE WHEN qc IS NULL AND taxonomy <> 'gtdbtk_failed' THEN 'ok' ELSE concat_ws(';', qc, CASE WHEN taxonomy = 'gtdbtk_failed' THEN taxonomy END) END AS status FROM t")
def r13(spark, d):
    kinds = F.array(*map(F.lit, ["d__Bacteria;o__Enterobacterales", "d__Bacteria;o__Bacteroidales", "unclassified", "gtdbtk_failed"]))
    t = _bins(spark, d).select("pool", "bin", F.element_at(kinds, (F.col("bin") % 4 + 1).cast("int")).alias("taxonomy"), F.when(F.col("n") % 5 == 0, "checkm2_failed").alias("qc"))
    failures = F.concat_ws(";", "qc", F.when(F.col("taxonomy") == "gtdbtk_failed", F.col("taxonomy")))
    return t.select("pool", "bin", rules.unexpected_taxon(F.col("taxonomy")).alias("unexpected"), F.when(failures == "", "ok").otherwise(failures).alias("status"))


@query("f6_provirus_floor", "WITH g AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Provirus' ELSE 'linear' END AS topology, CASE WHEN p_partkey % 11 = 0 THEN 'NA' ELSE CAST(p_size * 150 AS VARCHAR) END AS length, CAST(p_partkey % 5 AS VARCHAR) AS n_hallmarks, CASE WHEN p_partkey % 7 = 0 THEN 'NA' ELSE concat(p_size * 150, '-', p_partkey % 100) END AS coordinates FROM part) SELECT p_partkey, CAST(least(try_cast(regexp_extract(coordinates, '^(\\d+)-(\\d+)$', 1) AS BIGINT), try_cast(regexp_extract(coordinates, '^(\\d+)-(\\d+)$', 2) AS BIGINT)) AS BIGINT) AS start, CAST(greatest(try_cast(regexp_extract(coordinates, '^(\\d+)-(\\d+)$', 1) AS BIGINT), try_cast(regexp_extract(coordinates, '^(\\d+)-(\\d+)$', 2) AS BIGINT)) AS BIGINT) AS \"end\" FROM g WHERE lower(topology) = 'provirus' AND try_cast(length AS DOUBLE) >= 3000 AND try_cast(n_hallmarks AS DOUBLE) >= 2 AND regexp_matches(coordinates, '^\\d+-\\d+$')")
def f6(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size") * 150
    g = ad.table(spark, d, "part").select(
        k, F.when(k % 3 == 0, "Provirus").otherwise("linear").alias("topology"), F.when(k % 11 == 0, "NA").otherwise(size.cast("string")).alias("length"), (k % 5).cast("string").alias("n_hallmarks"), F.when(k % 7 == 0, "NA").otherwise(F.concat_ws("-", size.cast("string"), (k % 100).cast("string"))).alias("coordinates")
    )
    return lanes.provirus(g).select("p_partkey", "start", "end")


@query("f5_alignment_filter", f"WITH {HITS} SELECT pool, reference, count(*) AS hits FROM h WHERE \"end\" > 2000 AND start < 9000 AND CAST(matches AS DOUBLE) / block >= 0.95 GROUP BY ALL")
def f5(spark, d):
    start, size = F.col("start") % 12_000, F.col("end") - F.col("start")
    hits = pooled(spark, d).where("mapq >= 20").select("pool", F.col("contig").alias("reference"), start.alias("s"), F.least(start + size, F.lit(12_000)).alias("e"), (size - F.col("nm")).alias("matches"), size.alias("block"))
    kept = hits.where((intervals.overlap_bases(F.col("s"), F.col("e"), F.lit(2_000), F.lit(9_000)) > 0) & (fn.block_identity(F.col("matches"), F.col("block")) >= 0.95))
    return kept.groupBy("pool", "reference").agg(F.count(F.lit(1)).alias("hits"))


@query("f4_homology_filter", f"{R}, h AS (SELECT fragment_id, read_id, CAST(mapq AS DOUBLE) / 1e6 AS e, score AS aa, 100 + score AS qlen FROM reads) SELECT fragment_id, read_id FROM h WHERE e <= 1e-5 AND aa >= 25 AND least(1.0, aa * 3.0 / qlen) >= 0.5")
def f4(spark, d):
    h = ad.reads(spark, d).select("fragment_id", "read_id", (F.col("mapq").cast("double") / 1e6).alias("e"), F.col("score").alias("aa"), (100 + F.col("score")).alias("qlen"))
    return h.where((F.col("e") <= 1e-5) & (F.col("aa") >= 25) & (F.least(F.lit(1.0), F.col("aa") * 3.0 / F.col("qlen")) >= 0.5)).select("fragment_id", "read_id")


@query("j9_selected_reads", f"{R}, h AS (SELECT read_id FROM reads WHERE mapq <= 10 AND score >= 25 AND least(1.0, score * 3.0 / (100 + score)) >= 0.5) SELECT read_id, sample_id, flag FROM reads WHERE read_id IN (SELECT read_id FROM h)")
def j9(spark, d):
    return ad.reads(spark, d).join(f4(spark, d).select("read_id"), "read_id", "left_semi").select("read_id", "sample_id", "flag")


@query("f9_minimum_length", f"{R} SELECT contig, count(*) AS kept FROM reads WHERE \"end\" - start >= 130 GROUP BY contig")
def f9(spark, d):
    return ad.reads(spark, d).where(F.col("end") - F.col("start") >= 130).groupBy("contig").agg(F.count(F.lit(1)).alias("kept"))


@query("f7_tier_gate", f"{VARIANTS} SELECT sample_id, raw AS tier FROM t WHERE raw IN ('multi_gene', 'broad_island')")
def f7(spark, d):
    return _variant_tiers(spark, d).where(F.col("raw").isin("multi_gene", "broad_island")).select("sample_id", F.col("raw").alias("tier"))


@query("p14_header_gene", "WITH h AS (SELECT p_partkey, concat('id', p_partkey, '|x|', CASE WHEN p_partkey % 3 = 0 THEN concat('clb', chr(CAST(65 + p_partkey % 19 AS INTEGER))) ELSE 'clbAB' END, '|score=', p_size) AS header FROM part) SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN string_split(header, '|')[3] ELSE 'unknown' END AS gene FROM h")
def p14(spark, d):
    k = F.col("p_partkey")
    token = F.when(k % 3 == 0, F.concat(F.lit("clb"), F.chr(65 + k % 19))).otherwise("clbAB")
    header = F.concat(F.lit("id"), k.cast("string"), F.lit("|x|"), token, F.lit("|score="), F.col("p_size").cast("string"))
    return ad.table(spark, d, "part").select("p_partkey", fn.header_gene(header).alias("gene"))


@query("p12_identities", f"{R} SELECT sample_id, round(avg(CAST(\"end\" - start - nm AS DOUBLE) / (\"end\" - start)), 9) AS matched, round(avg(CAST(nm AS DOUBLE) / (\"end\" - start + 2)), 9) AS divergence, round(avg(CAST(score AS DOUBLE) / nullif(score + nm, 0)), 9) AS block FROM reads GROUP BY sample_id")
def p12(spark, d):
    size = F.col("end") - F.col("start")
    mean = lambda c, name: F.round(F.avg(c), 9).alias(name)
    return ad.reads(spark, d).groupBy("sample_id").agg(mean(fn.matched_identity(size, F.col("nm")), "matched"), mean(fn.column_divergence(F.col("nm"), size + 2), "divergence"), mean(fn.block_identity(F.col("score"), F.col("score") + F.col("nm")), "block"))


@query("p17_build_guess", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'GRCh38' WHEN 1 THEN 'GRCh37' WHEN 2 THEN 'T2T-CHM13' WHEN 3 THEN 'unknown' ELSE 'no_chr1' END AS build FROM part")
def p17(spark, d):
    length = F.element_at(F.array(*[F.lit(x).cast("long") for x in (248956422, 249250621, 248387328, 1000, None)]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return ad.table(spark, d, "part").select("p_partkey", fn.build_guess(length).alias("build"))


@query("p18_fingerprints", "WITH h AS (SELECT p_size AS file, p_partkey AS i, p_brand AS name, p_partkey % 1000 AS length, CASE WHEN p_size % 4 = 0 AND p_partkey % 3 = 0 THEN NULL ELSE md5(p_type) END AS m5 FROM part) SELECT file, md5(string_agg(concat(name, ':', length), chr(10) ORDER BY i)) AS sequences, CASE WHEN count(*) = count(m5) THEN md5(string_agg(DISTINCT m5, chr(10) ORDER BY m5)) END AS digests FROM h GROUP BY file")
def p18(spark, d):
    m5 = F.when(~((F.col("p_size") % 4 == 0) & (F.col("p_partkey") % 3 == 0)), F.md5("p_type"))
    h = ad.table(spark, d, "part").groupBy(F.col("p_size").alias("file")).agg(
        F.collect_list(F.struct(F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("name"), (F.col("p_partkey") % 1000).alias("length"))).alias("rows"), F.collect_list(F.coalesce(m5, F.lit(""))).alias("m5")
    )
    return h.select("file", fn.sequence_fingerprint(F.col("rows")).alias("sequences"), fn.digest_fingerprint(F.col("m5")).alias("digests"))


LINES = ["bwa mem -T 20 ref.fa", "/opt/bin/bwa-mem2 mem ref", "sentieon bwa mem -t 8", "bwa aln ref.fa", "", "minimap2 -ax sr"]
PROGRAMS = ["bwa", "bwa-mem2", "sentieon", "bwa", "bwa", "minimap2"]


@query("p19_low_score_state", f"WITH p AS (SELECT o_custkey AS file, CAST(o_orderkey % {len(LINES)} AS INTEGER) AS k FROM orders), e AS (SELECT file, CASE WHEN bool_or(k IN (0, 1, 2)) THEN 'yes' WHEN bool_or(k = 4) THEN 'no_cl' WHEN bool_or(k = 3) THEN 'not_mem' ELSE 'no' END AS evidence FROM p GROUP BY file) SELECT file, evidence, CASE WHEN evidence = 'no_cl' THEN 'on_requested' WHEN file % 5 = 0 THEN 'off_requested' WHEN evidence = 'yes' THEN 'on_auto_bwa_mem' WHEN evidence = 'not_mem' THEN 'off_auto_no_as_tag' ELSE 'off_auto_not_bwa_mem' END AS state FROM e")
def p19(spark, d):
    at = (F.col("o_orderkey") % len(LINES) + 1).cast("int")
    pick = lambda items: F.element_at(F.array(*map(F.lit, items)), at)
    p = ad.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("file")).agg(F.collect_set(F.struct(pick(PROGRAMS).alias("pn"), pick(LINES).alias("cl"))).alias("programs"))
    e = p.select("file", fn.bwa_evidence(F.col("programs")).alias("evidence"))
    request = F.when(F.col("evidence") == "no_cl", "on").when(F.col("file") % 5 == 0, "off").otherwise("auto")
    return e.withColumn("state", rules.low_score_state(request, F.col("evidence")))


@query("p21_evidence_label", "WITH m AS (SELECT o_orderkey, ['wgs', 'metagenome', 'wes', 'rna', 'other'][CAST(o_orderkey % 5 AS INTEGER) + 1] AS mode, CASE WHEN o_orderkey % 2 = 0 THEN 'untiered' ELSE 'multi_gene' END AS tier FROM orders) SELECT mode, tier, count(*) AS samples, any_value(CASE mode WHEN 'wgs' THEN CASE WHEN tier = 'untiered' THEN 'WGS evidence (not tiered: long-read)' ELSE 'WGS genomic evidence tier' END WHEN 'metagenome' THEN 'Metagenome read evidence (not tiered)' WHEN 'wes' THEN 'WES off-target DNA evidence (not tiered)' WHEN 'rna' THEN 'RNA expression evidence (not tiered)' ELSE 'NA' END) AS label FROM m GROUP BY ALL")
def p21(spark, d):
    mode = F.element_at(F.array(*map(F.lit, ["wgs", "metagenome", "wes", "rna", "other"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    m = ad.table(spark, d, "orders").select(mode.alias("mode"), F.when(F.col("o_orderkey") % 2 == 0, "untiered").otherwise("multi_gene").alias("tier"))
    return m.groupBy("mode", "tier").agg(F.count(F.lit(1)).alias("samples"), F.min(rules.evidence_label(F.col("mode"), F.col("tier"))).alias("label"))


@query("p25_sample_of_file", "SELECT p_partkey, concat(p_brand, '.txt') AS sample FROM part")
def p25(spark, d):
    path = F.concat(F.lit("/data/run/"), F.col("p_brand"), F.lit(".txt.counts.txt"))
    return ad.table(spark, d, "part").select("p_partkey", fn.sample_of_file(path, ".counts.txt").alias("sample"))


@query("p10_segments", f"{R} SELECT sample_id, CAST(CASE mate WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS INTEGER) AS segment, count(*) AS reads FROM reads GROUP BY ALL")
def p10(spark, d):
    flag = F.when(F.col("mate") == 1, 64).when(F.col("mate") == 2, 128).otherwise(F.when(F.col("nm") > 4, 192).otherwise(0))
    return ad.reads(spark, d).groupBy("sample_id", fn.segment_of(flag).alias("segment")).agg(F.count(F.lit(1)).alias("reads"))


@query("p16_allele_states", "WITH a AS (SELECT p_partkey, [concat('adk(', p_size, ')'), 'gyrB(~3)', 'icd(7?)', 'mdh(-)', concat('recA(', p_partkey % 4, ')')][CAST(p_partkey % 5 AS INTEGER) + 1] AS field FROM part) SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 'inexact' WHEN 2 THEN 'inexact' WHEN 3 THEN 'missing' ELSE 'exact' END AS state FROM a")
def p16(spark, d):
    k = F.col("p_partkey")
    fields = F.array(F.format_string("adk(%d)", "p_size"), F.lit("gyrB(~3)"), F.lit("icd(7?)"), F.lit("mdh(-)"), F.format_string("recA(%d)", k % 4))
    return ad.table(spark, d, "part").select("p_partkey", rules.allele_state(fn.allele_of(F.element_at(fields, (k % 5 + 1).cast("int")))).alias("state"))


# --- quality and reports

CHAIN = ["reads", "mapped", "passed", "island", "genes"]
CHAINS = f"{R}, q AS (SELECT sample_id, count(*) AS reads, count(*) FILTER (flag & 4 = 0) AS mapped, CASE WHEN sample_id % 3 <> 0 THEN count(*) FILTER (flag & 4 = 0 AND mapq >= 20) END AS passed, count(*) FILTER (flag & 4 = 0 AND mapq >= 20 AND start < 25000) + CASE WHEN sample_id % 7 = 0 THEN 1000 ELSE 0 END AS island, CASE WHEN sample_id % 5 <> 0 THEN count(DISTINCT part % 19) END AS genes FROM reads GROUP BY sample_id)"


def _chain(spark, d):
    s, ok = F.col("sample_id"), (F.col("flag").bitwiseAND(4) == 0) & (F.col("mapq") >= 20)
    return ad.reads(spark, d).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(F.col("flag").bitwiseAND(4) == 0).alias("mapped"), F.count_if(ok).alias("passed"), F.count_if(ok & (F.col("start") < 25_000)).alias("island"), F.countDistinct(F.col("part") % 19).alias("genes"),
    ).withColumns({"passed": F.when(s % 3 != 0, F.col("passed")), "island": F.col("island") + F.when(s % 7 == 0, 1000).otherwise(0), "genes": F.when(s % 5 != 0, F.col("genes"))})


@query("h4_stage_rates", f"{CHAINS}, e AS (SELECT sample_id, unnest(['mapped', 'passed', 'island', 'genes']) AS stage, unnest([reads, mapped, passed, island]) AS a, unnest([mapped, passed, island, genes]) AS b FROM q) SELECT sample_id, stage, CAST(a - b AS DOUBLE) / a AS removed FROM e WHERE a > 0 AND b <= a")
def h4(spark, d):
    return lanes.stage_rates(_chain(spark, d), ["sample_id"], CHAIN)


@query("v4_part_sums", f"{CHAINS} SELECT sample_id, reads, mapped, passed FROM q WHERE mapped + passed <> reads")
def v4(spark, d):
    return checks.not_sum(_chain(spark, d), ["mapped", "passed"], "reads").select("sample_id", "reads", "mapped", "passed")


@query("v5_bounded_pairs", f"{CHAINS}, e AS (SELECT sample_id, 'island>passed' AS broken FROM q WHERE island > passed UNION ALL SELECT sample_id, 'genes>mapped' FROM q WHERE genes > mapped UNION ALL SELECT sample_id, 'island>mapped' FROM q WHERE island > mapped) SELECT * FROM e")
def v5(spark, d):
    return checks.parts_over_total(_chain(spark, d), [("island", "passed"), ("genes", "mapped"), ("island", "mapped")]).select("sample_id", "broken")


@query("v5_ordered_values", f"{CHAINS} SELECT sample_id FROM q WHERE list_sort([x FOR x IN [island, passed, reads] IF x IS NOT NULL]) <> [x FOR x IN [island, passed, reads] IF x IS NOT NULL]")
def v5b(spark, d):
    return checks.not_ordered(_chain(spark, d), ["island", "passed", "reads"]).select("sample_id")


@query("v8_conservation", f"{R}, a AS (SELECT sample_id, count(*) AS before FROM reads GROUP BY 1), b AS (SELECT sample_id, count(*) AS after FROM reads WHERE NOT (sample_id % 4 = 0 AND mapq = 0) GROUP BY 1) SELECT sample_id, coalesce(before, 0) AS before, coalesce(after, 0) AS after FROM a FULL JOIN b USING (sample_id) WHERE coalesce(before, 0) <> coalesce(after, 0)")
def v8(spark, d):
    reads = ad.reads(spark, d)
    return checks.not_conserved(reads, reads.where(~((F.col("sample_id") % 4 == 0) & (F.col("mapq") == 0))), ["sample_id"])


@query("v10_duplicate_names", f"{R}, n AS (SELECT sample_id, concat(fragment_id, '/', mate) AS name, count(*) AS n FROM reads GROUP BY ALL), s AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS repeats FROM n GROUP BY 1) SELECT * FROM s WHERE repeats > 0.001 * rows")
def v10(spark, d):
    named = ad.reads(spark, d).withColumn("name", F.concat_ws("/", F.col("fragment_id").cast("string"), F.col("mate").cast("string")))
    return checks.too_many_duplicates(named, ["sample_id"], "name")


STAGES = {"read_qc": ["reads", "mapped"], "host_depletion": ["passed"], "profiling": ["island", "genes"]}


@query("r17_terminal_state", f"{CHAINS} SELECT sample_id, CASE WHEN sample_id % 13 = 0 THEN 'excluded_low_input' WHEN passed IS NULL THEN 'failed_at_host_depletion' WHEN genes IS NULL THEN 'failed_at_profiling' WHEN genes >= 10 THEN 'completed_positive' WHEN genes >= 5 THEN 'completed_negative' ELSE 'completed_untiered' END AS state FROM q")
def r17(spark, d):
    q = _chain(spark, d).withColumns({"excluded": F.when(F.col("sample_id") % 13 == 0, "low_input"), "outcome": rules.cascade([(F.col("genes") >= 10, "positive"), (F.col("genes") >= 5, "negative")], "untiered")})
    return q.select("sample_id", lanes.terminal_state(q, STAGES, "excluded", "outcome").alias("state"))


@query("h6_inferred_stages", "SELECT CAST(x.i AS INTEGER) AS place, x.s AS stage FROM (VALUES (0, 'read_qc', 'none'), (1, 'host_depletion', 'click'), (2, 'profiling', 'purchase'), (3, 'taxonomy', 'absent')) AS x(i, s, m) WHERE x.s = 'read_qc' OR x.m IN (SELECT event_type FROM events)")
def h6(spark, d):
    return lanes.inferred_stages(ad.events(spark, d), {"read_qc": ["none"], "host_depletion": ["click"], "profiling": ["purchase"], "taxonomy": ["absent"]}, ["read_qc"])


@query("a34_extraction_mix", "WITH m AS (SELECT trim(['on_auto_bwa_mem', 'off_requested', ' NA ', 'on_requested ', ''][CAST(o_custkey % 5 AS INTEGER) + 1]) AS mode FROM orders), c AS (SELECT mode, count(*) AS samples FROM m WHERE mode NOT IN ('', 'NA') GROUP BY 1) SELECT mode, samples, (SELECT bool_or(prefix(mode, 'on')) AND bool_or(prefix(mode, 'off')) FROM c) AS mixed FROM c")
def a34(spark, d):
    modes = F.array(*map(F.lit, ["on_auto_bwa_mem", "off_requested", " NA ", "on_requested ", ""]))
    return lanes.extraction_mix(ad.table(spark, d, "orders").select(F.element_at(modes, (F.col("o_custkey") % 5 + 1).cast("int")).alias("mode")), "mode")


@query("a35_task_rollup", "WITH t AS (SELECT o_orderpriority AS process, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL) SELECT process, CAST(sum(n) AS BIGINT) AS tasks, string_agg(concat(status, '=', n), ';' ORDER BY status) AS statuses FROM t GROUP BY process")
def a35(spark, d):
    trace = ad.table(spark, d, "orders").select(F.concat("o_orderpriority", F.lit(" ("), F.col("o_custkey").cast("string"), F.lit(")")).alias("name"), F.col("o_orderstatus").alias("status"))
    shown = F.array_join(F.transform(F.map_entries("statuses"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return lanes.task_rollup(trace).select("process", "tasks", shown.alias("statuses"))


LETTERS = [f"clb{chr(65 + i)}" for i in range(19)]


@query("a13_species_genes", f"{R}, c AS (SELECT contig AS species, part % 19 AS g FROM reads) SELECT species, " + ", ".join(f"count(*) FILTER (g = {i}) AS {g}" for i, g in enumerate(LETTERS)) + ', count(*) AS "Total" FROM c GROUP BY species')
def a13(spark, d):
    counts = ad.reads(spark, d).groupBy(F.col("contig").alias("species"), F.concat(F.lit("clb"), F.chr(65 + F.col("part") % 19)).alias("gene")).agg(F.count(F.lit(1)).alias("n"))
    return lanes.species_matrix(counts, [], "species", "gene", LETTERS, "n")


MATRIX = ", ".join(f"count(*) FILTER (g = {i}) AS {g}" for i, g in enumerate(LETTERS))


def _support(spark, d):
    gene = F.concat(F.lit("clb"), F.chr(65 + F.col("part") % 19))
    counts = ad.reads(spark, d).groupBy("sample_id", F.col("contig").alias("species"), gene.alias("gene")).agg(F.count(F.lit(1)).alias("n"))
    return lanes.species_matrix(counts, ["sample_id"], "species", "gene", LETTERS, "n")


@query("a14_combined_support", f'{R}, c AS (SELECT sample_id, contig AS species, part % 19 AS g FROM reads) SELECT sample_id, species, {MATRIX}, count(*) AS "Total" FROM c GROUP BY sample_id, species')
def a14(spark, d):
    reads = ad.reads(spark, d).groupBy("sample_id", F.col("contig").alias("species")).agg(F.count(F.lit(1)).alias("_reads"))
    united = _support(spark, d).join(reads, ["sample_id", "species"])  # refused if a species' genes do not add up to its reads
    return checks.passed(united, {"genes do not sum to Total": F.col("Total") != F.col("_reads")}, "support").drop("_reads")


@query("v7_gene_totals", f'{R}, c AS (SELECT sample_id, contig AS species, part % 19 AS g FROM reads), m AS (SELECT sample_id, species, {MATRIX}, count(*) + CASE WHEN sample_id % 13 = species THEN 1 ELSE 0 END AS "Total" FROM c GROUP BY sample_id, species) SELECT sample_id, species, "Total" FROM m WHERE {" + ".join(LETTERS)} <> "Total"')
def v7_genes(spark, d):
    claimed = F.col("Total") + F.when(F.col("sample_id") % 13 == F.col("species"), 1).otherwise(0)
    return checks.not_sum(_support(spark, d).withColumn("Total", claimed), LETTERS, "Total").select("sample_id", "species", "Total")


@query("v7_row_totals", f"{R}, c AS (SELECT contig AS species, count(*) AS n, count(*) FILTER (part % 19 < 3) AS few FROM reads GROUP BY 1) SELECT species, n AS total FROM c WHERE few + CASE WHEN species % 2 = 0 THEN n - few ELSE 0 END <> n")
def v7(spark, d):
    c = ad.reads(spark, d).groupBy(F.col("contig").alias("species")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("part") % 19 < 3).alias("few"))
    c = c.withColumn("rest", F.when(F.col("species") % 2 == 0, F.col("total") - F.col("few")).otherwise(0))
    return checks.not_sum(c, ["few", "rest"], "total").select("species", "total")


@query("r3_rates", f"{CHAINS} SELECT sample_id, coalesce(passed, mapped) AS host_depleted_reads, CASE WHEN passed IS NOT NULL THEN 'pangenome' ELSE 't2t_phix' END AS host_depleted_stage, CASE WHEN coalesce(passed, mapped) > 0 THEN island * 1e6::DOUBLE / coalesce(passed, mapped) END AS reads_per_million FROM q")
def r3(spark, d):
    return lanes.rates(_chain(spark, d), "island", "passed", "mapped").select("sample_id", "host_depleted_reads", "host_depleted_stage", "reads_per_million")


@query("r16_taxonomy_status", f"{CHAINS} SELECT sample_id, CASE WHEN island = 0 THEN 'no_pks_reads' WHEN sample_id % 4 = 0 THEN 'species_identified' WHEN coalesce(genes, 0) < 2 THEN 'below_rank_threshold' ELSE 'no_species_identified' END AS status FROM q")
def r16(spark, d):
    species = F.when(F.col("sample_id") % 4 == 0, 2).otherwise(0)
    return _chain(spark, d).select("sample_id", rules.taxonomy_status(species, F.coalesce("genes", F.lit(0)), F.col("island")).alias("status"))


@query("j3_rescued_names", f"{R}, names AS (SELECT DISTINCT fragment_id FROM reads WHERE score > 45), m AS (SELECT read_id, CASE WHEN mapq < 10 THEN 'low' ELSE 'ok' END AS kind, fragment_id FROM reads) SELECT read_id, kind FROM m JOIN names USING (fragment_id)")
def j3(spark, d):
    reads = ad.reads(spark, d)
    names = reads.where("score > 45").select("fragment_id").distinct().withColumn("named", F.lit(True))
    met = reads.select("read_id", F.when(F.col("mapq") < 10, "low").otherwise("ok").alias("kind"), "fragment_id").join(names, "fragment_id", "left")
    return met.where("named").select("read_id", "kind")


@query("j16_gene_positions", "WITH f AS (SELECT p_partkey AS tag, p_brand AS contig, p_size AS pos FROM part WHERE p_partkey % 3 > 0) SELECT o_orderkey, coalesce(contig, '') AS contig, CAST(coalesce(pos, 0) AS INTEGER) AS pos FROM orders LEFT JOIN f ON f.tag = o_orderkey % 1000")
def j16(spark, d):
    f = ad.table(spark, d, "part").where("p_partkey % 3 > 0").select(F.col("p_partkey").alias("tag"), F.col("p_brand").alias("contig"), F.col("p_size").alias("pos"))
    o = ad.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000).alias("tag"))
    return o.join(f, "tag", "left").select("o_orderkey", F.coalesce("contig", F.lit("")).alias("contig"), F.coalesce("pos", F.lit(0)).alias("pos"))


@query("j24_audit_selection", f"{VARIANTS}, s AS (SELECT sample_id, CASE WHEN raw IN ('multi_gene', 'broad_island', 'extensive_island') THEN 'positive' WHEN raw = 'localized_indeterminate' THEN 'near_miss' END AS reason FROM t) SELECT s.sample_id, reason, s_name AS path, s_name IS NULL AS missing FROM s LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 20) AS x ON s_suppkey = sample_id WHERE reason IS NOT NULL")
def j24(spark, d):
    chosen = _variant_tiers(spark, d).select("sample_id", rules.audit_reason(F.col("raw")).alias("reason")).where("reason is not null")
    sheet = ad.table(spark, d, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("sample_id"), F.col("s_name").alias("path"))
    return chosen.join(sheet, "sample_id", "left").withColumn("missing", F.col("path").isNull())


@query("j22_cohort_report", f"{CHAINS}, a AS (SELECT sample_id, reads, mapped FROM q WHERE sample_id % 3 > 0), b AS (SELECT s_suppkey AS sample_id, s_nationkey AS site FROM supplier WHERE s_nationkey < 15), c AS (SELECT sample_id, genes FROM q WHERE genes >= 10) SELECT s_suppkey AS sample_id, reads, mapped, site, genes, concat_ws(';', CASE WHEN a.sample_id IS NULL THEN 'quality' END, CASE WHEN b.sample_id IS NULL THEN 'sheet' END, CASE WHEN c.sample_id IS NULL THEN 'evidence' END) AS missing FROM supplier LEFT JOIN a ON a.sample_id = s_suppkey LEFT JOIN b ON b.sample_id = s_suppkey LEFT JOIN c ON c.sample_id = s_suppkey")
def j22(spark, d):
    q, s = _chain(spark, d), ad.table(spark, d, "supplier")
    sources = {"quality": q.where("sample_id % 3 > 0").select("sample_id", "reads", "mapped"), "sheet": s.where("s_nationkey < 15").select(F.col("s_suppkey").alias("sample_id"), F.col("s_nationkey").alias("site")), "evidence": q.where("genes >= 10").select("sample_id", "genes")}
    return lanes.report(s.select(F.col("s_suppkey").alias("sample_id")), sources, "sample_id")


@query("h7_annotation_flags", "WITH f AS (SELECT p_size AS genome, CASE WHEN p_partkey % 2 = 0 THEN 'CDS' ELSE 'gene' END AS type, ['recA', 'LEXA', 'recAB', 'clbA', NULL][CAST(p_partkey % 5 AS INTEGER) + 1] AS gene FROM part) SELECT genome, bool_or(coalesce(type = 'CDS' AND lower(gene) = 'reca', FALSE)) AS rec_a, bool_or(coalesce(type = 'CDS' AND lower(gene) = 'lexa', FALSE)) AS lex_a FROM f GROUP BY genome")
def h7(spark, d):
    gene = F.element_at(F.array(*[F.lit(x).cast("string") for x in ("recA", "LEXA", "recAB", "clbA", None)]), (F.col("p_partkey") % 5 + 1).cast("int"))
    f = ad.table(spark, d, "part").select(F.col("p_size").alias("genome"), F.when(F.col("p_partkey") % 2 == 0, "CDS").otherwise("gene").alias("type"), F.create_map(F.lit("gene"), gene).alias("attributes"))
    return lanes.annotation_flags(f, ["genome"], {"rec_a": "reca", "lex_a": "lexa"})


@query("h9_typed_unit", "WITH u AS (SELECT p_size AS sample, p_partkey AS ordinal, CASE WHEN p_partkey % 4 = 0 THEN 'typed' ELSE 'insufficient_loci' END AS status, p_brand AS st FROM part) SELECT sample, status, st FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY status <> 'typed', ordinal) AS r FROM u) AS x WHERE r = 1")
def h9(spark, d):
    u = ad.table(spark, d, "part").select(F.col("p_size").alias("sample"), F.col("p_partkey").alias("ordinal"), F.when(F.col("p_partkey") % 4 == 0, "typed").otherwise("insufficient_loci").alias("status"), F.col("p_brand").alias("st"))
    return lanes.typed_unit(u, ["sample"], "ordinal").select("sample", "unit.status", "unit.st")


@query("h10_second_pass", f"{R} SELECT fragment_id, read_id FROM reads WHERE fragment_id IN (SELECT fragment_id FROM reads WHERE flag & 4 > 0 AND score > 48)")
def h10(spark, d):
    return lanes.second_pass(ad.reads(spark, d), (F.col("flag").bitwiseAND(4) > 0) & (F.col("score") > 48), "fragment_id").select("fragment_id", "read_id")


@query("h11_panel_admission", f"WITH {ad.READS}, {ad.UNIONS}, c AS (SELECT sample_id, CAST(union_bases AS DOUBLE) / {ad.ISLAND} AS coverage, CASE WHEN sample_id % 2 = 0 THEN 'decoy' ELSE 'carrier' END AS role FROM (SELECT sample_id, CASE WHEN sample_id % 4 = 0 THEN union_bases // 12 ELSE union_bases END AS union_bases FROM unions) AS x) SELECT sample_id, coverage, role, CASE WHEN role = 'decoy' AND coverage < 0.1 THEN 'admitted_decoy' WHEN role = 'carrier' AND coverage >= 0.5 THEN 'admitted_carrier' ELSE 'rejected' END AS status FROM c")
def h11(spark, d):
    u = intervals.union_length(ad.reads(spark, d), ["sample_id"])
    held = F.when(F.col("sample_id") % 4 == 0, F.floor(F.col("union_bases") / 12)).otherwise(F.col("union_bases"))
    c = u.select("sample_id", (held.cast("double") / ad.ISLAND).alias("coverage"), F.when(F.col("sample_id") % 2 == 0, "decoy").otherwise("carrier").alias("role"))
    return c.withColumn("status", rules.panel_admission(F.col("coverage"), F.col("role")))


CLUSTERS = """clusters AS (SELECT p_partkey, concat('LOCUS ', p_brand, ' ', p_type, CASE p_partkey % 8 WHEN 0 THEN ' NRPS' WHEN 1 THEN ' a polyketide synthase' WHEN 2 THEN ' T1PKS clbB' WHEN 3 THEN ' transAT' WHEN 4 THEN ' Colibactin, nonribosomal' WHEN 5 THEN ' clbZ PKS' WHEN 6 THEN ' NRPSlike' ELSE ' terpene' END) AS text, p_size * 220 AS length FROM part)"""


@query("h11_cluster_status", f"WITH {CLUSTERS} SELECT p_partkey, CASE WHEN regexp_matches(text, '(?i)colibactin|\\bclb[A-S]\\b') THEN 'own_cluster' WHEN NOT regexp_matches(text, '(?i)\\bNRPS\\b|nonribosomal|polyketide|\\bPKS\\b|\\bT1PKS\\b|transAT') THEN 'other_class' WHEN length < 5000 THEN 'too_short' ELSE 'kept' END AS status FROM clusters")
def h11_clusters(spark, d):
    ends = F.array(*[F.lit(x) for x in (" NRPS", " a polyketide synthase", " T1PKS clbB", " transAT", " Colibactin, nonribosomal", " clbZ PKS", " NRPSlike", " terpene")])
    text = F.concat(F.lit("LOCUS "), "p_brand", F.lit(" "), "p_type", F.get(ends, (F.col("p_partkey") % 8).cast("int")))
    return ad.table(spark, d, "part").select("p_partkey", records.cluster_status(text, F.col("p_size") * 220).alias("status"))


@query("j24_audit_draw", "WITH n AS (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL), t AS (SELECT *, CASE WHEN n = 0 THEN 'negative' WHEN n >= 20 THEN 'multi_gene' WHEN n >= 5 THEN 'localized_indeterminate' ELSE 'untiered' END AS tier FROM n), d AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(concat(c_custkey, '42')), c_custkey) AS r FROM t WHERE tier = 'negative') SELECT c_custkey, CASE WHEN tier = 'multi_gene' THEN 'positive' ELSE 'near_miss' END AS reason FROM t WHERE tier IN ('multi_gene', 'localized_indeterminate') UNION ALL SELECT c_custkey, 'clean_negative' FROM d WHERE r <= 3")
def j24_draw(spark, d):
    orders = ad.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    t = ad.table(spark, d, "customer").select("c_custkey", "c_nationkey").join(orders, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    t = t.withColumn("tier", rules.cascade([(F.col("n") == 0, "negative"), (F.col("n") >= 20, "multi_gene"), (F.col("n") >= 5, "localized_indeterminate")], "untiered"))
    return lanes.audited(t, "tier", ["c_nationkey"], "c_custkey", 3, "42").select("c_custkey", "reason")


@query("h13_prophage_regions", f"WITH {BINS}, i AS (SELECT pool, contig AS bin, count(*) AS regions FROM pooled WHERE score = 50 GROUP BY ALL) SELECT b.pool, b.bin, CASE WHEN b.bin = 6 THEN 'unbinned' ELSE 'bin' END AS unit, CASE WHEN n % 4 > 0 THEN CAST(n % 100 AS DOUBLE) END AS completeness, coalesce(regions, 0) AS regions FROM b LEFT JOIN i ON i.pool = b.pool AND i.bin = b.bin")
def h13(spark, d):
    b = _bins(spark, d)
    regions = _alone(spark, d).where("score = 50").groupBy("pool", F.col("contig").alias("bin")).agg(F.count(F.lit(1)).alias("regions"))
    met = b.join(regions, ["pool", "bin"], "left")
    return met.select("pool", "bin", F.when(F.col("bin") == 6, "unbinned").otherwise("bin").alias("unit"), F.when(F.col("n") % 4 > 0, (F.col("n") % 100).cast("double")).alias("completeness"), F.coalesce("regions", F.lit(0).cast("long")).alias("regions"))


@query("h15_length_guard", "SELECT p_partkey AS name, p_size AS length FROM part WHERE p_size <> p_partkey % 50 + 1")
def h15(spark, d):
    p = ad.table(spark, d, "part")
    here, there = p.select(F.col("p_partkey").alias("name"), F.col("p_size").alias("length")), p.select(F.col("p_partkey").alias("name"), (F.col("p_partkey") % 50 + 1).cast("int").alias("length"))
    return checks.disagreeing(here, there, ["name"], "length").select("name", F.col("one").alias("length"))


@query("h16_header_fields", "SELECT p_partkey, p_brand AS phylogroup, CAST(p_size AS VARCHAR) AS st FROM part")
def h16(spark, d):
    header = F.concat(F.lit(">ref path/x.fa|phylogroup="), F.col("p_brand"), F.lit("|note|ST="), F.col("p_size").cast("string"))
    return ad.table(spark, d, "part").select("p_partkey", fn.header_fields(header)["phylogroup"].alias("phylogroup"), fn.header_fields(header)["ST"].alias("st"))


@query("h18_staged_order", "SELECT o_orderpriority AS kind, o_custkey AS sample, o_orderkey AS name, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey, o_orderkey) AS INTEGER) AS place FROM orders")
def h18(spark, d):
    return lanes.staged_order(ad.table(spark, d, "orders").select(F.col("o_orderpriority").alias("kind"), F.col("o_custkey").alias("sample"), F.col("o_orderkey").alias("name")))


@query("a10_marked_duplicates", f"{R} SELECT read_id, row_number() OVER (PARTITION BY sample_id, contig, start, flag & 16 ORDER BY score DESC, fragment_id, ordinal) > 1 AS duplicate FROM reads")
def a10(spark, d):
    key = ad.reads(spark, d).withColumn("strand", F.col("flag").bitwiseAND(16))
    return lanes.marked_duplicates(key, ["sample_id", "contig", "start", "strand"], [F.desc("score"), F.col("fragment_id"), F.col("ordinal")]).select("read_id", "duplicate")


@query("a17_gene_medians", f"WITH {ad.OVERLAPS}, m AS (SELECT gene, median(bases) AS median FROM assigned WHERE gene < 'g15' GROUP BY 1) SELECT g.gene, median FROM genes AS g LEFT JOIN m USING (gene)")
def a17(spark, d):
    m = _assigned(spark, d).where("gene < 'g15'").groupBy("gene").agg(F.percentile("bases", F.lit(0.5)).alias("median"))
    return ad.genes(spark).select("gene").join(m, "gene", "left")


@query("a18_summary_numbers", f"{R}, p AS (SELECT sample_id, score, row_number() OVER (PARTITION BY sample_id ORDER BY score) - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS n FROM reads), q AS (SELECT sample_id, score AS quantile FROM p WHERE i = floor(0.9 * (n - 1))) SELECT sample_id, min(score) AS low, avg(score) AS mean, median(score) AS median, max(score) AS high, any_value(quantile) AS quantile FROM reads JOIN q USING (sample_id) GROUP BY sample_id")
def a18(spark, d):
    return counting.summary_numbers(ad.reads(spark, d), ["sample_id"], "score", 0.9)


@query("a31_gene_floors", f"{R}, n AS (SELECT sample_id, part % 19 AS gene, count(*) AS n FROM reads WHERE mapq >= 35 GROUP BY ALL), s AS (SELECT sample_id, count(*) FILTER (n >= 1) AS f1, count(*) FILTER (n >= 2) AS f2, count(*) FILTER (n >= 3) AS f3 FROM n GROUP BY 1) SELECT CAST(1 AS INTEGER) AS floor, count(*) FILTER (f1 >= 19) AS positive, count(*) FILTER (f1 < 19) AS negative FROM s UNION ALL SELECT 2, count(*) FILTER (f2 >= 19), count(*) FILTER (f2 < 19) FROM s UNION ALL SELECT 3, count(*) FILTER (f3 >= 19), count(*) FILTER (f3 < 19) FROM s")
def a31b(spark, d):
    n = ad.reads(spark, d).where("mapq >= 35").groupBy("sample_id", (F.col("part") % 19).alias("gene")).agg(F.count(F.lit(1)).alias("n"))
    s = n.groupBy("sample_id").agg(*[F.count_if(F.col("n") >= f).alias(f"f{f}") for f in (1, 2, 3)])
    return lanes.sensitivity(s, [1, 2, 3], lambda f: F.col(f"f{f}") >= 19)


@query("set_union_fragments", f"{R} SELECT 'align' AS source, sample_id, count(*) AS n FROM reads WHERE mapq >= 20 GROUP BY 2 UNION ALL SELECT 'deplete', sample_id, count(*) FROM reads WHERE mapq < 20 GROUP BY 2")
def set_fragments(spark, d):
    reads = ad.reads(spark, d)
    one = lambda name, cond: reads.where(cond).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "sample_id", "n")
    return one("align", "mapq >= 20").unionByName(one("deplete", "mapq < 20"))


@query("set_union_reads", f"{R}, p AS (SELECT read_id, 'primary' AS kind FROM reads WHERE flag & 2304 = 0 UNION ALL SELECT read_id, 'rescued' FROM reads WHERE flag & 4 > 0) SELECT kind, count(*) AS reads FROM p GROUP BY kind")
def set_reads(spark, d):
    reads = ad.reads(spark, d)
    both = reads.where(F.col("flag").bitwiseAND(2304) == 0).select("read_id", F.lit("primary").alias("kind")).union(reads.where(F.col("flag").bitwiseAND(4) > 0).select("read_id", F.lit("rescued").alias("kind")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("reads"))


@query("w15_sorted_reads", f"{R} SELECT fragment_id, mate, ordinal, row_number() OVER (PARTITION BY fragment_id ORDER BY mate, ordinal) AS place FROM reads".replace("row_number() OVER (PARTITION BY fragment_id ORDER BY mate, ordinal)", "CAST(row_number() OVER (PARTITION BY fragment_id ORDER BY mate, ordinal) AS INTEGER)"))
def w15(spark, d):
    placed = ranking.top_n(ad.reads(spark, d), ["fragment_id"], [F.col("mate"), F.col("ordinal")], 2**31 - 1)
    return placed.select("fragment_id", "mate", "ordinal", "place").orderBy("fragment_id", "mate", "ordinal")


# --- alignments with clips: mate 1 is clipped on the left, mate 2 on the right, by five bases for each mismatch

CLIPPED = f"""{ad.READS}, cl AS (SELECT *, "end" - start AS len, CASE WHEN mate = 1 THEN nm * 5 ELSE 0 END AS lc, CASE WHEN mate = 2 THEN nm * 5 ELSE 0 END AS rc, start + 1 AS pos, "end" AS last, greatest(least("end", 45000) - greatest(start + 1, 5001) + 1, 0) AS inside FROM reads),
rq AS (SELECT *, CASE WHEN mapq < 20 THEN 'low_mapq' WHEN len < 120 THEN 'short_alignment' WHEN CAST(len - nm AS DOUBLE) / len < 0.95 THEN 'low_identity' WHEN inside > 10 AND len - inside > 10 THEN 'boundary_spanning' WHEN inside > 10 AND (abs(pos - 5001) <= 10 AND lc > 10 OR abs(last - 45000) <= 10 AND rc > 10) THEN 'boundary_spanning'
  WHEN CAST(len AS DOUBLE) / (len + lc + rc) >= 0.8 THEN CASE WHEN inside > 10 THEN 'island_internal' ELSE 'flank_only' END ELSE 'low_query_coverage' END AS what FROM cl),
rk AS (SELECT *, CASE WHEN what IN ('boundary_spanning', 'island_internal', 'flank_only') THEN what ELSE 'rejected' END AS class, CASE WHEN what NOT IN ('boundary_spanning', 'island_internal', 'flank_only') THEN what END AS reason FROM rq)"""
CLASSES = ["island_internal", "boundary_spanning", "flank_only", "rejected"]


def _aligned(spark, d):
    clip = F.concat((F.col("nm") * 5).cast("string"), F.lit("S"))
    some = F.col("nm") > 0
    cigar = F.concat(F.when((F.col("mate") == 1) & some, clip).otherwise(""), (F.col("end") - F.col("start")).cast("string"), F.lit("M"), F.when((F.col("mate") == 2) & some, clip).otherwise(""))
    return ad.reads(spark, d).withColumns({"cigar": cigar, "pos": F.col("start") + 1})


def _recruited(spark, d):
    made = rules.recruitment_class(F.col("pos"), F.col("cigar"), F.col("mapq"), F.col("nm"), 5_001, 45_000, matched=120, identity=0.95)
    return _aligned(spark, d).withColumn("r", made).select("*", "r.class", "r.reason")


@query("w7_fragment_class", f"WITH {CLIPPED} SELECT fragment_id, CASE min(CASE class WHEN 'island_internal' THEN 1 WHEN 'boundary_spanning' THEN 2 WHEN 'flank_only' THEN 3 ELSE 4 END) WHEN 1 THEN 'island_internal' WHEN 2 THEN 'boundary_spanning' WHEN 3 THEN 'flank_only' ELSE 'rejected' END AS class FROM rk GROUP BY fragment_id")
def w7(spark, d):
    return ranking.precedence(_recruited(spark, d), ["fragment_id"], "class", CLASSES)


@query("r6_recruitment_class", f"WITH {CLIPPED} SELECT read_id, class, reason FROM rk")
def r6(spark, d):
    return _recruited(spark, d).select("read_id", "class", "reason")


@query("h8_recruitment_census", f"""WITH {CLIPPED}, n AS (SELECT sample_id, class, CAST(count(*) AS BIGINT) AS reads, count(DISTINCT fragment_id) AS fragments FROM rk GROUP BY ALL UNION ALL SELECT sample_id, concat('rejected_', reason), count(*), count(DISTINCT fragment_id) FROM rk WHERE reason IS NOT NULL GROUP BY ALL),
  k AS (SELECT s.sample_id, metric FROM (SELECT DISTINCT sample_id FROM reads) AS s, (VALUES ('island_internal'), ('boundary_spanning'), ('flank_only'), ('rejected'), ('rejected_low_mapq'), ('rejected_short_alignment'), ('rejected_low_identity'), ('rejected_low_query_coverage')) AS m(metric))
  SELECT k.sample_id, metric, coalesce(reads, 0) AS reads, coalesce(fragments, 0) AS fragments FROM k LEFT JOIN n ON n.sample_id = k.sample_id AND n.class = metric""")
def h8(spark, d):
    r = _recruited(spark, d)
    metrics = F.array("class", F.when(F.col("reason").isNotNull(), F.concat(F.lit("rejected_"), F.col("reason"))))
    n = r.select("sample_id", "fragment_id", F.explode(metrics).alias("metric")).where("metric is not null").groupBy("sample_id", "metric").agg(F.count(F.lit(1)).alias("reads"), F.countDistinct("fragment_id").alias("fragments"))
    names = F.array(*map(F.lit, [*CLASSES, *[f"rejected_{x}" for x in ("low_mapq", "short_alignment", "low_identity", "low_query_coverage")]]))
    every = r.select("sample_id").distinct().select("sample_id", F.explode(names).alias("metric"))
    return counting.zero_filled(n.withColumn("fragments", F.col("fragments")), every, ["sample_id", "metric"], "reads").withColumn("fragments", F.coalesce("fragments", F.lit(0).cast("long")))


@query("a9_position_duplicates", f"WITH {CLIPPED}, k AS (SELECT sample_id, contig, flag & 16 AS strand, CASE WHEN flag & 16 > 0 THEN last + rc ELSE pos - lc END AS five FROM cl WHERE flag & 2308 = 0) SELECT sample_id, count(*) AS records, count(DISTINCT (contig, strand, five)) AS positions, count(*) - count(DISTINCT (contig, strand, five)) AS duplicates FROM k GROUP BY sample_id")
def a9(spark, d):
    kept = _aligned(spark, d).where(~fn.flagged(F.col("flag"), 2308)).withColumns({"strand": F.col("flag").bitwiseAND(F.lit(16)), "five": fn.five_prime(F.col("flag"), F.col("pos"), F.col("cigar"))})
    return counting.position_duplicates(kept, ["sample_id"], ["contig", "strand", "five"])


@query("a20_single_record", f"{R} SELECT fragment_id, read_id, score, nm FROM (SELECT *, row_number() OVER (PARTITION BY fragment_id ORDER BY CASE WHEN flag & 2304 = 0 THEN 0 ELSE 1 END, CASE WHEN flag & 2304 = 0 THEN 0 ELSE -score END, ordinal) AS r FROM reads WHERE flag & 4 = 0) AS x WHERE r = 1")
def a20(spark, d):
    other = F.col("flag").bitwiseAND(2304) != 0
    mapped = ad.reads(spark, d).where(F.col("flag").bitwiseAND(4) == 0)
    return ranking.first_by(mapped, ["fragment_id"], [other, F.when(other, -F.col("score")).otherwise(0), F.col("ordinal")]).select("fragment_id", "read_id", "score", "nm")


@query("a8_four_countings", f"WITH {ad.OVERLAPS}, strict AS (SELECT read_id, gene FROM (SELECT *, rank() OVER (PARTITION BY read_id ORDER BY bases DESC) AS k, count(*) OVER (PARTITION BY read_id, bases) AS n FROM sums) AS x WHERE k = 1 AND n = 1), w AS (SELECT a.*, s.gene IS NOT NULL AS once FROM assigned AS a LEFT JOIN strict AS s ON s.read_id = a.read_id) SELECT sample_id, gene, count(*) FILTER (once) AS raw, count(*) FILTER (flag & 1024 = 0) AS dup_marked, count(DISTINCT fragment_id) AS fragment, count(DISTINCT CASE WHEN flag & 1024 = 0 THEN fragment_id END) AS dup_collapsed FROM w GROUP BY sample_id, gene")
def a8(spark, d):
    """The raw count leaves ties out, as its own assignment does; the other three take the first gene."""
    reads = _assigned(spark, d, mark="once")
    dup = fn.flagged(F.col("flag"), 1024)
    return reads.groupBy("sample_id", "gene").agg(
        F.count_if("once").alias("raw"), F.count_if(~dup).alias("dup_marked"), F.countDistinct("fragment_id").alias("fragment"), F.countDistinct(F.when(~dup, F.col("fragment_id"))).alias("dup_collapsed")
    )


@query("a36_read_length_snap", f"{R}, f AS (SELECT sample_id, \"end\" - start AS len, row_number() OVER (PARTITION BY sample_id ORDER BY fragment_id, ordinal) AS i FROM reads), m AS (SELECT sample_id, CAST(floor(quantile_cont(len, 0.5)) AS BIGINT) AS median FROM f WHERE i <= 400 GROUP BY 1) SELECT sample_id, median, CAST(arg_min(n, struct_pack(a := abs(n - median), n := n)) AS INTEGER) AS snapped FROM m, (VALUES (100), (125), (150)) AS t(n) GROUP BY ALL")
def a36(spark, d):
    return lanes.snapped_length(ad.reads(spark, d).withColumn("length", F.col("end") - F.col("start")), ["sample_id"], "length", [F.col("fragment_id"), F.col("ordinal")], (100, 125, 150), first=400)


@query("j29_serial_depletion", f"{R}, one AS (SELECT * FROM reads WHERE mapq >= 35), a AS (SELECT * FROM reads WHERE read_id NOT IN (SELECT read_id FROM one)), two AS (SELECT * FROM a WHERE score >= 40), b AS (SELECT * FROM a WHERE read_id NOT IN (SELECT read_id FROM two)), three AS (SELECT * FROM b WHERE nm = 0), c AS (SELECT * FROM b WHERE read_id NOT IN (SELECT read_id FROM three)) SELECT 'one' AS stage, sample_id, count(*) AS reads FROM one GROUP BY 2 UNION ALL SELECT 'two', sample_id, count(*) FROM two GROUP BY 2 UNION ALL SELECT 'three', sample_id, count(*) FROM three GROUP BY 2 UNION ALL SELECT 'kept', sample_id, count(*) FROM c GROUP BY 2")
def j29(spark, d):
    reads = ad.reads(spark, d).select("read_id", "sample_id", "mapq", "score", "nm")
    hits = {"one": reads.where("mapq >= 35"), "two": reads.where("score >= 40"), "three": reads.where("nm = 0")}
    return lanes.serial_depletion(reads, {name: x.select("read_id") for name, x in hits.items()}, "read_id", ["sample_id"])


@query("j19_arm_union", f"{R}, a AS (SELECT fragment_id, max(score) FILTER (contig = 0) AS t1, max(score) FILTER (contig = 1) AS d1 FROM reads WHERE contig IN (0, 1) GROUP BY 1), b AS (SELECT fragment_id, max(score) AS t2, min(nm) AS nt2 FROM reads WHERE contig = 2 GROUP BY 1), c AS (SELECT fragment_id, max(score) AS d2, min(nm) AS nd2 FROM reads WHERE contig = 3 GROUP BY 1), u AS (SELECT coalesce(a.fragment_id, b.fragment_id, c.fragment_id) AS fragment_id, t1, d1, t2, nt2, d2, nd2 FROM a FULL JOIN b ON a.fragment_id = b.fragment_id FULL JOIN c ON c.fragment_id = coalesce(a.fragment_id, b.fragment_id)), "
  "k AS (SELECT *, CASE WHEN t1 IS NULL AND d1 IS NULL THEN 'ambiguous' WHEN d1 IS NULL THEN 'true' WHEN t1 IS NULL THEN 'decoy' WHEN t1 - d1 > 2 THEN 'true' WHEN d1 - t1 > 2 THEN 'decoy' ELSE 'ambiguous' END AS b1, CASE WHEN t2 IS NULL AND d2 IS NULL THEN 'ambiguous' WHEN d2 IS NULL THEN 'true' WHEN t2 IS NULL THEN 'decoy' WHEN t2 > d2 THEN 'true' WHEN d2 > t2 THEN 'decoy' WHEN nt2 < nd2 THEN 'true' WHEN nt2 > nd2 THEN 'decoy' ELSE 'ambiguous' END AS b2 FROM u) SELECT fragment_id, b1, b2, CASE WHEN b1 = 'true' AND b2 = 'true' THEN 'confirmed_true' WHEN b1 = 'decoy' AND b2 = 'decoy' THEN 'confirmed_decoy' ELSE 'ambiguous' END AS class FROM k")
def j19(spark, d):
    reads, c = ad.reads(spark, d), F.col("contig")
    a = reads.where(c.isin(0, 1)).groupBy("fragment_id").agg(F.max(F.when(c == 0, F.col("score"))).alias("t1"), F.max(F.when(c == 1, F.col("score"))).alias("d1"))
    b = reads.where(c == 2).groupBy("fragment_id").agg(F.max("score").alias("t2"), F.min("nm").alias("nt2"))
    e = reads.where(c == 3).groupBy("fragment_id").agg(F.max("score").alias("d2"), F.min("nm").alias("nd2"))
    u = a.join(b, "fragment_id", "full").join(e, "fragment_id", "full")
    u = u.withColumns({"b1": rules.favoured(F.col("t1"), F.col("d1"), 2), "b2": rules.favoured_with_mismatches(F.col("t2"), F.col("nt2"), F.col("d2"), F.col("nd2"))})
    return u.select("fragment_id", "b1", "b2", rules.confirmed(F.col("b1"), F.col("b2")).alias("class"))


@query("a27_best_bin", f"WITH {BINS}, p AS (SELECT pool, bin, tier, CASE tier WHEN 'broad_island' THEN 3 WHEN 'multi_gene' THEN 2 ELSE 1 END AS rank, CAST(len(genes) AS INTEGER) AS n_genes, CAST(n AS DOUBLE) / 1000 AS breadth FROM b WHERE tier IN ('broad_island', 'multi_gene')) SELECT pool, bin, tier, n_genes FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY rank DESC, n_genes DESC, breadth DESC, bin DESC) AS r FROM p) AS x WHERE r = 1")
def a27(spark, d):
    p = _bins(spark, d).where(F.col("tier").isin(POSITIVE)).withColumns({"rank": rules.tier_rank(F.col("tier")), "n_genes": F.size("genes"), "breadth": F.col("n").cast("double") / 1000})
    best = F.max_by(F.struct("bin", "tier", "n_genes"), F.struct("rank", "n_genes", "breadth", "bin"))
    return p.groupBy("pool").agg(best.alias("b")).select("pool", "b.*")


@query("w13_cohort_order", f"WITH {EVIDENCE}, t AS (SELECT sample_id, reads, genes, breadth, {TIER} AS tier FROM evidence) SELECT sample_id, tier, genes, reads, breadth, CAST(row_number() OVER (ORDER BY CASE tier WHEN 'extensive_island' THEN 4 WHEN 'broad_island' THEN 3 WHEN 'multi_gene' THEN 2 WHEN 'localized_indeterminate' THEN 1 ELSE 0 END DESC, genes DESC, reads DESC, breadth DESC, sample_id) AS INTEGER) AS place FROM t")
def w13(spark, d):
    return lanes.cohort_order(r1(spark, d), "tier", ["genes", "reads", "breadth"], "sample_id").select("sample_id", "tier", "genes", "reads", "breadth", "place")


@query("h12_count_buckets", f"{R} SELECT sample_id, contig, CASE WHEN count(*) FILTER (mapq >= 35) >= 10 THEN 'ten' WHEN count(*) FILTER (mapq >= 35) >= 3 THEN 'three' WHEN count(*) FILTER (mapq >= 35) >= 1 THEN 'one' ELSE 'none' END AS bucket FROM reads GROUP BY ALL")
def h12(spark, d):
    n = ad.reads(spark, d).groupBy("sample_id", "contig").agg(F.count_if(F.col("mapq") >= 35).alias("n"))
    return n.select("sample_id", "contig", rules.cascade([(F.col("n") >= 10, "ten"), (F.col("n") >= 3, "three"), (F.col("n") >= 1, "one")], "none").alias("bucket"))


@query("a5_binned_depth", f"""{R}, b AS (SELECT sample_id, unnest(range(start // 50, ("end" - 1) // 50 + 1)) AS bin, start, "end" FROM reads) SELECT sample_id, bin, CAST(sum(least("end", (bin + 1) * 50) - greatest(start, bin * 50)) AS BIGINT) / 50.0::DOUBLE AS depth FROM b GROUP BY sample_id, bin""")
def a5(spark, d):
    each = ad.reads(spark, d).select("sample_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), F.lit(1).alias("depth"))
    summed = intervals.binned_depth(each, ["sample_id"], 50)
    return summed.select("sample_id", "bin", (F.col("depth_sum").cast("double") / 50).alias("depth"))


@query("v1_malformed_ids", "SELECT c_custkey, 'malformed' AS problem FROM customer WHERE NOT regexp_full_match(c_mktsegment, '[A-M][A-Z]+') UNION ALL SELECT c_custkey, 'repeated' FROM customer WHERE c_name IN (SELECT c_name FROM customer WHERE c_nationkey % 2 = 0 GROUP BY c_name) AND c_nationkey = 4")
def v1(spark, d):
    c = ad.table(spark, d, "customer")
    twice = checks.duplicated(c.select("c_name").unionByName(c.where("c_nationkey = 4").select("c_name")), ["c_name"])
    repeated = c.join(twice, "c_name", "left_semi").select("c_custkey", F.lit("repeated").alias("problem"))
    return checks.malformed(c, "c_mktsegment", "[A-M][A-Z]+").select("c_custkey", F.lit("malformed").alias("problem")).union(repeated)


IDS = "ids AS (SELECT CASE WHEN c_custkey % 101 = 0 THEN NULL WHEN c_custkey % 97 = 0 THEN concat('bad id ', c_custkey) WHEN c_custkey % 89 = 0 THEN '-' WHEN c_custkey % 10 = 3 THEN concat('P', c_custkey // 20) ELSE concat('S-', c_custkey, '.a') END AS id FROM customer)"


@query("v1_id_problems", f"WITH {IDS}, n AS (SELECT id AS value, count(*) AS rows FROM ids GROUP BY id) SELECT * FROM (SELECT value, rows, concat_ws(';', CASE WHEN NOT coalesce(regexp_full_match(value, '[A-Za-z0-9][A-Za-z0-9._-]*'), FALSE) THEN 'malformed' END, CASE WHEN rows > 1 THEN 'repeated' END) AS problems FROM n) AS x WHERE problems <> ''")
def v1_ids(spark, d):
    k = F.col("c_custkey")
    made = F.when(k % 101 == 0, None).when(k % 97 == 0, F.concat(F.lit("bad id "), k.cast("string"))).when(k % 89 == 0, "-").when(k % 10 == 3, F.concat(F.lit("P"), F.floor(k / 20).cast("string"))).otherwise(F.concat(F.lit("S-"), k.cast("string"), F.lit(".a")))
    return checks.id_problems(ad.table(spark, d, "customer").select(made.alias("id")), "id", "[A-Za-z0-9][A-Za-z0-9._-]*")


@query("v5_broken_rules", f"{CHAINS}, r AS (SELECT sample_id, unnest([CASE WHEN island > passed THEN 'island>passed' END, CASE WHEN passed > mapped THEN 'passed>mapped' END, CASE WHEN genes NOT BETWEEN 0 AND 18 THEN 'genes' END, CASE WHEN passed IS NULL THEN 'passed is missing' END]) AS rule FROM q) SELECT * FROM r WHERE rule IS NOT NULL")
def v5_rules(spark, d):
    c = F.col
    rules_ = {"island>passed": c("island") > c("passed"), "passed>mapped": c("passed") > c("mapped"), "genes": ~c("genes").between(0, 18), "passed is missing": c("passed").isNull()}
    return checks.broken_rules(_chain(spark, d), ["sample_id"], rules_)


@query("j6_without_bins", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 20 = 0)")
def j6(spark, d):
    bins = ad.table(spark, d, "orders").where("o_orderkey % 20 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return ad.table(spark, d, "customer").join(bins, "c_custkey", "left_anti").select("c_custkey")


@query("v11_uniform_mode", "WITH m AS (SELECT o_custkey % 7 AS cohort, o_orderstatus AS mode FROM orders WHERE NOT (o_custkey % 7 < 3 AND o_orderstatus <> 'F')) SELECT cohort, count(DISTINCT mode) AS kinds FROM m GROUP BY cohort HAVING count(DISTINCT mode) > 1")
def v11(spark, d):
    m = ad.table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("cohort"), F.col("o_orderstatus").alias("mode"))
    return checks.several(m.where(~((F.col("cohort") < 3) & (F.col("mode") != "F"))), ["cohort"], "mode")


@query("v12_shared_contigs", "SELECT p_brand FROM part WHERE p_size < 20 INTERSECT SELECT p_brand FROM part WHERE p_size > 48")
def v12(spark, d):
    p = ad.table(spark, d, "part")
    return checks.shared(p.where("p_size < 20"), p.where("p_size > 48"), "p_brand")


@query("v6_disagreeing_tiers", f"{VARIANTS} SELECT sample_id, raw AS one, CASE WHEN sample_id % 3 = 0 THEN 'negative' ELSE dup_collapsed END AS two FROM t WHERE raw <> CASE WHEN sample_id % 3 = 0 THEN 'negative' ELSE dup_collapsed END")
def v6(spark, d):
    t = _variant_tiers(spark, d)
    return checks.disagreeing(t.select("sample_id", F.col("raw").alias("tier")), t.select("sample_id", F.when(F.col("sample_id") % 3 == 0, "negative").otherwise(F.col("dup_collapsed")).alias("tier")), ["sample_id"], "tier")


@query("v2_gene_contract", f"{R}, g AS (SELECT sample_id, concat('g', part % 21) AS gene, count(*) AS n FROM reads WHERE mapq = 40 AND score > 44 GROUP BY ALL), d AS (SELECT concat('g', i) AS gene FROM range(19) AS t(i)) SELECT s.sample_id, d.gene, 'missing' AS problem FROM (SELECT DISTINCT sample_id FROM g) AS s, d WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.sample_id = s.sample_id AND g.gene = d.gene) UNION ALL SELECT sample_id, gene, 'unknown' FROM g WHERE gene NOT IN (SELECT gene FROM d)")
def v2(spark, d):
    g = ad.reads(spark, d).where("mapq = 40 AND score > 44").groupBy("sample_id", F.concat(F.lit("g"), (F.col("part") % 21).cast("string")).alias("gene")).agg(F.count(F.lit(1)).alias("n"))
    genes = spark.range(19).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("gene"))
    lacking = checks.missing(g, ["sample_id"], "gene", genes).withColumn("problem", F.lit("missing"))
    return lacking.union(g.where(~F.col("gene").isin([f"g{i}" for i in range(19)])).select("sample_id", "gene", F.lit("unknown").alias("problem")))


@query("j10_rescued_taxonomy", f"{R}, t AS (SELECT p_partkey, p_size AS taxid FROM part WHERE p_size > 10), sp AS (SELECT s_suppkey AS taxid, s_nationkey AS species FROM supplier), nm AS (SELECT n_nationkey AS species, n_name AS name FROM nation WHERE n_regionkey < 4) SELECT coalesce(CAST(t.taxid AS VARCHAR), 'no_taxid') AS taxid, coalesce(CAST(sp.species AS VARCHAR), 'Unclassified') AS species, coalesce(name, 'unnamed') AS name, count(*) AS reads FROM reads LEFT JOIN t ON p_partkey = part LEFT JOIN sp ON sp.taxid = t.taxid LEFT JOIN nm ON nm.species = sp.species WHERE flag & 4 > 0 GROUP BY ALL")
def j10(spark, d):
    taxids = ad.table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("part"), F.col("p_size").cast("long").alias("taxid"))
    species = ad.table(spark, d, "supplier").select(F.col("s_suppkey").alias("taxid"), F.col("s_nationkey").alias("species"))
    names = ad.table(spark, d, "nation").where("n_regionkey < 4").select(F.col("n_nationkey").alias("species"), F.col("n_name").alias("name"))
    met = ad.reads(spark, d).where(F.col("flag").bitwiseAND(4) > 0).join(taxids, "part", "left").join(species, "taxid", "left").join(names, "species", "left")
    named = met.select(F.coalesce(F.col("taxid").cast("string"), F.lit("no_taxid")).alias("taxid"), F.coalesce(F.col("species").cast("string"), F.lit("Unclassified")).alias("species"), F.coalesce("name", F.lit("unnamed")).alias("name"))
    return named.groupBy("taxid", "species", "name").agg(F.count(F.lit(1)).alias("reads"))


@query("j5_community_input", f"WITH {BINS} SELECT a.pool, a.bin, n, prophages, protected, rec_a, CAST(len(genes) AS INTEGER) AS n_genes FROM (SELECT pool, bin, n FROM b WHERE bin <> 0) AS a JOIN (SELECT pool, bin, prophages FROM b WHERE bin <> 1) AS p ON p.pool = a.pool AND p.bin = a.bin JOIN (SELECT pool, bin, protected FROM b WHERE bin <> 2) AS q ON q.pool = a.pool AND q.bin = a.bin JOIN (SELECT pool, bin, rec_a FROM b WHERE pool <> 3) AS r ON r.pool = a.pool AND r.bin = a.bin LEFT JOIN (SELECT pool, bin, genes FROM b WHERE len(genes) > 18) AS g ON g.pool = a.pool AND g.bin = a.bin")
def j5(spark, d):
    b, on = _bins(spark, d), ["pool", "bin"]
    one = lambda cond, *columns: b.where(cond).select(*on, *columns)
    return lanes.community_input(one("bin <> 0", "n"), one("bin <> 1", "prophages"), one("bin <> 2", "protected"), one("pool <> 3", "rec_a"), one(F.size("genes") > 18, F.size("genes").alias("n_genes")), on=on)


@query("j2_evidence_input", f"{CHAINS}, p AS (SELECT sample_id, count(*) AS high FROM reads WHERE mapq >= 40 GROUP BY 1), m AS (SELECT s_suppkey AS sample_id, s_nationkey AS site FROM supplier WHERE s_nationkey < 20) SELECT q.sample_id, reads, passed, high, site FROM q JOIN p ON p.sample_id = q.sample_id JOIN m ON m.sample_id = q.sample_id JOIN (SELECT sample_id FROM q WHERE passed IS NOT NULL) AS k ON k.sample_id = q.sample_id")
def j2(spark, d):
    q = _chain(spark, d)
    profile = ad.reads(spark, d).where("mapq >= 40").groupBy("sample_id").agg(F.count(F.lit(1)).alias("high"))
    mode = ad.table(spark, d, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("sample_id"), F.col("s_nationkey").alias("site"))
    return lanes.joined(["sample_id"], q.select("sample_id", "reads"), profile, q.where("passed is not null").select("sample_id", "passed"), mode)


@query("a33_counts_summary", "SELECT 'status' AS section, o_orderstatus AS key, count(*) AS n_files FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'build', CASE o_orderkey % 4 WHEN 0 THEN 'GRCh38' WHEN 1 THEN 'GRCh37' WHEN 2 THEN 'T2T-CHM13' ELSE 'unknown' END, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'aligner', CASE WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'no' END, count(*) FROM orders GROUP BY 2")
def a33(spark, d):
    length = F.element_at(F.array(*[F.lit(x).cast("long") for x in (248956422, 249250621, 248387328, 5)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    sections = {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"), "build": fn.build_guess(length), "aligner": F.when(F.col("o_custkey") % 2 == 0, "yes").otherwise("no")}
    return lanes.counts_by_section(ad.table(spark, d, "orders"), sections)


_sql = dict(_ORACLE)


@query("a28_community_counts", f"WITH x AS ({_sql['j15_interactions']}), f AS (SELECT pool, bool_or(nm = 10) AS integrase, bool_or(nm = 9) AS trna FROM (WITH {ALONE} SELECT * FROM pooled) AS y WHERE score = 50 GROUP BY pool) SELECT f.pool, count(DISTINCT producer) AS producers, count(producer) AS assessed, count(*) FILTER (prophages > 1) AS with_prophages, any_value(integrase) AS integrase, any_value(trna) AS trna FROM f LEFT JOIN x ON x.pool = f.pool GROUP BY f.pool")
def a28(spark, d):
    flags = _alone(spark, d).where("score = 50").groupBy("pool").agg(F.bool_or(F.col("nm") == 10).alias("integrase"), F.bool_or(F.col("nm") == 9).alias("trna"))
    return lanes.community_counts(flags, j15(spark, d), ["pool"], least=2)


@query("j20_carrier_scores", f"WITH {POOLED} SELECT pool, fragment_id, contig % 3 AS carrier, max(score) AS score FROM pooled WHERE contig < 6 AND flag & 4 = 0 GROUP BY ALL")
def j20b(spark, d):
    panel = spark.range(6).select(F.col("id").alias("contig"), (F.col("id") % 3).alias("carrier"))
    met = pooled(spark, d).where(F.col("flag").bitwiseAND(4) == 0).join(F.broadcast(panel), "contig")
    return met.groupBy("pool", "fragment_id", "carrier").agg(F.max("score").alias("score"))


@query("a31_tier_movement", f"{VARIANTS}, m AS (SELECT raw AS before, dup_collapsed AS after, count(*) AS samples FROM t GROUP BY ALL) SELECT before, after, samples, CAST(sum(samples) OVER (PARTITION BY before) AS BIGINT) AS of_before FROM m")
def a31c(spark, d):
    return lanes.tier_movement(_variant_tiers(spark, d), "raw", "dup_collapsed")


@query("a31_parameter_drift", "WITH e(name, expected) AS (VALUES ('1-URGENT', 'F'), ('2-HIGH', 'O'), ('3-MEDIUM', 'P')) SELECT o_orderpriority AS name, expected, o_orderstatus AS found, count(*) AS runs FROM orders JOIN e ON name = o_orderpriority WHERE o_orderstatus <> expected GROUP BY ALL")
def a31d(spark, d):
    runs = ad.table(spark, d, "orders").select(F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("found"))
    return lanes.parameter_drift(runs, {"1-URGENT": "F", "2-HIGH": "O", "3-MEDIUM": "P"})


@query("a31_depletion_stages", f"{CHAINS}, n AS (SELECT CASE WHEN passed IS NOT NULL THEN 'pangenome' ELSE 't2t_phix' END AS stage, count(*) AS samples FROM q GROUP BY 1) SELECT stage, samples, (SELECT count(*) FROM n) > 1 AS mixed FROM n")
def a31e(spark, d):
    n = r3(spark, d).groupBy(F.col("host_depleted_stage").alias("stage")).agg(F.count(F.lit(1)).alias("samples"))
    return lanes.with_mix(n, "stage")
