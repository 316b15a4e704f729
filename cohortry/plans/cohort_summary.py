"""The cohort summary and its parts: the reads by fragment, place and gene, staged, and everything else from these groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cohortry.operators import cohort, intervals, lanes, rules
from cohortry.plans import adapters as ad
from cohortry.plans.cohort_queries import OTHER_GENES
from cohortry.plans.registry import GENE_TABLE, TIER, bootstrap_sql, query
from cohortry.staging import staged

NAMES = [f"g{i + 1:02d}" for i in range(ad.GENES)]
#: Contigs 0 to 5 are carriers and contig 6 holds what no bin has; the genus of a carrier is its number modulo 3.
PANEL = {str(c): f"G{c % 3}" for c in range(6)}
RESCUED = {"rescued_all": 0, "rescued_10": 10, "rescued_20": 20, "rescued_30": 30}


def read_facts(spark, d, *wanted):
    """The reads by sample, by fragment, by place on a contig, and by gene on a contig: all that the summary knows of them. As most
    fragments have one read, their rows are kept narrow: what is summed over a sample is counted by sample, yes or no is a bit."""
    reads = ad.reads(spark, d)
    c, mapped, score = F.col("contig"), F.col("flag").bitwiseAND(4) == 0, F.col("score")
    reads = reads.withColumn("best", cohort.best_interval(F.col("start"), F.col("end"), GENE_TABLE))
    reads = reads.select("*", F.col("best.label").alias("gene"), F.col("best.bases").alias("bases"), (F.substring("best.label", 2, 2).cast("int") - 1).alias("bit"), mapped.alias("mapped"), (F.col("flag").bitwiseAND(1024) == 0).alias("unmarked"))
    columns = ["sample_id", "fragment_id", "contig", "start", "end", "flag", "mapq", "score", "nm", "mate", "part", "mapped", "unmarked", "gene", "bases", "bit"]
    reads = staged(reads.select(*columns), "reads")  # scanned and assigned once; groupings read their own columns of it
    hit, low = F.col("gene").isNotNull(), F.col("mapped") & (score < 20)
    arm = lambda f, value, *contigs: f(F.when(c.isin(*contigs), value))
    target = lambda s, e: (F.col("start") < e) & (F.col("end") > s)
    ok = F.col("mapped") & (F.col("mapq") >= 20)
    genes = F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))), F.lit(0).cast("long"))
    marks = {"hit": hit, "hit_unmarked": hit & F.col("unmarked"), "mate_1": F.col("mate") == 1, "mate_2": F.col("mate") == 2, "in_a": c.isin(0, 3), "listed": c.isin(1, 2, 4, 5), "off": F.col("mapped") & (c == 6)}
    sets = {
        "sample": (["sample_id"], {
            "n": F.count(F.lit(1)), "primary": F.count_if(F.col("flag").bitwiseAND(2304) == 0), "unmapped": F.count_if(~F.col("mapped")), "aligned": F.count_if("mapped"), "low_score": F.count_if(low), "passed": F.count_if(ok),
            **{k: F.count_if(low & (F.col("mapq") >= q)) for k, q in RESCUED.items()}, "on_target": F.count_if(target(8_000, 9_000) | target(20_000, 20_500) | target(20_300, 20_900)),
            "hits": F.count_if(hit), "hits_unmarked": F.count_if(hit & F.col("unmarked")), "gene_bits": genes,
        }),
        "fragment": (["sample_id", "fragment_id"], {
            "marks": F.bit_or(reduce(lambda a, b: a + b, [F.when(m, 1 << i).otherwise(0) for i, m in enumerate(marks.values())])), "genes": genes, "bases": F.coalesce(F.sum("bases"), F.lit(0)).cast("long"),
            **{f"best_{k}": F.max(F.when(F.col("mapped") & (c == int(k)), score)) for k in PANEL},
            "clade": arm(F.max, F.col("part") % 3, 0, 3), "confidence": arm(F.max, F.col("mapq"), 0, 3), "kmers": arm(F.max, F.col("nm"), 0, 3),
        }),
        "position": (["sample_id", "contig", "start"], {"end": F.max("end")}),
        "gene": (["sample_id", "contig", "gene"], {
            "n": F.count(F.lit(1)), "q30": F.count_if(F.col("mapq") >= 30), "genes": genes, "prophages": F.count_if(score == 50), "protected": F.bool_or(F.col("nm") == 10), "trna": F.bool_or(F.col("nm") == 9),
        }),
    }
    facts = cohort.grouped(reads, {name: sets[name] for name in wanted or sets})
    if "fragment" in facts:
        facts["fragment"] = facts["fragment"].withColumns({name: F.col("marks").bitwiseAND(1 << i) != 0 for i, name in enumerate(marks)}).drop("marks")
    return facts


def fragment_fates(fragments):
    """Fragments with the fate of the challenge; arm A is contigs 0 and 3, true ones of arm B are 1 and 4, decoys 2 and 5."""
    t, x = F.greatest("best_1", "best_4"), F.greatest("best_2", "best_5")
    f = fragments.withColumns({"t": t, "x": x}).withColumn("by_score", rules.favoured(F.col("t"), F.col("x")))
    f = f.withColumns({"classification": F.when(F.col("by_score") == "ambiguous", "ambiguous").otherwise(F.concat(F.lit("confirmed_"), "by_score")), "a_ok": rules.clade_confirmed(F.col("clade"), F.col("confidence"), F.col("kmers"), target=1, least_confidence=10, least_kmers=2)})
    f = f.withColumn("survives", F.col("a_ok") & F.col("listed") & (F.col("classification") == "confirmed_true"))
    f = f.withColumn("fate", rules.read_fate(F.col("survives"), F.col("listed"), F.col("classification"), F.col("t").isNotNull() | F.col("x").isNotNull(), F.col("in_a")))
    decoy = F.when(F.col("x") == F.col("best_5"), "5").when(F.col("x") == F.col("best_2"), "2")
    return f.withColumns({"absorber": rules.absorber(decoy, F.lit(None).cast("string"), F.col("classification")), "near": rules.near_threshold(F.col("classification"), F.col("t") - F.col("x"), 5)})


def of_samples(facts):
    """Counts, depths, countings and challenge of each sample, from its fragments."""
    f = fragment_fates(facts["fragment"])
    kept = F.col("fate") == "survived"
    challenged = f.groupBy("sample_id").agg(
        F.count_if("hit").alias("fragments"), F.count_if("hit_unmarked").alias("fragments_dedup"),
        F.count(F.lit(1)).alias("recruited_fragments"), F.count_if(F.col("mate_1") & F.col("mate_2")).alias("paired_fragments"), F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col("fate").isin("survived", "lost")).alias("measured"), F.count_if(kept).alias("survived"),
        F.coalesce(F.bit_or(F.when(kept, F.col("genes"))), F.lit(0).cast("long")).alias("survived_genes"), F.coalesce(F.sum(F.when(kept, F.col("bases"))), F.lit(0)).cast("long").alias("survived_bases"),
    )
    return facts["sample"].join(challenged, "sample_id")


def of_places(facts):
    """Covered bases of each sample, and of its contigs by assembler (even and odd ones), cut to 5,000 to 45,000 there."""
    p = facts["position"]
    whole = intervals.union_length(p, ["sample_id"])
    cut = intervals.union_length(intervals.clipped(p, 5_000, 45_000), ["sample_id", "contig"]).where("union_bases >= 2000")
    one, two = F.col("contig") % 2 == 0, F.col("contig") % 2 == 1
    bases = lambda which: F.coalesce(F.sum(F.when(which, F.col("union_bases"))), F.lit(0)).cast("long")
    by_assembler = cut.groupBy("sample_id").agg(F.count_if(one).alias("contigs_one"), bases(one).alias("bases_one"), F.count_if(two).alias("contigs_two"), bases(two).alias("bases_two"))
    return whole.join(by_assembler, "sample_id", "left").na.fill(0, ["contigs_one", "bases_one", "contigs_two", "bases_two"])


def bins_of(facts):
    """Bins (contigs of a sample) with their genes of two reads at least, locus breadth, locus tier and context."""
    g = facts["gene"]
    flags = [F.bool_or(c).alias(c) for c in ("protected", "trna")]
    each = g.groupBy("sample_id", "contig").agg(F.sum("n").cast("long").alias("records"), F.sum("prophages").cast("long").alias("prophages"), *flags, F.coalesce(F.bit_or(F.when(F.col("q30") >= 2, F.col("genes"))), F.lit(0).cast("long")).alias("bits"))
    breadth = intervals.union_length(facts["position"], ["sample_id", "contig"])
    out = each.join(breadth, ["sample_id", "contig"]).withColumns({"n_genes": F.bit_count("bits").cast("long"), "breadth": F.col("union_bases") / F.lit(float(ad.ISLAND))})
    return out.withColumn("tier", rules.locus_tier(F.col("n_genes"), F.col("breadth")))


POSITIVE = [name for name, *_ in rules.TIERS]
TAXA = ["o__Enterobacterales", "o__Bacteroidales", "unclassified"]


def of_bins(bins):
    """Bins, positive ones, the best one by tier, genes and breadth, what no bin has, and the community around producers."""
    binned, positive = F.col("contig") < 6, (F.col("contig") < 6) & F.col("tier").isin(POSITIVE)
    producer = positive & (F.col("n_genes") >= 3) & (F.col("bits").bitwiseAND(0b10110) != 0)
    best = F.max(F.when(positive, F.struct(rules.tier_rank(F.col("tier")).alias("r"), "n_genes", "breadth", "contig")))
    rest = F.max(F.when(~binned, F.col("tier")))
    out = bins.groupBy("sample_id").agg(
        F.count_if(binned).alias("bins_total"), F.count_if(positive).alias("bins_positive"), best.alias("b"), rest.alias("unbinned_tier"), F.sum("prophages").cast("long").alias("prophages"), F.count_if(producer).alias("producers"),
        F.count_if(binned).alias("recipients"), F.count_if(binned & (F.col("prophages") > 0)).alias("with_prophage"), F.bool_or("protected").alias("integrase"), F.bool_or("trna").alias("trna"),
    )
    taxon = F.element_at(F.array(*map(F.lit, TAXA)), (F.col("b.contig") % 3 + 1).cast("int"))
    return out.select(
        "sample_id", "bins_total", "bins_positive", F.when(F.col("b").isNotNull(), taxon).alias("bin_taxonomy"), (F.col("b.contig") * 10 + 40).alias("bin_completeness"), F.coalesce("b.n_genes", F.lit(0)).alias("bin_genes"), F.col("b.contig").alias("best_bin"),
        "unbinned_tier", F.col("unbinned_tier").isin(POSITIVE).alias("unbinned_positive"), "prophages", "producers", (F.col("producers") * F.col("recipients")).alias("neighbours"), (F.col("producers") * F.col("with_prophage")).alias("neighbours_with_prophage"), "integrase", "trna",
    )


def carriers_of(facts):
    """The carrier summary of each sample, calls taken in place from the best scores of its fragments."""
    f = facts["fragment"].select("sample_id", "off", cohort.carrier_call({k: F.col(f"best_{k}") for k in PANEL}, PANEL).alias("x")).select("sample_id", "off", "x.*")
    calls = f.withColumn("call", F.coalesce("call", F.when(F.col("off"), "off_map").otherwise("unmapped")))
    s = lanes.carrier_summary(staged(calls.select("sample_id", "call", "top", "genera"), "calls"), ["sample_id"])
    return s.select("sample_id", F.col("verdict").alias("carrier_attribution"), F.col("top_carrier").alias("carrier_top"), F.try_divide(F.col("top_carrier_reads").cast("double"), F.col("n_attributed").cast("double")).alias("carrier_top_fraction"), F.col("top_genus").alias("carrier_top_genus"), F.col("runner_up_carrier").alias("carrier_runner_up"))


def absorbers_of(facts):
    """Flagged absorbers of each sample, by name."""
    lost = fragment_fates(facts["fragment"]).where("fate = 'lost'")
    named = lanes.absorbers(lost, ["sample_id"]).where("flagged")
    return named.groupBy("sample_id").agg(F.array_join(F.array_sort(F.collect_list("absorber")), ";").alias("flagged_absorbers"))


def typing_of(spark, d):
    """The first typed unit of each sample, else its first one; units are events, in order of their number."""
    units = ad.events(spark, d).select("sample_id", "ordinal", F.col("value").alias("sequence_type"), rules.cascade([(F.col("metric") == "purchase", "typed"), (F.col("metric") == "click", "insufficient_loci")], "novel_allele_combination").alias("status"))
    return lanes.typed_unit(units, ["sample_id"], "ordinal").select("sample_id", F.col("unit.status").alias("typing_status"), F.when(F.col("unit.status") == "typed", F.col("unit.sequence_type")).alias("sequence_type"))


def tiered_of(facts):
    """Reads, genes, breadth and first tier beside the counts of a sample."""
    s = of_samples(facts).join(of_places(facts), "sample_id")
    s = s.withColumns({"genes_detected": F.bit_count("gene_bits").cast("long"), "breadth": F.col("union_bases") / F.lit(float(ad.ISLAND))})
    return s.withColumn("tier", rules.read_tier(F.col("hits"), F.col("genes_detected"), F.col("breadth")))


def evidence_of(facts):
    """The same with the challenge's outcome."""
    return cohort.recomputed(tiered_of(facts), genes=NAMES, others=OTHER_GENES, length=ad.ISLAND, key="sample_id")


def transcripts_of(facts):
    """How many genes of a sample have five reads or more."""
    return facts["gene"].where("gene IS NOT NULL").groupBy("sample_id", "gene").agg(F.sum("n").alias("n")).groupBy("sample_id").agg(F.count_if(F.col("n") >= 5).alias("transcripts"))


#: Sources of the summary that the counts and tiers of a sample suffice for, and the groups of reads that these come from.
COUNTED, COUNTED_FROM = ("read profiling", "low-score rescue", "tier robustness"), ("sample", "fragment", "position")


def summary_of(spark, d, wanted=None):
    """A row a sample with all sources of the summary, or those ``wanted`` of COUNTED, for which nothing else is made. Modes go by
    the sample's number; so does which sources a sample lacks."""
    facts = read_facts(spark, d, *(COUNTED_FROM if wanted else ()))
    s = staged(tiered_of(facts) if wanted else evidence_of(facts), "evidence")
    k, tier = F.col("sample_id"), F.col("tier")
    mode = F.element_at(F.array(*map(F.lit, ["wgs", "metagenome", "wes", "rna"])), (k % 4 + 1).cast("int"))
    s = s.withColumns({"mode": mode, "extraction": F.element_at(F.array(*map(F.lit, ["on_auto_bwa_mem", "off_requested", "NA"])), (k % 3 + 1).cast("int"))})
    tiered = cohort.by_mode(F.col("mode"), {"wgs": tier, "metagenome": F.lit("untiered")})
    per_mode = lambda m, c: F.when(F.col("mode") == m, F.col(c))
    variant = lambda n: rules.read_tier(F.col(n), F.col("genes_detected"), F.col("breadth"))
    depleted = F.when(k % 5 > 0, F.col("passed")).otherwise(F.col("aligned"))
    counted = s.withColumns({
        "read_evidence": tiered, "evidence_label": rules.evidence_label(F.col("mode"), tiered), "host_depleted_reads": F.when(F.col("mode") == "metagenome", depleted), "host_depleted_stage": F.when(F.col("mode") == "metagenome", F.when(k % 5 > 0, "pangenome").otherwise("t2t_phix")),
        "reads_per_million": F.when((F.col("mode") == "metagenome") & (depleted > 0), F.col("hits") * F.lit(1e6) / depleted), "on_target_fraction": F.try_divide(F.col("on_target").cast("double"), F.col("aligned").cast("double")),
        "tier_if_fragments": variant("fragments"), "tier_if_dedup": variant("hits_unmarked"), "tier_if_fragments_dedup": variant("fragments_dedup"),
        "wes_reads": per_mode("wes", "hits"), "wes_genes": per_mode("wes", "genes_detected"), "wes_breadth": per_mode("wes", "breadth"), "rna_reads": per_mode("rna", "hits"), "rna_genes": per_mode("rna", "genes_detected"), "rna_breadth": per_mode("rna", "breadth"),
        "rna_residual_human_fraction": F.when(F.col("mode") == "rna", F.try_divide(F.col("unmapped").cast("double"), F.col("n").cast("double"))),
        "terminal_state": rules.cascade([(k % 13 == 0, "excluded_low_input"), (F.col("passed") == 0, "failed_at_host_depletion"), (F.col("mode") != "wgs", "completed_untiered"), (tier.isin(POSITIVE), "completed_positive")], "completed_negative"),
        "structure": rules.structural_call(F.col("bases_one") / F.lit(40_000.0), F.col("bases_two") / F.lit(40_000.0)),
    })
    counted = counted.withColumns({"tier_robustness": F.when(F.col("mode") == "wgs", rules.robustness(tier, [F.col(c) for c in ("tier_if_fragments", "tier_if_dedup", "tier_if_fragments_dedup")])), "final_structural_evidence": F.col("structure.call"), "assembler_agreement": F.col("structure.agreement")}).drop("structure")
    more = [] if wanted else [of_bins(bins_of(facts)), carriers_of(facts), absorbers_of(facts), typing_of(spark, d), transcripts_of(facts)]
    known, is_mode = F.col("n").isNotNull(), lambda *m: F.col("mode").isin(*m)
    sources = {
        "mode": (known, ["mode", "evidence_label"]), "terminal state": (known, ["terminal_state"]),
        "read profiling": (known & (k % 7 > 0), ["n", "primary", "unmapped", "low_score", "aligned", "passed", "extraction"]), "low-score rescue": (known & (k % 7 > 0) & F.col("extraction").startswith("on"), list(RESCUED)),
        "WES QC": (is_mode("wes"), ["on_target", "on_target_fraction"]), "evidence tier": (is_mode("wgs", "metagenome"), ["read_evidence", "hits", "genes_detected", "breadth", "host_depleted_reads", "host_depleted_stage", "reads_per_million"]),
        "tier robustness": (is_mode("wgs"), ["fragments", "tier_if_fragments", "hits_unmarked", "tier_if_dedup", "fragments_dedup", "tier_if_fragments_dedup", "tier_robustness"]),
        "WES evidence": (is_mode("wes"), ["wes_reads", "wes_genes", "wes_breadth"]), "RNA evidence": (is_mode("rna"), ["rna_reads", "rna_genes", "rna_breadth", "transcripts", "rna_residual_human_fraction"]),
        "contig reassembly": (known & (k % 5 < 4), ["final_structural_evidence", "assembler_agreement", "contigs_one", "bases_one", "contigs_two", "bases_two", "recruited_fragments", "paired_fragments"]),
        "draft genomes": (F.col("bins_total") > 0, ["bins_total", "bins_positive", "bin_taxonomy", "bin_completeness", "bin_genes", "unbinned_tier", "unbinned_positive"]),
        "community context": (F.col("bins_total") > 0, ["prophages", "producers", "neighbours", "neighbours_with_prophage", "integrase", "trna"]), "strain typing": (F.col("typing_status").isNotNull(), ["typing_status", "sequence_type"]),
        "locus specificity": (known & is_mode("wgs"), ["locus_specificity", "retention", "recomputed_tier", "flagged_absorbers"]), "carrier attribution": (F.col("carrier_attribution").isNotNull(), ["carrier_attribution", "carrier_top", "carrier_top_fraction", "carrier_top_genus", "carrier_runner_up"]),
    }
    expected = ad.table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample_id"))
    return cohort.summary(expected, "sample_id", [counted, *more], {name: source for name, source in sources.items() if not wanted or name in wanted})


# --- the same in SQL

def _tier(reads: str, genes: str, breadth: str) -> str:
    return TIER.replace("reads", reads).replace("genes", genes).replace("breadth", breadth)


_RANK = "list_position(['negative', 'localized_indeterminate', 'multi_gene', 'broad_island', 'extensive_island'], {})"
_LOCUS = "CASE WHEN n_genes = 0 AND breadth = 0 THEN 'negative' WHEN n_genes >= 10 AND breadth >= 0.15 THEN 'extensive_island' WHEN n_genes >= 8 AND breadth >= 0.075 THEN 'broad_island' WHEN n_genes >= 3 AND breadth >= 0.01 THEN 'multi_gene' ELSE 'localized_indeterminate' END"


def _union(rows: str, by: str) -> str:
    return f"""SELECT {by}, CAST(sum(greatest("end" - greatest(start, coalesce(prev, start)), 0)) AS BIGINT) AS union_bases FROM (SELECT *, max("end") OVER (PARTITION BY {by} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM ({rows}) AS r1) AS r2 GROUP BY {by}"""


_CLIP = 'SELECT sample_id, contig, greatest(start, 5000) AS start, least("end", 45000) AS "end" FROM reads WHERE least("end", 45000) > greatest(start, 5000)'
FACTS = f"""{ad.READS}, {ad.GENE_ROWS},
ov AS (SELECT read_id, gene, CAST(regexp_extract(gene, '[0-9]+') AS INTEGER) - 1 AS bit, bases FROM (SELECT read_id, gene, least("end", r_end) - greatest(start, r_start) AS bases, row_number() OVER (PARTITION BY read_id ORDER BY least("end", r_end) - greatest(start, r_start) DESC, gene) AS r FROM reads JOIN genes ON start < r_end AND "end" > r_start) AS x WHERE r = 1),
rd AS (SELECT r.*, gene, bit, bases, flag & 4 = 0 AS mapped, flag & 1024 = 0 AS unmarked FROM reads AS r LEFT JOIN ov USING (read_id)),
fr AS (SELECT sample_id, fragment_id, count(*) FILTER (gene IS NOT NULL) AS hits, count(*) FILTER (gene IS NOT NULL AND unmarked) AS hits_unmarked, bool_or(mate = 1) AND bool_or(mate = 2) AS paired, bool_or(mapped AND contig = 6) AS off,
  {", ".join(f"max(score) FILTER (mapped AND contig = {k}) AS best_{k}" for k in PANEL)}, coalesce(bit_or(CAST(1 AS BIGINT) << bit), 0) AS genes, CAST(coalesce(sum(bases), 0) AS BIGINT) AS bases,
  max(part % 3) FILTER (contig IN (0, 3)) AS clade, max(mapq) FILTER (contig IN (0, 3)) AS confidence, max(nm) FILTER (contig IN (0, 3)) AS kmers, bool_or(contig IN (0, 3)) AS in_a, bool_or(contig IN (1, 2, 4, 5)) AS listed FROM rd GROUP BY ALL),
tx AS (SELECT *, greatest(best_1, best_4) AS t, greatest(best_2, best_5) AS x FROM fr),
cl AS (SELECT *, CASE WHEN t IS NULL AND x IS NULL THEN 'ambiguous' WHEN x IS NULL OR t > x THEN 'confirmed_true' WHEN t IS NULL OR t < x THEN 'confirmed_decoy' ELSE 'ambiguous' END AS classification FROM tx),
su AS (SELECT *, coalesce(clade = 1 AND confidence >= 10 AND kmers >= 2, FALSE) AND listed AND classification = 'confirmed_true' AS survives FROM cl),
fates AS (SELECT *, CASE WHEN survives THEN 'survived' WHEN NOT listed THEN 'missing_from_arm_b' WHEN classification = 'ambiguous' AND t IS NULL AND x IS NULL THEN 'unaligned' WHEN NOT in_a THEN 'missing_from_arm_a' ELSE 'lost' END AS fate FROM su),
fs AS (SELECT sample_id, count(*) FILTER (hits > 0) AS fragments, count(*) FILTER (hits_unmarked > 0) AS fragments_dedup, count(*) AS evaluated, count(*) FILTER (paired) AS paired_fragments, count(*) FILTER (fate IN ('survived', 'lost')) AS measured, count(*) FILTER (fate = 'survived') AS survived,
  coalesce(bit_or(genes) FILTER (fate = 'survived'), 0) AS survived_genes, CAST(coalesce(sum(bases) FILTER (fate = 'survived'), 0) AS BIGINT) AS survived_bases FROM fates GROUP BY 1),
rs AS (SELECT sample_id, count(*) AS n, count(*) FILTER (flag & 2304 = 0) AS "primary", count(*) FILTER (NOT mapped) AS unmapped, count(*) FILTER (mapped) AS aligned, count(*) FILTER (mapped AND score < 20) AS low_score, count(*) FILTER (mapped AND mapq >= 20) AS passed,
  {", ".join(f"count(*) FILTER (mapped AND score < 20 AND mapq >= {q}) AS {k}" for k, q in RESCUED.items())}, count(*) FILTER ((start < 9000 AND "end" > 8000) OR (start < 20500 AND "end" > 20000) OR (start < 20900 AND "end" > 20300)) AS on_target,
  count(gene) AS hits, count(gene) FILTER (unmarked) AS hits_unmarked, count(DISTINCT gene) AS genes_detected FROM rd GROUP BY 1),
un AS ({_union('SELECT sample_id, start, "end" FROM reads', 'sample_id')}),
cs AS (SELECT sample_id, count(*) FILTER (contig % 2 = 0) AS contigs_one, CAST(coalesce(sum(union_bases) FILTER (contig % 2 = 0), 0) AS BIGINT) AS bases_one, count(*) FILTER (contig % 2 = 1) AS contigs_two, CAST(coalesce(sum(union_bases) FILTER (contig % 2 = 1), 0) AS BIGINT) AS bases_two FROM ({_union(_CLIP, 'sample_id, contig')}) AS c1 WHERE union_bases >= 2000 GROUP BY 1),
evid AS (SELECT rs.*, fs.* EXCLUDE (sample_id), CAST(union_bases AS DOUBLE) / {ad.ISLAND} AS breadth, coalesce(contigs_one, 0) AS contigs_one, coalesce(bases_one, 0) AS bases_one, coalesce(contigs_two, 0) AS contigs_two, coalesce(bases_two, 0) AS bases_two, {_tier('hits', 'genes_detected', f'(CAST(union_bases AS DOUBLE) / {ad.ISLAND})')} AS tier
  FROM rs JOIN fs USING (sample_id) JOIN un USING (sample_id) LEFT JOIN cs USING (sample_id)),
c AS (SELECT sample_id, CAST(sample_id AS VARCHAR) AS key, measured AS n, survived AS hits FROM evid), {bootstrap_sql()},
rec AS (SELECT e.*, CAST(survived AS DOUBLE) / nullif(measured, 0) AS retention, low AS low_bound, bit_count(survived_genes) AS recomputed_genes, least(1.0::DOUBLE, CAST(survived_bases AS DOUBLE) / {ad.ISLAND}) AS recomputed_breadth FROM evid AS e JOIN bounds USING (sample_id)),
rec2 AS (SELECT *, {_tier('survived', 'recomputed_genes', 'recomputed_breadth')} AS recomputed_tier FROM rec),
rec3 AS (SELECT *, {_RANK.format('tier')} - {_RANK.format('recomputed_tier')} AS tier_drop, CASE WHEN evaluated < 10 OR measured < 10 THEN 'UNDERPOWERED' WHEN CAST(evaluated - measured AS DOUBLE) / evaluated > 0.05 THEN 'INCOMPLETE'
  WHEN retention >= 0.8 AND low_bound >= 0.6 AND {_RANK.format('tier')} - {_RANK.format('recomputed_tier')} <= 1 AND bit_count(survived_genes & {sum(1 << NAMES.index(g) for g in OTHER_GENES)}) >= 2 THEN 'SURVIVES' ELSE 'NOT_DISTINGUISHABLE' END AS locus_specificity FROM rec2)"""
BIN_SQL = f"""bg AS (SELECT sample_id, contig, count(*) AS n_genes, bit_or(CAST(1 AS BIGINT) << bit) AS bits FROM (SELECT sample_id, contig, bit FROM rd WHERE gene IS NOT NULL AND mapq >= 30 GROUP BY ALL HAVING count(*) >= 2) AS g GROUP BY ALL),
be AS (SELECT sample_id, contig, count(*) AS records, count(*) FILTER (score = 50) AS prophages, bool_or(nm = 10) AS protected, bool_or(nm = 9) AS trna FROM rd GROUP BY ALL),
b0 AS (SELECT be.*, coalesce(n_genes, 0) AS n_genes, coalesce(bits, 0) AS bits, CAST(union_bases AS DOUBLE) / {ad.ISLAND} AS breadth FROM be JOIN ({_union('SELECT sample_id, contig, start, "end" FROM reads', 'sample_id, contig')}) AS u USING (sample_id, contig) LEFT JOIN bg USING (sample_id, contig)),
b1 AS (SELECT *, {_LOCUS} AS tier FROM b0), b AS (SELECT *, contig < 6 AND tier IN ('extensive_island', 'broad_island', 'multi_gene') AS positive FROM b1)"""
SUMMARY_SQL = f"""WITH {FACTS}, {BIN_SQL},
best AS (SELECT sample_id, contig, n_genes FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY {_RANK.format('tier')} DESC, n_genes DESC, breadth DESC, contig DESC) AS r FROM b WHERE positive) AS x WHERE r = 1),
bs AS (SELECT sample_id, count(*) FILTER (contig < 6) AS bins_total, count(*) FILTER (positive) AS bins_positive, max(tier) FILTER (contig = 6) AS unbinned_tier, CAST(sum(prophages) AS BIGINT) AS prophages, count(*) FILTER (positive AND n_genes >= 3 AND bits & 22 <> 0) AS producers,
  count(*) FILTER (contig < 6 AND prophages > 0) AS with_prophage, bool_or(protected) AS integrase, bool_or(trna) AS trna FROM b GROUP BY 1),
pairs2 AS (SELECT sample_id, fragment_id, unnest([{", ".join(f"{{'c': '{k}', 'g': '{g}', 's': best_{k}}}" for k, g in PANEL.items())}], recursive := true) FROM fr),
tops AS (SELECT *, max(s) OVER (PARTITION BY sample_id, fragment_id) AS most, row_number() OVER (PARTITION BY sample_id, fragment_id ORDER BY s DESC, c) AS place FROM pairs2 WHERE s IS NOT NULL),
calls AS (SELECT sample_id, fragment_id, CASE WHEN count(*) FILTER (s = most) = 1 THEN 'attributed' ELSE 'ambiguous' END AS call, max(c) FILTER (place = 1) AS top, count(DISTINCT g) FILTER (s = most) AS n_genera, min(g) FILTER (s = most) AS genus FROM tops GROUP BY ALL),
ct AS (SELECT sample_id, top AS k, count(*) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY count(*) DESC, top) AS i FROM calls WHERE call = 'attributed' GROUP BY sample_id, top),
gt AS (SELECT sample_id, genus AS k, count(*) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY count(*) DESC, genus) AS i FROM calls WHERE n_genera = 1 GROUP BY sample_id, genus),
ca AS (SELECT f.sample_id, (SELECT count(*) FROM calls AS x WHERE x.sample_id = f.sample_id) AS n_mapped, (SELECT CAST(sum(n) AS BIGINT) FROM ct WHERE ct.sample_id = f.sample_id) AS attributed, (SELECT CAST(sum(n) AS BIGINT) FROM gt WHERE gt.sample_id = f.sample_id) AS genus_attributed FROM fs AS f),
cc AS (SELECT ca.sample_id, one.k AS carrier_top, CAST(one.n AS DOUBLE) / attributed AS carrier_top_fraction, g.k AS carrier_top_genus, two.k AS carrier_runner_up, CASE WHEN attributed >= 10 AND one.n >= 0.8 * attributed THEN 'CARRIER_ATTRIBUTED' WHEN genus_attributed >= 10 AND g.n >= 0.8 * genus_attributed THEN 'CARRIER_GENUS_ONLY' WHEN n_mapped < 10 THEN 'CARRIER_UNDETERMINED' ELSE 'CARRIER_AMBIGUOUS' END AS carrier_attribution
  FROM ca LEFT JOIN ct AS one ON one.sample_id = ca.sample_id AND one.i = 1 LEFT JOIN ct AS two ON two.sample_id = ca.sample_id AND two.i = 2 LEFT JOIN gt AS g ON g.sample_id = ca.sample_id AND g.i = 1),
lost AS (SELECT sample_id, coalesce(CASE WHEN x = best_5 THEN '5' WHEN x = best_2 THEN '2' END, CASE WHEN classification = 'confirmed_true' THEN 'arm_a_not_confirmed' ELSE 'no_decoy_alignment' END) AS absorber, count(*) AS n, count(*) FILTER (classification = 'ambiguous' OR coalesce(abs(t - x) <= 5, FALSE)) AS near FROM fates WHERE fate = 'lost' GROUP BY ALL),
ab AS (SELECT sample_id, string_agg(absorber, ';' ORDER BY absorber) AS flagged_absorbers FROM (SELECT *, sum(n) OVER (PARTITION BY sample_id) AS total FROM lost) AS x WHERE CAST(n AS DOUBLE) / total > 0.2 AND near > 0 GROUP BY 1),
ty AS (SELECT user_id AS sample_id, CASE WHEN event_type = 'purchase' THEN 'typed' WHEN event_type = 'click' THEN 'insufficient_loci' ELSE 'novel_allele_combination' END AS typing_status, CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS sequence_type
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type <> 'purchase', event_id) AS r FROM events) AS x WHERE r = 1),
tr AS (SELECT sample_id, count(*) FILTER (n >= 5) AS transcripts FROM (SELECT sample_id, gene, count(*) AS n FROM rd WHERE gene IS NOT NULL GROUP BY ALL) AS x GROUP BY 1),
m AS (SELECT s_suppkey AS sample_id, ['wgs', 'metagenome', 'wes', 'rna'][CAST(s_suppkey % 4 AS INTEGER) + 1] AS mode, ['on_auto_bwa_mem', 'off_requested', 'NA'][CAST(s_suppkey % 3 AS INTEGER) + 1] AS extraction FROM supplier),
v AS (SELECT m.sample_id, mode, extraction, e.* EXCLUDE (sample_id), {_tier('fragments', 'genes_detected', 'breadth')} AS tf, {_tier('hits_unmarked', 'genes_detected', 'breadth')} AS td, {_tier('fragments_dedup', 'genes_detected', 'breadth')} AS tfd, CASE WHEN m.sample_id % 5 > 0 THEN passed ELSE aligned END AS depleted,
  greatest(bases_one / 40000.0::DOUBLE, bases_two / 40000.0::DOUBLE) AS most, least(bases_one / 40000.0::DOUBLE, bases_two / 40000.0::DOUBLE) AS lesser, n IS NOT NULL AS known FROM m LEFT JOIN rec3 AS e USING (sample_id)),
w AS (SELECT *, known AND mode IN ('wgs', 'metagenome') AS tiers, known AND mode = 'wgs' AS wgs, known AND mode = 'wes' AS wes, known AND mode = 'rna' AS rna, known AND sample_id % 7 > 0 AS qc, known AND sample_id % 5 < 4 AS built, known AND mode = 'metagenome' AS meta FROM v)
SELECT w.sample_id, CASE WHEN known THEN mode END AS mode, CASE WHEN known THEN CASE mode WHEN 'wgs' THEN 'WGS genomic evidence tier' WHEN 'metagenome' THEN 'Metagenome read evidence (not tiered)' WHEN 'wes' THEN 'WES off-target DNA evidence (not tiered)' ELSE 'RNA expression evidence (not tiered)' END END AS evidence_label,
  CASE WHEN known THEN CASE WHEN w.sample_id % 13 = 0 THEN 'excluded_low_input' WHEN passed = 0 THEN 'failed_at_host_depletion' WHEN mode <> 'wgs' THEN 'completed_untiered' WHEN tier IN ('extensive_island', 'broad_island', 'multi_gene') THEN 'completed_positive' ELSE 'completed_negative' END END AS terminal_state,
  {", ".join(f'CASE WHEN qc THEN {a} END AS {b}' for a, b in (("n", "n"), ('"primary"', '"primary"'), ("unmapped", "unmapped"), ("low_score", "low_score"), ("aligned", "aligned"), ("passed", "passed"), ("extraction", "extraction")))}, {", ".join(f"CASE WHEN qc AND prefix(extraction, 'on') THEN {k} END AS {k}" for k in RESCUED)},
  CASE WHEN wes THEN on_target END AS on_target, CASE WHEN wes THEN CAST(on_target AS DOUBLE) / nullif(aligned, 0) END AS on_target_fraction, CASE WHEN wgs THEN tier WHEN meta THEN 'untiered' END AS read_evidence, {", ".join(f"CASE WHEN tiers THEN {k} END AS {k}" for k in ("hits", "genes_detected", "breadth"))},
  CASE WHEN meta THEN depleted END AS host_depleted_reads, CASE WHEN meta THEN CASE WHEN w.sample_id % 5 > 0 THEN 'pangenome' ELSE 't2t_phix' END END AS host_depleted_stage, CASE WHEN meta AND depleted > 0 THEN hits * 1e6::DOUBLE / depleted END AS reads_per_million,
  {", ".join(f"CASE WHEN wgs THEN {a} END AS {b}" for a, b in (("fragments", "fragments"), ("tf", "tier_if_fragments"), ("hits_unmarked", "hits_unmarked"), ("td", "tier_if_dedup"), ("fragments_dedup", "fragments_dedup"), ("tfd", "tier_if_fragments_dedup"), ("CASE WHEN tf = tier AND td = tier AND tfd = tier THEN 'stable' ELSE 'unstable' END", "tier_robustness")))},
  {", ".join(f"CASE WHEN {k} THEN {a} END AS {k}_{b}" for k in ("wes", "rna") for a, b in (("hits", "reads"), ("genes_detected", "genes"), ("breadth", "breadth")))}, CASE WHEN rna THEN transcripts END AS transcripts, CASE WHEN rna THEN CAST(unmapped AS DOUBLE) / n END AS rna_residual_human_fraction,
  CASE WHEN built THEN CASE WHEN most >= 0.9 THEN 'complete_island' WHEN most >= 0.75 THEN 'near_complete_island' WHEN most >= 0.2 THEN 'fragmented_island' WHEN most >= 0.05 THEN 'partial_island' WHEN most > 0 THEN 'limited_contig_support' ELSE 'read_evidence_only' END END AS final_structural_evidence,
  CASE WHEN built THEN CASE WHEN most = 0 THEN 'no_contig_support' WHEN lesser = 0 THEN 'single_assembler_only' WHEN abs(bases_one / 40000.0::DOUBLE - bases_two / 40000.0::DOUBLE) <= 0.2 THEN 'concordant' ELSE 'discordant' END END AS assembler_agreement,
  {", ".join(f"CASE WHEN built THEN {a} END AS {b}" for a, b in (("contigs_one", "contigs_one"), ("bases_one", "bases_one"), ("contigs_two", "contigs_two"), ("bases_two", "bases_two"), ("evaluated", "recruited_fragments"), ("paired_fragments", "paired_fragments")))},
  {", ".join(f"CASE WHEN bins_total > 0 THEN {a} END AS {b}" for a, b in (("bins_total", "bins_total"), ("bins_positive", "bins_positive"), ("['o__Enterobacterales', 'o__Bacteroidales', 'unclassified'][CAST(best.contig % 3 AS INTEGER) + 1]", "bin_taxonomy"), ("best.contig * 10 + 40", "bin_completeness"), ("coalesce(best.n_genes, 0)", "bin_genes"), ("unbinned_tier", "unbinned_tier"), ("unbinned_tier IN ('extensive_island', 'broad_island', 'multi_gene')", "unbinned_positive"), ("prophages", "prophages"), ("producers", "producers"), ("producers * bins_total", "neighbours"), ("producers * with_prophage", "neighbours_with_prophage"), ("integrase", "integrase"), ("trna", "trna")))},
  typing_status, sequence_type, {", ".join(f"CASE WHEN wgs THEN {k} END AS {k}" for k in ("locus_specificity", "retention", "recomputed_tier", "flagged_absorbers"))}, carrier_attribution, carrier_top, carrier_top_fraction, carrier_top_genus, carrier_runner_up,
  concat_ws(';', {", ".join(f"CASE WHEN NOT coalesce({c}, FALSE) THEN '{name}' END" for name, c in (("mode", "known"), ("terminal state", "known"), ("read profiling", "qc"), ("low-score rescue", "qc AND prefix(extraction, 'on')"), ("WES QC", "wes"), ("evidence tier", "tiers"), ("tier robustness", "wgs"), ("WES evidence", "wes"), ("RNA evidence", "rna"), ("contig reassembly", "built"), ("draft genomes", "bins_total > 0"), ("community context", "bins_total > 0"), ("strain typing", "typing_status IS NOT NULL"), ("locus specificity", "wgs"), ("carrier attribution", "carrier_attribution IS NOT NULL")))}) AS missing
FROM w LEFT JOIN bs USING (sample_id) LEFT JOIN best USING (sample_id) LEFT JOIN cc USING (sample_id) LEFT JOIN ab USING (sample_id) LEFT JOIN ty USING (sample_id) LEFT JOIN tr USING (sample_id)"""


@query("j21_master_summary", SUMMARY_SQL)
def j21(spark, d):
    return summary_of(spark, d)


@query("a24_recomputed", f"WITH {FACTS} SELECT sample_id, evaluated, measured, survived, retention, low_bound AS low, CAST(recomputed_genes AS BIGINT) AS recomputed_genes, recomputed_breadth, recomputed_tier, CAST(tier_drop AS INTEGER) AS tier_drop, locus_specificity FROM rec3")
def a24(spark, d):
    out = evidence_of(read_facts(spark, d, *COUNTED_FROM))
    names = ["evaluated", "measured", "survived", "retention", "low", "recomputed_genes", "recomputed_breadth", "recomputed_tier", "tier_drop", "locus_specificity"]
    return out.withColumn("tier_drop", F.col("tier_drop").cast("int")).select("sample_id", *names)


@query("a27_best_locus", f"WITH {FACTS}, {BIN_SQL} SELECT sample_id, contig AS best_bin, tier, n_genes, breadth FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY {_RANK.format('tier')} DESC, n_genes DESC, breadth DESC, contig DESC) AS r FROM b WHERE positive) AS x WHERE r = 1")
def a27(spark, d):
    bins = bins_of(read_facts(spark, d, "position", "gene")).where((F.col("contig") < 6) & F.col("tier").isin(POSITIVE))
    place = F.struct(rules.tier_rank(F.col("tier")), "n_genes", "breadth", "contig")
    return bins.groupBy("sample_id").agg(F.max_by(F.struct(F.col("contig").alias("best_bin"), "tier", "n_genes", "breadth"), place).alias("b")).select("sample_id", "b.*")


@query("a34_qc_rollup", f"WITH s AS ({SUMMARY_SQL}) SELECT count(rescued_all) AS traced, " + ", ".join(f"CAST(coalesce(sum({k}) FILTER (rescued_all IS NOT NULL), 0) AS BIGINT) AS sum_{k}" for k in RESCUED) + ", count(*) FILTER (extraction <> 'NA') AS with_mode, count(*) FILTER (prefix(extraction, 'on')) AS rescued, count(*) FILTER (prefix(extraction, 'off')) AS not_rescued, count(*) FILTER (prefix(extraction, 'on')) > 0 AND count(*) FILTER (prefix(extraction, 'off')) > 0 AS mixed, count(tier_robustness) AS tiered, count(*) FILTER (tier_robustness = 'stable') AS stable, count(*) FILTER (tier_robustness = 'unstable') AS unstable FROM s")
def a34(spark, d):
    return cohort.tallied(summary_of(spark, d, COUNTED), list(RESCUED), "extraction", "tier_robustness")
