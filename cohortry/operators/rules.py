"""Classification cascades as ordered conditional expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.functions import scalars as fn

#: Tiers with the least reads, genes and breadth that each needs, strongest first.
TIERS = [("extensive_island", 100, 10, 0.15), ("broad_island", 30, 8, 0.075), ("multi_gene", 5, 3, 0.01)]


def cascade(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first rule that holds."""
    end = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return reduce(lambda out, rule: F.when(rule[0], rule[1]).otherwise(out), reversed(rules), end)


#: Classes of reference sequences and the names that belong to them, in the order in which they are tried.
CONTIG_CATEGORIES = [
    ("canonical", r"^(chr)?([1-9]|1[0-9]|2[0-2]|X|Y)$"),
    ("mito", r"^(chr)?(M|MT)$"),
    ("alt", r"_alt$"),
    ("decoy", r"_decoy$|^hs37d5$|^HLA-"),
    ("viral", r"(?i)^(chr)?(EBV|NC_007605|HPV|HBV|HCV|HIV|KSHV|HTLV|CMV|HHV|MCPyV|SV40)"),
    ("unplaced", r"_random$|^(chr)?Un_|^(GL|KI|JH)[0-9]"),
]


def read_tier(reads: Column, genes: Column, breadth: Column, tiers=TIERS) -> Column:
    """negative without reads; else the strongest tier that all three reach, or localized_indeterminate."""
    for strong, weak in zip(tiers, tiers[1:], strict=False):
        if any(a < b for a, b in zip(strong[1:], weak[1:], strict=True)):
            raise ValueError(f"thresholds of {strong[0]} are below those of {weak[0]}")
    rules = [((reads >= r) & (genes >= g) & (breadth >= b), name) for name, r, g, b in tiers]
    return cascade([(reads == 0, "negative"), *rules], "localized_indeterminate")


def locus_tier(genes: Column, breadth: Column, tiers=TIERS) -> Column:
    """The same without reads: negative only if both are 0."""
    return cascade([((genes == 0) & (breadth == 0), "negative"), *[((genes >= g) & (breadth >= b), name) for name, _, g, b in tiers]], "localized_indeterminate")


def outcome(tier: Column) -> Column:
    """Only a formal tier is positive; localized_indeterminate is none."""
    return cascade([(tier.isNull() | (tier == "untiered"), "untiered"), (tier.isin([name for name, *_ in TIERS]), "positive")], "negative")


def structural_call(one: Column, two: Column) -> Column:
    """What two assemblies show of the island, by the better one, and whether they agree: struct of call and agreement."""
    best, least = F.greatest(one, two), F.least(one, two)
    call = cascade([(best >= 0.9, "complete_island"), (best >= 0.75, "near_complete_island"), (best >= 0.2, "fragmented_island"), (best >= 0.05, "partial_island"), (best > 0, "limited_contig_support")], "read_evidence_only")
    agreement = cascade([(best == 0, "no_contig_support"), (least == 0, "single_assembler_only"), (F.abs(one - two) <= 0.2, "concordant")], "discordant")
    return F.struct(call.alias("call"), agreement.alias("agreement"))


def assembly_diagnostic(fragments: Column, breadth: Column) -> Column:
    """Why an assembly came out as it did, from the fragments that support the island."""
    return cascade([(fragments.isNull(), "recruitment_classes_unavailable"), (fragments == 0, "no_island_supporting_fragments"), (breadth > 0, "island_contigs_recovered")], "island_fragments_no_contig")


def recruitment_class(pos: Column, cigar: Column, mapq: Column, nm: Column, left: int, right: int, *, matched: int = 60, identity: float = 0.9, coverage: float = 0.8, least_mapq: int = 20, tolerance: int = 10) -> Column:
    """struct of class and reason for an alignment at 1-based ``pos``; the island is ``left`` to ``right``, both included.

    Too weak alignments are rejected first. Then: bases on both sides of a border, or an end at a border with a clip
    beyond it, span it; the rest is inside or flanking if enough of the read is aligned.
    """
    steps = fn.cigar_steps(cigar)
    same, span = fn.cigar_sum(steps, "M=X"), fn.reference_span(steps)
    aligned = same + fn.cigar_sum(steps, "I")
    end = pos + span - 1
    inside = F.greatest(F.least(end, F.lit(right)) - F.greatest(pos, F.lit(left)) + 1, F.lit(0))
    at_left = (F.abs(pos - left) <= tolerance) & (fn.clip(cigar, "left") > tolerance)
    at_right = (F.abs(end - right) <= tolerance) & (fn.clip(cigar, "right") > tolerance)
    enough = F.coalesce(F.try_divide(aligned, fn.read_length(steps)), F.lit(0.0)) >= coverage
    made = lambda name, reason=None: F.struct(F.lit(name).alias("class"), F.lit(reason).cast("string").alias("reason"))
    return cascade(
        [
            (steps.isNull(), made("rejected", "unmapped")),
            (mapq < least_mapq, made("rejected", "low_mapq")),
            (same < matched, made("rejected", "short_alignment")),
            (F.coalesce(F.try_divide(same - nm, same), F.lit(0.0)) < identity, made("rejected", "low_identity")),
            ((inside > tolerance) & (span - inside > tolerance), made("boundary_spanning")),
            ((inside > tolerance) & (at_left | at_right), made("boundary_spanning")),
            ((inside > tolerance) & enough, made("island_internal")),
            (~(inside > tolerance) & enough, made("flank_only")),
        ],
        made("rejected", "low_query_coverage"),
    )


def favoured(one: Column, two: Column, margin: int = 0) -> Column:
    """true or decoy by the better score; ambiguous within the margin or without either."""
    lead = one - two
    return cascade([(one.isNull() & two.isNull(), "ambiguous"), (two.isNull(), "true"), (one.isNull(), "decoy"), (lead > margin, "true"), (lead < -margin, "decoy")], "ambiguous")


def favoured_with_mismatches(one: Column, nm_one: Column, two: Column, nm_two: Column) -> Column:
    """By score, then by fewer mismatches; unknown or equal mismatches stay ambiguous."""
    by_score = favoured(one, two)
    return cascade([(by_score != "ambiguous", by_score), (one.isNull(), "ambiguous"), (nm_one < nm_two, "true"), (nm_one > nm_two, "decoy")], "ambiguous")


def confirmed(first: Column, second: Column) -> Column:
    return cascade([((first == "true") & (second == "true"), "confirmed_true"), ((first == "decoy") & (second == "decoy"), "confirmed_decoy")], "ambiguous")


def typing_status(alleles: Column, type_: Column, loci: int = 7) -> Column:
    """Only exact alleles at all loci can name a type."""
    exact = F.size(F.filter(alleles, lambda a: allele_state(a) == "exact"))
    return cascade([(exact < loci, "insufficient_loci"), (type_.isNull(), "novel_allele_combination")], "typed")


def retention_verdict(evaluated: Column, measured: Column, retention: Column, low: Column, drop: Column, genes: Column) -> Column:
    """Whether a locus survives the challenge: enough reads, nearly all of them measured, most kept (with ``low``, the lower
    bound of the interval), the tier at most one lower, and genes outside the megasynthases still covered."""
    unmeasured = (evaluated - measured) / evaluated
    survives = (retention >= 0.8) & (low >= 0.6) & (drop <= 1) & (genes >= 2)
    return cascade([((evaluated < 10) | (measured < 10), "UNDERPOWERED"), (unmeasured > 0.05, "INCOMPLETE"), (survives, "SURVIVES")], "NOT_DISTINGUISHABLE")


def tier_rank(tier: Column, tiers=TIERS) -> Column:
    """Place of a read tier, from 0 for negative."""
    order = [*[name for name, *_ in tiers], "localized_indeterminate", "negative"]
    return cascade([(tier == name, place) for place, name in enumerate(reversed(order))])


def contig_category(name: Column) -> Column:
    """The class of a reference sequence by its name; the order decides."""
    return cascade([(name.rlike(pattern), kind) for kind, pattern in CONTIG_CATEGORIES], "other")


def allele_state(allele: Column) -> Column:
    return cascade([(allele.isNull() | F.trim(allele).isin("-", "", "?", "NA"), "missing"), (allele.startswith("~") | allele.endswith("?"), "inexact")], "exact")


def carrier_verdict(attributed: Column, top: Column, genus_attributed: Column, top_genus: Column, mapped: Column, *, least: int = 10, share: float = 0.8) -> Column:
    """Whether a sample's reads name a carrier, only its genus, neither, or are too few: reads attributed to one carrier,
    those of the first carrier, the same for genera, and reads that aligned to the panel at all."""
    enough = lambda n, first: (n >= least) & (first >= share * n)
    return cascade([(enough(attributed, top), "CARRIER_ATTRIBUTED"), (enough(genus_attributed, top_genus), "CARRIER_GENUS_ONLY"), (mapped < least, "CARRIER_UNDETERMINED")], "CARRIER_AMBIGUOUS")


def read_fate(survives: Column, listed: Column, classification: Column, scored: Column, in_first_arm: Column) -> Column:
    """What the challenge says of an evaluated read: survived, lost, or one of the kinds of not measured."""
    return cascade(
        [(survives, "survived"), (~listed, "missing_from_arm_b"), ((classification == "ambiguous") & ~scored, "unaligned"), (~in_first_arm, "missing_from_arm_a")],
        "lost",
    )


def absorber(b1: Column, b2: Column, classification: Column) -> Column:
    """The decoy that a lost read went to; reads without a decoy alignment are named by what they lost on."""
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(blank(b1), blank(b2), F.when(classification == "confirmed_true", "arm_a_not_confirmed").otherwise("no_decoy_alignment"))


def near_threshold(classification: Column, lead: Column, margin: float) -> Column:
    return (classification == "ambiguous") | F.coalesce(F.abs(lead) <= margin, F.lit(False))


def reference_status(coverage: Column, identity: Column, consensus: Column, group: Column, lead: Column) -> Column:
    """unresolved under half coverage or 0.9 identity; confident if the near-best agree with the best one's group and no other
    group is within 0.02 of its score; else ambiguous."""
    return cascade([((coverage < 0.5) | (identity < 0.9), "unresolved"), ((consensus == group) & (lead >= 0.02), "confident")], "ambiguous")


#: What the evidence of each mode may be read as.
EVIDENCE_LABELS = {
    "metagenome": "Metagenome read evidence (not tiered)",
    "wes": "WES off-target DNA evidence (not tiered)",
    "rna": "RNA expression evidence (not tiered)",
}


def evidence_label(mode: Column, tier: Column) -> Column:
    """What a row's evidence may be read as, by its mode; only wgs has tiers, and long reads have none there either."""
    wgs = F.when(tier == "untiered", "WGS evidence (not tiered: long-read)").otherwise("WGS genomic evidence tier")
    return cascade([(mode == "wgs", wgs), *[(mode == m, label) for m, label in EVIDENCE_LABELS.items()]], "NA")


def robustness(tier: Column, variants: list[Column]) -> Column:
    """stable if every other way of counting gives the same tier; null without a tier or without a variant."""
    same = reduce(lambda a, b: a & b, [v == tier for v in variants])
    return F.when(tier.isNotNull() & (tier != "untiered"), F.when(same, "stable").otherwise("unstable"))


def divergence_notes(raw: Column, variants: dict[str, Column]) -> Column:
    """struct of verdict, PASS or FLAG, and notes: the variants whose tier is another than the raw one's."""
    notes = F.filter(F.array(*[F.when(v != raw, F.concat(F.lit(f"{name}: "), raw, F.lit(" -> "), v)) for name, v in variants.items()]), lambda x: x.isNotNull())
    return F.struct(F.when(F.size(notes) == 0, "PASS").otherwise("FLAG").alias("verdict"), notes.alias("notes"))


def clade_confirmed(clade: Column, confidence: Column, kmers: Column, *, target, least_confidence, least_kmers) -> Column:
    """Whether the first arm confirms a read; a read that it lacks is not confirmed."""
    return F.coalesce((clade == target) & (confidence >= least_confidence) & (kmers >= least_kmers), F.lit(False))


def locus_class(genes: Column, tier: Column, positive: list[str], least: int = 3, all_genes: int = 19, near: int = 15, resistance: str = "clbS") -> Column:
    """What a bin's genes and the tier of its own alignment make of it; null without genes."""
    n = F.size(genes)
    return cascade(
        [
            (n == 0, None), ((n == 1) & F.array_contains(genes, resistance), "clbS_only_possible_resistance"), (n < least, "isolated_or_low_evidence_clb_hits"), (~F.coalesce(tier.isin(positive), F.lit(False)), "hmm_candidate_locus_not_confirmed"),
            (n < near, "partial_pks_candidate"), (n < all_genes, "near_complete_pks_candidate"),
        ],
        "complete_pks_candidate",
    )


def susceptibility(protected: Column, rec_a: Column, lex_a: Column) -> Column:
    return cascade([(protected, "lower"), (rec_a & lex_a, "plausible")], "uncertain")


def bins_outcome(contigs: Column, bins: Column, positive: Column) -> Column:
    return cascade([(contigs == 0, "no_contigs"), (bins == 0, "contigs_no_bins"), (positive == 0, "bins_no_pks")], "pks_positive_bins")


def taxonomy_status(species: Column, species_reads: Column, island_reads: Column) -> Column:
    return cascade([(island_reads == 0, "no_pks_reads"), (species > 0, "species_identified"), (species_reads < 2, "below_rank_threshold")], "no_species_identified")


def low_score_state(request: Column, evidence: Column) -> Column:
    """What extraction did about low scores; with auto and a program line that hides which aligner ran, the query fails."""
    refused = F.raise_error(F.lit("a bwa program line without its command: say on or off")).cast("string")
    return cascade([(request == "on", "on_requested"), (request == "off", "off_requested"), (evidence == "yes", "on_auto_bwa_mem"), (evidence == "not_mem", "off_auto_no_as_tag"), (evidence == "no_cl", refused)], "off_auto_not_bwa_mem")


def panel_admission(coverage: Column, role: Column) -> Column:
    """Decoys carry less than a tenth of the island, carriers half of it at least; all others stay listed as rejected."""
    return cascade([((role == "decoy") & (coverage < 0.1), "admitted_decoy"), ((role == "carrier") & (coverage >= 0.5), "admitted_carrier")], "rejected")


def unexpected_taxon(taxonomy: Column, expected: str = "Enterobacterales") -> Column:
    """Classified, but not as expected; unclassified is unknown and not unexpected."""
    return ~taxonomy.isin("unclassified", "", "NA", "gtdbtk_failed") & ~taxonomy.contains(expected)


def audit_reason(tier: Column) -> Column:
    """Why a sample is audited; null for those that are drawn or left."""
    return cascade([(tier.isin([name for name, *_ in TIERS]), "positive"), (tier == "localized_indeterminate", "near_miss")])
