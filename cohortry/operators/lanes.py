"""Tables of a cohort: carriers, specificity, bins and their community, quality and reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import counting, intervals, numbering, ranking, rules


def carrier_reads(records: DataFrame, panel: DataFrame, key: list[str], *, contig: str = "contig", score: str = "score", least_lead: int = 1, margin: int = 0) -> DataFrame:
    """One row a read: the call of ``ranking.carrier_calls`` over its best score for each carrier of the panel (contig,
    carrier, genus), the genera of its tied carriers, or unmapped, or off_map if it aligned to contigs outside it only.

    ``records`` have ``mapped``, whether the record is aligned. Records without a score count as aligned, not as hits."""
    met = records.join(panel, contig, "left").withColumn("hit", F.col("mapped") & F.col("carrier").isNotNull() & F.col(score).isNotNull())
    best = met.where("hit").groupBy(*key, "carrier").agg(F.max(score).alias(score))
    calls = ranking.carrier_calls(best, key, "carrier", score, least_lead=least_lead, margin=margin)
    genus = panel.groupBy("carrier").agg(F.min("genus").alias("genus"))
    tied = calls.select(*key, F.explode("tied").alias("carrier")).join(genus, "carrier").groupBy(*key).agg(F.array_sort(F.collect_set("genus")).alias("genera"))
    seen = met.groupBy(*key).agg(F.max(F.col("mapped") & F.col("carrier").isNull()).alias("off"))
    out = seen.join(calls, key, "left").join(tied, key, "left")
    return out.withColumn("call", F.coalesce("call", F.when(F.col("off"), "off_map").otherwise("unmapped"))).drop("off")


def carrier_summary(calls: DataFrame, by: list[str]) -> DataFrame:
    """Counts of a sample's reads by call, its first and second carrier, first genus, the genus sets that reads could not
    separate, and the verdict."""
    kind = lambda k: F.count_if(F.col("call") == k)
    totals = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("n_reads"), kind("attributed").alias("n_attributed"), kind("ambiguous").alias("n_ambiguous"), kind("unmapped").alias("n_unmapped"), kind("off_map").alias("n_off_map"))

    def ranked(rows: DataFrame, name: str, out: str) -> DataFrame:
        counts = rows.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))
        held = counts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(name).cast("string").alias("k")))).alias(out))
        return held

    carriers = ranked(calls.where("call = 'attributed'").withColumn("k", F.col("top")), "k", "_c")
    mapped = calls.where("genera is not null")
    genera = ranked(mapped.where(F.size("genera") == 1).withColumn("k", F.col("genera")[0]), "k", "_g")
    sets = ranked(mapped.where(F.size("genera") > 1).withColumn("k", F.array_join("genera", "+")), "k", "_t")
    out = reduce(lambda a, b: a.join(b, by, "left"), [carriers, genera, sets], totals)
    first = lambda c, i: F.get(c, F.lit(i))
    n_of = lambda c, i: F.coalesce(-first(c, i)["n"], F.lit(0).cast("long"))
    shown = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: F.concat(x["k"], F.lit(":"), (-x["n"]).cast("string"))), ";"), F.lit(""))
    all_of = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda t, x: t - x["n"]), F.lit(0).cast("long"))
    out = out.select(
        *by, "n_reads", "n_attributed", "n_ambiguous", "n_unmapped", "n_off_map", (F.col("n_attributed") + F.col("n_ambiguous")).alias("n_mapped"), first("_c", 0)["k"].alias("top_carrier"), n_of("_c", 0).alias("top_carrier_reads"),
        first("_c", 1)["k"].alias("runner_up_carrier"), n_of("_c", 1).alias("runner_up_reads"), first("_g", 0)["k"].alias("top_genus"), n_of("_g", 0).alias("top_genus_reads"), all_of("_g").alias("genus_attributed"), shown("_c").alias("carrier_reads"),
        shown("_g").alias("genus_reads"), shown("_t").alias("tied_genus_sets"),
    )
    verdict = rules.carrier_verdict(F.col("n_attributed"), F.col("top_carrier_reads"), F.col("genus_attributed"), F.col("top_genus_reads"), F.col("n_mapped"))
    return out.withColumn("verdict", verdict)


def retention(fates: DataFrame, by: list[str]) -> DataFrame:
    """Evaluated, measured and surviving reads, each kind of unmeasured, and the shares of them."""
    n = lambda k: F.count_if(F.col("fate") == k)
    kinds = ["missing_from_arm_b", "unaligned", "missing_from_arm_a"]
    out = fates.groupBy(*by).agg(F.count(F.lit(1)).alias("n_evaluated"), n("survived").alias("n_survived"), n("lost").alias("n_lost"), *[n(k).alias(f"n_{k}") for k in kinds])
    out = out.withColumn("n_measured", F.col("n_survived") + F.col("n_lost"))
    share = lambda a, b: F.coalesce(counting.share(F.col(a), F.col(b)), F.lit(0.0))
    return out.withColumns({"retention": share("n_survived", "n_measured"), "retention_if_unmeasured_lost": share("n_survived", "n_evaluated")}).withColumn("unmeasured_fraction", F.coalesce(counting.share(F.col("n_evaluated") - F.col("n_measured"), F.col("n_evaluated")), F.lit(0.0)))


def absorbers(lost: DataFrame, by: list[str], *, share: float = 0.2) -> DataFrame:
    """Decoys that lost reads went to (absorber, near): reads, those near the threshold, share of a sample's lost reads, and
    whether both ask for a look by hand. The sample's total comes from the counts, not from the reads."""
    counts = lost.groupBy(*by, "absorber").agg(F.count(F.lit(1)).alias("reads"), F.count_if("near").alias("near_threshold"))
    total = F.sum("reads").over(Window.partitionBy(*by))
    out = counts.withColumn("fraction", F.col("reads").cast("double") / total)
    return out.withColumn("flagged", (F.col("fraction") > share) & (F.col("near_threshold") > 0))


def recomputed_breadth(overlaps: DataFrame, exact: DataFrame, by: list[str], length: int) -> DataFrame:
    """Breadth of a sample's surviving reads: the exact one (breadth) where a depth was taken, else overlaps over the length."""
    near = overlaps.groupBy(*by).agg(F.sum("bases").cast("long").alias("bases"))
    met = near.join(exact, by, "full")
    approximate = F.least(F.lit(1.0), F.coalesce(F.col("bases"), F.lit(0)).cast("double") / length)
    return met.select(*by, F.coalesce("breadth", approximate).alias("breadth"), F.when(F.col("breadth").isNotNull(), "exact").otherwise("approximate").alias("source"))


def reference_ranking(hits: DataFrame, by: list[str], length: int) -> DataFrame:
    """References (reference, group) of each query by coverage x identity: hits have start and end on the reference, matches
    and block. Equal scores rank by coverage, identity, name."""
    covered = intervals.union_length(hits, [*by, "reference"])
    sums = hits.groupBy(*by, "reference").agg(F.min("group").alias("group"), F.sum("matches").cast("long").alias("matches"), F.sum("block").cast("long").alias("block"))
    out = sums.join(covered, [*by, "reference"]).withColumns({"coverage": F.col("union_bases").cast("double") / length, "identity": F.coalesce(counting.share(F.col("matches"), F.col("block")), F.lit(0.0))})
    out = out.withColumn("score", F.col("coverage") * F.col("identity"))
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("coverage"), F.desc("identity"), "reference")
    return out.withColumn("place", F.row_number().over(w))


def reference_call(ranked: DataFrame, by: list[str], *, top: int = 5, near: float = 0.98) -> DataFrame:
    """The best reference of each query, its runner-ups, the group that the near-best share, and the status."""
    w = Window.partitionBy(*by)
    best = lambda c: F.max(F.when(F.col("place") == 1, F.col(c))).over(w)
    held = ranked.withColumns({"_s": best("score"), "_g": best("group")})
    named = ~F.coalesce(F.col("group").isin("", "NA"), F.lit(True))
    close = (F.col("place") <= top) & (F.col("score") >= F.col("_s") * near) & named
    one = lambda c: F.max(F.when(F.col("place") == 1, F.col(c))).alias(c)
    out = held.groupBy(*by).agg(
        one("reference"), one("group"), one("coverage"), one("identity"), one("score"), F.max(F.when(F.col("place") == 2, F.col("score"))).alias("_second"), F.max(F.when(F.col("group") != F.col("_g"), F.col("score"))).alias("_other"), F.array_sort(F.collect_set(F.when(close, F.col("group")))).alias("_near"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("place") > 1) & (F.col("place") <= top), F.struct("place", "reference")))), lambda x: x["reference"].cast("string")), ";").alias("runner_ups"),
    )
    consensus = F.when(F.size("_near") == 1, F.col("_near")[0]).when(F.size("_near") > 1, "ambiguous").otherwise("NA")
    lead = lambda c: F.col("score") - F.coalesce(F.col(c), F.lit(0.0))
    out = out.withColumns({"consensus": consensus, "lead": lead("_second")})
    return out.withColumn("status", rules.reference_status(F.col("coverage"), F.col("identity"), F.col("consensus"), F.col("group"), lead("_other"))).drop("_second", "_other", "_near")


def context_flags(rows: DataFrame, by: list[str], flags: list[str], listed: str, separator: str = ";") -> DataFrame:
    """Whether any row of a group has each flag, and the sorted distinct items of a separated list."""
    items = F.filter(F.transform(F.split(F.coalesce(F.col(listed), F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")
    rows = rows.select(*by, *flags, F.explode_outer(items).alias("_i"))
    return rows.groupBy(*by).agg(*[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags], F.array_join(F.array_sort(F.collect_set("_i")), separator).alias(listed))


def bin_table(quality: DataFrame, taxonomy: DataFrame, *others: DataFrame, on: list[str]) -> DataFrame:
    """Bins that have both quality and taxonomy, with what else is known of them: rows that only others have go."""
    return reduce(lambda a, b: a.join(b, on, "left"), others, quality.join(taxonomy, on))


def interactions(bins: DataFrame, by: list[str], *, biosynthetic: list[str], positive: list[str], least: int = 3) -> DataFrame:
    """Producers with each recipient of the same sample: bins have bin, genes, tier, prophages, protected, rec_a, lex_a.

    A producer has enough genes, a biosynthetic one and a positive tier; a recipient has prophages. Pairs of bins of one
    sample are what is asked for; a sample has some hundred bins."""
    core = F.arrays_overlap("genes", F.array(*map(F.lit, biosynthetic)))
    producers = bins.where((F.size("genes") >= least) & core & F.col("tier").isin(positive)).select(*by, F.col("bin").alias("producer"))
    recipients = bins.where("prophages > 0").select(*by, F.col("bin").alias("recipient"), "prophages", "protected", "rec_a", "lex_a")
    return producers.join(recipients, by).withColumn("hypothesis", rules.susceptibility(F.col("protected"), F.col("rec_a"), F.col("lex_a")))


def provirus(df: DataFrame, *, length: int = 3_000, hallmarks: int = 2) -> DataFrame:
    """Proviruses above both floors, with start and end in order; rows without numbers or coordinates go."""
    number = lambda c: F.floor(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("0")).try_cast("double"))
    at = lambda i: F.regexp_extract("coordinates", r"^(\d+)-(\d+)$", i).try_cast("long")
    kept = df.where((F.lower("topology") == "provirus") & (number("length") >= length) & (number("n_hallmarks") >= hallmarks) & at(1).isNotNull())
    return kept.withColumns({"start": F.least(at(1), at(2)), "end": F.greatest(at(1), at(2))})


def annotation_flags(features: DataFrame, by: list[str], genes: dict[str, str]) -> DataFrame:
    """Whether a genome has a coding sequence whose gene attribute is exactly each name, in any case."""
    is_ = lambda g: F.coalesce((F.col("type") == "CDS") & (F.lower(F.col("attributes")["gene"]) == g), F.lit(False))
    return features.groupBy(*by).agg(*[F.bool_or(is_(g)).alias(out) for out, g in genes.items()])


def stage_rates(df: DataFrame, key: list[str], chain: list[str]) -> DataFrame:
    """stage and share removed by it, for each consecutive pair of a chain of counts; pairs without both, with nothing to
    remove, or that grew have none."""
    pairs = F.array(*[F.struct(F.lit(b).alias("stage"), F.col(a).alias("before"), F.col(b).alias("after")) for a, b in zip(chain, chain[1:], strict=False)])
    each = df.select(*key, F.inline(pairs)).where((F.col("before") > 0) & (F.col("after") <= F.col("before")))
    return each.select(*key, "stage", ((F.col("before") - F.col("after")).cast("double") / F.col("before")).alias("removed"))


def terminal_state(df: DataFrame, stages: dict[str, list[str]], excluded: str, outcome: str) -> Column:
    """excluded_<reason>, failed_at_<first stage with a metric missing>, or completed_<outcome>."""
    failed = [(reduce(lambda a, b: a | b, [F.col(m).isNull() for m in metrics]), F.lit(f"failed_at_{stage}")) for stage, metrics in stages.items()]
    done = F.concat(F.lit("completed_"), F.when(F.col(outcome).isin("positive", "negative"), F.col(outcome)).otherwise("untiered"))
    return rules.cascade([(F.col(excluded).isNotNull(), F.concat(F.lit("excluded_"), F.col(excluded))), *failed], done)


def inferred_stages(long: DataFrame, stages: dict[str, list[str]], always: list[str], metric: str = "metric") -> DataFrame:
    """Stages that always run or that a sample reported a metric of, in order: place, stage."""
    listed = long.sparkSession.createDataFrame([(i, s, m) for i, (s, ms) in enumerate(stages.items()) for m in ms], "place int, stage string, metric string")
    seen = long.select(F.col(metric).alias("metric")).distinct().join(F.broadcast(listed), "metric").select("place", "stage")
    fixed = listed.where(F.col("stage").isin(always)).select("place", "stage")
    return seen.union(fixed).distinct()


def extraction_mix(df: DataFrame, mode: str) -> DataFrame:
    """Samples by mode and whether the cohort mixes modes that extract with ones that do not; blank and NA modes are left out.
    One row for each mode: total over modes, of which there are five."""
    counts = df.where(~F.coalesce(F.trim(mode), F.lit("")).isin("", "NA")).groupBy(F.trim(mode).alias("mode")).agg(F.count(F.lit(1)).alias("samples"))
    every = Window.partitionBy(F.lit(1))
    mixed = (F.max(F.col("mode").startswith("on").cast("int")).over(every) == 1) & (F.max(F.col("mode").startswith("off").cast("int")).over(every) == 1)
    return counts.withColumn("mixed", mixed)


def task_rollup(trace: DataFrame, name: str = "name", status: str = "status") -> DataFrame:
    """Tasks of each process and their number by status, as a map; a task is named process (tag)."""
    process = F.trim(F.split(F.col(name), r" \(", 2)[0])
    each = trace.select(process.alias("process"), F.coalesce(F.trim(status), F.lit("UNKNOWN")).alias("status")).where("process <> ''").groupBy("process", "status").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("process").agg(F.sum("n").cast("long").alias("tasks"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("statuses"))


def species_matrix(counts: DataFrame, by: list[str], species: str, gene: str, genes: list[str], value: str) -> DataFrame:
    """A row for each species with a column for each gene, 0 where there is none, and their Total."""
    wide = counting.pivoted(counts, [*by, species], gene, genes, value)
    return wide.withColumn("Total", reduce(lambda a, b: a + b, [F.col(g) for g in genes]))


def rates(df: DataFrame, reads: str, after_pangenome: str, after_t2t: str) -> DataFrame:
    """Reads per million host-depleted reads, with the denominator and the stage that it was taken after: the last one that
    ran. Null where nothing was left."""
    depleted = F.coalesce(after_pangenome, after_t2t)
    stage = F.when(F.col(after_pangenome).isNotNull(), "pangenome").when(F.col(after_t2t).isNotNull(), "t2t_phix")
    return df.withColumns({"host_depleted_reads": depleted, "host_depleted_stage": stage, "reads_per_million": F.when(depleted > 0, F.col(reads) * F.lit(1e6) / depleted)})


def second_pass(records: DataFrame, wanted: Column, name: str) -> DataFrame:
    """All records whose name one wanted record has."""
    return records.join(records.where(wanted).select(name).distinct(), name, "left_semi")


def marked_duplicates(records: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Adds ``duplicate``: all but the first record of each key in the given order are. A hot key's rows are one sort; the
    key is a position on one strand of one library."""
    w = Window.partitionBy(*key).orderBy(*order)
    return records.withColumn("duplicate", F.row_number().over(w) > 1)


def typed_unit(units: DataFrame, by: list[str], order: str) -> DataFrame:
    """The first typed unit of each group, else its first one, as a struct."""
    place = F.struct((F.col("status") != "typed").alias("untyped"), F.col(order).alias("at"))
    return units.groupBy(*by).agg(F.min_by(F.struct(*[c for c in units.columns if c not in by]), place).alias("unit"))


def staged_order(manifest: DataFrame) -> DataFrame:
    """Manifest rows (kind, sample, name) with the number under which each kind's files are staged; a kind of any size is
    numbered by many tasks."""
    placed = numbering.numbered(manifest, ["sample", "name"], by=["kind"], name="place")
    return placed.withColumn("place", F.col("place").cast("int"))


def sensitivity(samples: DataFrame, floors: list[int], genes: Callable[[int], Column]) -> DataFrame:
    """Samples that are positive under each floor: floor, positive, negative."""
    made = F.array(*[F.struct(F.lit(f).alias("floor"), genes(f).alias("ok")) for f in floors])
    return samples.select(F.inline(made)).groupBy("floor").agg(F.count_if("ok").alias("positive"), F.count_if(~F.col("ok")).alias("negative"))


def report(expected: DataFrame, sources: dict[str, DataFrame], key: str) -> DataFrame:
    """A row for each expected sample with what each source knows of it, and which sources know nothing; a source with two
    rows for a sample fails the query."""
    out = expected.select(key)
    for name, source in sources.items():
        once = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in source.columns if c != key])
        same = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{name}: more than one row for "), F.col(key).cast("string"))).cast("boolean")).otherwise(True)
        out = out.join(once.withColumn(f"_{name}", same).drop("_n"), key, "left")
    absent = F.filter(F.array(*[F.when(F.coalesce(F.col(f"_{n}"), F.lit(False)), None).otherwise(F.lit(n)) for n in sources]), lambda x: x.isNotNull())
    return out.withColumn("missing", F.array_join(absent, ";")).drop(*[f"_{n}" for n in sources])


def snapped_length(reads: DataFrame, by: list[str], length: str, order: list[Column], lengths: tuple[int, ...], first: int = 20_000) -> DataFrame:
    """Median length of the first reads of each group, cut to a whole number, and the nearest of the lengths at hand, the
    lower on ties. That only the first reads count is the rule."""
    w = Window.partitionBy(*by).orderBy(*order)
    held = reads.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= first)
    m = held.groupBy(*by).agg(F.floor(F.percentile(length, F.lit(0.5))).alias("median"))
    nearest = F.array_min(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.struct(F.abs(n - F.col("median")).alias("a"), n.alias("n"))))
    return m.withColumn("snapped", nearest["n"])


def serial_depletion(reads: DataFrame, stages: dict[str, DataFrame], name: str, by: list[str]) -> DataFrame:
    """Reads that each stage removes of those that all stages before it left, and the kept ones: stage, by, reads."""
    counted, left = [], reads
    count = lambda df, stage: df.groupBy(*by).agg(F.count(F.lit(1)).alias("reads")).select(F.lit(stage).alias("stage"), *by, "reads")
    for stage, hits in stages.items():
        counted.append(count(left.join(hits, name, "left_semi"), stage))
        left = left.join(hits, name, "left_anti")
    return reduce(lambda a, b: a.unionByName(b), [*counted, count(left, "kept")])


def cohort_order(samples: DataFrame, tier: str, counts: list[str], name: str) -> DataFrame:
    """Samples by strongest tier, then counts, then name, with their place."""
    order = [F.desc_nulls_last("_t"), *[F.desc_nulls_last(c) for c in counts], F.col(name)]
    placed = numbering.numbered(samples.withColumn("_t", rules.tier_rank(F.col(tier))), order, name="place")
    return placed.withColumn("place", F.col("place").cast("int")).drop("_t")


def audited(samples: DataFrame, tier: str, by: list[str], name: str, negatives: int, seed: str) -> DataFrame:
    """Samples to audit with the reason: all positive and near-miss ones, and of the clean negatives of each group so many, drawn in
    the order of a digest of name and seed, all if there are fewer."""
    reasoned = samples.withColumn("reason", rules.audit_reason(F.col(tier)))
    drawn = ranking.hashed_sample(reasoned.where(F.col(tier) == "negative"), by, name, seed, negatives).withColumn("reason", F.lit("clean_negative"))
    return reasoned.where("reason IS NOT NULL").unionByName(drawn)


def joined(on: list[str], *tables: DataFrame) -> DataFrame:
    """Samples that all tables have."""
    return reduce(lambda a, b: a.join(b, on), tables)


def community_input(*tables: DataFrame, on: list[str]) -> DataFrame:
    """Bins that all tables but the last have, with what the last one knows."""
    *all_of, last = tables
    return joined(on, *all_of).join(last, on, "left")


def counts_by_section(files: DataFrame, sections: dict[str, Column]) -> DataFrame:
    """Files by section and key, counted in one pass: section, key, n_files."""
    pairs = F.array(*[F.struct(F.lit(s).alias("section"), c.cast("string").alias("key")) for s, c in sections.items()])
    return files.select(F.inline(pairs)).groupBy("section", "key").agg(F.count(F.lit(1)).alias("n_files"))


def community_counts(samples: DataFrame, pairs: DataFrame, by: list[str], *, least: int = 1) -> DataFrame:
    """Each sample with its distinct producers, the neighbours assessed, and those with ``least`` prophages."""
    n = pairs.groupBy(*by).agg(F.countDistinct("producer").alias("producers"), F.count(F.lit(1)).alias("assessed"), F.count_if(F.col("prophages") >= least).alias("with_prophages"))
    return samples.join(n, by, "left").na.fill(0, ["producers", "assessed", "with_prophages"])


def tier_movement(samples: DataFrame, before: str, after: str) -> DataFrame:
    """Samples by tier before and after, beside all samples of the tier before."""
    n = samples.groupBy(F.col(before).alias("before"), F.col(after).alias("after")).agg(F.count(F.lit(1)).alias("samples"))
    return n.withColumn("of_before", F.sum("samples").over(Window.partitionBy("before")))


def parameter_drift(runs: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Runs by parameter whose value is not the expected one."""
    values = runs.sparkSession.createDataFrame(list(expected.items()), "name string, expected string")
    return runs.join(F.broadcast(values), "name").where(~F.col("found").eqNullSafe(F.col("expected"))).groupBy("name", "expected", "found").agg(F.count(F.lit(1)).alias("runs"))


def with_mix(counts: DataFrame, label: str) -> DataFrame:
    """Counts by label, and whether there is more than one label; a fixed number of labels meets in one window."""
    every = Window.partitionBy(F.lit(1))
    return counts.withColumn("mixed", F.count(label).over(every) > 1)
