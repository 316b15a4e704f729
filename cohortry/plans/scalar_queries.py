"""Queries of scalar functions over columns of odd values. The SQL twins state the right answer for each value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.functions import scalars as fn
from cohortry.operators import counting, rules
from cohortry.plans import adapters as ad
from cohortry.plans.lane_queries import CLIPPED, POSITIVE, _aligned
from cohortry.plans.registry import query


def shown(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def answers(cases: list[tuple]) -> str:
    """SQL: the answers of the cases in turn over the parts."""
    return f"SELECT p_partkey, [{', '.join(shown(want) for *_, want in cases)}][CAST(p_partkey % {len(cases)} AS INTEGER) + 1] AS got FROM part"


def asked(spark, d, cases: list[tuple], kinds: list[str]) -> tuple:
    """The parts, and a column for each input of the cases in turn."""
    at = (F.col("p_partkey") % len(cases) + 1).cast("int")
    columns = [F.element_at(F.array(*[F.lit(c[i]).cast(kind) for c in cases]), at) for i, kind in enumerate(kinds)]
    return ad.table(spark, d, "part"), columns


def over(spark, d, cases: list[tuple], kinds: list[str], function) -> Column:
    parts, columns = asked(spark, d, cases, kinds)
    return parts.select("p_partkey", function(*columns).alias("got"))


NAMES = [("@r1/1 extra", "r1/1"), (">r2 1:N:0", "r2"), ("  r3  ", "r3"), ("@@r4\\tx".replace("\\t", "\t"), "r4"), ("r5@x", "r5@x")]


@query("p1_read_names", answers(NAMES))
def p1(spark, d):
    return over(spark, d, NAMES, ["string"], fn.read_name)


MATES = [("@r/1", 1), ("r/2 1:N:0", 2), ("r 1:N:0", 1), ("r 2", 2), ("r 12:N", 0), ("r", 0), ("r 2:Y", 2), ("r/3 1", 1)]


@query("p3_mates", answers(MATES))
def p3(spark, d):
    return over(spark, d, MATES, ["string"], fn.mate_of)


TAGGED = [("r", "r/2"), ("r/1", "r/1"), ("r/2", "r/2"), ("r/3", "r/3/2"), ("r/12", "r/12/2")]


@query("p4_tagged_names", answers(TAGGED))
def p4(spark, d):
    return over(spark, d, TAGGED, ["string"], lambda c: fn.tagged(c, 2))


CIGARS = [("5S50M2I40M3D8M4H", 103, 109, 101), ("10M", 10, 10, 10), ("3H4S10=2X5N1P6S", 12, 25, 17), ("10M5", None, None, None), ("*", None, None, None), ("2I8M2D", 12, 10, 10)]


@query("p5_valid_cigars", answers([(c, want[0] is not None) for c, *want in CIGARS]))
def p5(spark, d):
    return over(spark, d, [(c, 0) for c, *_ in CIGARS], ["string"], lambda c: fn.cigar_steps(c).isNotNull())


@query("p6_cigar_metrics", f"SELECT p_partkey, {', '.join(f'[{", ".join(shown(c[i]) for c in CIGARS)}][CAST(p_partkey % {len(CIGARS)} AS INTEGER) + 1] AS {name}' for i, name in ((1, 'columns'), (2, 'length'), (3, 'span')))} FROM part")
def p6(spark, d):
    parts, (cigar,) = asked(spark, d, CIGARS, ["string"])
    steps = fn.cigar_steps(cigar)
    return parts.select("p_partkey", fn.columns_of(steps).alias("columns"), fn.read_length(steps).alias("length"), fn.reference_span(steps).alias("span"))


CLIPS = [("5S50M", 5, 0), ("3H4S10M6S", 7, 6), ("10M", 0, 0), ("2I8M1S2H", 0, 3), ("5M2S5M", 0, 0)]


@query("p7_clips", f"SELECT p_partkey, [{', '.join(str(c[1]) for c in CLIPS)}][CAST(p_partkey % {len(CLIPS)} AS INTEGER) + 1] AS leading, [{', '.join(str(c[2]) for c in CLIPS)}][CAST(p_partkey % {len(CLIPS)} AS INTEGER) + 1] AS trailing FROM part")
def p7(spark, d):
    parts, (cigar,) = asked(spark, d, CLIPS, ["string"])
    return parts.select("p_partkey", fn.clip(cigar, "left").alias("leading"), fn.clip(cigar, "right").alias("trailing"))


@query("p8_five_prime", f"WITH {CLIPPED} SELECT read_id, CASE WHEN flag & 16 > 0 THEN last + rc ELSE pos - lc END AS five FROM cl")
def p8(spark, d):
    return _aligned(spark, d).select("read_id", fn.five_prime(F.col("flag"), F.col("pos"), F.col("cigar")).alias("five"))


@query("p11_query_coverage", f"WITH {ad.READS} SELECT read_id, least(1.0::DOUBLE, CAST(score * 3 AS DOUBLE) / nullif(ordinal * 20, 0)) AS coverage FROM reads")
def p11(spark, d):
    return ad.reads(spark, d).select("read_id", fn.query_coverage(F.col("score").cast("double"), (F.col("ordinal") * 20).cast("double")).alias("coverage"))


@query("p23_fractions", f"WITH {ad.READS}, n AS (SELECT sample_id, contig, count(*) FILTER (mapq = 40) AS part, count(*) FILTER (mapq >= 35 AND nm > 8) AS whole FROM reads GROUP BY sample_id, contig) SELECT sample_id, contig, CASE WHEN contig < 5 AND whole > 0 THEN CAST(part AS DOUBLE) / whole END AS fraction FROM n")
def p23(spark, d):
    n = ad.reads(spark, d).groupBy("sample_id", "contig").agg(F.count_if(F.col("mapq") == 40).alias("part"), F.count_if((F.col("mapq") >= 35) & (F.col("nm") > 8)).alias("whole"))
    whole = F.when(F.col("contig") < 5, F.col("whole"))
    return n.select("sample_id", "contig", counting.share(F.col("part"), whole).alias("fraction"))


NUMBERS = [("7", 7), ("7.0", 7), ("1e3", 1000), ("7.5", None), ("", None), ("NA", None), (None, None), ("-2", -2)]


@query("p24_tolerant_numbers", answers(NUMBERS).replace(" AS got", "::BIGINT AS got"))
def p24(spark, d):
    return over(spark, d, NUMBERS, ["string"], fn.whole_number)


LOCI = [(0, 0.0, "negative"), (0, 0.001, "localized_indeterminate"), (3, 0.01, "multi_gene"), (8, 0.075, "broad_island"), (10, 0.15, "extensive_island"), (10, 0.14, "broad_island"), (2, 0.9, "localized_indeterminate"), (3, 0.0, "localized_indeterminate")]


@query("r2_locus_tier", answers(LOCI))
def r2(spark, d):
    return over(spark, d, LOCI, ["int", "double"], rules.locus_tier)


DIAGNOSTICS = [(None, 0.5, "recruitment_classes_unavailable"), (0, 0.5, "no_island_supporting_fragments"), (5, 0.1, "island_contigs_recovered"), (5, 0.0, "island_fragments_no_contig")]


@query("r8_assembly_diagnostic", answers(DIAGNOSTICS))
def r8(spark, d):
    return over(spark, d, DIAGNOSTICS, ["int", "double"], rules.assembly_diagnostic)


TYPES = [("1,2,3,4,5,6,7", "131", "typed"), ("1,2,3,4,5,6,7", None, "novel_allele_combination"), ("1,2,3,4,5,6,~7", "131", "insufficient_loci"), ("1,2,3,-,5,6,7", None, "insufficient_loci"), ("1,2,3,4,5,6,7?", "131", "insufficient_loci")]


@query("r15_typing_status", answers(TYPES))
def r15(spark, d):
    return over(spark, d, TYPES, ["string", "string"], lambda alleles, kind: rules.typing_status(F.split(alleles, ","), kind))


B1 = [(10, None, "true"), (None, 10, "decoy"), (None, None, "ambiguous"), (10, 8, "ambiguous"), (13, 10, "true"), (10, 13, "decoy")]


@query("r9_first_call", answers(B1))
def r9b(spark, d):
    return over(spark, d, B1, ["int", "int"], lambda a, b: rules.favoured(a, b, 2))


AUDITS = [("multi_gene", "positive"), ("extensive_island", "positive"), ("localized_indeterminate", "near_miss"), ("negative", None), (None, None)]


@query("j24_audit_reasons", answers(AUDITS))
def j24b(spark, d):
    assert set(POSITIVE) == {name for name, *_ in rules.TIERS}
    return over(spark, d, AUDITS, ["string"], rules.audit_reason)


#: Numbers as tables have them, made of the parts' columns.
TEXTS = """t AS (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN concat(' -', p_size, ' ') WHEN 2 THEN concat(p_size, '.', p_partkey % 100) WHEN 3 THEN concat(p_size, 'e', p_partkey % 4) WHEN 4 THEN 'NA' WHEN 5 THEN concat(p_size, '_000') WHEN 6 THEN concat(p_size, '_') WHEN 7 THEN p_brand END AS text FROM part)"""


@query("p24_or_zero", f"WITH {TEXTS} SELECT p_partkey, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(_[0-9]+)*') THEN CAST(replace(trim(text), '_', '') AS BIGINT) ELSE 0 END AS whole, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(_[0-9]+)*([.][0-9]+)?(e[0-9]+)?') THEN CAST(replace(trim(text), '_', '') AS DOUBLE) ELSE 0 END AS number FROM t")
def p24_or_zero(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    kinds = [size, F.concat(F.lit(" -"), size, F.lit(" ")), F.concat(size, F.lit("."), (k % 100).cast("string")), F.concat(size, F.lit("e"), (k % 4).cast("string")), F.lit("NA"), F.concat(size, F.lit("_000")), F.concat(size, F.lit("_")), F.col("p_brand")]
    text = F.get(F.array(*kinds), (k % 9).cast("int"))
    return ad.table(spark, d, "part").select("p_partkey", fn.int_or_zero(text).alias("whole"), fn.float_or_zero(text).alias("number"))


@query("p19_min_score", """WITH c AS (SELECT p_partkey, p_size AS n, CASE p_partkey % 7 WHEN 0 THEN concat('bwa mem -t 8 -T ', p_size, ' ref.fa') WHEN 1 THEN concat('/opt/bin/bwa-mem2 mem -T', p_size, ' ref.fa') WHEN 2 THEN concat('sentieon bwa mem -R ', p_brand, ' ref.fa') WHEN 3 THEN concat('bwa mem -T ', p_brand) WHEN 4 THEN concat('bwa aln -T ', p_size) WHEN 5 THEN concat('bwa mem ref.fa -T -', p_size, ' -T 3') ELSE 'minimap2 -x sr' END AS cl FROM part)
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN regexp_extract(cl, '-T (\\d+)', 1) WHEN 1 THEN regexp_extract(cl, '-T(\\d+)', 1) WHEN 2 THEN 'default' WHEN 3 THEN 'unparsed' WHEN 5 THEN regexp_extract(cl, '-T (-\\d+)', 1) END AS score FROM c""")
def p19_min_score(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    lines = [
        F.concat(F.lit("bwa mem -t 8 -T "), size, F.lit(" ref.fa")), F.concat(F.lit("/opt/bin/bwa-mem2 mem -T"), size, F.lit(" ref.fa")), F.concat(F.lit("sentieon bwa mem -R "), "p_brand", F.lit(" ref.fa")), F.concat(F.lit("bwa mem -T "), "p_brand"),
        F.concat(F.lit("bwa aln -T "), size), F.concat(F.lit("bwa mem ref.fa -T -"), size, F.lit(" -T 3")), F.lit("minimap2 -x sr"),
    ]
    return ad.table(spark, d, "part").select("p_partkey", fn.bwa_min_score(F.get(F.array(*lines), (k % 7).cast("int"))).alias("score"))
