"""Scalar functions and rules over values that are made of the tables' columns, so that the SQL twins compute them from the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.functions import scalars as fn
from cohortry.operators import rules
from cohortry.plans import adapters as ad
from cohortry.plans.cohort_summary import BIN_SQL, FACTS, bins_of, of_places, of_samples, read_facts
from cohortry.plans.registry import query


def _text(c):
    return F.col(c).cast("string")


HEADERS = """h AS (SELECT l_orderkey, l_linenumber, ['@', '>', ' ', '@@'][CAST(l_partkey % 4 AS INTEGER) + 1] AS mark, concat('r', l_orderkey, '.', l_linenumber) AS stem, ['', '/1', '/2', '/3'][CAST(l_suppkey % 4 AS INTEGER) + 1] AS suffix,
  ['', '1:N:0', '2:Y:0', '2', '12:N'][CAST(l_orderkey % 5 AS INTEGER) + 1] AS second FROM lineitem)"""


@query("p1_header_parts", f"WITH {HEADERS} SELECT l_orderkey, l_linenumber, concat(stem, suffix) AS name, CASE WHEN suffix = '/1' THEN 1 WHEN suffix = '/2' THEN 2 WHEN second IN ('1:N:0') THEN 1 WHEN second IN ('2:Y:0', '2') THEN 2 ELSE 0 END AS mate, concat(stem, CASE WHEN suffix IN ('/1', '/2') THEN suffix ELSE concat(suffix, '/2') END) AS tagged, CASE WHEN suffix IN ('/1', '/2') THEN stem ELSE concat(stem, suffix) END AS fragment FROM h")
def p1(spark, d):
    li = ad.table(spark, d, "lineitem")
    pick = lambda items, c: F.get(F.array(*map(F.lit, items)), (F.col(c) % len(items)).cast("int"))
    header = F.concat(pick(["@", ">", " ", "@@"], "l_partkey"), F.lit("r"), _text("l_orderkey"), F.lit("."), _text("l_linenumber"), pick(["", "/1", "/2", "/3"], "l_suppkey"), F.lit(" "), pick(["", "1:N:0", "2:Y:0", "2", "12:N"], "l_orderkey"))
    name = fn.read_name(header)
    return li.select("l_orderkey", "l_linenumber", name.alias("name"), fn.mate_of(header).alias("mate"), fn.tagged(name, 2).alias("tagged"), fn.fragment_name(name).alias("fragment"))


STEPS = """c AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS h, l_linenumber % 4 * 5 AS s, CAST(l_quantity AS BIGINT) AS m1, CAST(round(l_discount * 100) AS BIGINT) AS i, l_suppkey % 90 + 1 AS m2, CAST(round(l_tax * 100) AS BIGINT) AS d, l_partkey % 7 AS e, l_partkey % 11 AS n, CASE WHEN l_shipdate < DATE '1994-01-01' THEN 4 ELSE 0 END AS t FROM lineitem)"""


@query("p6_cigars_of_columns", f"WITH {STEPS} SELECT l_orderkey, l_linenumber, m1 + i + m2 + d + e AS columns, s + m1 + i + m2 + e + t + h AS length, m1 + m2 + d + n + e AS span, CAST(h + s AS BIGINT) AS leading, CAST(t AS BIGINT) AS trailing FROM c")
def p6(spark, d):
    li = ad.table(spark, d, "lineitem")
    whole = lambda c: F.round(F.col(c) * 100).cast("long")
    counts = [
        (F.col("l_linenumber") % 3, "H"), (F.col("l_linenumber") % 4 * 5, "S"), (F.col("l_quantity").cast("long"), "M"), (whole("l_discount"), "I"), (F.col("l_suppkey") % 90 + 1, "M"), (whole("l_tax"), "D"), (F.col("l_partkey") % 7, "="), (F.col("l_partkey") % 11, "N"),
        (F.when(F.col("l_shipdate") < F.lit("1994-01-01").cast("date"), 4).otherwise(0), "S"),
    ]
    cigar = F.concat(*[F.when(n > 0, F.concat(n.cast("long").cast("string"), F.lit(op))).otherwise("") for n, op in counts])
    # made and checked once a row, then read by each number
    rows = li.select("l_orderkey", "l_linenumber", fn.strict_cigar(cigar).alias("cigar"))
    return rows.select("l_orderkey", "l_linenumber", *[c.cast("long").alias(k) for k, c in fn.cigar_numbers(F.col("cigar")).items()])


@query("r2_locus_tiers", f"WITH {FACTS}, {BIN_SQL} SELECT sample_id, contig, n_genes, breadth, tier FROM b")
def r2(spark, d):
    return bins_of(read_facts(spark, d, "position", "gene")).select("sample_id", "contig", "n_genes", "breadth", "tier")


@query("r8_assembly_states", f"WITH {FACTS}, s AS (SELECT sample_id, CASE WHEN sample_id % 5 < 4 THEN paired_fragments - CASE WHEN sample_id % 3 = 0 THEN paired_fragments ELSE 0 END END AS supporting, CASE WHEN sample_id % 2 = 0 THEN bases_one ELSE 0 END AS bases FROM evid) SELECT sample_id, CASE WHEN supporting IS NULL THEN 'recruitment_classes_unavailable' WHEN supporting = 0 THEN 'no_island_supporting_fragments' WHEN bases > 0 THEN 'island_contigs_recovered' ELSE 'island_fragments_no_contig' END AS state FROM s")
def r8(spark, d):
    facts, k = read_facts(spark, d, "sample", "fragment", "position"), F.col("sample_id")
    s = of_samples(facts).join(of_places(facts), "sample_id")
    supporting = F.when(k % 5 < 4, F.when(k % 3 == 0, 0).otherwise(F.col("paired_fragments")))
    return s.select("sample_id", rules.assembly_diagnostic(supporting, F.when(k % 2 == 0, F.col("bases_one")).otherwise(0)).alias("state"))


ALLELES = """a AS (SELECT p_partkey, p_size, [CASE (p_partkey * 7 + i * p_size) % 23 WHEN 0 THEN '-' WHEN 1 THEN concat('~', p_size) WHEN 2 THEN concat(p_size, '?') WHEN 3 THEN '' ELSE CAST(p_size + i AS VARCHAR) END FOR i IN range(7)] AS alleles FROM part)"""


@query("r15_typing_of_columns", f"WITH {ALLELES}, n AS (SELECT p_partkey, p_size, len([x FOR x IN alleles IF x NOT IN ('-', '') AND NOT prefix(x, '~') AND NOT suffix(x, '?')]) AS exact FROM a) SELECT p_partkey, CASE WHEN exact < 7 THEN 'insufficient_loci' WHEN p_size % 3 = 0 THEN 'novel_allele_combination' ELSE 'typed' END AS status FROM n")
def r15(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size").cast("long")

    def allele(i: int):
        at = (k * 7 + i * size) % 23
        return F.when(at == 0, "-").when(at == 1, F.concat(F.lit("~"), size.cast("string"))).when(at == 2, F.concat(size.cast("string"), F.lit("?"))).when(at == 3, "").otherwise((size + i).cast("string"))

    sequence_type = F.when(size % 3 != 0, size)
    return ad.table(spark, d, "part").select("p_partkey", rules.typing_status(F.array(*[allele(i) for i in range(7)]), sequence_type).alias("status"))
