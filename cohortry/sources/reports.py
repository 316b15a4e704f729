"""Readers of sample sheets, tool reports and headers, which say what is wrong with a file rather than guess."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.records import WHOLE_FILE, file_digests
from cohortry.sources.text_tables import KRAKEN, numbered_lines, tsv

#: Rank names of a taxonomy dump; the column that holds them is found by them.
RANKS = ["no rank", "superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species", "subspecies", "strain"]
SAMPLE_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


def input_kind(columns: list[str]) -> str:
    """alignment or fastq, by the columns of a sample sheet: one of the two kinds must be there, and not both."""
    names = {c.strip() for c in columns}
    alignment, reads = bool(names & {"alignment", "bam"}), "fastq1" in names
    if alignment == reads:
        raise ValueError("a sample sheet has either an alignment (or bam) column or a fastq1 column")
    return "alignment" if alignment else "fastq"


def sample_sheet(spark: SparkSession, path: str, *, long_reads: bool = False) -> tuple[DataFrame, DataFrame]:
    """(samples, problems) of a CSV sheet with a header. Values are trimmed. ``problems``: row (the line in the file, the
    header is 1) and message, for every row at once: empty or malformed ids, repeated ids, empty inputs, mates of long reads.
    """
    lines = numbered_lines(spark, path)
    header = spark.read.option("header", True).csv(path).columns
    kind = input_kind(header)
    named = {c.strip(): c for c in header}
    if "patient" not in named:
        raise ValueError("the sample sheet has no patient column")
    schema = ", ".join(f"`{c}` string" for c in header)
    rows = lines.where((F.col("line") > 0) & (F.trim("value") != "")).select((F.col("line") + 1).alias("row"), F.from_csv("value", schema).alias("r"))
    value = lambda c: F.trim(F.coalesce(F.col("r")[named[c]], F.lit(""))) if c in named else F.lit("")
    first = F.when(value("alignment") != "", value("alignment")).otherwise(value("bam")) if kind == "alignment" else value("fastq1")
    samples = rows.select("row", value("patient").alias("sample"), F.lit(kind).alias("kind"), first.alias("input"), value("fastq2").alias("mates"))
    twice = samples.groupBy("sample").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND sample <> ''").select("sample", F.lit(True).alias("twice"))
    told = samples.join(twice, "sample", "left")
    rules = [
        (F.col("sample") == "", F.lit("empty patient value")),
        ((F.col("sample") != "") & ~F.col("sample").rlike(SAMPLE_ID), F.concat(F.lit("invalid patient value "), F.col("sample"))),
        (F.col("twice"), F.concat(F.lit("repeated patient value "), F.col("sample"))),
        (F.col("input") == "", F.lit(f"empty {kind} value")),
        (F.lit(long_reads) & (F.col("mates") != ""), F.lit("long reads have no mates")),
    ]
    messages = F.filter(F.array(*[F.when(cond, text) for cond, text in rules]), lambda m: m.isNotNull())
    return samples, told.select("row", F.explode(messages).alias("message"))


def taxonomy(spark: SparkSession, *, taxdb: str | None = None, nodes: str | None = None, names: str | None = None) -> DataFrame:
    """taxid, parent, name and rank. The table that came with the database is preferred to a later dump: reads were assigned
    by it. Ids that are not whole numbers and rows without a name fail the query; an empty rank is no rank."""
    number = lambda c: F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).cast("long")).otherwise(F.raise_error(F.concat(F.lit("invalid taxid: "), c)).cast("long"))
    if taxdb:
        f = spark.read.text(taxdb).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 4)
        name = F.when(F.trim(F.col("f")[2]) != "", F.trim(F.col("f")[2])).otherwise(F.raise_error(F.lit("a taxon without a name")).cast("string"))
        return f.select(number(F.col("f")[0]).alias("taxid"), number(F.col("f")[1]).alias("parent"), name.alias("name"), F.coalesce(F.nullif(F.trim(F.col("f")[3]), F.lit("")), F.lit("no rank")).alias("rank"))
    if not (nodes and names):
        raise ValueError("either a taxDB or a pair of nodes and names is needed")
    cut = lambda path: spark.read.text(path).select(F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", " "))).alias("f"))
    tree = cut(nodes)
    at = rank_column(tree)
    named = cut(names).where(F.col("f")[3] == "scientific name").select(F.col("f")[0].cast("long").alias("taxid"), F.col("f")[1].alias("name"))
    return tree.select(number(F.col("f")[0]).alias("taxid"), number(F.col("f")[1]).alias("parent"), F.col("f")[at].alias("rank")).join(named, "taxid").select("taxid", "parent", "name", "rank")


def rank_column(tree: DataFrame, rows: int = 2_000) -> int:
    """The column of a dump that holds ranks, by the vote of its first rows; without a majority this raises."""
    votes = tree.limit(rows).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.get("f", F.lit(i)).isin(RANKS)).alias(f"c{i}") for i in range(2, 6)]).first()
    best = max(range(2, 6), key=lambda i: votes[f"c{i}"])
    if 2 * votes[f"c{best}"] <= votes["n"]:
        raise ValueError("no column of the dump holds ranks")
    return best


def kraken_calls(spark: SparkSession, path: str) -> DataFrame:
    """read_id and taxid of classified reads with a taxon other than 0."""
    calls = tsv(spark, path, KRAKEN, strict=False).where((F.col("status") == "C") & (F.trim("taxid") != "0"))
    return calls.select("read_id", F.trim("taxid").alias("taxid"))


def diamond_hits(spark: SparkSession, path: str) -> DataFrame:
    """Rows of exactly eight fields; any other row fails the query."""
    f = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("f"), "value")
    whole = F.when(F.size("f") == 8, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not eight fields: "), F.col("value"))).cast("array<string>"))
    kinds = {"qseqid": "string", "sseqid": "string", "pident": "double", "length": "int", "qlen": "int", "slen": "int", "evalue": "double", "bitscore": "double"}
    return f.select(whole.alias("f")).select(*[F.col("f")[i].cast(k).alias(n) for i, (n, k) in enumerate(kinds.items())])


def idxstats(spark: SparkSession, path: str) -> DataFrame:
    """name, mapped, unmapped; four fields with whole counts, and no mapped reads on the row of reads without a place."""
    f = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("f"), "value")
    good = (F.size("f") == 4) & F.get("f", F.lit(2)).rlike("^[0-9]+$") & F.get("f", F.lit(3)).rlike("^[0-9]+$") & ~((F.get("f", F.lit(0)) == "*") & (F.get("f", F.lit(2)) != "0"))
    whole = F.when(F.coalesce(good, F.lit(False)), F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not an idxstats row: "), F.col("value"))).cast("array<string>"))
    return f.select(whole.alias("f")).select(F.col("f")[0].alias("name"), F.col("f")[2].cast("long").alias("mapped"), F.col("f")[3].cast("long").alias("unmapped"))


def flagstat(spark: SparkSession, path: str) -> DataFrame:
    """what, passed and failed of a flagstat text."""
    m = lambda i: F.regexp_extract("value", r"^(\d+) \+ (\d+) ([^(]*[^( ])", i)
    return spark.read.text(path).where(m(1) != "").select(m(3).alias("what"), m(1).cast("long").alias("passed"), m(2).cast("long").alias("failed"))


def feature_counts(spark: SparkSession, path: str, genes: list[str]) -> DataFrame:
    """gene and count of a featureCounts table. The header, one row for each of ``genes`` and finite counts of 0 or more are
    required; ``problems`` of it are raised together. The table has as many rows as genes."""
    lines = numbered_lines(spark, path).where(~F.col("value").startswith("#")).orderBy("line").limit(len(genes) + 3).collect()
    rows = [r.value.split("\t") for r in lines]
    problems = [] if rows and rows[0][:6] == ["Geneid", "Chr", "Start", "End", "Strand", "Length"] else ["no featureCounts header"]
    found = [r[0] for r in rows[1:]]
    problems += [f"missing {g}" for g in genes if g not in found] + [f"unknown {g}" for g in found if g not in genes] + [f"repeated {g}" for g in sorted({g for g in found if found.count(g) > 1})]
    counts = []
    for r in rows[1:]:
        try:
            value = float(r[-1])
            ok = 0 <= value < float("inf")
        except ValueError:
            value, ok = 0.0, False
        problems += [] if ok else [f"count of {r[0]} is {r[-1]!r}"]
        counts.append((r[0], value))
    if problems:
        raise ValueError(f"{path}: " + "; ".join(problems))
    return spark.createDataFrame(counts, "gene string, count double")


def header_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """file, line and tags (a map) of the header lines of a kind, such as SQ or PG. Command lines are for looking at."""
    lines = numbered_lines(spark, path).where(F.col("value").startswith(f"@{kind}\t"))
    pairs = F.filter(F.slice(F.split("value", "\t"), 2, 2**31 - 2), lambda t: t.contains(":"))
    return lines.select("file", "line", F.map_from_entries(F.transform(pairs, lambda t: F.struct(F.substring_index(t, ":", 1), F.regexp_replace(t, "^[^:]*:", "")))).alias("tags"))


def named_report(spark: SparkSession, path: str, required: dict[str, str]) -> DataFrame:
    """Columns of a tab-separated report by name and type; a report without one of them raises and names those it has."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    if absent := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} is missing {', '.join(absent)}; it has {', '.join(df.columns) or 'no columns'}")
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in required.items()])


def bin_quality(spark: SparkSession, path: str) -> DataFrame:
    """Quality of bins; a report that its tool failed to make has a status and no rows."""
    return named_report(spark, path, {"Name": "string", "Completeness": "double", "Contamination": "double", "Genome_Size": "long", "Contig_N50": "long"})


def bin_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """bin and taxonomy; without a classification it is unclassified."""
    rows = named_report(spark, path, {"user_genome": "string", "classification": "string"})
    return rows.select(F.col("user_genome").alias("bin"), F.coalesce(F.nullif(F.trim("classification"), F.lit("")), F.lit("unclassified")).alias("taxonomy"))


def abundances(spark: SparkSession, path: str) -> DataFrame:
    """taxon and reads above 0 of an abundance report. An empty file has no taxa; a file that has rows but no number of reads
    raises, as does one without the columns."""
    if spark.read.text(path).limit(1).count() == 0:
        return spark.createDataFrame([], "taxon string, reads double")
    rows = named_report(spark, path, {"name": "string", "new_est_reads": "string"}).select(F.col("name").alias("taxon"), F.col("new_est_reads").try_cast("double").alias("reads"))
    n, numbers = rows.agg(F.count(F.lit(1)), F.count("reads")).first()
    if n and not numbers:
        raise ValueError(f"{path}: new_est_reads holds no numbers")
    return rows.where(F.col("taxon").isNotNull() & (F.col("reads") > 0))


def proviruses(spark: SparkSession, path: str) -> DataFrame:
    return named_report(spark, path, {c: "string" for c in ("seq_name", "length", "topology", "n_hallmarks", "coordinates")})


def allele_table(spark: SparkSession, path: str) -> DataFrame:
    """file, scheme, type and alleles (array) of typing output, a row a genome."""
    f = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    return f.select(F.col("f")[0].alias("file"), F.col("f")[1].alias("scheme"), F.nullif(F.col("f")[2], F.lit("-")).alias("type"), F.slice("f", 4, 2**31 - 4).alias("alleles"))


def run_parameters(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """file and, for each name, its value in a run's record: the first place of several that has parameters, else lines of
    ``name  value`` in a text report. Files are records of a run; each is one row."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    places = ["$.invocation.params", "$.invocation.parameters", "$.params", "$.parameters"]
    filled = [F.when(F.get_json_object("value", p).rlike(r'^\{.*"'), F.get_json_object("value", p)) for p in places]
    node = F.coalesce(*filled)
    line = lambda n: F.nullif(F.regexp_extract("value", rf"(?m)^\s*{n}\s+(\S+)\s*$", 1), F.lit(""))
    return whole.select("file", *[F.when(node.isNotNull(), F.get_json_object(node, f"$.{n}")).otherwise(line(n)).alias(n) for n in names])


def output_digests(spark: SparkSession, path: str, largest: int = WHOLE_FILE) -> DataFrame:
    """path, bytes and sha256 of the files below a folder; files larger than ``largest`` are streamed (``records.file_digests``)."""
    return file_digests(spark, path, largest)


def publish(df: DataFrame, path: str, by: str = "sample") -> None:
    """A table under a folder for each sample, without the column; rows of a sample meet in one task only if they are few."""
    df.write.mode("overwrite").partitionBy(by).option("compression", "zstd").parquet(path)


def union_of(tables: list[DataFrame]) -> DataFrame:
    """Tables of one header as one; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def is_missing(value: Column) -> Column:
    return F.coalesce(F.trim(value), F.lit("")).isin("", "NA")
