"""Readers of the text formats that a cohort consists of, and the writer of its tables.

Every schema is stated, none inferred. Coordinates become 0-based half-open here and stay so. ``NA`` is null on the way in
and out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAF = "qname string, qlen long, start long, end long, strand string, tname string, tlen long, t_start long, t_end long, nmatch long, alen long, mapq int"
DIAMOND = "qseqid string, sseqid string, pident double, length int, qlen int, slen int, evalue double, bitscore double"
KRAKEN = "status string, read_id string, taxid string, length string, kmers string"
IDXSTATS = "name string, length long, mapped long, unmapped long"
DEPTH = "contig string, pos long, depth long"
BEDGRAPH = "contig string, start long, end long, value double"
EAV = "sample string, metric string, value string"


def tsv(spark: SparkSession, path: str, schema: str, *, header: bool = False, comment: str | None = None, strict: bool = True) -> DataFrame:
    """A tab-separated table; ``strict`` fails on a row that does not fit, else such rows have nulls."""
    reader = spark.read.option("sep", "\t").option("header", header).option("nullValue", "NA").option("mode", "FAILFAST" if strict else "PERMISSIVE").option("quote", "")
    return (reader.option("comment", comment) if comment else reader).schema(schema).csv(path)


def fields(df: DataFrame, least: int, names: list[str], pattern: str = r"\s+", strict: bool = True) -> DataFrame:
    """Lines split into named columns. Shorter lines fail the query if ``strict``, else they go."""
    parts = df.where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("_f", F.split(F.trim("value"), pattern))
    if strict:
        short = F.raise_error(F.concat(F.lit("too few fields: "), F.col("value")))
        parts = parts.withColumn("_f", F.when(F.size("_f") >= least, F.col("_f")).otherwise(short.cast("array<string>")))
    else:
        parts = parts.where(F.size("_f") >= least)
    return parts.select(*[F.col("_f")[i].alias(n) for i, n in enumerate(names) if n], "_f")


def tags(items: Column) -> Column:
    """NAME:TYPE:VALUE fields as a map by name."""
    return F.map_from_entries(F.transform(items, lambda t: F.struct(F.substring_index(t, ":", 1), F.regexp_replace(t, "^[^:]*:[^:]*:", ""))))


def sam(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    lines = spark.read.text(path).where(~F.col("value").startswith("@"))
    cut = fields(lines, 11, ["read_id", "flag", "contig", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"], "\t", strict)
    whole = {c: F.col(c).cast("long") for c in ("flag", "pos", "mapq", "pnext", "tlen")}
    tagged = cut.withColumns(whole).withColumn("tags", tags(F.slice("_f", 12, F.greatest(F.size("_f") - 11, F.lit(0)))))
    number = {out: F.col("tags")[tag].try_cast("int") for out, tag in (("score", "AS"), ("nm", "NM"))}
    return tagged.withColumns(number | {"start": F.col("pos") - 1}).drop("_f")


def paf(spark: SparkSession, path: str) -> DataFrame:
    """Rows of fewer than 12 fields go; more fields are not read."""
    return tsv(spark, path, PAF, strict=False).where(F.col("mapq").isNotNull())


def paf_strict(spark: SparkSession, path: str) -> DataFrame:
    """The same for rankings, where a row of fewer than 12 fields fails the query."""
    cut = fields(spark.read.text(path), 12, [c.split()[0] for c in PAF.split(", ")], "\t")
    return cut.select(*[F.col(name).cast(kind).alias(name) for name, kind in (c.split() for c in PAF.split(", "))])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 0) and value of each line of text files.

    Files are read in blocks by many tasks. A line's number is its place in its block plus the lines of the blocks before,
    which are counted first; no file is held whole. Compressed files are one block.
    """
    ids = F.monotonically_increasing_id()
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), ids.alias("id"), "value")
    blocks = rows.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(placed, ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line"), "value")


def gff(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Features before the sequence part of each file; attributes as a map."""
    lines = numbered_lines(spark, path)
    ends = lines.where(F.col("value").startswith("##FASTA")).groupBy("file").agg(F.min("line").alias("last"))
    lines = lines.join(ends, "file", "left").where(F.col("last").isNull() | (F.col("line") < F.col("last"))).select("value")
    cut = fields(lines, 9, ["contig", "source", "type", "first", "last", "score", "strand", "phase", "attributes"], "\t", strict=False)
    made = cut.select("contig", "type", (F.col("first").cast("long") - 1).alias("start"), F.col("last").cast("long").alias("end"), "strand", F.str_to_map("attributes", F.lit(";"), F.lit("=")).alias("attributes"))
    return made.where(F.col("type") == kind) if kind else made


def scan_hits(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """nhmmscan tables, strict: gene, read_id, aligned length, e-value and score. Numbers must be finite and genes be of
    ``models``, if given; anything else fails the query."""
    cut = fields(spark.read.text(path), 15, ["gene", "", "read_id", "", "", "", "ali_from", "ali_to", "", "", "", "", "e", "score"])
    gene = F.replace("gene", F.lit(".cds.aln"), F.lit(""))
    finite = lambda c: F.when(F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")), F.raise_error(F.concat(F.lit(f"{c} is not finite: "), F.col(c))).cast("double")).otherwise(F.col(c).cast("double"))
    if models is not None:
        gene = F.when(gene.isin(models), gene).otherwise(F.raise_error(F.concat(F.lit("unknown model: "), gene)).cast("string"))
    return cut.select(gene.alias("gene"), "read_id", (F.abs(F.col("ali_to").cast("long") - F.col("ali_from").cast("long")) + 1).alias("aligned"), finite("e").alias("e"), finite("score").alias("score"))


def search_hits(spark: SparkSession, path: str) -> DataFrame:
    """hmmsearch tables, lenient: the least e-value of each locus and gene."""
    cut = fields(spark.read.text(path), 19, ["locus_tag", "", "gene", "", "e"], strict=False)
    return cut.groupBy("locus_tag", "gene").agg(F.min(F.col("e").try_cast("double")).alias("e"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Four-line records, numbered within their file; a truncated or misplaced record fails the query. Blank lines count as
    lines, but for those at the end of a file. Lines meet by file and record, so a file is read by many tasks."""
    lines = numbered_lines(spark, path)
    at = lambda i: F.max(F.when(F.col("line") % 4 == i, F.col("value")))
    each = lines.groupBy("file", F.floor(F.col("line") / 4).alias("ordinal")).agg(*[at(i).alias(f"l{i}") for i in range(4)])
    each = each.where(F.concat_ws("", "l0", "l1", "l2", "l3") != "")
    good = F.col("l0").startswith("@") & F.col("l2").startswith("+") & (F.length("l1") == F.length("l3"))
    header = F.when(F.coalesce(good, F.lit(False)), F.col("l0")).otherwise(F.raise_error(F.concat(F.lit("malformed or truncated record in "), F.col("file"))).cast("string"))
    return each.select("file", "ordinal", header.alias("header"), F.col("l1").alias("seq"), F.col("l3").alias("qual"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, header and sequence of each record, whatever its lines end with."""
    records = spark.read.text(path, lineSep="\n>").where(F.trim("value") != "")
    header = F.regexp_replace(F.split("value", "\n", 2)[0], "^>|\r$", "")
    return records.select(F.split(header, r"\s+")[0].alias("name"), header.alias("header"), F.regexp_replace(F.get(F.split("value", "\n", 2), F.lit(1)), r"\s", "").alias("seq"))


def from_manifest(spark: SparkSession, manifest: DataFrame, kind: str, schema: str) -> DataFrame:
    """All files of a kind in one scan, each row with the sample that its file belongs to. The manifest is the driver's list.

    Paths are compared as the file system spells them out, so a path without a scheme or a host matches its file in any
    store. A file of two samples, and a file that is not there, fail before the scan."""
    listed = manifest.where(F.col("kind") == kind).select("sample", "path").distinct().collect()
    if not listed:
        return spark.createDataFrame([], schema).withColumn("sample", F.lit(None).cast("string"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named: dict[str, str] = {}
    for row in listed:
        path = jvm.org.apache.hadoop.fs.Path(row.path)
        whole = path.getFileSystem(conf).resolvePath(path).toString()  # raises if there is no such file
        if named.setdefault(whole, row.sample) != row.sample:
            raise ValueError(f"{row.path} is listed for two samples")
    rows = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").schema(schema).csv(list(named)).withColumn("_path", _plain(F.col("_metadata.file_path")))
    samples = spark.createDataFrame([(w, v) for w, v in named.items()], "_path string, sample string").withColumn("_path", _plain(F.col("_path")))
    met = rows.join(F.broadcast(samples), "_path", "left")
    unmatched = F.raise_error(F.concat(F.lit("no sample for "), F.col("_path"))).cast("string")
    return met.withColumn("sample", F.coalesce("sample", unmatched)).drop("_path")


def _plain(path: Column) -> Column:
    """A path without its scheme and host, and decoded."""
    return F.url_decode(F.replace(F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))


def write_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The given columns in order, null as NA, booleans as True and False."""
    kinds = dict(df.dtypes)
    shown = [F.initcap(F.col(c).cast("string")).alias(c) if kinds[c] == "boolean" else F.col(c) for c in columns]
    df.select(*shown).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").option("emptyValue", "").csv(path)
