"""Readers against small files, good and bad."""

import hashlib
import os

import pytest
from cohortry.sources import reports, text_tables
from cohortry.streaming.incremental import append_fragments, conflicts, latest
from pyspark.sql import functions as F


def put(path, text):
    path.write_text(text)
    return str(path)


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    path = put(tmp_path / "long.txt", "".join(f"line {i}\n" for i in range(5000)))
    put(tmp_path / "short.txt", "a\n\nb")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = text_tables.numbered_lines(spark, path).collect()
        assert sorted((r.line, r.value) for r in rows) == [(i, f"line {i}") for i in range(5000)]
        both = text_tables.numbered_lines(spark, str(tmp_path)).where(F.col("file").endswith("short.txt")).collect()
        assert sorted((r.line, r.value) for r in both) == [(0, "a"), (1, ""), (2, "b")]
        fq = put(tmp_path / "many.fq", "".join(f"@r{i}\nAC\n+\nII\n" for i in range(2000)))
        assert [(r.ordinal, r.header) for r in text_tables.fastq(spark, fq).orderBy("ordinal").collect()] == [(i, f"@r{i}") for i in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(Exception, match="malformed"):
        text_tables.fastq(spark, put(tmp_path / "cut.fq", "@r\nAC\n+\n")).collect()


def test_features_end_at_the_sequences_of_their_own_file(spark, tmp_path):
    put(tmp_path / "a.gff", "##gff\nc\tx\tCDS\t11\t20\t.\t+\t0\tID=1\n##FASTA\n>c\nACGT\nd\tx\tCDS\t1\t2\t.\t+\t0\tID=9\n")
    put(tmp_path / "b.gff", "c\tx\tgene\t5\t6\t.\t-\t0\tID=2\nc\tx\tCDS\t7\t8\t.\t-\t0\tID=3\n")
    assert sorted(r.attributes["ID"] for r in text_tables.gff(spark, str(tmp_path)).collect()) == ["1", "2", "3"]


def test_manifest_paths_match_in_any_spelling(spark, tmp_path):
    one, two = put(tmp_path / "a b+c.tsv", "k\tv\nx\t1\n"), put(tmp_path / "two.tsv", "k\tv\ny\tNA\n")
    manifest = spark.createDataFrame([("s1", "qc", one), ("s2", "qc", "file://" + two), ("s3", "other", "/none")], "sample string, kind string, path string")
    rows = text_tables.from_manifest(spark, manifest, "qc", "k string, v int").collect()
    assert sorted((r["sample"], r.k, r.v) for r in rows) == [("s1", "x", 1), ("s2", "y", None)]
    with pytest.raises(Exception, match="none|exist"):
        text_tables.from_manifest(spark, manifest, "other", "k string")
    assert text_tables.from_manifest(spark, manifest, "absent", "k string").count() == 0


def test_sample_sheets_tell_all_problems_at_once(spark, tmp_path):
    sheet = put(tmp_path / "s.csv", "patient,bam\n a1 ,x.bam\n-bad,y.bam\na1,z.bam\n,w.bam\nb2,\n")
    samples, problems = reports.sample_sheet(spark, sheet)
    assert [(r["sample"], r.input) for r in samples.orderBy("row").collect()][0] == ("a1", "x.bam")
    told = sorted((r.row, r.message) for r in problems.collect())
    assert told == [(2, "repeated patient value a1"), (3, "invalid patient value -bad"), (4, "repeated patient value a1"), (5, "empty patient value"), (6, "empty alignment value")]
    long = put(tmp_path / "l.csv", "patient,fastq1,fastq2\na,r1,r2\n")
    assert [r.message for r in reports.sample_sheet(spark, long, long_reads=True)[1].collect()] == ["long reads have no mates"]
    assert reports.sample_sheet(spark, long)[1].count() == 0
    for bad in (["patient"], ["patient", "bam", "fastq1"]):
        with pytest.raises(ValueError):
            reports.input_kind(bad)


def test_taxonomies(spark, tmp_path):
    taxdb = put(tmp_path / "taxDB", "1\t1\troot\t\n2\t1\tBacteria\tsuperkingdom\n562\t2\tE. coli\tspecies\n")
    assert {(r.taxid, r.parent, r.rank) for r in reports.taxonomy(spark, taxdb=taxdb, nodes="x", names="y").collect()} == {(1, 1, "no rank"), (2, 1, "superkingdom"), (562, 2, "species")}
    nodes, names = put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\n562\t|\t1\t|\tspecies\t|\n"), put(tmp_path / "names.dmp", "1\t|\troot\t|\t\t|\tscientific name\t|\n562\t|\tE. coli\t|\t\t|\tscientific name\t|\n562\t|\tcolibacillus\t|\t\t|\tsynonym\t|\n")
    assert {(r.taxid, r.name, r.rank) for r in reports.taxonomy(spark, nodes=nodes, names=names).collect()} == {(1, "root", "no rank"), (562, "E. coli", "species")}
    with pytest.raises(ValueError, match="ranks"):
        reports.taxonomy(spark, nodes=names, names=names)
    with pytest.raises(Exception, match="invalid taxid"):
        reports.taxonomy(spark, taxdb=put(tmp_path / "bad", "x\t1\tn\tspecies\n")).collect()


def test_tool_reports(spark, tmp_path):
    genes = ["A", "B"]
    head = "# made by\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tx.bam\n"
    assert {(r.gene, r["count"]) for r in reports.feature_counts(spark, put(tmp_path / "ok", head + "A\tc\t1\t2\t+\t2\t5\nB\tc\t1\t2\t+\t2\t0\n"), genes).collect()} == {("A", 5.0), ("B", 0.0)}
    with pytest.raises(ValueError, match="missing B; unknown Z; count of A"):
        reports.feature_counts(spark, put(tmp_path / "bad", head + "A\tc\t1\t2\t+\t2\t-1\nZ\tc\t1\t2\t+\t2\t0\n"), genes)
    assert reports.abundances(spark, put(tmp_path / "none", "")).count() == 0
    assert [(r.taxon, r.reads) for r in reports.abundances(spark, put(tmp_path / "some", "name\ttaxonomy_id\tnew_est_reads\nE\t562\t7\nF\t1\t0\nG\t2\tx\n")).collect()] == [("E", 7.0)]
    for bad in ("name\ttaxonomy_id\nE\t562\n", "name\tnew_est_reads\nE\tx\n"):
        with pytest.raises(ValueError):
            reports.abundances(spark, put(tmp_path / "odd", bad))
    assert [tuple(r) for r in reports.bin_taxonomy(spark, put(tmp_path / "gtdb", "user_genome\tclassification\nb1\t\nb2\to__X\n")).orderBy("bin").collect()] == [("b1", "unclassified"), ("b2", "o__X")]
    with pytest.raises(ValueError, match="Genome_Size"):
        reports.bin_quality(spark, put(tmp_path / "cm", "Name\tCompleteness\tContamination\tGenome_size\tContig_N50\nb\t1\t2\t3\t4\n"))
    assert [(r.file, r.type, r.alleles) for r in reports.allele_table(spark, put(tmp_path / "mlst", "g.fa\tecoli\t-\tadk(1)\tgyrB(~2)\n")).collect()] == [("g.fa", None, ["adk(1)", "gyrB(~2)"])]
    assert [tuple(r) for r in reports.kraken_calls(spark, put(tmp_path / "k", "C\tr1\t562\t100\tx\nU\tr2\t0\t1\tx\nC\tr3\t0\t1\tx\n")).collect()] == [("r1", "562")]
    with pytest.raises(Exception, match="eight"):
        reports.diamond_hits(spark, put(tmp_path / "d", "a\tb\t1\n")).collect()
    assert reports.idxstats(spark, put(tmp_path / "i", "chr1\t10\t5\t1\n*\t0\t0\t7\n")).agg(F.sum("mapped"), F.sum("unmapped")).first() == (5, 8)
    with pytest.raises(Exception, match="idxstats"):
        reports.idxstats(spark, put(tmp_path / "i2", "*\t0\t3\t7\n")).collect()
    assert [tuple(r) for r in reports.flagstat(spark, put(tmp_path / "f", "10 + 2 in total (QC-passed reads + QC-failed reads)\n8 + 1 mapped (80.00% : N/A)\n")).collect()] == [("in total", 10, 2), ("mapped", 8, 1)]
    with pytest.raises(Exception, match="too few"):
        text_tables.paf_strict(spark, put(tmp_path / "p.paf", "q\t1\t2\n")).collect()


def test_headers_and_run_records(spark, tmp_path):
    sam = put(tmp_path / "h.sam", "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:10\n@PG\tID:bwa\tPN:bwa\tCL:bwa mem -R @RG:x ref\nr\t0\n")
    assert [(r.line, r.tags) for r in reports.header_records(spark, sam, "SQ").collect()] == [(1, {"SN": "chr1", "LN": "10"})]
    row = text_tables.sam(spark, put(tmp_path / "t.sam", "@HD\tx\nr\t0\tc\t5\t9\t3M\t*\t0\t0\tACG\tIII\tNM:i:2\tAS:i:40\tXX:Z:a:b\nshort\t0\n")).first()
    assert (row.score, row.nm, row.start, row.tags["XX"]) == (40, 2, 4, "a:b")
    assert reports.header_records(spark, sam, "PG").first().tags["CL"] == "bwa mem -R @RG:x ref"
    put(tmp_path / "r1.json", '{"invocation": {"params": {}, "parameters": {"mode": "wgs", "cap": 5}}, "params": {"mode": "old"}}')
    put(tmp_path / "r2.json", "PARAMETERS\n  mode   rna\n  other  x\n")
    rows = {r.file.rsplit("/", 1)[1]: (r.mode, r.cap) for r in reports.run_parameters(spark, str(tmp_path / "r*.json"), ["mode", "cap"]).collect()}
    assert rows == {"r1.json": ("wgs", "5"), "r2.json": ("rna", None)}
    digests = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in reports.output_digests(spark, str(tmp_path), largest=60).collect()}
    assert digests["r2.json"][1] and digests["r1.json"] == (os.path.getsize(tmp_path / "r1.json"), hashlib.sha256((tmp_path / "r1.json").read_bytes()).hexdigest()) and digests["r1.json"][0] > 60


def test_a_corrected_metric_replaces_the_old_one(spark, tmp_path):
    import os

    (tmp_path / "in").mkdir()
    for i, text in enumerate(("sample\tmetric\tvalue\ns\tn\t1\ns\tm\t5\n", "sample\tmetric\tvalue\ns\tn\t2\nt\tn\t7\nt\tn\t8\n")):
        path = put(tmp_path / "in" / f"{i}.tsv", text)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        append_fragments(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert sorted(tuple(r) for r in latest(table).where("sample = 's'").collect()) == [("s", "m", "5"), ("s", "n", "2")]
    assert [(r["sample"], r.metric) for r in conflicts(table).collect()] == [("t", "n")]
    reports.publish(latest(table), str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out"))[-2:] == ["sample=s", "sample=t"]
