"""Depth, bedGraph, GenBank and index sources, digests of files of any size, and the table that fragments are upserted into."""

import hashlib
import os
import random
import struct

import pytest
from cohortry.sources import records, reports, text_tables
from cohortry.streaming import incremental
from pyspark.sql import functions as F


def test_bedgraph(spark, tmp_path):
    good = tmp_path / "a.bedgraph"
    good.write_bytes(b"track type=bedGraph\n# x\n\nc1\t0\t10\t1.5e1\r\nc1\t10\t12\t0\n")
    assert [tuple(r) for r in records.bedgraph(spark, str(good)).orderBy("start").collect()] == [("c1", 0, 10, 15.0), ("c1", 10, 12, 0.0)]
    (tmp_path / "none").write_text("track\n\n")
    with pytest.raises(ValueError, match="no data rows"):
        records.bedgraph(spark, str(tmp_path / "none"))
    for bad in ("c\t1\t2", "c\t2\t2\t1", "c\t-1\t2\t1", "c\t1\t2\tnan", "c\t1\t2\tinf", "c\t1\t2\t-1", "c\tx\t2\t1", "c\t1\t2\t1\t5"):
        (tmp_path / "bad").write_text(bad + "\n")
        with pytest.raises(Exception, match="not a bedGraph row"):
            records.bedgraph(spark, str(tmp_path / "bad")).collect()


def test_depth(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("c\t1\t0\nc\t2\t3\nnote\nc\t3\t1\nc\t4\t2\n")
    rows = records.depth(spark, str(tmp_path / "d.tsv"))
    assert [tuple(r)[1:] for r in records.depth_breadths(rows, 4).collect()] == [(0.75, 0.5, 0.25)]
    with pytest.raises(Exception, match="expected 5 depth positions, observed 4"):
        records.depth_breadths(rows, 5).collect()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_genbank_and_fasta(spark, tmp_path, end):
    text = end.join(["LOCUS       BGC1  9 bp", "DEFINITION  a polyketide", "ORIGIN", "        1 acgta cgnnx", "//", "LOCUS       BGC2 3 bp", "FEATURES clbB", "//", ""])
    (tmp_path / "a.gbk").write_bytes(text.encode())
    got = {r.name: r for r in records.genbank(spark, str(tmp_path / "a.gbk")).collect()}
    assert {n: r.sequence for n, r in got.items()} == {"BGC1": "ACGTACGNN", "BGC2": ""} and "polyketide" in got["BGC1"].text
    (tmp_path / "a.fa").write_bytes(end.join([">a x", "AC", "GT", ">b", "T", ""]).encode())
    assert sorted(map(tuple, text_tables.fasta(spark, str(tmp_path / "a.fa")).collect())) == [("a", "a x", "ACGT"), ("b", "b", "T")]


def test_cluster_status(spark):
    rows = [("makes colibactin, a polyketide", 9_000, "own_cluster"), ("has clbC and NRPS", 9_000, "own_cluster"), ("a terpene", 9_000, "other_class"), ("T1PKS", 4_999, "too_short"), ("Nonribosomal", 5_000, "kept"), ("clbZ transAT", 5_000, "kept")]
    got = spark.createDataFrame(rows, "t string, n int, want string").withColumn("got", records.cluster_status(F.col("t"), F.col("n"))).collect()
    assert all(r.got == r.want for r in got)


def test_index_heads(spark, tmp_path):
    rng = random.Random(1)
    sequences = [(f"chr{i}" if i else "", rng.choice([10, 0x0A0A0A0A, 2**32 - 1])) for i in range(40)] + [("n\nl", 266)]
    head = b"MMI\x02" + struct.pack("<5I", 10, 15, 14, len(sequences), 2) + b"".join(bytes([len(n)]) + n.encode() + struct.pack("<I", size) for n, size in sequences)
    (tmp_path / "a.mmi").write_bytes(head + rng.randbytes(5000))
    (tmp_path / "b.mmi").write_bytes(head)
    for name in "ab":
        got = records.index_sequences(spark, str(tmp_path / f"{name}.mmi")).orderBy("place").collect()
        assert [(r.name, r.length) for r in got] == sequences and got[0][1:4] == (10, 15, 2)
    (tmp_path / "cut.mmi").write_bytes(head[:-3])
    (tmp_path / "odd.mmi").write_bytes(b"MMI\x03" + head[4:])
    for name, said in (("cut", "cut off"), ("odd", "not an index")):
        with pytest.raises(Exception, match=said):
            records.index_sequences(spark, str(tmp_path / f"{name}.mmi")).collect()


def test_digests_of_files_of_any_size(spark, tmp_path):
    rng = random.Random(2)
    made = {"a.bin": rng.randbytes(70_000), "b b[1].bin": rng.randbytes(40_000) + b"\n", "c.txt": b"x\r\ny\r\n" * 9_000, "d.txt": b"\n" * 5_000, "empty": b"", "small": b"abc", "e.gz": rng.randbytes(9_000), "f": b"\xff\xfe" * 4_000, "g": b"l" * 60_000}
    (tmp_path / "in").mkdir()
    for name, content in made.items():
        (tmp_path / "in" / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # several blocks a file
        got = {os.path.basename(r.path.replace("%20", " ").replace("%5B", "[").replace("%5D", "]")): (r.bytes, r.sha256) for r in reports.output_digests(spark, str(tmp_path / "in"), 1_000).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in made.items() if c}


def test_fragments_are_upserted_over_triggers(spark, tmp_path):
    arriving, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    os.mkdir(arriving)

    def arrive(name, rows, at):
        path = os.path.join(arriving, name)
        with open(path, "w") as f:
            f.write("sample\tmetric\tvalue\n" + "".join("\t".join(r) + "\n" for r in rows))
        os.utime(path, (at, at))
        incremental.upsert_fragments(spark, arriving, table, checkpoint, 4)
        return {(r["sample"], r.metric): r.value for r in spark.read.parquet(table).collect()}

    assert arrive("a.tsv", [("s", "reads", "1"), ("t", "reads", "5")], 1_000) == {("s", "reads"): "1", ("t", "reads"): "5"}
    assert arrive("b.tsv", [("s", "reads", "2"), ("s", "genes", "7")], 2_000) == {("s", "reads"): "2", ("s", "genes"): "7", ("t", "reads"): "5"}
    # a file that was written earlier does not win over a later one, though it arrives after it
    assert arrive("c.tsv", [("s", "reads", "0"), ("u", "reads", "NA")], 500) == {("s", "reads"): "2", ("s", "genes"): "7", ("t", "reads"): "5", ("u", "reads"): None}
    incremental.upsert_fragments(spark, arriving, table, checkpoint, 4)  # a restart without new files
    assert spark.read.parquet(table).count() == 4
