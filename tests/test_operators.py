from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanloom.operators import graph as G
from spanloom.operators import rollup as R
from spanloom.operators import sequences as S
from spanloom.sinks import formats as K
from spanloom.sources import formats as X


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = G.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {x.node: x.component for x in got} == {x: root(x) for x in parent}
    assert G.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_annotation_coverage_counts_members_without_hits(spark):
    members = spark.createDataFrame([("T", "m1", 600), ("T", "m2", 600)], "grp string, member string, n long")
    hits = spark.createDataFrame([("m1", "x", 1, 200), ("m1", "x", 150, 400)], "member string, label string, s long, e long")
    got = R.annotation_coverage(hits, members, "grp", "member", "n", "label").first()
    assert abs(got.coverage - 400 / 600 / 2) < 1e-9


def test_motifs_and_repeats(spark):
    df = spark.createDataFrame([("tta",), ("GAT",)], "m string")
    assert [r[0] for r in df.select(S.canonical_motif(F.col("m"))).collect()] == ["AAT", "ATC"]
    found = S.find_ssrs("gg" + "at" * 10 + "cc")
    assert [(x["motif"], x["repeats"], x["start"]) for x in found] == [("at", 10, 3)]
    assert S.find_ssrs(None) == [] and [(x["motif"], x["repeats"], x["start"], x["end"]) for x in S.find_ssrs("c" + "a" * 40)] == [("a", 40, 2, 41)]
    assert [x["motif"] for x in S.find_ssrs("a" * 40 + "gc" * 9)] == ["gc"]  # one letter counts only where there is nothing else
    motifs = spark.createDataFrame([(["ATAT", "AT", "GC", "ATC"],)], "m array<string>")
    assert motifs.select(S.unique_motifs(F.col("m"))).first()[0] == ["AT", "GC", "ATC"]


def test_sources_and_sinks_round_trip(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first\nACGT\nAC\n>s2\nTT\n")
    fasta = X.read_fasta(spark, str(tmp_path / "a.fa")).drop("rec_no")
    assert sorted(map(tuple, fasta.collect())) == [("s1", "ACGTAC", 6), ("s2", "TT", 2)]
    K.write_fasta(fasta, str(tmp_path / "out"))
    assert sorted(map(tuple, X.read_fasta(spark, str(tmp_path / "out")).drop("rec_no").collect())) == sorted(map(tuple, fasta.collect()))
    (tmp_path / "a.gff3").write_text("##gff-version 3\nchr1\tx\ttandem\t5\t9\t1\t.\t.\tName=F_1;ssr=AT (9%25)\n")
    gff = X.read_gff3(spark, str(tmp_path / "a.gff3"))
    assert gff.first().attributes == {"Name": "F_1", "ssr": "AT (9%25)"}
    K.write_gff3(gff, str(tmp_path / "gff"), ["Name", "ssr"])
    assert X.read_gff3(spark, str(tmp_path / "gff")).collect() == gff.collect()
    assert all(p.read_text().startswith("##gff-version 3\n") for p in (tmp_path / "gff").glob("part-*"))
    K.write_gff3_by_name(gff, str(tmp_path / "named"), ["Name", "ssr"])
    assert [p.read_text().splitlines()[0] for p in (tmp_path / "named" / "Name=F_1").glob("part-*")] == ["##gff-version 3"]
    (tmp_path / "empty.tsv").write_text("")
    assert X.read_hits(spark, str(tmp_path / "empty.tsv")).count() == 0
    (tmp_path / "a.out").write_text("h\n\nh\n 12 1 2 3 chr1 7 90 (5) C Fam#x Cls 1 2\nbad\n")
    assert [(r.seqid, r.s, r.e, r.strand, r.ref) for r in X.read_repeat_hits(spark, str(tmp_path / "a.out")).collect()] == [("chr1", 7, 90, "+", "Fam#x")]
    (tmp_path / "p.txt").write_text(">c1|H\n1 2.5 NA\n>c1|bg\n3\n")
    assert {(r.case_id, r.kind): r["values"] for r in X.read_periodograms(spark, str(tmp_path / "p.txt")).collect()} == {("c1", "H"): [1.0, 2.5, None], ("c1", "bg"): [3.0]}


def test_streaming_merge_matches_batch(spark, tmp_path):
    from spanloom.streaming.merge import window_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = window_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), ["event_type"], "ts", "1 hour")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, window_counts(events, ["event_type"], "ts", "1 hour").collect()))


def test_annotation_shares_whatever_the_order(spark):
    members = spark.createDataFrame([(1, m, 2000) for m in range(7)], "grp int, member int, len int")
    hits = [(m, "A", s, s + 90) for m in range(7) for s in range(1, 2000, 177 + m)] + [(m, "B", 1, 1091) for m in range(7)]
    seen = set()
    for parts in (1, 2, 5, 11):
        df = spark.createDataFrame(hits, "member int, label string, s long, e long").repartition(parts, "s")
        coverage = R.annotation_coverage(df, members, "grp", "member", "len", "label")
        text = R.describe_annotations(coverage, members.select("grp").distinct(), "grp", "label")
        seen.add((tuple(sorted(map(tuple, coverage.collect()))), text.first().annotation))
    assert len(seen) == 1 and "B (54.6%25)" in seen.pop()[1]
