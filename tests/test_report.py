"""Readers, sinks and report operators on small inputs, and graph operators against plain Python."""

from __future__ import annotations

import gzip
import random
import warnings

import pytest
from pyspark.sql import functions as F

from spanloom.operators import graph as G
from spanloom.operators import report as R
from spanloom.operators import sequences as S
from spanloom.sinks import formats as K
from spanloom.sources import formats as X
from spanloom.sources import tables as T


def test_fasta_repeats_and_missing_header(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 x\nAC\n>s2\nTT\n>s1\nGG\n")
    records = X.read_fasta(spark, str(tmp_path / "a.fa"))
    assert [r.seq_id for r in records.orderBy("rec_no").collect()] == ["s1", "s2", "s1"]
    assert {r.seq_id: r.seq for r in X.last_of_each(records).collect()} == {"s1": "GG", "s2": "TT"}
    assert X.checked_fasta(spark, str(tmp_path / "a.fa")).count() == 3
    assert [r.seq for r in X.only_ids(records, spark.createDataFrame([("s2",)], "seq_id string")).collect()] == ["TT"]
    (tmp_path / "b.fa").write_text("ACGT\n>s1\nAC\n")
    with pytest.raises(Exception, match="no header"):
        X.checked_fasta(spark, str(tmp_path / "b.fa")).collect()


def test_gzip_by_content(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plain.txt").write_text("a\nb\n")
    (folder / "packed.txt").write_bytes(gzip.compress(b"c\nd\n"))
    assert sorted(r.value for r in T.read_any_text(spark, str(folder)).collect()) == ["a", "b", "c", "d"]


def test_strict_attributes(spark):
    df = spark.createDataFrame([("a=1;bad;b=2=3",)], "t string")
    assert df.select(X.attribute_map(F.col("t"))).first()[0] == {"a": "1", "b": "2=3"}
    with pytest.raises(Exception, match="no key and value"):
        df.select(X.attribute_map(F.col("t"), strict=True)).collect()


def test_manifest(spark, tmp_path):
    (tmp_path / "m.tsv").write_text(f"input_dir\tsample_code\trun_prefix\n{tmp_path}\tA\tp\n{tmp_path}/none\tB\tp\n")
    with pytest.warns(UserWarning, match="none"):
        assert T.read_manifest(spark, str(tmp_path / "m.tsv")).count() == 2
    (tmp_path / "bad.tsv").write_text("input_dir\tsample_code\nx\tA\n")
    with pytest.raises(ValueError, match="_prefix"):
        T.read_manifest(spark, str(tmp_path / "bad.tsv"))


def test_bundle_and_side_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, None, True, ["x", "y"]), (2, 0.5, None, None)], "id int, share double, sure boolean, labels array<string>")
    said = K.write_bundle({"families": (df, {"id": "number", "sure": "whether", "share": "part", "labels": "all"})}, str(tmp_path / "out"))
    assert [r.column for r in said.orderBy("position").collect()] == ["id", "sure", "share", "labels"]
    back = T.read_rows(spark, str(tmp_path / "out" / "families"))
    assert back.columns == ["id", "sure", "share", "labels"]
    assert sorted(tuple(v or "" for v in r) for r in back.collect()) == [("1", "true", "", "x, y"), ("2", "", "0.5", "")]
    K.write_superfamilies(spark.createDataFrame([(1, "TRC_2", True)], "superfamily int, member string, attached boolean"), str(tmp_path / "sf"))
    assert T.superfamily_table(spark.read.csv(str(tmp_path / "sf"), header=True)).first() == (1, ["TRC_2"], ["TRC_2"])
    features = spark.createDataFrame([("c", "s", "t", 1, 5, "1", ".", ".", {"Name": "F1", "k": "old"}), ("c", "s", "t", 7, 9, "1", ".", ".", {"Name": "F2"})], X.GFF.replace("attributes string", "attributes map<string,string>"))
    more = K.with_attributes(features, spark.createDataFrame([("F1", "new")], "Name string, k string"), "Name", ["k"])
    assert [r.attributes for r in more.orderBy("start").collect()] == [{"Name": "F1", "k": "new"}, {"Name": "F2"}]
    K.write_graph(df.select("id"), df.select("id"), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g" / "edges")).count() == 2


def test_conversion_table(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("a\tb\nonly\nc\td\n")
    assert sorted(map(tuple, T.read_conversion(spark, str(tmp_path / "c.tsv")).collect())) == [("a", "b"), ("c", "d")]


def test_thresholds():
    with pytest.raises(ValueError, match="identity.*coverage"):
        R.check_thresholds(identity=0, coverage=80)
    with pytest.warns(UserWarning, match="score=0"):
        R.check_thresholds(score=0)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        R.check_thresholds(identity=80, coverage=0.8, score=20, resolution=1.0, rounds=2)


def test_row_order_puts_near_rows_together(spark):
    rows = [("a", 0.0, 0.0), ("b", 10.0, 0.0), ("c", 0.1, 0.0), ("d", 10.0, 1.0), ("e", 50.0, 50.0)]
    order = R.row_order(spark.createDataFrame(rows, "k string, x double, y double"), "k")
    assert sorted(order) == list("abcde")
    assert abs(order.index("a") - order.index("c")) == 1 and abs(order.index("b") - order.index("d")) == 1 and order.index("e") in (0, 4)


def plain_modularity(edges, label):
    total = sum(edges.values())
    degree, inside = {}, 0.0
    for (a, b), w in edges.items():
        for x in (a, b):
            degree[label[x]] = degree.get(label[x], 0) + w
        inside += w * (label[a] == label[b])
    return inside / total - sum((d / (2 * total)) ** 2 for d in degree.values())


def test_communities_find_planted_groups(spark):
    rng = random.Random(4)
    edges = {}
    for a in range(48):
        for b in range(a + 1, 48):
            if rng.random() < (0.8 if a // 12 == b // 12 else 0.03):
                edges[a, b] = rng.choice((1.0, 2.0))
    df = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src long, dst long, weight double")
    got = {r.node: r.community for r in G.communities(df).collect()}
    assert got == {i: i // 12 * 12 for i in range(48)}
    labels = spark.createDataFrame([(i, i % 5) for i in range(48)], "node long, community long")
    assert abs(G.modularity(df, labels) - plain_modularity(edges, {i: i % 5 for i in range(48)})) < 1e-9
    assert G.communities(df.where("false")).count() == 0


def plain_ssrs(text):
    """Repeats found by comparing letters, without regular expressions."""
    found, runs = {}, []
    for size, least in S.SSR_LIMITS:
        at = 0
        while at + size <= len(text):
            motif = text[at : at + size]
            n = 1
            while text[at + n * size : at + (n + 1) * size] == motif:
                n += 1
            if n >= least and set(motif) <= set("gatc"):
                row = (motif, n, at + 1, at + n * size)
                if len(set(motif)) > 1:
                    found.setdefault(at, row)
                elif size == 1:
                    runs.append(row)
                at += n * size
            else:
                at += 1
    return [found[k] for k in sorted(found)] or runs


def test_repeats_of_all_documents_against_a_plain_scan(spark):
    from spanloom.plans.adapters import dna_docs
    from spanloom.plans.registry import QUERIES

    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.seq.lower() for r in dna_docs(spark, data).collect() if r.seq is not None and len(r.seq) < 3000}
    rng = random.Random(1)
    assert all(plain_ssrs(t) == [(x["motif"], x["repeats"], x["start"], x["end"]) for x in S.find_ssrs(t)] for t in ("".join(rng.choice("at") for _ in range(400)) for _ in range(40)))
    got = {}
    for r in QUERIES["ssr_scan"](spark, data).collect():
        got.setdefault(r.doc_id, []).append((r.motif, r.repeats, r.start, r.end))
    assert all(got.get(k, []) == plain_ssrs(t) for k, t in texts.items())
    lengths = {r.doc_id: len(r.seq) for r in dna_docs(spark, data).collect()}
    shares = {}
    for r in QUERIES["ssr_summary"](spark, data).collect():
        shares[r.doc_id] = shares.get(r.doc_id, 0) + r.percent
    assert all(abs(shares[k] - 100 * sum(len(m) * n for m, n, _, _ in rows) / lengths[k]) < 1e-4 for k, rows in got.items())


def test_window_shifts_against_direct_correlation(spark):
    """Every window of the registered query, turned by hand through all shifts."""
    from spanloom.plans.consensus_queries import PERIOD, tally
    from spanloom.plans.registry import QUERIES

    data = "/root/testdata/sf0.001"
    counts = {}
    for r in tally(spark, data).collect():
        counts.setdefault(r.doc_id, {}).setdefault(r.window_no, [[0] * 4 for _ in range(PERIOD)])[r.pos]["ACGT".index(r.base)] = r.n
    sharp = lambda w: max(map(sum, w)) / sum(map(sum, w))
    for r in QUERIES["window_shifts"](spark, data).collect():
        windows = counts[r.doc_id]
        ref = windows[min(windows, key=lambda k: (-sharp(windows[k]), k))]
        own = windows[r.window_no]
        agree = [sum(ref[p][b] * own[(p + s) % PERIOD][b] for p in range(PERIOD) for b in range(4)) for s in range(PERIOD)]
        assert agree[r.shift] == max(agree)


def test_statistics_images_and_suffixes(spark):
    from pyspark.sql import functions as F

    from spanloom.sources import tables as T

    rows = spark.createDataFrame([(1, '{"n_trcs_total": 12, "total_tr_length": "77", "n_ssrs": null, "version": "1.2-b"}'), (2, "{}"), (3, "no json"), (4, None), (5, '{"n_tras": 1.5}')], "id int, text string")
    got = {r.id: r for r in T.statistics_of_run(rows).collect()}
    assert (got[1].n_trcs_total, got[1].total_tr_length, got[1].n_ssrs, got[1].version) == (12, 77, None, "1.2-b")
    assert all(v is None for i in (2, 3, 4) for v in got[i][1:]) and got[5].n_tras is None
    cells = spark.createDataFrame([(1, '<img src="a/b.png" alt="x">'), (2, "<a><img src='c d.png'></a>"), (3, r'<img src=\"e.png\">'), (4, "none"), (5, None), (6, '<img src="">')], "id int, c string")
    assert {r.id: r.p for r in cells.select("id", T.image_path(F.col("c")).alias("p")).collect()} == {1: "a/b.png", 2: "c d.png", 3: "e.png", 4: None, 5: None, 6: None}
    names = spark.createDataFrame([("T_10",), ("T_9",), ("T",), ("T_x",), ("T_2_1",)], "n string")
    assert [r.n for r in names.orderBy(T.numeric_suffix(F.col("n")), "n").collect()] == ["T_9", "T_10", "T", "T_2_1", "T_x"]
    assert T.sample_columns(["Satellite_family", "a", "a_length", "b", "b_annot", "x_prevalent_annot", "prevalent_annot", "group_id"]) == ["a", "b"]
    page = spark.createDataFrame([("Program version : 1.10.2\n", 1), ("version: 2.0-rc1, more", 2), ("none", 3)], "html string, id int")
    assert {r.id: r.version for r in T.statistics_of_run(pages=page).collect()} == {1: "1.10.2", 2: "2.0-rc1", 3: None}
