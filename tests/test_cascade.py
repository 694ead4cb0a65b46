"""The founder cascade, rule by rule, on small hand-made cases."""

from __future__ import annotations

import random
import statistics

import pytest

from spanloom.operators import cascade as C

COLUMNS = "c string, f string, rank int, period double, score double, identity double, iqr double, occupancy double, coverage double, contrast double, proposed double, basic double"


def call(spark, rows, motifs=None):
    """rows: (case, family, proposed, basic, [(period, score, identity, iqr, occupancy, coverage, contrast)])."""
    flat = [(c, f, i + 1, *map(float_or_none, p), proposed, basic) for c, f, proposed, basic, peaks in rows for i, p in enumerate(peaks)]
    df = spark.createDataFrame(flat, COLUMNS)
    return {r.c: r for r in C.founders(df, "c", "f", motifs).collect()}


def float_or_none(x):
    return None if x is None else float(x)


def peak(period, score=0.5, identity=0.9, iqr=None, occupancy=None, coverage=None, contrast=None):
    return period, score, identity, iqr, occupancy, coverage, contrast


def test_first_call_and_tiers(spark):
    got = call(spark, [
        ("plain", "A", 540.0, None, [peak(540, 0.9, 0.95), peak(180, 0.3, 0.8), peak(270, 0.3, 0.75)]),
        ("none", "B", 100.0, None, [peak(100, 0.9, 0.3)]),
        ("lost", "C", None, None, [peak(77, 0.9, 0.9)]),
        ("first", "D", 900.0, None, [peak(150, 0.9, 0.72), peak(900, 0.3, 0.95), peak(450, 0.3, 0.99)]),
    ])
    assert (got["plain"].founder, got["plain"].multiple, got["plain"].tier, got["plain"].method) == (180, 3, "strict", "strict")
    assert abs(got["plain"].gain - 15) < 1e-6
    assert (got["none"].founder, got["none"].multiple, got["none"].tier) == (100, 1, "none")
    assert (got["lost"].founder, got["lost"].method, got["lost"].gain) == (77, "fallback", None)
    assert (got["first"].strongest, got["first"].founder, got["first"].multiple) == (450, 150, 3)


def test_consensus_rescue_anchor_and_loose_divisor(spark):
    same = [(f"s{i}", "A", 600.0, None, [peak(600, 0.9, 0.95), peak(200, 0.3, 0.8)]) for i in range(4)]
    got = call(spark, same + [
        ("near", "A", 650.0, None, [peak(650, 0.9, 0.95), peak(205, 0.2, 0.55)]),
        ("loose", "Z", 650.0, None, [peak(650, 0.9, 0.95), peak(300, 0.2, 0.8)]),
        ("anchored", "A", 5001.0, None, [peak(200, 0.9, 0.8), peak(5018, 0.9, 0.95), peak(700, 0.2, 0.6)]),
    ])
    assert (got["near"].founder, got["near"].multiple, got["near"].method, got["near"].irregular) == (205, 3, "consensus", True)
    assert (got["loose"].founder, got["loose"].multiple, got["loose"].method, got["loose"].tier) == (300, 2, "loose", "weak")
    assert (got["anchored"].founder, got["anchored"].multiple, got["anchored"].method) == (200, 25, "consensus")


def test_motif_cluster_and_basic(spark):
    motifs = spark.createDataFrame([("S", 3)], "f string, motif_length int")
    got = call(spark, [
        ("motif", "S", 540.0, None, [peak(540, 0.9, 0.95), peak(180, 0.3, 0.8)]),
        ("heavy", "A", None, None, [peak(900, 0.5, 0.2), peak(300, 0.4, 0.2, coverage=0.3, contrast=0.6), peak(310, 0.2, 0.2)]),
        ("light", "A", None, None, [peak(900, 0.9, 0.2), peak(300, 0.4, 0.2, coverage=0.3, contrast=0.6), peak(310, 0.2, 0.2)]),
        ("deep", "B", 600.0, 150.0, [peak(600, 0.9, 0.95), peak(150, 0.2, 0.6, occupancy=0.95, coverage=0.9)]),
        ("thin", "B", 600.0, 150.0, [peak(600, 0.9, 0.95), peak(150, 0.2, 0.6, occupancy=0.95, coverage=0.5)]),
    ], motifs)
    assert (got["motif"].founder, got["motif"].strongest, got["motif"].method, got["motif"].multiple) == (3, 3, "motif", 1)
    assert (got["heavy"].founder, got["heavy"].method) == (305, "cluster") and got["light"].method == "fallback"
    assert (got["deep"].founder, got["deep"].multiple, got["deep"].method, got["deep"].tier) == (150, 4, "basic", "supported")
    assert got["thin"].method == "strict" and got["thin"].multiple == 1


def test_ladders(spark):
    ladder = [peak(1073, 0.3, 0.9), peak(179, 0.9, 0.65, 0.05, 0.8), peak(358, 0.2, 0.66), peak(537, 0.2, 0.66)]
    flat = [peak(358, 0.9, 0.72, 0.02, 0.9), peak(179, 0.3, 0.68, 0.02, 0.9)]
    clean = [peak(358, 0.9, 0.92, 0.02, 0.9), peak(179, 0.3, 0.68, 0.02, 0.9)]
    dominant = [peak(188, 0.9, 0.66, 0.05, 0.8), peak(3150, 0.3, 0.9), peak(376, 0.2, 0.65), peak(563, 0.2, 0.65)]
    got = call(spark, [("ladder", "A", 1073.0, None, ladder), ("flat", "B", 358.0, None, flat), ("clean", "C", 358.0, None, clean), ("dominant", "D", 188.0, None, dominant)])
    assert (got["ladder"].founder, got["ladder"].multiple, got["ladder"].method, got["ladder"].tier) == (179, 6, "ladder", "supported")
    assert got["flat"].multiple == 1 and (got["clean"].founder, got["clean"].multiple) == (179, 2)
    assert (got["dominant"].founder, got["dominant"].method, got["dominant"].tier) == (188, "dominant", "weak")


def test_review_columns(spark):
    got = call(spark, [("short", "A", 20.0, None, [peak(20, 0.1, 0.9), peak(500, 0.6, 0.5), peak(800, 0.7, 0.5), peak(2000, 0.05, 0.5)])])["short"]
    assert (got.founder, got.weak_short, got.longer, got.alternatives) == (20, True, 800, "800,500")


@pytest.mark.parametrize("seed", range(3))
def test_clusters_against_a_plain_walk(spark, seed):
    r = random.Random(seed)
    rows = [(c, k + 1, float(r.randrange(1, 4000)), r.randrange(1, 9) / 10) for c in range(20) for k in range(r.randrange(1, 12))]
    want = {}
    for c in range(20):
        clusters = []
        for _, period, rank in sorted((-s, p, k) for cc, k, p, s in rows if cc == c):
            home = [n for n, members in enumerate(clusters) if min(abs(period - q) - max(0.05 * q, 100) for q in members) <= 0]
            if home:
                clusters[home[0]].append(period)
            else:
                clusters.append([period])
            want[c, rank] = home[0] + 1 if home else len(clusters)
    got = C.period_clusters(spark.createDataFrame(rows, "c int, rank int, period double, score double"), "c").collect()
    assert {(x.c, x["rank"]): x.cluster for x in got} == want


def test_median_is_the_usual_one(spark):
    from pyspark.sql import functions as F

    for values in ([3.0], [1.0, 4.0], [5.0, 1.0, 2.0], [4.0, 3.0, 2.0, 9.0]):
        assert spark.createDataFrame([(values,)], "v array<double>").select(C._median(F.col("v"))).first()[0] == statistics.median(values)
    assert C.founders(spark.createDataFrame([], COLUMNS), "c", "f").count() == 0
