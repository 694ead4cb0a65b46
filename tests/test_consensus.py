"""Consensus, clusters and nested repeats against plain Python and planted cases."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from spanloom.operators import consensus as K
from spanloom.operators import sequences as S
from spanloom.operators import subrepeats as N


def letters(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def turned(a, b):
    return len(a) == len(b) and b in a + a


def test_monomers_are_cut_at_anchors(spark):
    df = spark.createDataFrame([(1, "GGACTTTACTGACT"), (2, ""), (3, None)], "id int, seq string")
    anchors = spark.createDataFrame([(1, "ACT"), (2, "ACT"), (3, "ACT")], "id int, kmer string")
    assert sorted(map(tuple, K.monomers(df, "id", "seq", anchors, 5).collect())) == [(1, 0, "ACTTT"), (1, 1, "ACTGA")]


def test_stack_consensus(spark):
    rows = [("x", "AC-T"), ("x", "AG-T"), ("x", "AT--"), ("x", "aAGN"), ("y", "--"), ("y", None)]
    got = {r["k"]: r for r in K.stack_consensus(spark.createDataFrame(rows, "k string, s string"), "k", "s").collect()}
    assert got["x"]["consensus"] == "ANT" and (got["x"]["n_kept"], got["x"]["n_dropped"], got["x"]["n_n"]) == (3, 1, 1)
    assert abs(got["x"]["mean_entropy"] - 2 / 3) < 1e-9
    assert got["y"]["consensus"] == "" and got["y"]["mean_entropy"] is None and got["y"]["n_dropped"] == 2
    assert K.stack_consensus(spark.createDataFrame([], "k string, s string"), "k", "s").isEmpty()


def plain_buckets(lengths, tolerance=0.15):
    buckets, of = [], {}
    for value in sorted(lengths, reverse=True):
        b = next((i for i, x in enumerate(buckets) if abs(value - np.median(x)) <= tolerance * np.median(x)), len(buckets))
        if b == len(buckets):
            buckets.append([])
        buckets[b].append(value)
        assert of.setdefault(value, b + 1) == b + 1
    return of


def test_length_clusters(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice((10, 11, 12, 13, 15, 18, 20, 25, 40, 41, 50)), rng.randint(1, 9)) for k in range(20) for _ in range(rng.randint(1, 30))] + [(99, None, 1), (None, 5, 1)]
    got = K.length_clusters(spark.createDataFrame(rows, "k int, len int, cn int"), "k", "len", "cn").collect()
    assert {r["k"] for r in got} == set(range(20))
    for k in range(20):
        of = plain_buckets([n for key, n, _ in rows if key == k])
        assert {r["len"]: r["bucket"] for r in got if r["k"] == k} == of
        weight = {}
        for key, n, c in rows:
            if key == k:
                weight[of[n]] = weight.get(of[n], 0) + n * c
        assert {r["bucket"] for r in got if r["k"] == k and r["dominant"]} == {min(weight, key=lambda b: (-weight[b], b))}


def test_shifted_windows_are_turned_back(spark):
    rng = random.Random(7)
    unit = letters(rng, 30)
    # the second window starts 7 letters later in the unit; 600 is a multiple of 30
    text = unit * 20 + (unit[7:] + unit[:7]) * 20 + (unit * 3)[:45]
    df = spark.createDataFrame([(1, text)], "id int, seq string")
    tally = K.window_tally(df, "id", "seq", 30, 600)
    assert tally.agg(F.sum("n"), F.max("window_no")).first()[:] == (1245, 1)
    shifts = {r["window_no"]: r["shift"] for r in K.window_shifts(tally, "id", 30).collect()}
    assert (shifts[0] - shifts[1]) % 30 == 7
    whole = K.rotated_tally(tally, K.window_shifts(tally, "id", 30), "id", 30)
    got = "".join(r["base"] for r in S.consensus(whole, "id").orderBy("pos").collect())
    assert turned(unit, got) and whole.agg(F.sum("n")).first()[0] == 1245


def test_harmonics_see_a_half_period(spark):
    rng = random.Random(1)
    half = letters(rng, 20)
    df = spark.createDataFrame([(1, half * 40), (2, letters(rng, 40) * 20)], "id int, seq string")
    got = {(r["id"], r["k"]): r["strength"] for r in K.harmonics(S.base_tally(df, "id", "seq", 40), "id", 40).collect()}
    assert sorted(k for i, k in got if i == 1) == [2, 3, 4, 5]
    assert got[1, 3] < 1e-9 and got[1, 5] < 1e-9 and got[1, 2] > 0.01 and got[2, 3] > 1e-3
    short = K.harmonics(S.base_tally(df, "id", "seq", 8), "id", 8)
    assert {r["strength"] for r in short.collect()} == {0.0}


def test_cycles_give_the_planted_monomer(spark):
    rng = random.Random(3)
    unit = letters(rng, 60)
    text = "".join("".join(rng.choice("ACGT") if rng.random() < 0.01 else c for c in unit) for _ in range(60))
    df = spark.createDataFrame([(1, text), (2, "ACG"), (3, "")], "id int, seq string")
    got = K.monomer_cycles(S.kmer_counts(df, "seq", 11, ("id",)), "id").collect()
    assert [r["length"] for r in got if r["id"] == 1] == [60] and turned(unit, got[0]["monomer"])
    assert {r["id"] for r in got} == {1}


def test_strong_components_against_reachability():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 12)
        follow = {str(i): sorted({str(rng.randrange(n)) for _ in range(rng.randint(0, 2))}) for i in range(n)}
        reach = {}
        for i in follow:
            seen, todo = set(), [i]
            while todo:
                for x in follow[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            reach[i] = seen
        want = {frozenset(j for j in follow if j == i or (j in reach[i] and i in reach[j])) for i in follow}
        assert set(map(frozenset, K.strong_components(follow))) == {x for x in want if len(x) > 1}


def test_greedy_clusters_against_the_sequential_rule(spark):
    rng = random.Random(8)
    size = {i: rng.randint(1, 5) for i in range(60)}
    edges = [(rng.randrange(60), rng.randrange(50)) for _ in range(90)] + [(3, 3)]
    near = {i: {b if a == i else a for a, b in edges if i in (a, b) and a != b} for i in size}
    nodes = spark.createDataFrame(list(size.items()), "node long, size int")
    tie = {r.node: r.h for r in nodes.select("node", F.xxhash64("node").alias("h")).collect()}
    order, chosen = sorted(size, key=lambda i: (-size[i], tie[i])), {}
    for i in order:
        if not any(chosen.get(j) == j for j in near[i]):
            chosen[i] = i
    for i in order:
        if i not in chosen:
            chosen[i] = next(j for j in order if j in near[i] and chosen.get(j) == j)
    got = K.greedy_clusters(nodes, spark.createDataFrame(edges, "src long, dst long"), -F.col("size"))
    assert dict(map(tuple, got.collect())) == chosen and got.count() == 60
    none = spark.createDataFrame([], "src long, dst long")
    assert dict(map(tuple, K.greedy_clusters(nodes, none, -F.col("size")).collect())) == {i: i for i in size}
    assert K.greedy_clusters(nodes.where("size > 9"), none, -F.col("size")).isEmpty()


def test_greedy_clusters_of_repeated_nodes_and_long_chains(spark):
    rows = [(i, 1) for i in range(400)] + [(0, 25), (7, 25), (None, 3)]
    nodes = spark.createDataFrame(rows, "node long, size int")
    chain = spark.createDataFrame([(i, i + 1) for i in range(399)] + [(5, 9999)], "src long, dst long")
    got = dict(map(tuple, K.greedy_clusters(nodes, chain, -F.col("size"), max_rounds=30).collect()))
    assert set(got) == set(range(400)) and got[0] == 0 and got[7] == 7 and got[1] == 0
    assert all(got[got[i]] == got[i] and abs(i - got[i]) <= 1 for i in got)
    assert all(got[i] != i or got[i + 1] != i + 1 for i in range(399))


def test_tiers_of_null_peaks(spark):
    kinds = "period double, founder double, phantom boolean, occupancy double, identity double, coverage double, intervals int, phase double, auto double, nested boolean"
    blank = (None,) * 8
    rows = [(None, 90.0, *blank), (9.0, None, *blank), (9.0, 90.0, *blank), (9.0, 90.0, None, 0.16, None, None, None, 0.2, None, None), (28.0, 90.0, *blank), (80.0, 90.0, *blank)]
    got = [r[0] for r in spark.createDataFrame(rows, kinds).coalesce(1).select(N.peak_tier(F.col("founder"))).collect()]
    assert got == ["REJECT_BAD", "REJECT_NO_FOUNDER", "WEAK", "HIGH", "REJECT_AMBIGUOUS_LOW", "REJECT_TOO_LARGE"]


def test_candidates_and_their_gates(spark):
    cell = "other/305:d=0.084:sc=0.5:pc=0.1:localized; other/60:sc=x:d=0.6:localized;other/47:d=0.2:id=nan:localized;noslash:d=1;founder/20:d=0.9:localized;other/31:d=0.3:localized;other/29:d=0.25:weak"
    df = spark.createDataFrame([(1, cell), (2, None), (3, "")], "id int, cell string").withColumn("c", N.parse_candidates(F.col("cell")))
    rows = {r["id"]: r for r in N.nested_repeats(df, F.lit(180.0), F.col("c"), F.lit(None).cast("string"), F.lit(None).cast("double")).collect()}
    assert [(x["kind"], x["period"], x["density"], x["contrast"], x["label"]) for x in rows[1]["c"]][:3] == [("other", 305.0, 0.084, 0.5, "localized"), ("other", 60.0, 0.6, None, "localized"), ("other", 47.0, 0.2, None, "localized")]
    assert len(rows[1]["c"]) == 6
    assert [tuple(x) for x in rows[1]["nested"]] == [(31.0, 0.3), (47.0, 0.2)] and rows[1]["edge"] and rows[1]["edge_copies"] == 3
    for k in (2, 3):
        assert rows[k]["nested"] == [] and not rows[k]["edge"] and rows[k]["edge_copies"] is None
