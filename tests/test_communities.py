"""A round of ``communities`` against plain modularity, and what it shuffles."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanloom.operators import graph as G


def test_a_round_gives_modularity_and_moves_and_sends_an_edge_once(spark):
    rng = random.Random(7)
    edges = [(a, b, rng.choice((1.0, 2.5))) for a in range(24) for b in range(a, 24) if rng.random() < 0.3]
    links = spark.createDataFrame(edges, "src long, dst long, weight double")
    labels = {i: i % 4 for i in range(24)}
    total, k = sum(w for *_, w in edges), dict.fromkeys(labels, 0.0)
    for a, b, w in edges:
        k[a] += w
        k[b] += w
    tot = {c: sum(k[i] for i in k if labels[i] == c) for c in range(4)}
    held = spark.createDataFrame([(i, c, k[i], tot[c]) for i, c in labels.items()], "node long, community long, k double, tot double")

    def plain(of: dict[int, int]) -> float:
        sums = [sum(k[i] for i in k if of[i] == c) for c in set(of.values())]
        return sum(w for a, b, w in edges if of[a] == of[b]) / total - sum((s / (2 * total)) ** 2 for s in sums)

    sent = G._dealt(links, rows=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sent.join(held.select(F.col("node").alias("dst"), "community"), "dst")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ENSURE_REQUIREMENTS") == 1  # the labels only; the edges lie as they are
        best, quality = G._best(held, sent, sum(w for a, b, w in edges if a == b), total, 1.0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert abs(quality - plain(labels)) < 1e-9
    rows = best.where("c is not null").collect()
    assert rows
    for r in rows:
        others = [plain(labels | {r.src: c}) - plain(labels) for c in range(4) if c != r.own]
        assert abs(r.gain / total - (plain(labels | {r.src: r.c}) - plain(labels))) < 1e-8
        assert r.gain / total > max(others) - 1e-8
    sent.unpersist()
