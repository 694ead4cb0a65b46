"""Best references: lengths of unions, and hits that cross one shuffle by pair without an aggregate ahead of it."""

from __future__ import annotations

import contextlib
import io
import random

from spanloom.operators import rollup as R


def test_best_reference_deals_hits_by_pair_once(spark):
    r = random.Random(4)
    rows = [(r.randint(1, 3), r.randint(1, 4), s, s + r.randint(0, 30), float(r.randint(90, 100))) for s in (r.randint(1, 90) for _ in range(60))]
    rows += [(9, 1, None, 5, 99.0), (9, 2, 5, None, 99.0), (1, 1, None, 500, 100.0)]
    hits = spark.createDataFrame(rows, "subject int, ref int, s long, e long, pident double")
    lengths = spark.createDataFrame([(1, "a", 120), (2, "a", 130), (3, "b", 140), (4, "b", 110)], "ref int, kind string, ref_len int")
    want = {}
    kinds = {1: ("a", 120), 2: ("a", 130), 3: ("b", 140), 4: ("b", 110)}
    for subject, ref in {x[:2] for x in rows}:
        mine = [x for x in rows if x[:2] == (subject, ref)]
        covered = {p for x in mine if x[2] and x[3] for p in range(x[2], x[3] + 1)}
        identity = max(x[4] for x in mine)
        if covered and identity >= 95:
            kind, size = kinds[ref]
            want[subject, kind] = max(want.get((subject, kind), (0, 0)), (len(covered) / size, identity))
    best = R.best_reference(hits, lengths, "subject", "ref", "kind", 95.0)
    assert {(x.subject, x.kind): (x.coverage, x.identity) for x in best.collect()} == want
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        best.explain()
    final = plan.getvalue().split("Initial Plan")[-1]
    assert final.count("Exchange hashpartitioning(subject") == 2  # by pair, and by kind
