"""Numbering, packing and sliding complexity against plain Python."""

from __future__ import annotations

import random

import pytest

from spanloom.operators import complexity as C
from spanloom.operators import packing as P
from spanloom.operators.sequences import find_ssrs
from tests.test_tandem import dna


def test_packing(spark):
    r = random.Random(1)
    rows = [(i, r.randint(0, 90)) for i in range(500)] + [(500, None)]
    df = spark.createDataFrame(rows, "id int, size long").repartition(7)
    got = sorted(map(tuple, P.running_before(df, "size", ["id"]).collect()))
    assert got == [(i, s, sum(x or 0 for _, x in rows[:i])) for i, s in rows]
    parts = {}
    for x in P.pack_by_size(df, "size", 400, ["id"]).collect():
        parts.setdefault(x.part, []).append(x)
    assert sum(map(len, parts.values())) == 501 and all(abs(sum(x.size or 0 for x in p) - 400) < 90 for k, p in parts.items() if 0 < k < max(parts))
    assert sorted((x.id, x.part) for x in P.round_robin_parts(df, "size", 6, "id").collect()) == sorted((i, k % 6) for k, (i, _) in enumerate(sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))))
    even = [x.part for x in P.even_parts(df, 4, ["id"]).orderBy("id").collect()]
    assert even == [k // 126 for k in range(501)]
    assert P.row_numbers(df.where("false"), ["id"]).count() == P.even_parts(df.where("false"), 3, ["id"]).count() == 0


def test_names_to_indices_and_back(spark):
    names = spark.createDataFrame([("b",), ("a",), ("10",)], "name string")
    index = P.index_names(names, "name", ["name"])
    assert sorted(map(tuple, index.collect())) == [("1", "10"), ("2", "a"), ("3", "b")]
    hits = spark.createDataFrame([("3", 5), ("1", 6), ("9", 7), (None, 8)], "q string, n int")
    assert sorted(map(tuple, P.restore_names(hits, index, "q", "name").collect()), key=lambda x: x[1]) == [("b", 5), ("10", 6), ("9", 7), (None, 8)]


def plain_masked(text, window, level):
    masked = set()
    for at in range(max(1, len(text) - window + 1)):
        part = text[at : at + window].upper()
        triplets = [part[i : i + 3] for i in range(len(part) - 2)]
        known = [t for t in triplets if set(t) <= set("ACGT")]
        pairs = sum(x == y for i, x in enumerate(known) for y in known[i + 1 :])
        if triplets and pairs / max(1, len(triplets) - 1) > level:
            masked |= set(range(at + 1, at + len(part) + 1))
    return masked


@pytest.mark.parametrize("piece", [50, 250_000])
def test_sliding_complexity(spark, piece):
    r = random.Random(4)
    rows = [(1, dna(r, 60) + "AC" * 30 + dna(r, 80) + "A" * 25 + dna(r, 40)), (2, "acg" * 12), (3, "A" * 20), (4, "AC"), (5, ""), (6, None), (7, dna(r, 150)), (8, "N" * 90), (9, "A" * 30 + "N" + "A" * 30)]
    df = spark.createDataFrame(rows, "id int, text string")
    spans = {}
    for x in C.low_complexity(df, "id", "text", window=32, level=1.5, piece=piece).collect():
        spans.setdefault(x.id, set()).update(range(x.s, x.e + 1))
    want = {i: m for i, t in rows if t and (m := plain_masked(t, 32, 1.5))}
    assert spans == want and {1, 2, 3} <= set(want)
    got = {x.id: (x.share, x.covered) for x in C.gated_ssr_coverage(df, "id", "text", window=32, level=1.5, piece=piece).collect()}
    for i, t in rows:
        share = len(want.get(i, ())) / len(t) if t else None
        assert got[i][0] == share
        covered = {p for x in find_ssrs(t) for p in range(x["start"], x["end"] + 1)} if share and share > 0.8 else set()
        assert got[i][1] == pytest.approx(len(covered) / len(t) if covered else 0.0)
