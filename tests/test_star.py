"""Centre-star alignment against a plain table, and consensus of copies with insertions and deletions."""

from __future__ import annotations

import random

import pytest

from spanloom.operators import star
from tests.test_tandem import dna, mutated


def plain_score(a, b):
    row = [-star.GAP * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], -star.GAP * i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(last + (star.MATCH if x == y else star.MISMATCH), row[j] - star.GAP, row[j - 1] - star.GAP)
    return row[-1]


@pytest.mark.parametrize("seed", range(4))
def test_alignment_to_the_centre(seed):
    r = random.Random(seed)
    for _ in range(25):
        a = dna(r, r.randint(0, 40))
        b = mutated(r, a, 0.3) if r.random() < 0.8 else dna(r, r.randint(0, 40))
        row, extra = star.against(a, b, 60)
        assert len(row) == len(a) and len(extra) == len(a) + 1
        assert "".join(x + y for x, y in zip(extra, [*row, ""], strict=True)).replace("-", "") == b
        score = sum((star.MATCH if x == y else star.MISMATCH) if y != "-" else -star.GAP for x, y in zip(a, row, strict=True)) - star.GAP * sum(map(len, extra))
        assert score == plain_score(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_alignments_side_by_side_are_those_of_one_by_one(seed):
    r = random.Random(seed)
    pairs = []
    for _ in range(150):
        a = dna(r, r.choice([0, 1, r.randint(0, 30), r.randint(100, 160)]))
        pairs.append((a, a if r.random() < 0.2 else mutated(r, a, 0.3) if r.random() < 0.8 else dna(r, r.randint(0, 60))))
    pairs.append(("aé\U0001f600b", "é\U0001f600xb"))
    for band in (2, 24):
        want = [star.against(a, b, band) for a, b in pairs]
        assert star.all_against(pairs, band) == want and star._side_by_side(pairs, band) == want


def test_unequal_copies_give_the_planted_consensus(spark):
    r = random.Random(2)
    monomers = {k: dna(r, n) for k, n in (("a", 180), ("b", 60), ("c", 33))}
    rows = [(k, mutated(r, m, 0.06)) for k, m in monomers.items() for _ in range(40)] + [("a", None), (None, "ACGT"), ("d", "ACGT"), ("e", "")]
    df = spark.createDataFrame(rows, "k string, t string").repartition(3)
    stacks = {}
    for x in star.star_alignment(df, "k", "t").collect():
        stacks.setdefault(x.k, []).append(x.aligned)
    assert set(stacks) == {"a", "b", "c", "d", "e"}
    for k, stack in stacks.items():
        assert len({len(x) for x in stack}) == 1
        assert sorted(x.replace("-", "") for x in stack) == sorted(t for key, t in rows if key == k and t is not None)
    got = {x.k: x.consensus for x in star.star_consensus(df, "k", "t").collect()}
    assert {k: got[k] for k in monomers} == monomers and got["d"] == "ACGT"


def test_copies_between_anchors(spark):
    df = spark.createDataFrame([(1, "xxANCabcANCabANCabcdANC"), (2, "noneANC"), (3, "ANCaANC" + "b" * 40 + "ANCcANC")], "id int, t string")
    anchors = spark.createDataFrame([(1, "ANC"), (2, "ANC"), (3, "ANC")], "id int, kmer string")
    assert sorted(map(tuple, star.copies_between(df, "id", "t", anchors).collect())) == [(1, "ANCab"), (1, "ANCabc"), (1, "ANCabcd"), (3, "ANCa"), (3, "ANCc")]
    assert star.star_consensus(df.where("false"), "id", "t").count() == 0
