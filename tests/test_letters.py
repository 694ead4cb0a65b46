"""Letters in Arrow batches against plain Python: rows that share an id, null ids and texts, chunks of any size, long sequences."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from spanloom.operators import complexity as C
from spanloom.operators import letters as L
from spanloom.operators import sequences as S
from spanloom.operators import tandem as T

ROWS = [(1, "ACGTACGTAAN"), (2, None), (3, ""), (None, "ACACACAC"), (1, "TTACGTAC"), (4, "aß€😀aß€😀aß€😀"), (2**53 + 1, "GGGGGGG"), (None, "CAC")]


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_ids_with_several_rows_count_together(spark, monkeypatch, size):
    monkeypatch.setattr(L, "CHUNK", size)
    df = spark.createDataFrame(ROWS, "id long, text string").repartition(3)
    counts = Counter((k, t[i : i + 3]) for k, t in ROWS for i in range(len(t or "") - 2))
    assert {(r.id, r.kmer): r.n for r in S.kmer_counts(df, "text", 3, ("id",)).collect()} == counts
    bases = Counter((k, i % 4, b) for k, t in ROWS for i, b in enumerate((t or "").upper()) if b in "ACGT")
    assert {(r.id, r.pos, r.base): r.n for r in S.base_tally(df, "id", "text", 4).collect()} == bases


@pytest.mark.parametrize("call", [lambda df: S.kmer_gaps(df, "id", "text", 6, 200), lambda df: S.anchor_kmer(df, "id", "text", 5, 12, 3), lambda df: S.dust_score(df, "id", "text"), lambda df: S.base_tally(df, "id", "text", 12), lambda df: S.kmer_counts(df, "text", 4, ("id",))])
def test_no_row_a_letter(spark, call):
    assert "Generate" not in call(spark.createDataFrame(ROWS, "id long, text string"))._jdf.queryExecution().optimizedPlan().toString()


def test_periodogram_of_a_long_sequence(spark):
    unit = "".join(random.Random(3).choices("ACGT", k=50))
    found = T.periodogram(spark.createDataFrame([(1, unit * 1000)], "id int, text string"), "id", "text", 6, 60).collect()
    assert max(found, key=lambda r: r.score).gap == 50


def test_repeats_of_many_sequences_as_by_regular_expressions():
    rng = random.Random(5)

    def plain(text):
        found, runs = {}, []
        for size, least in S.SSR_LIMITS:
            for m in re.finditer(rf"(([gatc]{{{size}}})\2{{{least - 1},}})", text.lower()):
                row = (m[2], len(m[1]) // size, m.start() + 1, m.end())
                if len(set(m[2])) > 1:
                    found.setdefault(m.start(), row)
                elif size == 1:
                    runs.append(row)
        return [found[k] for k in sorted(found)] or runs

    texts = ["".join(rng.choice("atn")[: 1 + (rng.random() < 0.9)] * rng.choice([1, 1, 2, 25]) for _ in range(200)) for _ in range(40)]
    texts += ["".join(("".join(rng.choice("acgtn") for _ in range(rng.randint(1, 14))) * rng.choice([1, 4, 5, 6, 9, 10])) for _ in range(20)) for _ in range(60)]
    texts += ["", "İat" + "AT" * 9 + "€" + "at" * 8 + "aatat"]
    got = [[] for _ in texts]
    for of, r in S.ssrs_of([*texts, None]):
        got[of].append((r["motif"], r["repeats"], r["start"], r["end"]))
    assert got == [plain(t) for t in texts]


def test_window_scores_by_counting_pairs():
    codes = np.random.default_rng(2).integers(0, 5, 300).astype(np.uint8)
    for n in (2, 3, 10, 63, 64, 65, 300):
        part, scores = codes[:n], []
        triplets = [tuple(part[i : i + 3]) if max(part[i : i + 3]) < 4 else i for i in range(n - 2)]
        wide = min(62, len(triplets))
        for i in range(len(triplets) - wide + 1 if triplets else 0):
            scores.append(sum(c * (c - 1) // 2 for c in Counter(triplets[i : i + wide]).values()) / max(1, wide - 1))
        assert C.window_scores(part).tolist() == scores


def test_orientation_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 3)
    rng, k = random.Random(8), 4
    rows = [(rng.choice([1, 2, None]), i, "".join(rng.choices("acgtN€"[: rng.choice([4, 4, 5, 6])], k=rng.randint(0, 60)))) for i in range(60)] + [(1, 99, None), (2, None, "ACGT" * 3)]
    back = lambda t: t.translate(str.maketrans(S.BASES, S.COMPLEMENTS))[::-1]

    def half(t):
        seen = [t[i : i + k] for i in range(len(t) - k + 1)]
        counts = Counter(seen)
        return sorted(counts, key=lambda x: (-counts[x], seen.index(x)))[: len(counts) // 2]

    longest = {}
    for g, i, t in rows:
        if None not in (g, i, t):
            longest[g] = min(longest.get(g, (0, i, "")), (-len(t), i, t.upper()))
    df = spark.createDataFrame(rows, "grp int, id int, text string")
    call = S.orientation(df, "grp", "id", "text", k)
    for r in S.orientation(df, "grp", "id", "text", k).collect():
        text = next((t for g, i, t in rows if (g, i) == (r.grp, r.id)), None)
        votes = [sum(x in longest[r.grp][2] for x in half(s)) for s in (text.upper(), back(text.upper()))] if None not in (r.grp, r.id, text) else [0, 0]
        assert r.forward == (votes[0] > votes[1])
