"""Tandem arrays, periodograms and copy identities on planted repeats and against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from spanloom.operators import tandem as T
from spanloom.operators.similarity import Search


def dna(r, n):
    return "".join(r.choice("ACGT") for _ in range(n))


def mutated(r, text, share):
    return "".join(c if r.random() >= share else r.choice(["", "A", "C", "G", "T", c + r.choice("ACGT")]) for c in text)


def planted(seed, plans):
    """(rows, truth): each plan (period, copies, mutations) stands in a sequence of its own between random letters."""
    r = random.Random(seed)
    rows, truth = [], {}
    for i, (period, copies, share) in enumerate(plans):
        monomer = dna(r, period)
        array = "".join(mutated(r, monomer, share) for _ in range(copies))
        left = dna(r, r.randint(300, 3000))
        rows.append((i, left + array + dna(r, 1500)))
        truth[i] = (len(left) + 1, len(left) + len(array), period)
    return rows, truth


def assert_found(got, truth):
    assert sorted(g[0] for g in got) == sorted(truth)
    for key, s, e, period in got:
        s0, e0, p0 = truth[key]
        assert abs(s - s0) <= p0 and abs(e - e0) <= p0 and abs(period - p0) <= max(3, 0.03 * p0)


def test_planted_arrays_in_three_rounds(spark):
    rows, truth = planted(4, [(5, 60, 0.05), (45, 12, 0.1), (180, 20, 0.1), (1200, 6, 0.08), (3000, 6, 0.08), (171, 100, 0.1), (3500, 5, 0.05)])
    r = random.Random(1)
    extra = [(100, dna(r, 20_000)), (101, None), (102, ""), (None, rows[1][1]), (103, "N" * 5000)]
    df = spark.createDataFrame(rows + extra, "id int, text string").repartition(3)
    found = T.tandem_rounds(df, "id", "text", rounds=((5, 39), (40, 3200), (3201, 10_000))).collect()
    assert_found([(x.id, x.s, x.e, x.period) for x in found], truth)
    assert {x.id: x["round"] for x in found} == {0: 1, 1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 3}


def test_pieces_join_across_their_borders(spark):
    rows, truth = planted(9, [(120, 80, 0.08), (60, 150, 0.1), (200, 40, 0.05)])
    df = spark.createDataFrame(rows, "id int, text string")
    whole, parts = ([(x.id, x.s, x.e, x.period) for x in T.find_arrays(df, "id", "text", 40, 250, piece=size).collect()] for size in (250_000, 1100))
    assert_found(whole, truth)
    assert_found(parts, truth)
    cut = T.pieces(df, "id", "text", 1100, 258).collect()
    for i, text in rows:
        own = sorted((x.at, x.own, x.text) for x in cut if x.id == i)
        assert "".join(t[:n] for _, n, t in own) == text and all(t == text[at : at + len(t)] and len(t) in (n + 258, len(text) - at) for at, n, t in own)


def test_links_against_a_plain_scan():
    r = random.Random(2)
    text = dna(r, 30) * 4 + "NN" + dna(r, 200)
    at, apart = T.links(T.similarity.encoded(text), 5)
    want = set()
    for i in range(len(text) - 4):
        if "N" not in text[i : i + 5]:
            j = text.find(text[i : i + 5], i + 1)
            if j > 0:
                want.add((i, j - i))
    assert set(zip(at.tolist(), apart.tolist(), strict=True)) == want


def plain_spectrum(text, k, most):
    counts = {}
    last = {}
    for i in range(len(text) - k + 1):
        gap = i - last.get(text[i : i + k], i - most - 1)
        last[text[i : i + k]] = i
        if gap <= most:
            counts[gap] = counts.get(gap, 0) + 1
    q = (sum(text.count(b) ** 2 for b in "ACGT") / len(text) ** 2) ** k
    starts = len(text) - k + 1
    return {g: (n, (n - (starts - g) * q * (1 - q) ** (g - 1)) / (starts - g)) for g, n in counts.items()}


def plain_peaks(spectrum, near, least, multiple, tolerance, top):
    score = {g: s for g, (_, s) in spectrum.items() if s > 0}
    maxima = {g: s for g, s in score.items() if s >= least and all(score.get(x, -1) <= s for x in range(g - near, g + near + 1)) and all(score.get(x, -1) < s for x in range(g - near, g))}
    alone = [g for g, s in maxima.items() if not any(abs(g - f * m) <= tolerance and t >= s for f, t in maxima.items() for m in range(2, multiple + 1))]
    return [(k + 1, g) for k, g in enumerate(sorted(alone, key=lambda g: (-maxima[g], g))[:top])]


def test_periodogram_and_peaks_against_plain_python(spark):
    r = random.Random(5)
    rows = [(i, "".join(mutated(r, dna(r, p), 0) if i % 2 else m for _ in range(9))) for i, (p, m) in enumerate([(37, dna(r, 37)), (40, ""), (21, dna(r, 21)), (60, ""), (12, dna(r, 12))])] + [(8, "ACG"), (9, "A" * 90)]
    spectrum = T.periodogram(spark.createDataFrame(rows + [(7, None)], "id int, text string"), "id", "text", 5, 120)
    got = {}
    for x in spectrum.collect():
        got.setdefault(x.id, {})[x.gap] = (x.n, x.score)
    for i, text in rows:
        want = plain_spectrum(text, 5, 120)
        assert {g: n for g, (n, _) in want.items()} == {g: n for g, (n, _) in got.get(i, {}).items()}
        assert all(abs(got[i][g][1] - s) < 1e-8 for g, (_, s) in want.items())
    peaks = {}
    for x in T.spectrum_peaks(spectrum, "id", near=2, least=0.01).collect():
        peaks.setdefault(x.id, []).append((x["rank"], x.period))
    assert {i: sorted(p) for i, p in peaks.items()} == {i: p for i in got if (p := plain_peaks(got[i], 2, 0.01, 5, 2, 20))}
    assert peaks[0][0] == (1, 37) and sorted(peaks[2])[0] == (1, 21)


def edits_of(a, b):
    """Letters that a longest common subsequence keeps."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_identities_of_copies():
    r = random.Random(8)
    monomer = dna(r, 150)
    exact = T.copy_identities(monomer * 5 + monomer[:70], 150)
    assert exact.tolist() == [1.0] * 4
    copies = [mutated(r, monomer, 0.1) for _ in range(7)]
    shares = T.copy_identities("".join(copies), 150)
    plain = np.median([edits_of(a, b) / max(len(a), len(b)) for a, b in zip(copies, copies[1:], strict=False)])
    assert abs(np.median(shares) - plain) < 0.12 and 0.7 < np.median(shares) < 0.95
    assert np.median(T.copy_identities(dna(r, 900), 150)) < 0.5
    assert len(T.copy_identities("ACGT", 3)) == len(T.copy_identities("", 5)) == len(T.copy_identities("ACGT", 0)) == 0


def test_only_cases_that_need_it_are_scored_again(spark):
    r = random.Random(3)
    long, short = dna(r, 400), dna(r, 50)
    seqs = spark.createDataFrame([("long", long * 4), ("short", short * 20), ("none", None)], "case string, text string")
    peaks = spark.createDataFrame([("long", 1, 400.0, 0.9), ("long", 2, 37.0, 0.1), ("short", 1, 50.0, 0.9), ("short", 2, 400.0, 0.2), ("none", 1, 9.0, 0.1), ("missing", 1, 9.0, 0.1)], "case string, rank int, period double, score double")
    first = T.rescore(peaks, seqs, "case", "text", 100)
    got = {(x.case, x.period): x.identity for x in first.collect()}
    assert got["long", 400.0] is None and got["long", 37.0] < 0.5 and got["short", 50.0] == 1.0 and got["short", 400.0] is None and got["none", 9.0] is None and got["missing", 9.0] is None
    again = {(x.case, x.period): x.identity for x in T.rescore_long(first, seqs, "case", "text", 100, 1000).collect()}
    assert again == got | {("long", 400.0): 1.0}


def test_from_sequences_to_founders(spark):
    r = random.Random(6)
    one, other = dna(r, 60), dna(r, 90)
    higher = [mutated(r, one, 0.08) for _ in range(3)]  # a higher order of three copies of the first
    rows = [(1, dna(r, 500) + one * 30 + dna(r, 400)), (2, dna(r, 300) + "".join(mutated(r, one, 0.03) for _ in range(30))), (3, other * 20 + dna(r, 700)), (4, dna(r, 200) + "".join(higher) * 12), (5, dna(r, 3000))]
    got = {int(x.id.split("_")[0]): x for x in T.array_founders(spark.createDataFrame(rows, "id int, text string"), "id", "text", search=Search(k=9, window=3, share=0.03, band=200), max_period=400, cap=150).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert abs(got[1].founder - 60) <= 1 and abs(got[2].founder - 60) <= 2 and abs(got[3].founder - 90) <= 1
    assert got[1].family == got[2].family != got[3].family
    assert round(got[4].strongest / got[4].founder) in (1, 3) and got[4].strongest in range(55, 190)


@pytest.mark.parametrize("text", ["ACGT" * 3, "", None, "AAAA"])
def test_short_texts_have_no_arrays(spark, text):
    assert T.tandem_rounds(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text", rounds=((5, 40),)).count() == 0
