"""The sequence self-join against all pairs, and its alignment against a plain table."""

from __future__ import annotations

import random

import numpy as np
import pytest

from spanloom.operators import graph as G
from spanloom.operators import similarity as Y


def mutated(r, text, share):
    out = []
    for c in text:
        x = r.random()
        if x < share * 0.7:
            out.append(r.choice("ACGT"))
        elif x < share * 0.85:
            out += [c, r.choice("ACGT")]
        elif x >= share:
            out.append(c)
    return "".join(out)


def complement(text):
    return text[::-1].translate(str.maketrans("ACGT", "TGCA"))


def families(seed, n=200):
    """Sequences of families with substitutions, gaps, rotated halves, reverse strands and exact copies; a motif that most share."""
    r = random.Random(seed)
    rows, founders = [], ["".join(r.choice("ACGT") for _ in range(r.randint(50, 120))) for _ in range(40)]
    for i in range(n):
        text = mutated(r, r.choice(founders), r.choice([0, 0.03, 0.1, 0.2]))
        if r.random() < 0.3:
            text = complement(text)
        if r.random() < 0.6:
            text += "ACGGTACCATTGACGGA"
        rows.append((i, text if r.random() < 0.8 else text.lower()))
    return rows + [(n, ""), (n + 1, "ACG"), (n + 2, None), (n + 3, "N" * 80), (None, rows[0][1]), (n + 4, rows[0][1]), (n + 5, rows[0][1].upper()), (n + 6, "A" * 90)]


def plain_table(a, b):
    """Best score of a local alignment with affine gaps, cell by cell."""
    low = -(10**6)
    h, e = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        f = low
        for j in range(1, len(b) + 1):
            e[i][j] = max(h[i - 1][j] - 3, e[i - 1][j] - 1)
            f = max(h[i][j - 1] - 3, f - 1)
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] and a[i - 1] in "ACGT" else -1), e[i][j], f)
            best = max(best, h[i][j])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_alignment_against_a_plain_table(seed):
    r = random.Random(seed)
    pairs = []
    for _ in range(30):
        a = "".join(r.choice("ACGTN") for _ in range(r.randint(0, 50)))
        pairs.append((a, mutated(r, a, 0.3) + "".join(r.choice("ACGT") for _ in range(r.randint(0, 9))), r.randint(-4, 4)))
    found = Y.banded_alignments([(Y.encoded(a), Y.encoded(b), d) for a, b, d in pairs], 70)
    for (a, b, _), (score, matches, columns, gaps, a0, a1, b0, b1) in zip(pairs, found.tolist(), strict=True):
        assert score == plain_table(a, b)
        if score:
            letters = 2 * columns - (a1 - a0 + 1) - (b1 - b0 + 1)  # that stand in gaps
            assert score == matches - (columns - letters - matches) - 2 * gaps - letters


def test_a_narrow_band_holds_what_lies_in_it():
    a = "ACGTTGCAAGGCTTACCGATTGACCATGCAT"
    one = Y.banded_alignments([(Y.encoded(a), Y.encoded("GG" + a), -2), (Y.encoded(a), Y.encoded("GG" + a), 30)], 0).tolist()
    assert one[0][:4] == [len(a), len(a), len(a), 0] and one[0][4:] == [0, len(a) - 1, 2, len(a) + 1] and one[1][0] < 5


@pytest.mark.parametrize("search, group", [(Y.Search(k=9, window=4, share=0.05, band=200), 256), (Y.Search(k=7, window=1, share=0.3, band=200, min_identity=90.0), 4), (Y.Search(k=9, window=4, share=0.05, band=200, both_strands=False), 3)])
def test_hits_against_all_pairs(spark, monkeypatch, search, group):
    monkeypatch.setattr(Y, "GROUP", group)
    rows = families(7)
    df = spark.createDataFrame(rows, "id int, text string").repartition(5)
    texts = {}
    for i, t in rows:
        if i is not None and t is not None:
            texts[t.upper()] = min(i, texts.get(t.upper(), i))
    nodes = sorted((i, t) for t, i in texts.items())
    pairs = [(a, b) for k, a in enumerate(nodes) for b in nodes[k + 1 :]]
    want = {(a[0], b[0]): h for (a, b), h in zip(pairs, Y.align_pairs([(a[1], b[1]) for a, b in pairs], search), strict=True) if h}
    copies = {(texts[t.upper()], i) for i, t in rows if i is not None and t and texts[t.upper()] != i}
    got = {(r.q, r.s): tuple(r)[2:] for r in Y.similarity_hits(df, "id", "text", search).collect()}
    assert set(got) == set(want) | copies and len(want) > 100 and len(copies) >= 2
    assert all(got[k][0] == want[k][0] and got[k][-1] == want[k][-1] for k in want)
    if search.both_strands:
        assert {v[-1] for v in want.values()} == {"+", "-"}

    parent = {i: i for i, t in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert {r.id: r.representative for r in Y.similarity_clusters(df, "id", "text", search).collect()} == {i: root(i) for i in parent}


def test_hits_feed_the_gates_and_greedy_clusters(spark):
    search = Y.Search(k=9, window=4, share=0.05, band=200)
    df = spark.createDataFrame(families(3, 60), "id int, text string")
    hits = Y.similarity_hits(df, "id", "text", search)
    assert hits.where(G.cluster_gate()).count() == hits.where("q <> s").count()
    assert hits.select(G.superfamily_score().alias("x")).where("x is null").count() == 0 and hits.where(G.comparative_gate()).count() > 0
    links = {frozenset(r) for r in hits.select("q", "s").collect()}
    got = {r.node: r.representative for r in Y.similarity_greedy(df.where("id is not null"), "id", "text", search).collect()}
    assert set(got) == {i for i, _ in families(3, 60) if i is not None}
    chosen = {b for a, b in got.items() if a == b}
    assert not any(frozenset((a, b)) in links for a in chosen for b in chosen if a != b)
    assert Y.similarity_hits(df.where("false"), "id", "text", search).count() == 0


def test_recall_of_planted_families(spark):
    """Pairs within a fifth of mutations of one founder, against all pairs of their families."""
    r = random.Random(11)
    rows, family = [], {}
    for f in range(12):
        founder = "".join(r.choice("ACGT") for _ in range(400))
        for _ in range(8):
            family[len(rows)] = f
            rows.append((len(rows), mutated(r, founder, 0.1)))
    got = {(h.q, h.s) for h in Y.similarity_hits(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    planted = {(a, b) for a in family for b in family if a < b and family[a] == family[b]}
    assert all(family[a] == family[b] for a, b in got) and len(got & planted) >= 0.9 * len(planted)


def test_only_the_windows_of_a_pair_are_aligned():
    rng = np.random.default_rng(5)
    search = Y.Search(k=9, window=3, share=0.03, band=20)
    short = "".join(rng.choice(list("ACGT"), 300))
    changed = short[:100] + "GG" + short[100:200] + short[203:]
    back = changed[::-1].translate(str.maketrans("ACGT", "TGCA"))
    around = ["".join(rng.choice(list("ACGT"), n)) for n in (7000, 5000)]
    keys = lambda t: Y.Keys(*(k := Y.minimizers(Y.encoded(t), 9, 3, True)), len(k[0]), len(t))
    for inside, forward in ((changed, True), (back, False)):
        long = around[0] + inside + around[1]
        for a, b in ((short, long), (long, short)):
            found = Y.placed_pair(keys(a), keys(b), search)
            assert found[0] is forward and max(found[3], found[5]) <= 300 + 2 * search.band
            line = found[1] + found[2] - found[4]  # of the whole texts
            other = Y.encoded(b) if forward else Y.reversed_complement(Y.encoded(b))
            whole = Y.banded_alignments([(Y.encoded(a), other, line)], search.band)[0]
            hit = Y.align_pairs([(a, b)], search)[0]
            assert (hit[0], hit[2], hit[3], hit[4] - 1, hit[5] - 1) == tuple(whole[[0, 2, 3, 4, 5]])
            assert (hit[6] - 1, hit[7] - 1) == (tuple(whole[6:]) if forward else (len(b) - 1 - whole[7], len(b) - 1 - whole[6]))


def test_score_without_a_way_back_is_that_of_the_alignment():
    r, rng = random.Random(8), np.random.default_rng(8)
    for size, band in ((60, 5), (90, 32), (600, 16)):
        texts = [("".join(rng.choice(list("ACGT"), r.randint(1, size)))) for _ in range(40)]
        pairs = [(Y.encoded(t), Y.encoded(mutated(r, t, 0.2) if i % 2 else texts[i - 1]), r.randint(-3, 3)) for i, t in enumerate(texts)]
        rows, wide = max(len(a) for a, _, _ in pairs), 2 * band + 1
        left, right = np.full((rows, len(pairs)), 5, np.uint8), np.full((rows + wide, len(pairs)), 6, np.uint8)
        for p, (a, b, d) in enumerate(pairs):
            left[: len(a), p] = a
            kept = b[max(0, -d - band) : max(0, rows - d + band + 1)]
            right[max(0, d + band) :, p][: len(kept)] = kept
        score, first, last = Y.reach(left, right, band)
        whole = Y.banded_alignments(pairs, band)
        assert (score == whole[:, 0]).all() and (last == whole[:, 5])[score > 0].all() and (first <= whole[:, 4])[score > 0].all()


def test_many_pairs_are_placed_as_one_by_one():
    search = Y.Search(k=7, window=3, share=0.1, band=12)
    texts = [t for _, t in families(4, 60) if t]
    sides = [Y.minimizers(Y.encoded(t), search.k, search.window, True) for t in texts]
    ends = np.cumsum([0, *(len(k[0]) for k in sides)])
    keys, at, ahead = (np.concatenate([k[c] for k in sides]) for c in range(3))
    x, y = (v.ravel() for v in np.triu_indices(len(texts), 1))
    kept, *rest = Y._places(x, y, np.diff(ends), np.array([len(t) for t in texts]), ends, np.unique(keys, return_inverse=True)[1], at.astype(np.int64), ahead, search)
    one = [Y.Keys(*k, len(k[0]), len(t)) for k, t in zip(sides, texts, strict=True)]
    want = {p: f for p, (i, j) in enumerate(zip(x, y, strict=True)) if (f := Y.placed_pair(one[i], one[j], search))}
    assert len(want) > 100 and {p: (bool(f), *map(int, v)) for p, f, *v in zip(kept.tolist(), *rest, strict=True)} == want


def test_a_frequent_key_and_long_texts(spark):
    """Pairs of a hub are dealt to parts, each pair once; long windows, which go to tasks of their own, give the hits that all pairs compared give."""
    rng, r = np.random.default_rng(2), random.Random(2)
    dna = lambda n: "".join(rng.choice(list("ACGT"), n))
    line, long = dna(70), dna(6000)
    rows = [(i, dna(r.randint(5, 60)) + line + dna(r.randint(5, 200))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate([long, mutated(r, long, 0.05), complement(mutated(r, long, 0.05)), dna(3000) + long[:1500], dna(500) + long])]
    search = Y.Search(k=13, window=8, share=0.2, band=24, min_identity=80.0)
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :]]
    want = {(a[0], b[0]): h for (a, b), h in zip(pairs, Y.align_pairs([(a[1], b[1]) for a, b in pairs], search), strict=True) if h}
    assert sum(q >= 1000 for q, _ in want) >= 5 and len(want) > 50
    assert {(h.q, h.s): tuple(h)[2:] for h in Y.similarity_hits(df, "id", "text", search).collect()} == want
    nodes = df.selectExpr("cast(id as long) node", "text seq")
    found, _ = Y.candidate_pairs(Y.shared_keys(nodes, search), search)
    met = [tuple(sorted((p, row.node))) for row in found.collect() for p in row.others]
    assert len(met) == len(set(met)) and set(met) >= set(want)
