"""Library search: planted copies on both strands, and the same features whole and in pieces."""

from __future__ import annotations

import random

from spanloom.operators import library as L
from tests.test_tandem import dna, mutated

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def planted(seed):
    r = random.Random(seed)
    entries = [(1, "sat#a", dna(r, 180)), (2, "sat#b", dna(r, 300)), (3, "sat#a", dna(r, 120)), (4, "none", dna(r, 200)), (5, "odd", ""), (None, "odd", "ACGT" * 30)]
    rows, truth = [], []
    for i in range(4):
        text = dna(r, 400)
        for _ in range(3):
            entry = r.choice(entries[:3])
            copy = mutated(r, entry[2], 0.05)
            strand = r.choice("+-")
            truth.append((i, entry[0], strand, len(text) + 1, len(text) + len(copy)))
            text += (copy if strand == "+" else copy[::-1].translate(COMPLEMENT)) + dna(r, r.randint(150, 500))
        rows.append((i, text if i % 2 else text.lower()))
    return rows + [(10, None), (11, ""), (12, "ACGTAC"), (13, "N" * 500), (None, rows[0][1])], entries, truth


def test_planted_copies_and_pieces(spark):
    rows, entries, truth = planted(3)
    seqs = spark.createDataFrame(rows, "seqid int, seq string").repartition(3)
    library = spark.createDataFrame(entries, "entry int, name string, seq string")
    whole = {tuple(x) for x in L.library_hits(seqs, library).collect()}
    hits = [x for x in L.library_hits(seqs, library).collect() if x.covered >= 60]
    for key, entry, strand, s, e in truth:
        assert any(x.seqid == key and x.entry == entry and x.strand == strand and min(x.e, e) - max(x.s, s) + 1 > 0.6 * (e - s + 1) for x in hits)
    assert all(any(x.seqid == key and x.entry == entry and x.strand == strand and x.s >= s - 12 and x.e <= e + 12 for key, entry, strand, s, e in truth) for x in hits)
    for size in (97, 1000):
        assert {tuple(x) for x in L.library_hits(seqs, library, piece=size).collect()} == whole
    spans = [sorted(map(tuple, L.annotate_from_library(seqs, library, piece=size).collect())) for size in (250_000, 211)]
    assert spans[0] == spans[1] and {x[-1] for x in spans[0]} <= {"sat#a", "sat#b"} and len(spans[0]) > 3


def test_sampled_keys_are_a_part_of_all(spark):
    rows, entries, _ = planted(5)
    seqs = spark.createDataFrame([x for x in rows if x[1]], "seqid int, seq string")
    every = {tuple(x) for x in L.placed_kmers(seqs, "seqid", "seq", 11, 500).collect()}
    some = {tuple(x) for x in L.placed_kmers(seqs, "seqid", "seq", 11, 77, sample=4).collect()}
    assert some < every and 0.15 < len(some) / len(every) < 0.35
    assert L.library_hits(seqs.where("false"), spark.createDataFrame(entries, "entry int, name string, seq string")).count() == 0


def test_keys_leave_a_task_only_where_the_library_has_them(spark):
    rows, _, _ = planted(7)
    text = dna(random.Random(1), 3000) + "nRy" + dna(random.Random(2), 40)
    seqs = spark.createDataFrame([x for x in rows if x[0] is not None] + [(20, text)], "seqid int, seq string").repartition(2)
    for k in (1, 5, 16, 31):
        want = set()
        for key, seq in [x for x in rows if x[0] is not None and x[1]] + [(20, text)]:
            upper = seq.upper()
            for i in range(len(upper) - k + 1):
                kmer = upper[i : i + k]
                if not set(kmer) - set("ACGT"):
                    back = kmer[::-1].translate(COMPLEMENT)
                    want.add((key, i, sum("ACGT".index(c) << 2 * (k - 1 - j) for j, c in enumerate(min(kmer, back))), kmer <= back))
        assert {tuple(x) for x in L.placed_kmers(seqs, "seqid", "seq", k, 400).collect()} == want
        known = L.np.array(sorted({x[2] for x in want})[::7])
        assert {tuple(x) for x in L.placed_kmers(seqs, "seqid", "seq", k, 400, known=known).collect()} == {x for x in want if x[2] in set(known.tolist())}
    assert L.placed_kmers(seqs, "seqid", "seq", 16, 400, known=L.np.zeros(0, "int64")).count() == 0
