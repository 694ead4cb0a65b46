from __future__ import annotations

import random

import pytest

from spanloom.operators import intervals as I


def rows(seed, n, m):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s = r.randint(1, m)
        out.append((r.choice(["chr1", "chr2"]), s, s + r.randint(0, m // 4), r.choice(["A", "B", "C"])))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "seqid string, s long, e long, name string")


def covered(data, key):
    out = {}
    for r in data:
        out.setdefault(key(r), set()).update(range(r[1], r[2] + 1))
    return out


@pytest.mark.parametrize("seed,n,m,width", [(1, 40, 20, 7), (2, 40, 60, None), (3, 30, 200, 16), (4, 0, 20, 8)])
def test_merge_covers_the_same_positions_and_is_idempotent(spark, seed, n, m, width):
    data = rows(seed, n, m)
    merged = I.merge_intervals(frame(spark, data), ["seqid", "name"], width=width)
    got = [(r.seqid, r.s, r.e, r.name) for r in merged.collect()]
    assert covered(got, lambda r: (r[0], r[3])) == covered(data, lambda r: (r[0], r[3]))
    by = {}
    for g in sorted(got):
        last = by.get((g[0], g[3]))
        assert last is None or g[1] > last + 1
        by[g[0], g[3]] = g[2]
    assert sorted((r.seqid, r.s, r.e, r.name) for r in I.merge_intervals(frame(spark, got), ["seqid", "name"], width=width).collect()) == sorted(got)


def test_width_from_the_rows(spark, monkeypatch):
    data = [("a", 10 * i, 10 * i + 4, "x") for i in range(100)] + [("b", 5, 900, "x")]
    df = frame(spark, data)
    assert I.fit_width(df, ["seqid"]) is None and I.fit_width(df.where("false"), ["seqid"]) is None
    assert I.fit_width(df, ["seqid"], rows=10) == 99 and I.fit_width(df.where("seqid = 'b'"), ["seqid"], rows=0) == 896
    monkeypatch.setattr(I.fit_width, "__defaults__", ("s", "e", 8))
    assert I.fit_width(df, ["seqid"]) == 79
    got = sorted((r.seqid, r.s, r.e, r.n) for r in I.merge_intervals(df, ["seqid"], touch=6).collect())
    assert got == [("a", 0, 994, 100), ("b", 5, 900, 1)]


def test_adjacent_rows_across_bins(spark, monkeypatch):
    from spanloom.operators import report

    r = random.Random(8)
    data = [(i, r.choice("ab"), s := r.randint(1, 60), s + r.randint(0, 2)) for i in range(300)]
    df = spark.createDataFrame(data, "id int, seqid string, s long, e long").repartition(3)
    want = []
    for key in "ab":
        rows = sorted((x for x in data if x[1] == key), key=lambda x: (x[2], x[0]))
        want += [x for x, y in zip(rows, [*rows[1:], None], strict=True) if y is None or x[2:] != y[2:]]
    for width in (None, 1, 7):
        monkeypatch.setattr(report, "fit_width", lambda *_, width=width: width)
        assert sorted(map(tuple, report.drop_adjacent(df, "seqid", "s", "e", ["id"], "id").collect())) == sorted(want)


@pytest.mark.parametrize("seed", [5, 6])
def test_containment_against_all_pairs(spark, seed):
    data, outer = rows(seed, 40, 60), rows(seed + 50, 15, 60)
    want = sorted(g for g in data if any(f[0] == g[0] and f[3] == g[3] and f[1] <= g[1] and g[2] <= f[2] for f in outer))
    assert sorted(map(tuple, I.contained(frame(spark, data), frame(spark, outer), ["seqid", "name"]).collect())) == want


def test_contested_spans_go_to_the_larger_family(spark):
    data = [("c", 1, 100, "A"), ("c", 1000, 1200, "A"), ("c", 50, 150, "B"), ("c", 1010, 1050, "C")]
    resolved = I.resolve_overlaps(frame(spark, data), ["seqid"], width=64)
    got = sorted((r.name, r.s, r.e) for r in resolved.collect())
    assert got == [("A", 1, 100), ("A", 1000, 1200), ("B", 101, 150)]
    assert [r.name for r in I.absorbed_names(frame(spark, data), resolved).collect()] == ["C"]
    again = I.resolve_overlaps(resolved.select("seqid", "s", "e", "name"), ["seqid"], width=64)
    assert sorted((r.name, r.s, r.e) for r in again.collect()) == got


def test_chunks(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10)], "seq string, n long")
    got = sorted((r.seq, r.start0, r.end0) for r in I.chunk_map(sizes, "seq", "n", 20, 5).collect())
    assert got == [("a", 0, 25), ("a", 20, 45), ("a", 40, 65), ("a", 60, 85), ("a", 80, 100), ("b", 0, 10)]


def test_masking_past_the_end(spark):
    seqs = spark.createDataFrame([(1, "ACGTACGT"), (2, "AC")], "seq_id long, seq string")
    regions = spark.createDataFrame([(1, 2, 3), (1, 3, 4), (1, 7, 20)], "seq_id long, s long, e long")
    assert {r.seq_id: r.seq for r in I.mask_sequences(seqs, regions).collect()} == {1: "ANNNACNN", 2: "AC"}
