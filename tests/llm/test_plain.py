"""Training-data queries against brute force on small tables, and awkward tables through every stage."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, line_crf, mixing, near_copies, pii, quality_gam, queries, sharding, simhash

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ 3


def plain_draw(seed, shard, key):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<i", shard), h)
    h = xxhash.xxh64_intdigest(key.encode(), h)
    return -math.log(((h >> 11) + 0.5) / (1 << 53))


def test_shards_of_the_query_against_plain_descent(spark):
    """Draws worked out in Python, and the tree walked from the root: region, rack, shard."""
    rows = queries.op3_hash_tree_shards(spark, DATA).collect()
    fan = sharding.FAN
    for r in rows[:150]:
        for n, at in ((40, r.shard), (41, r.grown_shard)):
            draws = {s: plain_draw(7, s, str(r.doc_id)) for s in range(n)}
            racks = {k: min(draws[s] for s in draws if s // fan[1] == k) for k in {s // fan[1] for s in draws}}
            regions = {g: min(racks[k] for k in racks if k // fan[0] == g) for g in {k // fan[0] for k in racks}}
            region = min(regions, key=regions.get)
            rack = min((k for k in racks if k // fan[0] == region), key=racks.get)
            assert min((s for s in draws if s // fan[1] == rack), key=draws.get) == at
        assert (r.region, r.rack) == (r.shard // (fan[0] * fan[1]), r.shard // fan[1])


def test_regions_and_racks_share_by_weight(spark):
    weights = [float(1 + i % 5) for i in range(40)]
    placed = sharding.with_shard(spark.range(20_000), F.col("id"), 40, "at", weights).select("at.*").collect()
    for level, size in (("region", 16), ("rack", 4)):
        got = Counter(getattr(r, level) for r in placed)
        for node in {i // size for i in range(40)}:
            share = sum(weights[node * size : (node + 1) * size]) / sum(weights)
            assert abs(got[node] / 20_000 - share) < 4 * math.sqrt(share * (1 - share) / 20_000)


# ------------------------------------------------------------------ 4


def least_edits(passage, text):
    """Least edits of a passage anywhere in a text."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(passage, 1):
        new = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        new = np.r_[i, new]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_contamination_against_alignment_with_every_passage(spark):
    rng = np.random.default_rng(21)
    letters = list("abcdefghijklmnop")
    word = lambda: "".join(rng.choice(letters, rng.integers(3, 9)))
    items = [(i, " ".join(word() for _ in range(int(rng.integers(6, 40))))) for i in range(8)]
    docs = []
    for k in range(40):
        text = " ".join(word() for _ in range(30))
        source = items[k % 8][1]
        start, size = int(rng.integers(0, max(1, len(source) - 60))), int(rng.integers(60, 240))
        cut = list(source[start : start + size])
        for _ in range(int(rng.integers(0, 14))):
            at = int(rng.integers(0, len(cut)))
            cut[at] = rng.choice(["", "z", cut[at] + "y"])
        docs.append((k, f"{text} {''.join(cut)} {text}"))
    want = set()
    for d, text in docs:
        codes = decontaminate._codes(decontaminate.normalise(text))
        for item, source in items:
            whole = decontaminate._codes(decontaminate.normalise(source))
            last = max(0, len(whole) - decontaminate.PASSAGE)
            for start in {*range(0, last, decontaminate.PASSAGE // 2), last}:
                passage = whole[start : start + decontaminate.PASSAGE]
                budget = min(int(len(passage) * decontaminate.EDIT_RATE), (len(passage) - decontaminate.Q) // decontaminate.Q)
                if least_edits(passage, codes) <= budget:
                    want.add((d, item))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench).collect()} == want and 8 < len(want) < 40
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench, block_chars=300).collect()} == want
    for chars in (300, 2_000_000):
        assert {r.doc_id for r in decontaminate.drop_contaminated(frame, bench, block_chars=chars).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_contamination_in_a_very_long_text(spark):
    item = "the council of the river met on the first of may and said that the road would be mended before the end of the summer " * 2
    docs = spark.createDataFrame([(1, "lorem ipsum dolor " * 60_000 + item + " amet" * 60_000), (2, "lorem ipsum dolor " * 60_000)], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()] == [1]


# ------------------------------------------------------------------ 7, 8


def test_gam_scores_are_sums_of_table_entries(spark):
    rng = np.random.default_rng(22)
    x = rng.normal(size=(400, len(quality_gam.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=400) * 0.3 > 0).astype(int)
    model = quality_gam.fit(x, y, rounds=20, pair_rounds=5)
    for row, got in zip(x[:40], model.score(x[:40]), strict=True):
        total = model.base + sum(float(t[np.searchsorted(c, v, side="right")]) for t, c, v in zip(model.tables, model.edges, row, strict=True))
        total += sum(float(t[np.searchsorted(model.pair_edges[a], row[a], side="right"), np.searchsorted(model.pair_edges[b], row[b], side="right")]) for a, b, t in model.pairs)
        assert math.isclose(got, 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated)


def test_line_rules_of_all_documents_against_plain_counts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op8_line_crf_rules(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r.doc_id] or "") < 6000:
            n, chars, symbols, dups, repeated = plain_counts(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeated)
            assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)


def test_line_field_on_labels_it_was_not_fitted_on(spark):
    rows = queries.op8_line_crf_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % line_crf.HELD_OUT == 0]
    assert len(held) > 40 and np.mean([r.kept == bool(r.quality) for r in held]) > 0.95


# ------------------------------------------------------------------ 10


def test_many_matches_of_one_text(spark):
    """Positions over several blocks of matches, with characters beyond the basic plane between them."""
    text = " ".join(f"é😀 a{i}@b.co" for i in range(5000))
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (None, "x@y.zw")], "doc_id long, text string").withColumn("base", F.lit("clash"))
    want, at = [], 0
    for m in re.finditer(r"a\d+@b\.co", text):
        want.append(f"email:{m.start()}:{m.end()}")
    rows = pii.digest(pii.find_pii(df)).collect()
    assert sorted((str(r.doc_id), r.n_email) for r in rows) == [("1", 5000), ("1", 5000), ("2", 0), ("None", 1)]
    assert all(r.spans.startswith(",".join(want[:1000])) and r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() for r in rows if r.doc_id == 1)
    assert pii.digest(pii.find_pii(df.where("false"))).count() == 0


# ------------------------------------------------------------------ pipeline


def test_parities_never_drop_a_link():
    rng = np.random.default_rng(23)
    for n in (3, 40, 700, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 62, n))
            lost = int(rng.integers(0, len(a) + 1))
            b = np.unique(np.r_[a[lost:], rng.integers(0, 1 << 62, int(rng.integers(0, n)))])
            apart = len(np.setxor1d(a, b))
            assert near_copies.parity_distance(near_copies.parity_bits(a), near_copies.parity_bits(b)) <= apart


def test_shared_rows_over_batches():
    import pyarrow as pa

    rng = np.random.default_rng(24)
    token = np.sort(rng.integers(0, 60, 300))
    node = np.concatenate([np.sort(rng.choice(10_000, k, replace=False)) for k in Counter(token.tolist()).values()])
    rows = np.stack([token, node, node % 50, node % 7], axis=1)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    ends = [0, 1, 2, 5, 6, 90, 91, 92, 250, 300]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[a:b, k], t) for k, t in enumerate(kinds)], names=["token", "node", "size", "pos"]) for a, b in zip(ends, ends[1:], strict=False)]
    got = [tuple(r.values()) for out in near_copies._shared(iter(batches)) for r in out.to_pylist()]
    want = []
    for t in sorted(set(token.tolist())):
        group = rows[token == t].tolist()
        want += [(*r, *group[0][1:]) for r in group if len(group) > 1]
    assert got == want


def test_stages_on_an_empty_table_and_repeats(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    few = docs.limit(3)
    again = few.unionByName(few).unionByName(docs.where("doc_id > 20").limit(40).withColumn("source", F.lit(None).cast("string")))
    odd = spark.createDataFrame([(900, None, "en", None, None), (901, "", None, "x", 0), (None, "no id here at all", "en", "x", 17)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, docs.where("false"), DATA)
        assert nothing.count() == 0, name
        out = stage(spark, again.unionByName(odd), DATA)
        assert name == "shards" or out.columns == docs.columns
        out.collect()
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{DATA}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    docs.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_row_of_equal_ids_stays(spark):
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (1, "quite another text stands here", "s"), (2, "a b c d e f", "t"), (3, "something else again altogether", "t"), (None, "lost one", "t"), (None, "lost two", "t"), (None, "lost one", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.keep_named(df, near_copies.similar_classes(df)).collect()
    assert Counter(r.doc_id for r in kept) == {1: 1, 3: 1, None: 2}
    assert {r.text for r in kept if r.doc_id is None} == {"lost one", "lost two"}


def test_mixture_of_rows_equal_in_id_and_size(spark):
    rows = [(1, "a b c d", "s")] * 5 + [(2, "x y", "s")] * 3 + [(3, "w " * 50, "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = Counter()
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += r.taken
    words = Counter()
    for r in mixing.mixed_documents(df, chars_col="none").collect():
        words[r.doc_id] += len(r.text.split())
    assert words == +taken


@pytest.mark.parametrize("hot", [0, 1, 1000])
def test_hot_keys_join_like_others(spark, hot):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "k long, v long")
    values = df.groupBy("k").agg(F.count("*").alias("n"), (F.max("v") * 2).alias("w"))
    got = simhash.with_values(df, values, "k", hot=hot).select("k", "v", "w").collect()
    assert sorted(map(tuple, got)) == sorted((i % 7, i, 2 * max(j for j in range(50) if j % 7 == i % 7)) for i in range(50))
