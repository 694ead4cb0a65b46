"""Toxicity, spelling variants and vector codes against plain Python on small and awkward inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import queries, spelling, toxicity, vector_codes
from tests.llm.test_llm import AWKWARD, frame

DATA = "/root/testdata/sf0.001"

# ------------------------------------------------------------------ 11


def plain_kneser_ney(grams: list[tuple], backoff, discount: float):
    """p(symbol, context) from a list of n-grams with repeats."""
    counts = Counter(grams)
    total, kinds = Counter(), Counter()
    for g, n in counts.items():
        total[g[:-1]] += n
        kinds[g[:-1]] += 1

    def p(g):
        h = g[:-1]
        if not total[h]:
            return backoff(g)
        return (max(counts[g] - discount, 0) + discount * kinds[h] * backoff(g)) / total[h]

    return p


def symbols(text):
    out = []
    for ch in text or "":
        s = toxicity._symbol(ch) if ord(ch) < 1 << 16 else toxicity.DIGIT + 1 + ord(ch) % toxicity.OTHERS
        if s or (out and out[-1]):
            out.append(s)
    if not out or out[-1]:
        out.append(0)
    return out


def plain_grams(text, order=toxicity.ORDER):
    row = [0] * (order - 1) + symbols(text)
    return [tuple(row[i : i + order]) for i in range(len(row) - order + 1)]


def cell(gram):
    at = 0
    for s in gram:
        at = at * toxicity.SYMBOLS + s
    return at


@pytest.mark.parametrize("text", [None, "", "  \n ", "a", "Abc, d1-2  é😀!", "x" * 50 + " " * 40 + "y", "ab  cd " * 9])
@pytest.mark.parametrize("size", [1, 3, 1 << 18])
def test_cells_of_a_text_whatever_the_slices(monkeypatch, text, size):
    monkeypatch.setattr(toxicity, "SLICE", size)
    assert np.concatenate(list(toxicity.gram_blocks(text))).tolist() == [cell(g) for g in plain_grams(text)]


def test_models_equal_a_plain_kneser_ney():
    ordinary = ["the house is large", "a house by the sea", "the sea is calm", "the the the"]
    toxic = ["you idiot of a house", "idiots by the sea"]
    every = [[g for t in texts for g in plain_grams(t)] for texts in (ordinary, toxic)]
    counts = [np.bincount([cell(g) for g in grams], minlength=toxicity.CELLS) for grams in every]

    def discount(grams):
        n = Counter(Counter(grams).values())
        return min(0.95, max(0.05, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5

    levels = [every[0] + every[1]]
    while len(levels[-1][0]) > 1:
        levels.append([g[1:] for g in sorted(set(levels[-1]))])
    shared = lambda g: 1 / toxicity.SYMBOLS
    for grams in reversed(levels):
        shared = plain_kneser_ney(grams, (lambda below: lambda g: below(g[1:]))(shared) if len(grams[0]) > 1 else shared, discount(grams))
    sides = [plain_kneser_ney(grams, shared, discount(grams)) for grams in every]
    ratios = toxicity.log_ratios(*counts)
    for g in {*every[0], *every[1], *plain_grams("quite unseen words, 42")}:
        assert ratios[cell(g)] == pytest.approx(math.log(sides[1](g) / sides[0](g)), abs=1e-4)
    table = toxicity.shared_model(counts[0] + counts[1]).reshape(-1, toxicity.SYMBOLS)
    assert np.allclose(table.sum(axis=1), 1)


@pytest.mark.parametrize("size", [7, 1 << 18])
def test_stretches_of_a_text(monkeypatch, size):
    monkeypatch.setattr(toxicity, "SLICE", size)
    ratios = np.random.default_rng(3).normal(size=toxicity.CELLS).astype(np.float32)
    for text in ("", "short", "some words of a longer text that go on and on, " * 3):
        values = [float(ratios[cell(g)]) for g in plain_grams(text)]
        w = toxicity.WINDOW
        most = max((sum(values[i : i + w]) / w for i in range(len(values) - w + 1)), default=sum(values) / len(values))
        assert toxicity.text_ratios(text, ratios) == pytest.approx((sum(values) / len(values), most), abs=1e-6)


def test_counts_are_of_all_labelled_texts(spark):
    rows = [(t, k % 2, k % 3 % 2) for k, t in enumerate(["one two", None, "", "one two", "é 3"] * 4)]
    counts = toxicity.gram_counts(spark.createDataFrame(rows, "t string, half int, y int").repartition(3))
    want = defaultdict(int)
    for t, half, y in rows:
        for g in plain_grams(t):
            want[half, y, cell(g)] += 1
    assert {k: int(counts[k]) for k in map(tuple, np.argwhere(counts))} == dict(want)


def test_toxicity_on_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (4, 1), (5, 0), (7, 1), (7, 0), (None, 1), (6, 5), (8, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.classify(frame(spark), labels).collect()
    assert len(got) == len(AWKWARD) and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert toxicity.classify(frame(spark).where("false"), labels).count() == 0
    alone = toxicity.classify(frame(spark), labels.where("toxic = 0")).collect()
    assert len({r.score for r in alone}) == 1 and alone[0].predicted == 0
    assert len({r.score for r in toxicity.classify(frame(spark), labels.where("false")).collect()}) == 1


def test_toxicity_held_out(spark):
    """Planted expressions: a stem with changing endings, in texts of which a half has labels."""
    rng = np.random.default_rng(5)
    syllables = ["ba", "ne", "li", "tor", "mun", "sel", "pi", "ka", "dro", "ven"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(2, 4)))
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = [word() for _ in range(60)]
        if bad:
            for at in rng.integers(0, 60, 3):
                words[at] = "zwarg" + rng.choice(syllables)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    got = toxicity.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    truth = dict(labels)
    hit = sum(truth[r.doc_id] and r.predicted for r in got)
    assert hit >= 0.95 * sum(truth[r.doc_id] for r in got) and hit >= 0.95 * sum(r.predicted for r in got)


# ------------------------------------------------------------------ 12


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, longer = sorted((a, b), key=len)
    return len(longer) == len(short) + 1 and any(longer[:i] + longer[i + 1 :] == short for i in range(len(longer)))


def plain_groups(counts, near):
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def neighbours(words):
    """Near words by wildcards: a plainer path than halves and blocks."""
    keys = defaultdict(list)
    for w in words:
        for i in range(len(w)):
            keys[w[:i], w[i + 1 :]].append(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= set(keys[w[:i], w[i + 1 :]])
            short = w[:i] + w[i + 1 :]
            if short in near:
                near[w].add(short)
                near[short].add(w)
        near[w].discard(w)
    return near


@pytest.mark.parametrize("block", [1, 3, 256])
def test_near_words_whatever_the_blocks(spark, block):
    rng = np.random.default_rng(block)
    words = sorted({"".join(rng.choice(list("abé"), rng.integers(1, 8))) for _ in range(300)} | {"a", "b", "aaaaaaaaaa", "aaaaaaaaa", "aaaaaaaaaaa"})
    got = [(r.word, r.near) for r in spelling.near_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), block).collect()]
    want = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_groups_of_the_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = plain_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in queries.QUERIES["op12_spelling_dictionaries"](spark, DATA).collect())
    assert got == plain_groups(counts, neighbours(list(counts)))


def test_forms_are_followed_to_the_root(spark):
    counts = {"colour": 1000, "colours": 150, "colourss": 20, "coloursss": 3, "colou": 1000, "zzzzzz": 5, "colourÿ": 999}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(rows, block=1).collect())
    assert got == plain_groups(counts, {w: {x for x in counts if one_edit(w, x)} for w in counts})
    assert {r[0]: r[2] for r in got}["coloursss"] == "colour"


def test_spelling_on_awkward_rows(spark):
    rows = [(i, t) for i, t, _ in AWKWARD] + [(9, "Straße straße éclairÉ " * 6), (None, "naïvely " * 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(0), "run": F.lit(1), "id": F.lit("x")})
    counts = plain_words(rows)
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df).collect())
    assert got == plain_groups(counts, neighbours(list(counts))) and len(got) == 3
    assert spelling.spelling_variants(df.where("false")).count() == 0


# ------------------------------------------------------------------ 13


def plain_codes(rows, dims, entries=64):
    """Everything with Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    width = dims // 16
    part = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(16)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(2):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(part(v, p), book)[1]].append(part(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(book)]
    out, sums = [], Counter()
    for i, v, y in kept:
        found = [nearest(part(v, p), books[p]) for p in range(16)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), y))
        sums[y] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, error, sums[y], digest) for i, code, error, y in out), key=str)


@pytest.mark.parametrize("seed, block, parts", [(1, 4096, 4), (2, 3, 7)])
def test_codes_against_plain_integers(spark, monkeypatch, seed, block, parts):
    rng = np.random.default_rng(seed)
    nan, inf = float("nan"), float("inf")
    rows = [(int(i), [float(x) for x in rng.normal(scale=0.3, size=32).round(2)], int(y) if y else None) for i, y in zip(rng.permutation(150), rng.integers(0, 4, 150), strict=True)]
    rows += [(-1, None, 1), (-2, [], 1), (-3, [nan] * 32, 1), (-4, [inf] + [0.0] * 31, 2), (-5, [None] * 32, 2), (-6, [0.5] * 31, 3), (-7, [0.5] * 16, 3)]
    rows += [rows[0], rows[0], (None, [-0.001] * 32, 9), (5, [1.0] * 32, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("clash"), "v": F.lit(1), "code": F.lit(2)}).repartition(parts)
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes.fit_codebooks, "__defaults__", (16, 64, 2, block, 2))
    got = sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df).collect()), key=str)
    assert got == plain_codes(rows, 32)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(3, [float(k) for k in range(16)], None), (1, [0.0] * 16, 1), (1, [0.0] * 16, 1)]
    got = sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == plain_codes(rows, 16)
    for none in ([], [(1, None, 1), (2, [1.0] * 5, 2)]):
        empty = vector_codes.compress(spark.createDataFrame(none, schema))
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


def test_large_components_stay_within_64_bits(spark):
    rows = [(k, [s * 1e300] * 16, 1) for k, s in enumerate((1, -1, 1))]
    got = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), entries=1, rounds=0).collect()
    assert max(r.error for r in got) == 16 * (2 * vector_codes.limit_of(16)) ** 2 < 2**63


def test_codes_of_the_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({queries.ORACLE_SQL['op13_vector_codes']})").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op13_vector_codes"](spark, DATA).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]
    assert sorted(got) == sorted(want)


# ------------------------------------------------------------------ columns and short items


def test_stages_keep_columns_of_any_name(spark):
    """Columns named as the stages' own helpers, or with dots and back quotes, come out as they went in."""
    names = ["__size", "__key", "__score", "__h", "__id", "__n", "__lost", "__gone", "whole", "t_key", "t_n", "a.b", "c`d", "column 1"]
    rows = [(i, "the same words " * 9 if i % 3 else f"text number {i} of its own " * 9, "ab"[i % 2]) for i in range(12)] + [(None, None, None), (4, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.select("*", *(F.concat(F.lit("mine "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    benchmark = spark.createDataFrame([(1, "nothing of this is in any of the texts at all " * 4), (2, "no such passage " * 9)], "item_id long, text string")
    classes = docs.select("doc_id", F.col("doc_id").alias("component_id"))
    from spanloom.llm import decontaminate, mixing, quality_gam, simhash

    stages = {
        "quality": quality_gam.keep_good(docs, labels, threshold=0.0),
        "named": simhash.keep_named(docs, classes),
        "clean": decontaminate.drop_contaminated(docs, benchmark),
        "clean in blocks": decontaminate.drop_contaminated(docs, benchmark, block_chars=20),
        "mixed": mixing.mixed_documents(docs, chars_col="none"),
    }
    for name, out in stages.items():
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(v == f"mine {'none' if r.doc_id is None else r.doc_id}" for r in got for v in r[3:]), name


def test_short_items_and_text_ids(spark):
    from spanloom.llm import decontaminate

    docs = spark.createDataFrame([(1, "It is 42, he said: Blue-Whale!"), (2, "bluewhale 142"), (3, None), (4, "blue whale blue whale")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "42"), ("y", "Blue whale"), ("z", ""), (None, None), ("w", "!!")], "item_id string, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(1, "x", 6, 8, 0), (1, "y", 17, 27, 0), (4, "y", 0, 10, 0)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, items).orderBy("doc_id").collect()] == [2, 3]


def test_excerpts_are_found_from_a_passage_and_a_step_on(spark):
    from spanloom.llm import decontaminate

    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    item = decontaminate.normalise(" ".join(word() for _ in range(300)))
    for passage, step in ((120, 60), (60, 20)):
        index = decontaminate.index_passages([(1, item)], passage=passage, step=step)
        for size in (passage + step, passage + step + 30):
            texts = [" ".join(word() for _ in range(20)) + " " + item[at : at + size] + " " + word() for at in rng.integers(0, len(item) - size, 40)]
            assert {r[0] for r in decontaminate.find_passages(texts, index)} == set(range(40))
