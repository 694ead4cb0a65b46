"""Spelling variants: words one edit apart, found in a forward and a reversed sorted dictionary.

A pair one edit apart (a code point inserted, deleted or replaced) has the edit in one half, so the other half is intact. Of a pair whose
shorter word has ``m`` code points either the first ``m // 2`` are shared, which puts both into one block of the sorted dictionary, or the
last ``m - m // 2``, which does so in the dictionary of reversed words. A word so stands in four blocks: forward and reversed, as
the shorter (or equally long) and as the longer one of a pair.

A block of more than ``block`` words is subdivided: what lies between its shared prefix and suffix is a window with the edit in one half,
and again the other half is intact. So each of its words goes to two finer blocks, until the window is a single letter. The words of such
a block differ in one letter, or in two where one word is longer, so the alphabet bounds it (90 and 90 * 90 words of the letters taken
here). No word is dropped, and no frequent prefix or ending is left out.

Blocks are ranges of sorted rows: dictionaries are range-partitioned by block and sorted in the task, which scans a block after the
other and holds one. Pairs are verified there, and only those one edit apart leave the task. The place of the edit (the length of the
common prefix) says which of its blocks counts a pair, so each is found once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.session import cut, written

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE = 199  # of so many occurrences, by checksum, one loses a letter
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
BLOCK = 256
BROADCAST_ROWS = 500_000


# ---------------------------------------------------------------- words


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, ``least_letters`` or longer and found ``least_count`` times or more.

    An occurrence whose checksum (CRC-32 of ``<id>:<run>``) ``noise`` divides loses the letter at checksum modulo length; 0 leaves all as they are.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.translate(F.col(text_col), CAPITALS, SMALL), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_letters)
    word = F.col("run")
    if noise:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % noise == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))


# ---------------------------------------------------------------- blocks


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) with their block: a letters from the start and b from the end, of the words whose pairs have m letters in the shorter."""
    head, tail = F.substring("word", F.lit(1), F.col("a")), F.expr("right(word, b)")
    return rows.withColumn("block", F.concat_ws(" ", F.lpad(F.col("m").cast("string"), 9, "0"), F.concat(head, F.lit("*"), tail), F.col("a").cast("string")))


def _finer(rows: DataFrame) -> DataFrame:
    """Each row in the two blocks that halve its window: one shares the window's first half too, the other its last."""
    half = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    pick = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    split = F.array(pick(F.col("a") + half, F.col("b")), pick(F.col("a"), F.col("m") - F.col("a") - half))
    return rows.withColumn("x", F.explode(split)).select("word", "n", "m", F.col("x.a").alias("a"), F.col("x.b").alias("b"))


def dictionary_blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, word, n, m, a, b): every word in its blocks, none with more than ``block`` words unless its window is one letter."""
    sizes = F.array(F.length("word"), F.length("word") - 1)
    rows = _keyed(_finer(words.select("word", "n", F.explode(sizes).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("b"))))
    done = None
    while True:
        rows = written(rows)
        large = cut(rows.where("m - a - b > 1").groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > block).select("block"))
        many = large.count()
        if not many:
            return rows if done is None else done.unionByName(rows)
        some = F.broadcast(large) if many <= BROADCAST_ROWS else large
        kept = rows.join(some, "block", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = _keyed(_finer(rows.join(some, "block", "left_semi").drop("block")))


# ---------------------------------------------------------------- pairs


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points of each word, zero beyond its end."""
    return np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)


def near_pairs(words: list[str], m: int, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Indices of the pairs of a block that are one edit apart, with the edit in the block's window; one word of each has ``m`` letters.

    Words of one row are compared at a time; a row and its comparisons are what is held beside the block's letters.
    """
    sizes = np.array([len(w) for w in words])
    short, longer = np.flatnonzero(sizes == m), np.flatnonzero(sizes == m + 1)
    grid = _letters(words, m + 1)
    inside = lambda e: (e >= a) & ((e < m - b) | (b == 0))
    backward = lambda eq: np.logical_and.accumulate(eq[:, ::-1], axis=1).sum(axis=1)
    forward = lambda eq: np.logical_and.accumulate(eq, axis=1).sum(axis=1)
    for k, i in enumerate(short):
        rest = short[k + 1 :]
        if len(rest):
            equal = grid[rest, :m] == grid[i, :m]
            once = equal.sum(axis=1) == m - 1
            for j in rest[once & inside(forward(equal))]:
                yield int(i), int(j)
        if len(longer):
            first = forward(grid[longer, :m] == grid[i, :m])
            fits = first + backward(grid[longer, 1:] == grid[i, :m]) >= m
            for j in longer[fits & inside(first)]:
                yield int(i), int(j)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (block, word, n, m, a, b) in; (word, near, near_n) both ways out."""
    key, words, counts = None, [], []

    def flush() -> pa.RecordBatch:
        pairs = list(near_pairs(words, *key[1:])) if len(words) > 1 else []
        both = pairs + [(j, i) for i, j in pairs]
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i, _ in both], pa.string()), pa.array([words[j] for _, j in both], pa.string()), pa.array([counts[j] for _, j in both], pa.int64())], names=["word", "near", "near_n"])

    for batch in batches:
        out = []
        for block, word, n, m, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key is None or key[0] != block:
                if len(words) > 1:
                    out.append(flush())
                key, words, counts = (block, m, a, b), [], []
            words.append(word)
            counts.append(n)
        yield from (x for x in out if x.num_rows)
    if len(words) > 1:
        yield flush()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): all pairs of distinct words one edit apart, both ways, from (word, n)."""
    rows = dictionary_blocks(words, block).select("block", "word", "n", "m", "a", "b")
    return rows.repartitionByRange("block").sortWithinPartitions("block", "word").mapInArrow(_scan, "word string, near string, near_n long")


# ---------------------------------------------------------------- groups


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms are followed twice as far each round, until all have ended."""
    ways = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.join(ways.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        step = cut(ahead.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ways = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ways


def spelling_groups(words: DataFrame, ratio: float = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) with distinct words.

    A word's form is its near word of largest n, the first in code-point order of equals, if that n is at least ``ratio`` times the
    word's; the root is where forms lead, each commoner than the one before (``ratio`` over 1). Without a form the root is the word.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, or forms could go in circles")
    words = written(words.select("word", F.col("n").cast("long").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("o"), F.col("near"))).alias("x")
    near = near_words(words, block).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form: Column = F.when(-F.col("x.o") >= ratio * F.col("n"), F.struct(F.col("x.near").alias("form"), (-F.col("x.o")).alias("form_n")))
    found = written(words.join(near, "word", "left").withColumn("f", form).select("word", F.col("f.form").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("f.form_n").alias("form_n")))
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``spelling_groups`` of the words of whole texts. Null and empty texts have none, a null id is an empty one in checksums, repeated rows count again.

    An empty table gives no rows. Only the two named columns are read, so others may have any name.
    """
    return spelling_groups(word_counts(docs, id_col, text_col), **how)
