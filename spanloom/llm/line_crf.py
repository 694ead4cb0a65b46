"""Quality rules with line labelling: a linear-chain conditional random field marks lines as content or boilerplate.

A line gives a few binary features. The field scores a labelling of a text's lines by its features' weights and by label
changes between neighbours; Viterbi decoding finds the best one. The share of words in content lines decides
whether a document stays. Weights are trained here, by gradient ascent on the conditional likelihood of weakly labelled
lines: those of documents labelled good are content, those of documents labelled bad are boilerplate, and
sequences join lines of several documents, so that changes of label are seen as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
LEGAL = re.compile(r"licen[sc]e|copyright|©|all rights reserved|https?:|www\.|cookie|subscribe|click here|terms of (?:use|service)", re.I)
FEATURES = ("bias", "one_or_two_words", "few_words", "many_words", "symbol_words", "some_symbols", "capitals", "pipes", "exclamations", "seen_before", "one_word_repeats", "low_variety", "digits", "legal", "ends_sentence", "long_words")
MAX_TRAINING_DOCS, MAX_TRAINING_LINES = 600, 200_000
HELD_OUT = 5
SEQUENCE_LINES = 80
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_CONTENT_SHARE = 50, 50, 0.5


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines that hold a word; features are 0 or 1."""
    rows, sizes = [], []
    seen: set[str] = set()
    for line in lines:
        words = WORD.findall(line)
        n = len(words)
        if not n:
            continue
        chars = sum(map(len, words))
        symbols = len(SYMBOL.findall(line))
        kinds = len(set(words))
        rows.append((
            1, n <= 2, n < 8, n >= 20, symbols > 0.5 * n, symbols > 0, n > 1 and line.isupper(), "|" in line, line.count("!") > 0.2 * n + 1,
            line in seen, n >= 4 and kinds <= n / 4, n >= 4 and kinds <= 0.6 * n, sum(map(line.count, "0123456789")) > 0.3 * chars, LEGAL.search(line) is not None, words[-1][-1] in ".!?:;", chars > 12 * n,
        ))
        seen.add(line)
        sizes.append(n)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


class Crf:
    """Weights: for each label and feature, and for each label after each other. Label 1 is content."""

    def __init__(self, emit: np.ndarray, step: np.ndarray) -> None:
        self.emit, self.step = emit, step

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best labels of one sequence; content wins ties."""
        n = len(x)
        if not n:
            return np.zeros(0, np.int64)
        e = (x @ self.emit.T).tolist()
        (t00, t01), (t10, t11) = self.step.tolist()
        from0, from1 = [0] * n, [0] * n
        s0, s1 = e[0]
        for k in range(1, n):
            a0, b0, a1, b1 = s0 + t00, s1 + t10, s0 + t01, s1 + t11
            from0[k], from1[k] = int(b0 >= a0), int(b1 >= a1)
            s0, s1 = max(a0, b0) + e[k][0], max(a1, b1) + e[k][1]
        labels = np.zeros(n, np.int64)
        at = int(s1 >= s0)
        for k in range(n - 1, -1, -1):
            labels[k] = at
            at = from1[k] if at else from0[k]
        return labels


def prior_field() -> Crf:
    """The field where no labelled lines are at hand: plain lines are content; junk and legal marks speak against it."""
    emit = np.zeros((2, len(FEATURES)))
    emit[1, FEATURES.index("bias")] = 1.0
    for name in ("symbol_words", "capitals", "pipes", "exclamations", "seen_before", "one_word_repeats", "digits", "legal"):
        emit[0, FEATURES.index(name)] = 2.0
    return Crf(emit, np.array([[0.5, -0.5], [-0.5, 0.5]]))


def train_field(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, rate: float = 0.1, shrink: float = 1e-3) -> Crf:
    """Adam ascent on the mean conditional log likelihood of (features, labels) sequences; forward-backward over all at once."""
    start = prior_field()
    sequences = [s for s in sequences if len(s[0])]
    if len({int(v) for _, y in sequences for v in np.unique(y)}) < 2:
        return start
    size = max(len(x) for x, _ in sequences)
    n, m = len(sequences), len(FEATURES)
    x, y, live = np.zeros((n, size, m)), np.zeros((n, size), np.int64), np.zeros((n, size), bool)
    for k, (fx, fy) in enumerate(sequences):
        x[k, : len(fx)], y[k, : len(fx)], live[k, : len(fx)] = fx, fy, True
    both = live[:, 1:] & live[:, :-1]
    want_emit = np.stack([(x * ((y == c) & live)[..., None]).sum((0, 1)) for c in (0, 1)])
    want_step = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], float)
    theta = np.concatenate([start.emit.ravel(), start.step.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        emit, step = theta[: 2 * m].reshape(2, m), theta[2 * m :].reshape(2, 2)
        e = np.where(live[..., None], x @ emit.T, 0)
        alpha, beta = np.zeros((n, size, 2)), np.zeros((n, size, 2))
        alpha[:, 0] = e[:, 0]
        for k in range(1, size):
            moved = np.logaddexp.reduce(alpha[:, k - 1, :, None] + step, axis=1) + e[:, k]
            alpha[:, k] = np.where(live[:, k, None], moved, alpha[:, k - 1])
        for k in range(size - 2, -1, -1):
            moved = np.logaddexp.reduce(step + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
            beta[:, k] = np.where(live[:, k + 1, None], moved, 0)
        whole = np.logaddexp.reduce(alpha[:, -1], axis=1)
        p = np.exp(alpha + beta - whole[:, None, None]) * live[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + step + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - whole[:, None, None, None]) * both[..., None, None]
        slope = np.concatenate([(want_emit - np.einsum("nsc,nsm->cm", p, x)).ravel(), (want_step - pair.sum((0, 1))).ravel()]) / live.sum() - shrink * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Crf(theta[: 2 * m].reshape(2, m), theta[2 * m :].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_TRAINING_DOCS, max_lines: int = MAX_TRAINING_LINES) -> Crf:
    """Fit on lines of at most ``max_docs`` labelled documents of each label, the first in the order of a hash.

    Documents whose crc32 of the id as text is divisible by ``HELD_OUT`` are never fitted on. The bounds are for fitting only: texts are read
    whole, in the tasks, and a line comes to the driver as one number that holds its features; sequences are fitted on until
    they have ``max_lines`` lines. Long texts are cut into sequences of ``SEQUENCE_LINES`` lines. Without documents of both labels
    it is ``prior_field``.
    """
    fitted = F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT != 0
    usable = labels.where(F.col(id_col).isNotNull() & fitted & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).alias("__y"), F.max(label_col).alias("__z")).where("__y = __z")
    each = [usable.where(F.col("__y") == y).select(F.col(id_col).alias("__id"), "__y").orderBy(F.xxhash64("__id"), "__id").limit(max_docs) for y in (0, 1)]
    sample = F.broadcast(each[0].unionByName(each[1]))
    joined = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text")).join(sample, F.col("__doc") == F.col("__id")).select(F.col("__doc").cast("string"), F.col("__y").cast("int"), "__text")
    place = 1 << np.arange(len(FEATURES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [(line_features((t or "").split("\n"))[0].astype(np.int64) @ place).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.list_(pa.int32()))], names=["id", "y", "marks"])

    rows = sorted((r["id"], r["y"], r["marks"]) for r in joined.mapInArrow(run, "id string, y int, marks array<int>").dropDuplicates(["id"]).toLocalIterator())
    by_label = [[(np.array(r[2], np.int64)[:, None] & place > 0).astype(np.float64) for r in rows if r[1] == y] for y in (0, 1)]
    if not all(by_label):
        return prior_field()
    sequences, lines = [], 0
    for k in range(max(map(len, by_label))):  # good, bad and good again, in turns
        good, bad = (by_label[y][k % len(by_label[y])] for y in (1, 0))
        parts = ((good, 1), (bad, 0)) if k % 2 else ((bad, 0), (good, 1))
        x, y = np.concatenate([x for x, _ in parts]), np.concatenate([np.full(len(x), y) for x, y in parts])
        x, y = x[: max_lines - lines], y[: max_lines - lines]
        lines += len(x)
        sequences += [(x[i : i + SEQUENCE_LINES], y[i : i + SEQUENCE_LINES]) for i in range(0, len(x), SEQUENCE_LINES)]
    return train_field(sequences)


def measure(text: str | None, field: Crf) -> tuple[int, int, int, int, int, int]:
    """(words, their characters, symbols, repeated lines, words in repeated three-word windows, words in content lines)."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines = text.split("\n")
    with_words = [x for x in lines if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if windows and len(counts := Counter(windows)) < len(windows):
        covered = np.zeros(n, bool)
        twice = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, len(windows)))
        for k in range(3):
            covered[twice + k] = True
        repeated = int(covered.sum())
    x, sizes = line_features(with_words)
    content = int(sizes[field.decode(x) == 1].sum())
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), len(with_words) - len(set(with_words)), repeated, content


def line_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_CONTENT_SHARE, **how) -> DataFrame:
    """Counts, content_share, base_failed and kept, one row for each row of ``docs``.

    A document fails the base rules with under 50 words, or with over half of its words in repeated windows; of the others those
    stay whose content lines hold at least ``min_share`` of the words. A null or wordless text has no words and fails.
    Texts are read whole. Only the named columns are read.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, **how))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t, field.value) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(found[:, j])) for j in range(6))], names=[id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"{c} long" for c in names))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("content_words") / F.col("n_words")).otherwise(F.lit(0.0))
    return counted.withColumns({"content_share": share, "base_failed": failed}).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= min_share)).drop("content_words")
