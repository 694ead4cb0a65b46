"""Toxicity: class-conditional Kneser-Ney models of symbol n-grams, compared by length-normalised log-likelihood.

Texts are read as symbols: letters without case, digits as one symbol, other letters dealt to twelve, and runs of all else as one
boundary. A model predicts each symbol from the three before it. Counts come from every labelled document that isn't held out:

* Shared: counts of both classes, interpolated Kneser-Ney with continuation counts at the lower orders.
* Toxic, ordinary: the counts of one class, discounted, with what the discount frees given to the shared model. A context that a class
  has not seen so falls back on what both classes have, and a rare spelling of an expression is judged by the pieces it shares.

A document's log-likelihoods are compared by their difference a symbol: over the whole text, and over its most toxic stretch of
``WINDOW`` symbols (a few words), so that a long text does not hide an expression. Two weights and a constant turn these into a probability; they are
fitted on documents of one half of the labels scored by the models of the other half.

An n-gram is one of ``SYMBOLS ** ORDER`` cells (2.56 million), whatever the corpus: this bounds what is sent to the driver and what is
broadcast, while the counts in the cells grow with the labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.workers import released

SYMBOLS, ORDER = 40, 4
CELLS = SYMBOLS**ORDER
DIGIT, OTHERS = 27, 12
WINDOW = 32
THRESHOLD = 0.3
MAX_CALIBRATION = 20_000
BROADCAST_ROWS = 500_000
SLICE = 1 << 18  # characters of a text that are held as arrays at a time


# ---------------------------------------------------------------- symbols


def _symbol(ch: str) -> int:
    low = ch.lower()[0]
    if "a" <= low <= "z":
        return 1 + ord(low) - ord("a")
    if low.isdigit():
        return DIGIT
    return DIGIT + 1 + ord(low) % OTHERS if low.isalpha() else 0


SYMBOL_OF = np.array([_symbol(chr(c)) for c in range(1 << 16)], np.int64)


def gram_blocks(text: str | None) -> Iterator[np.ndarray]:
    """Cells of a text's n-grams, one a symbol, a slice of the text at a time. The text stands between boundaries; an empty one is a boundary alone."""
    text = text or ""
    last, empty = np.zeros(ORDER - 1, np.int64), True
    for at in range(0, len(text) + 1, SLICE):
        part = text[at : at + SLICE]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols = np.where(points < 1 << 16, SYMBOL_OF[points & 0xFFFF], DIGIT + 1 + points % OTHERS)
        row = np.r_[last[-1], symbols]
        row = np.r_[last, symbols[(row[1:] > 0) | (row[:-1] > 0)]]
        empty = empty and len(row) == len(last)
        if at + SLICE > len(text) and (row[-1] > 0 or empty):
            row = np.r_[row, 0]
        n = len(row) - ORDER + 1
        cells = np.zeros(n, np.int64)
        for j in range(ORDER):
            cells = cells * SYMBOLS + row[j : j + n]
        last = row[len(row) - ORDER + 1 :]
        yield cells


# ---------------------------------------------------------------- the model


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _interpolated(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probability of each cell's last symbol after those before it: discounted counts, and ``below`` for what the discount frees."""
    table = counts.reshape(-1, SYMBOLS)
    total = table.sum(axis=1, keepdims=True)
    d = _discount(counts)
    kept, freed = np.maximum(table - d, 0), d * (table > 0).sum(axis=1, keepdims=True)
    under = below.reshape(table.shape)
    return np.where(total > 0, (kept + freed * under) / np.maximum(total, 1), under).ravel()


def shared_model(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney over cells: below the highest order a cell counts the different symbols that stand before it."""
    levels = [counts]
    while levels[-1].size > SYMBOLS:
        levels.append((levels[-1].reshape(SYMBOLS, -1) > 0).sum(axis=0))
    below = np.full(SYMBOLS, 1 / SYMBOLS)
    for level in reversed(levels):
        below = _interpolated(level, np.tile(below, level.size // below.size))
    return below


def log_ratios(ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-likelihood of each cell under the toxic model less that under the ordinary one; both back off to the shared model."""
    shared = shared_model(ordinary + toxic)
    return np.log(_interpolated(toxic, shared) / _interpolated(ordinary, shared)).astype(np.float32)


def text_ratios(text: str | None, ratios: np.ndarray) -> tuple[float, float]:
    """The mean log ratio a symbol of a text, and that of its most toxic stretch of ``WINDOW`` symbols (all of a shorter text)."""
    total, n, most, tail = 0.0, 0, -np.inf, np.zeros(0)
    for cells in gram_blocks(text):
        values = np.r_[tail, ratios[cells].astype(np.float64)]
        sums = np.r_[0.0, np.cumsum(values)]
        total, n = total + sums[-1] - sums[len(tail)], n + len(cells)
        if len(values) >= WINDOW:
            most = max(most, float((sums[WINDOW:] - sums[:-WINDOW]).max()) / WINDOW)
        tail = values[max(0, len(values) - WINDOW + 1) :]
    mean = total / n
    return mean, mean if most == -np.inf else most


@dataclass
class Model:
    weights: np.ndarray  # constant, whole text, stretch
    ratios: np.ndarray | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability that each text is toxic."""
        x = np.zeros((len(texts), 2)) if self.ratios is None else np.array([text_ratios(t, self.ratios) for t in texts]).reshape(len(texts), 2)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, slightly drawn to zero; negative slopes are left out, so that a higher ratio never scores lower."""
    columns = [0, 1]
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    while True:
        a = np.c_[np.ones(len(y)), x[:, columns] / scale[columns]]
        w = np.zeros(a.shape[1])
        pull = np.diag([1e-6, *[0.01] * len(columns)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull, a.T @ (y - p) - pull @ w)
            w = w + np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        low = [c for c, v in zip(columns, w[1:], strict=True) if v < 0]
        if not low:
            weights = np.zeros(3)
            weights[[0, *(c + 1 for c in columns)]] = w / np.r_[1, scale[columns]]
            return weights
        columns = [c for c in columns if c not in low]


# ---------------------------------------------------------------- on Spark


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 on division by 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _half(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("half")), F.lit(2)).cast("int")


def gram_counts(rows: DataFrame) -> np.ndarray:
    """Counts of all cells by half and class, (2, 2, ``CELLS``), of rows (text, half, class). A task holds one such table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, CELLS), np.int64)
        for batch in batches:
            for text, half, y in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for cells in gram_blocks(text):
                    if len(cells) < CELLS // 16:
                        np.add.at(held[2 * half + y], cells, 1)
                    else:
                        held[2 * half + y] += np.bincount(cells, minlength=CELLS)
        part, cell = np.nonzero(held)
        for at in range(0, len(part), 1 << 16):
            p, c = part[at : at + (1 << 16)], cell[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(p * CELLS + c), pa.array(held[p, c])], names=["at", "n"])

    sums = rows.mapInArrow(released(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(4 * CELLS, np.int64)
    counts[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return counts.reshape(2, 2, CELLS)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_calibration: int = MAX_CALIBRATION) -> Model:
    """Count over every labelled document that isn't held out; weigh on at most ``max_calibration`` of them, the first in the order of a hash.

    Labels other than 0 and 1, ids that have both, and rows without an id are left out; a text that stands in several rows of an id
    counts as often. Without labels of both kinds the score is the smoothed share of label 1. Labels are broadcast up to
    ``BROADCAST_ROWS``, and joined beyond.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.min(label_col).cast("int").alias("__y"), F.max(label_col).alias("__z"))
    usable = usable.where("__y = __z").select(F.col(id_col).alias("__id"), "__y")
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text"))
    kinds = {r["__y"]: r["count"] for r in usable.groupBy("__y").count().collect()}
    n, positive = sum(kinds.values()), kinds.get(1, 0)
    share = np.log((positive + 1) / (n - positive + 1))
    if len(kinds) < 2:
        return Model(np.array([share, 0.0, 0.0]))
    joined = texts.join(F.broadcast(usable) if n <= BROADCAST_ROWS else usable, F.col("__doc") == F.col("__id"))
    counts = gram_counts(joined.select("__text", _half("__id").alias("half"), "__y"))
    if not counts.sum(axis=(0, 2)).all():
        return Model(np.array([share, 0.0, 0.0]))
    spark = docs.sparkSession
    halves = spark.sparkContext.broadcast([log_ratios(*counts[1 - k]) for k in (0, 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_ratios(t, halves.value[k]) for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]).reshape(batch.num_rows, 2)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3).cast(pa.string()), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["y", "id", "whole", "most"])

    some = F.broadcast(usable.orderBy(F.xxhash64("__id"), "__id").limit(max_calibration))
    chosen = texts.join(some, F.col("__doc") == F.col("__id")).select("__text", _half("__id").alias("half"), "__y", "__id")
    table = chosen.mapInArrow(released(run), "y int, id string, whole double, most double").dropDuplicates(["id"]).toArrow().sort_by("id")
    halves.unpersist()
    x, y = np.stack([table["whole"].to_numpy(), table["most"].to_numpy()], axis=1), table["y"].to_numpy()
    return Model(calibrate(x, y) if len(set(y.tolist())) > 1 else np.array([share, 0.0, 1.0]), log_ratios(*counts.sum(axis=0)))


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score column (a column of that name is replaced) from whole texts; null texts score as empty ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.score(texts.tolist()))

    of = F.pandas_udf(released(run), "double")
    return docs.withColumn(into, of(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    Equal texts score alike; a null id is held in; an empty table gives no rows. Only the named columns are read, so others may have any name.
    """
    model = train(docs, labels, id_col, text_col, **how)
    scored = score(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), model, "__text", "score")
    return scored.select(F.col("__id").alias(id_col), held_out("__id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
