"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Cyclic boosting visits the features in turn, and each visit fits a shallow tree to the
gradient over that feature's bins alone and adds a small step of it to the feature's lookup table; then the strongest pairs of
features get two-dimensional tables the same way. A score is the sum of one table entry for each
feature and pair, through the logistic function.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.columns import set_apart
from spanloom.llm.workers import released

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FEATURES = (
    "log_words", "mean_word_chars", "long_word_share", "short_word_share", "symbol_share", "capital_word_share", "title_word_share", "exclamation_share",
    "digit_share", "stop_share", "comma_share", "distinct_word_share", "top_word_share", "repeat_triple_share", "dup_line_share", "words_per_line",
)
MAX_LABELS = 10_000
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, STEP = 150, 60, 0.08


def features(text: str | None) -> list[float]:
    """The values named in ``FEATURES``; all zero for a text without words."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    chars = int(sizes.sum())
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    upper = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    title = sum(k for w, k in counts.items() if w[0].isupper())
    return [
        float(np.log1p(n)),
        chars / n,
        float((sizes > 12).mean()),
        float((sizes <= 3).mean()),
        sum(map(text.count, "#*$%&|<>~^=_{}[]\\@")) / chars,
        upper / n,
        title / n,
        text.count("!") / n,
        sum(map(text.count, "0123456789")) / chars,
        text.count(".") / n,
        text.count(",") / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - triples / (n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        n / max(1, len(lines)),
    ]


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


# ---------------------------------------------------------------- the model


@dataclass
class Gam:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features: binned lookups, added."""
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _split(g: np.ndarray, h: np.ndarray, axis: int) -> tuple[float, int]:
    """The best cut of a block of bins along an axis: (gain, bins before it)."""
    other = tuple(i for i in range(g.ndim) if i != axis)
    gs, hs = g.sum(axis=other).cumsum(), h.sum(axis=other).cumsum()
    if len(gs) < 2:
        return 0.0, 0
    left, right = (gs[:-1], hs[:-1]), (gs[-1] - gs[:-1], hs[-1] - hs[:-1])
    gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - gs[-1] ** 2 / (hs[-1] + 1)
    gain = np.where((left[1] > 0.5) & (right[1] > 0.5), gain, 0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Newton steps of a best-first tree of so many leaves over a grid of gradient and curvature sums."""
    blocks = [tuple(slice(0, n) for n in g.shape)]
    while len(blocks) < leaves:
        gain, k, at, axis = max((*_split(g[b], h[b], axis), i, axis) for i, b in enumerate(blocks) for axis in range(g.ndim))
        if gain <= 1e-9:
            break
        b = blocks.pop(at)
        cut = b[axis].start + k
        blocks += [tuple(slice(s.start, cut) if i == axis else s for i, s in enumerate(b)), tuple(slice(cut, s.stop) if i == axis else s for i, s in enumerate(b))]
    out = np.zeros(g.shape)
    for b in blocks:
        out[b] = -g[b].sum() / (h[b].sum() + 1)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS) -> Gam:
    """Fit to rows of features and labels 0 or 1; with no rows or one label only, the model is its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    n, m = x.shape
    model.edges = [_cuts(x[:, j], BINS) for j in range(m)]
    model.pair_edges = [_cuts(x[:, j], PAIR_BINS) for j in range(m)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(n, model.base)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = gradient()
            step = STEP * _tree(np.bincount(bins[j], g, len(table)), np.bincount(bins[j], h, len(table)), 3)
            table += step
            total += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], values, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    g, h = gradient()
    gains = []
    for a in range(m):
        for b in range(a):
            sums = grid(a, b, g)
            gains.append((-float((_tree(sums, grid(a, b, h), 4) * sums).sum()), a, b))
    chosen = sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:PAIRS]
    model.pairs = [(a, b, np.zeros((sizes[a], sizes[b]))) for _, a, b in chosen]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = gradient()
            step = STEP * _tree(grid(a, b, g), grid(a, b, h), 4)
            table += step
            total += step[coarse[a], coarse[b]]
    return model


# ---------------------------------------------------------------- on Spark


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labels: int = MAX_LABELS) -> Gam:
    """Fit on labelled documents that aren't held out, at most ``max_labels`` of them, the first in the order of a hash.

    The bound makes the labels small enough to broadcast and their feature rows to fit on the driver. Rows without an id or
    with a label other than 0 and 1 are left out, as are ids with both labels.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.min(label_col).alias("__y"), F.max(label_col).alias("__z")).where("__y = __z")
    sample = usable.select(F.col(id_col).alias("__id"), "__y").orderBy(F.xxhash64("__id"), "__id").limit(max_labels)
    joined = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text")).join(F.broadcast(sample), F.col("__doc") == F.col("__id")).select("__doc", "__text", "__y")
    names = [f"f{j}" for j in range(len(FEATURES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(2).cast(pa.int32()), *(pa.array(x[:, j]) for j in range(x.shape[1]))], names=["id", "y", *names])

    rows = joined.mapInArrow(released(run), "id string, y int, " + ", ".join(f"{c} double" for c in names))
    # a document that repeats under one id counts once
    table = rows.dropDuplicates(["id"]).toArrow().sort_by("id")
    x = np.stack([table[c].to_numpy() for c in names], axis=1) if table.num_rows else np.zeros((0, len(names)))
    return fit(x, table["y"].to_numpy())


def score(docs: DataFrame, model: Gam, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score column from whole texts; null and wordless texts score as texts of zero features."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.score(feature_matrix(texts.tolist())))

    of = F.pandas_udf(released(run), "double")
    return docs.withColumn(into, of(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``. Only the named columns are read."""
    model = train(docs, labels, id_col, text_col, **how)
    scored = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "score")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with the columns they came with."""
    model = train(docs, labels, id_col, text_col, **how)
    rows, back = set_apart(docs, text_col)
    return back(score(rows, model, text_col, "__score").where(F.col("__score") >= threshold))
