"""Low complexity at every position: triplet repetition in sliding windows, the spans it masks, and the share that decides on a repeat scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.intervals import merge_intervals, union_length
from spanloom.operators.sequences import ssr_coverage, ssr_scan
from spanloom.operators.similarity import encoded
from spanloom.operators.tandem import pieces

WINDOW, LEVEL = 64, 2.0  # fixed values: letters of a window, score above which it is masked
PIECE = 250_000


def window_scores(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Score of the window at each start: pairs of equal triplets in it by the number of its triplets less one. A shorter text is one window.

    A window's pairs are those of the one before, with those of the triplet that enters and without those of the one that leaves; how often a
    triplet stands among its neighbours is looked up in its own places. Triplets with other letters than A, C, G and T pair with none.
    """
    triplets = len(codes) - 2
    if triplets < 1:
        return np.zeros(0)
    known = (codes[:-2] < 4) & (codes[1:-1] < 4) & (codes[2:] < 4)
    value = np.where(known, codes[:-2] * 16 + codes[1:-1] * 4 + codes[2:], 64).astype(np.uint8)
    wide = min(window - 2, triplets)
    order = np.argsort(value, kind="stable")
    order = order[: int(known.sum())]
    key = value[order].astype(np.int64) * (triplets + wide) + order
    rank = np.arange(len(key))
    before, after = np.zeros(triplets, np.int64), np.zeros(triplets, np.int64)  # equal ones among the wide - 1 on either side
    before[order] = rank - np.searchsorted(key, key - (wide - 1))
    after[order] = np.searchsorted(key, key + (wide - 1), side="right") - 1 - rank
    pairs = before[:wide].sum() + np.r_[0, np.cumsum(before[wide:] - after[: triplets - wide])]
    return pairs / max(1, wide - 1)


def low_complexity(seqs: DataFrame, seq_id: str, seq: str, window: int = WINDOW, level: float = LEVEL, piece: int = PIECE) -> DataFrame:
    """(seq_id, s, e): maximal spans, 1-based and inclusive, under windows that score above ``level``; long sequences in overlapping pieces."""
    kind = seqs.schema[seq_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, at, own, text in zip(batch[seq_id], batch["at"], batch["own"], batch["text"], strict=True):
                over = np.flatnonzero(window_scores(encoded(text), window)[:own] > level)
                if len(over):
                    breaks = np.flatnonzero(np.diff(over) > 1)
                    rows += [(key, at + s + 1, at + min(e + window, len(text))) for s, e in zip(over[np.r_[0, breaks + 1]], over[np.r_[breaks, len(over) - 1]], strict=True)]
            yield pd.DataFrame(rows, columns=[seq_id, "s", "e"])

    # the last piece of a long sequence may be shorter than a window; the piece before it has its windows
    cut = pieces(seqs.where(F.col(seq_id).isNotNull()), seq_id, seq, piece, window - 1).where((F.col("at") == 0) | (F.length("text") >= window))
    return merge_intervals(cut.mapInPandas(run, f"{seq_id} {kind}, s long, e long"), [seq_id], touch=1).select(seq_id, "s", "e")


def complexity_share(seqs: DataFrame, seq_id: str, seq: str, **how) -> DataFrame:
    """(seq_id, share): the share of each sequence under ``low_complexity``; 0 without any, null for empty and null sequences."""
    masked = union_length(low_complexity(seqs, seq_id, seq, **how), [seq_id], width=None)
    return seqs.select(seq_id, F.length(seq).alias("__n")).join(masked, seq_id, "left").select(seq_id, (F.coalesce("length", F.lit(0)) / F.nullif(F.col("__n"), F.lit(0))).alias("share"))


def gated_ssr_coverage(seqs: DataFrame, seq_id: str, seq: str, gate: float = 0.8, **how) -> DataFrame:
    """(seq_id, share, covered): the share under short repeats, sought only where low complexity passes the gate, 0 elsewhere."""
    shares = complexity_share(seqs, seq_id, seq, **how)
    able = seqs.join(shares.where(F.col("share") > gate).select(seq_id), seq_id, "left_semi")
    found = ssr_coverage(ssr_scan(able, seq_id, seq), able.select(seq_id, F.length(seq).alias("__n")), seq_id, "__n")
    return shares.join(found, seq_id, "left").select(seq_id, "share", F.coalesce("covered", F.lit(0.0)).alias("covered"))
