"""Tandem repeats from sequences alone: arrays found in rounds of periods, periodograms with ranked peaks, identities of neighbouring copies.

A k-mer's distance to its next occurrence is the period where a sequence repeats in tandem, so an array shows as many k-mers at one
distance, no further apart than about a copy. Sequences are searched in pieces that overlap by the longest period: a link belongs to
the piece in which it starts, so pieces change no link, and what they found of one array is joined by period and position afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators import similarity
from spanloom.operators.cascade import founders
from spanloom.operators.intervals import WIDTH, mask_sequences
from spanloom.operators.letters import Letters, by_sequence
from spanloom.operators.report import needs_rescoring
from spanloom.operators.rollup import replace_groups
from spanloom.operators.sequences import gap_rows, subsequences
from spanloom.session import written

ROUNDS = ((40, 3000), (3001, 10_000), (10_001, 25_000))  # fixed values: least and greatest period of each round
MIN_COPIES = 5  # fixed value
K = 8
DENSITY = 0.08  # of an array's positions that start a link, at least
PIECE = 250_000
SPREAD, NARROW = 1.08, 50  # periods of one array are within this ratio, and below ``NARROW`` within 4 letters


# ---------------------------------------------------------------- arrays


def links(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance to the next equal k-mer) of all k-mers of A, C, G and T that occur again."""
    n = len(codes) - k + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value, broken = np.zeros(n, np.int64), np.zeros(n, bool)
    for j in range(k):
        part = codes[j : j + n]
        broken |= part > 3
        value = value << 2 | (part & 3)
    at = np.flatnonzero(~broken)
    order = at[np.argsort(value[at], kind="stable")]
    same = value[order[1:]] == value[order[:-1]]
    return order[:-1][same], (order[1:] - order[:-1])[same]


def _trimmed(at: np.ndarray, period: int, density: float) -> tuple[int, int]:
    """The links (first, behind the last) between those with half the density asked for in the period after, and in the period before."""
    need = max(2, density / 2 * period)
    after = np.searchsorted(at, at + period, side="right") - np.arange(len(at))
    before = np.arange(len(at)) + 1 - np.searchsorted(at, at - period, side="left")
    firsts, lasts = np.flatnonzero(after >= need), np.flatnonzero(before >= need)
    return (int(firsts[0]), int(lasts[-1]) + 1) if len(firsts) and len(lasts) and firsts[0] <= lasts[-1] else (0, 0)


def dense_runs(at: np.ndarray, apart: np.ndarray, k: int, density: float) -> list[tuple[int, int, int, int]]:
    """(start, end, period, links), 0-based and inclusive: runs of links of like distance, at most two periods apart (or ``4 * k``).

    Stray links at the ends go; of runs that share half of the smaller the one with more links stays.
    """
    found: list[tuple[int, int, int, int]] = []
    if not len(at):
        return found
    for shift in (0.0, 0.5):
        cell = np.floor(np.where(apart < NARROW, apart / 4, NARROW / 4 + np.log(apart / NARROW) / np.log(SPREAD)) + shift).astype(np.int64)
        order = np.lexsort((at, cell))
        a, d, c = at[order], apart[order], cell[order]
        starts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (a[1:] - a[:-1] > np.maximum(2 * d[:-1], 4 * k))])
        ends = np.r_[starts[1:], len(a)]
        several = ends - starts >= 3
        for i, j in zip(starts[several], ends[several], strict=True):
            values, counts = np.unique(d[i:j], return_counts=True)
            period = int(values[counts.argmax()])
            first, last = _trimmed(a[i:j], period, density)
            if last - first >= 3:
                low, high = int(a[i + first]), int((a[i + first : i + last] + d[i + first : i + last]).max()) + k - 1
                if last - first >= density * (high - low - period):
                    found.append((low, high, period, last - first))
    kept: list[tuple[int, int, int, int]] = []
    for run in sorted(found, key=lambda r: (-r[3], r[2], r[0])):
        if not any(min(run[1], x[1]) - max(run[0], x[0]) + 1 > 0.5 * min(run[1] - run[0] + 1, x[1] - x[0] + 1) for x in kept):
            kept.append(run)
    return kept


def pieces(seqs: DataFrame, seq_id: str, seq: str, size: int, overlap: int) -> DataFrame:
    """(seq_id, at, own, text): sequences in pieces of ``size`` letters that run on by ``overlap``; at is 0-based. Long sequences' pieces are dealt out."""
    rows = seqs.where(F.col(seq).isNotNull()).select(seq_id, F.col(seq).alias("text"))
    short = rows.where(F.length("text") <= size).select(seq_id, F.lit(0).cast("long").alias("at"), F.length("text").alias("own"), "text")
    kind = seqs.schema[seq_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch[seq_id], batch["text"], strict=True):
                for at in range(0, len(text), size):
                    yield pd.DataFrame({seq_id: [key], "at": [at], "own": [min(size, len(text) - at)], "text": [text[at : at + size + overlap]]})

    long = rows.where(F.length("text") > size).mapInPandas(run, f"{seq_id} {kind}, at long, own int, text string")
    return short.unionByName(long.repartition(seq_id, "at"))


def _joined(runs: DataFrame, seq_id: str, shift: float, slack: int) -> DataFrame:
    """Runs of one sequence and like period that lie within two periods of each other (or ``slack``) as one; the period is that of most links."""
    period = F.col("period")
    cell = F.floor(F.when(period < NARROW, period / 4).otherwise(NARROW / 4 + F.ln(period / NARROW) / float(np.log(SPREAD))) + shift)
    order = Window.partitionBy(seq_id, "cell").orderBy("s", "e", "period")
    reach = F.max(F.col("e") + F.greatest(2 * period, F.lit(slack))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("cell", cell).withColumn("new", F.when(F.col("s") <= reach, 0).otherwise(1))
    numbered = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    same = numbered.groupBy(seq_id, "cell", "island", "period").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"))
    return same.groupBy(seq_id, "cell", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("links"), F.max_by("period", F.struct("n", -F.col("period"))).alias("period")).select(seq_id, "s", "e", "period", F.col("links").alias("n"))


def find_arrays(seqs: DataFrame, seq_id: str, seq: str, low: int, high: int, min_copies: int = MIN_COPIES, k: int = K, density: float = DENSITY, piece: int = PIECE) -> DataFrame:
    """(seq_id, s, e, period, n): tandem arrays with periods from ``low`` to ``high``, 1-based and inclusive, with their number of links.

    Ids are unique. An array with ``min_copies`` copies or more stays unless half of it lies in one with more links. Letters other than
    A, C, G and T make no links; null and short sequences have no arrays. A task holds one piece of a sequence, at least four of the
    longest periods long.
    """
    piece = max(piece, 4 * high)
    kind = seqs.schema[seq_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, offset, own, text in zip(batch[seq_id], batch["at"], batch["own"], batch["text"], strict=True):
                at, apart = links(similarity.encoded(text), k)
                mine = (at < own) & (apart >= low) & (apart <= high)
                rows += [(key, offset + s + 1, offset + e + 1, p, n) for s, e, p, n in dense_runs(at[mine], apart[mine], k, density)]
            yield pd.DataFrame(rows, columns=[seq_id, "s", "e", "period", "n"])

    able = seqs.where(F.length(seq) >= min_copies * low).select(seq_id, seq)
    runs = pieces(able, seq_id, seq, piece, high + k).mapInPandas(run, f"{seq_id} {kind}, s long, e long, period int, n long")
    arrays = written(_joined(_joined(runs, seq_id, 0.0, 2 * k), seq_id, 0.5, 2 * k).where((F.col("e") - F.col("s") + 1 >= min_copies * F.col("period")) & (F.col("n") >= density * (F.col("e") - F.col("s") + 1 - F.col("period")))))
    binned = arrays.withColumn("bin", F.explode(F.sequence(F.floor(F.col("s") / WIDTH), F.floor(F.col("e") / WIDTH))))
    other = binned.select(seq_id, "bin", F.col("s").alias("os"), F.col("e").alias("oe"), F.struct("n", -F.col("period"), -F.col("s")).alias("better"))
    shared = F.least("e", "oe") - F.greatest("s", "os") + 1
    under = binned.join(other, [seq_id, "bin"]).where((F.col("better") > F.struct("n", -F.col("period"), -F.col("s"))) & (2 * shared > F.col("e") - F.col("s") + 1)).select(seq_id, "s", "e", "period").distinct()
    return arrays.join(under, [seq_id, "s", "e", "period"], "left_anti").select(seq_id, "s", "e", "period", "n")


def tandem_rounds(seqs: DataFrame, seq_id: str, seq: str, rounds: Sequence[tuple[int, int]] = ROUNDS, **how) -> DataFrame:
    """(seq_id, s, e, period, n, round): arrays of each round of periods, looked for in what the rounds before have left unmasked."""
    left, every = seqs.where(F.col(seq_id).isNotNull() & F.col(seq).isNotNull()).select(seq_id, seq), None
    for number, (low, high) in enumerate(rounds, 1):
        found = written(find_arrays(left, seq_id, seq, low, high, **how).withColumn("round", F.lit(number)))
        every = found if every is None else every.unionByName(found)
        if number < len(rounds):
            after = left.where(F.length(seq) >= how.get("min_copies", MIN_COPIES) * rounds[number][0])
            left = written(mask_sequences(after, found.join(after.select(seq_id), seq_id, "left_semi"), seq_id, seq))
    return every


# ---------------------------------------------------------------- periodogram


def periodogram(seqs: DataFrame, seq_id: str, seq: str, k: int, max_gap: int) -> DataFrame:
    """(seq_id, gap, n, score): how often equal k-mers follow each other at a gap, and the excess over chance by position.

    Chance has the sequence's letters in any order: a k-mer comes again ``gap`` later with probability q = (sum of squared shares)^k, and
    not before with (1 - q)^(gap - 1). Ids are unique.
    """

    def each(letters: Letters) -> tuple[np.ndarray, dict]:
        owner, gap, n = gap_rows(letters, k, max_gap)
        count = len(letters.ids)
        squares = sum(np.bincount(letters.owner[letters.points == ord(b)], minlength=count).astype(float) ** 2 for b in "ACGT")
        total = np.bincount(letters.owner, minlength=count)
        return owner, {"gap": gap, "n": n, "total": total[owner], "squares": squares[owner]}

    found = by_sequence(seqs.where(F.col(seq_id).isNotNull()), seq_id, seq, each, "gap int, n long, total long, squares double")
    total = F.col("total").cast("double")  # squares of over 46,340 letters pass an int
    q = F.pow(F.col("squares") / (total * total), F.lit(float(k)))
    room = F.col("total") - k + 1 - F.col("gap")
    chance = room * q * F.pow(1 - q, (F.col("gap") - 1).cast("double"))
    return found.select(seq_id, "gap", "n", F.round((F.col("n") - chance) / room, 9).alias("score"))


def spectrum_peaks(spectrum: DataFrame, seq_id: str, near: int = 3, least: float = 0.02, most_multiple: int = 5, tolerance: int = 2, top: int = 20) -> DataFrame:
    """(seq_id, rank, period, score): the ``top`` local maxima of a periodogram without overtones, highest first, ties by period.

    A maximum has no higher score within ``near`` gaps, nor an equal one before it. It is an overtone if within ``tolerance`` of 2 to
    ``most_multiple`` times another maximum that scores as high or higher.
    """
    around = Window.partitionBy(seq_id).orderBy("gap").rangeBetween(-near, near)
    before = Window.partitionBy(seq_id).orderBy("gap").rangeBetween(-near, -1)
    highest = (F.col("score") >= F.max("score").over(around)) & (F.col("score") > F.coalesce(F.max("score").over(before), F.lit(-1.0)))
    maxima = spectrum.where("score > 0").withColumn("peak", highest).where(F.col("peak") & (F.col("score") >= least)).select(seq_id, "gap", "score")
    spread = F.transform(F.sequence(F.lit(2), F.lit(most_multiple)), lambda m: F.transform(F.sequence(F.lit(-tolerance), F.lit(tolerance)), lambda t: F.col("gap") * m + t))
    over = maxima.select(seq_id, F.explode(F.flatten(spread)).alias("gap"), F.col("score").alias("under")).groupBy(seq_id, "gap").agg(F.max("under").alias("under"))
    alone = maxima.join(over, [seq_id, "gap"], "left").where(F.col("under").isNull() | (F.col("under") < F.col("score")))
    rank = F.row_number().over(Window.partitionBy(seq_id).orderBy(F.col("score").desc(), "gap"))
    return alone.withColumn("rank", rank).where(F.col("rank") <= top).select(seq_id, "rank", F.col("gap").cast("int").alias("period"), "score")


# ---------------------------------------------------------------- identity of copies


def copy_identities(text: str, period: int, band: int | None = None) -> np.ndarray:
    """Share of each copy's letters that the next copy has too, aligned with room for insertions and deletions; none for under two copies."""
    codes = similarity.encoded(text)
    room = min(64, max(8, period // 20)) if band is None else band
    starts = range(0, len(codes) - 2 * period + 1, period) if period > 0 else ()
    shares = []
    some = max(1, min(256, similarity.CELLS // (max(period, 1) * (2 * room + 1))))
    for at in range(0, len(starts), some):
        part = [(codes[i : i + period], codes[max(0, i + period - room) : i + 2 * period + room], -min(room, i + period)) for i in starts[at : at + some]]
        found = similarity.banded_alignments(part, room)
        shares.append(found[:, 1] / (found[:, 2] + period - (found[:, 5] - found[:, 4] + 1) * (found[:, 2] > 0)))
    return np.concatenate(shares) if shares else np.zeros(0)


def rescore(peaks: DataFrame, seqs: DataFrame, case: str, seq: str, max_period: int = 10_000) -> DataFrame:
    """``peaks`` with identity, the median share of letters that neighbouring copies have in common, iqr, its quartile range, and copies.

    Null for periods above ``max_period`` (the work is length times band) and sequences with under two copies. ``peaks`` has (case, period),
    ``seqs`` one row a case; a case without a sequence keeps its peaks with nulls. Columns of these three names are replaced.
    """
    kind = peaks.schema[case].dataType.simpleString()
    wanted = peaks.where(F.col("period").isNotNull()).select(case, F.bround(F.col("period").cast("double")).cast("int").alias("lag")).distinct()
    able = seqs.select(case, F.col(seq).alias("text")).join(wanted.where((F.col("lag") >= 1) & (F.col("lag") <= max_period)), case)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, lag in zip(batch[case], batch["text"], batch["lag"], strict=True):
                shares = copy_identities(text or "", int(lag))
                if len(shares):
                    low, middle, high = np.percentile(shares, [25, 50, 75])
                    rows.append((key, lag, float(middle), float(high - low), len(shares) + 1))
            yield pd.DataFrame(rows, columns=[case, "lag", "identity", "iqr", "copies"])

    found = able.select(case, "text", "lag").mapInPandas(run, f"{case} {kind}, lag int, identity double, iqr double, copies int")
    base = peaks.drop("identity", "iqr", "copies").withColumn("lag", F.bround(F.col("period").cast("double")).cast("int"))
    return base.join(found, [case, "lag"], "left").drop("lag")


def rescore_long(peaks: DataFrame, seqs: DataFrame, case: str, seq: str, cap: int, extended: int, least: float = 0.7) -> DataFrame:
    """Rescored peaks in which only the cases that ``needs_rescoring`` selects are scored again, up to ``extended``, and put back."""
    flagged = needs_rescoring(peaks, case, cap, least)
    again = rescore(peaks.join(flagged, case, "left_semi"), seqs.join(flagged, case, "left_semi"), case, seq, extended)
    return replace_groups(peaks, again.select(*peaks.columns), case)


def ranked_periods(seqs: DataFrame, seq_id: str, seq: str, k: int = 6, max_gap: int = 600, cap: int = 300, **how) -> DataFrame:
    """(seq_id, rank, period, score, identity, iqr, copies, proposed): peaks of the periodogram with identities, as the founder cascade takes them.

    Periods up to ``cap`` are rescored, and longer ones only where the case needs it. The first peak is the founder proposed.
    """
    peaks = written(spectrum_peaks(periodogram(seqs, seq_id, seq, k, max_gap), seq_id, **how))
    scored = written(rescore(peaks, seqs, seq_id, seq, cap))
    first: Column = F.max(F.when(F.col("rank") == 1, F.col("period"))).over(Window.partitionBy(seq_id)).cast("double")
    return rescore_long(scored, seqs, seq_id, seq, cap, max_gap).withColumn("proposed", first)


def array_founders(seqs: DataFrame, seq_id: str, seq: str, search: similarity.Search | None = None, rounds: Sequence[tuple[int, int]] = ROUNDS, max_period: int = 3000, cap: int = 1000, **how) -> DataFrame:
    """From sequences to founders: arrays are found, cut out, grouped into families by similarity, scored and given to the founder cascade.

    (id, family, and what ``cascade.founders`` gives); id is sequence_start_end, a family the smallest id of a cluster. Arrays without
    a peak in their periodogram have no row.
    """
    arrays = written(tandem_rounds(seqs, seq_id, seq, rounds, **how))
    cases = written(subsequences(arrays, seqs.where(F.col(seq_id).isNotNull()), seq_id, seq, "s", "e").toDF("id", "seq"))
    families = similarity.similarity_clusters(cases, "id", "seq", search).withColumnRenamed("representative", "family")
    peaks = ranked_periods(cases, "id", "seq", max_gap=max_period, cap=cap).join(families, "id")
    return founders(peaks, "id", "family")
