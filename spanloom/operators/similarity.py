"""Similarity self-join of sequences: candidates from an inverted index of minimizers, verified by banded local alignment.

* A sequence's keys are its minimizers: of every ``window`` neighbouring k-mers the one with the least hash. Two sequences with a common
  run of ``k + window - 1`` letters share one. With both strands a k-mer stands for its reverse complement too.
* A pair counts if it shares at least ``share`` of the keys of the sequence with fewer. So of that sequence the most frequent keys,
  as many as it may lack less one, need not be looked up: keys are ordered rarest first and only a prefix probes the index. Motifs that very many
  sequences have come last there.
* The rows of one key are dealt out: probes to one of several groups by hash, index rows to all of them, about ``GROUP`` probes a group,
  so no task has all pairs of a key. Probes with the same most frequent key form a block; their pairs are dealt by the other ends to
  parts of the block, where pairs are made distinct.
* To a part go its sequences, once each, and not a pair's texts. There the common keys of all pairs are counted in full, by arrays of many pairs; they give the
  strand and the diagonal, and what lies within ``band`` of it is aligned: a local alignment with affine gaps gives identity,
  length and gaps. Pairs are aligned side by side, row by row; first without a way back, which only pairs get that may cover enough.

Equal sequences are one node; ``copies`` has the ids that a node stands for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.consensus import greedy_clusters
from spanloom.operators.graph import connected_components
from spanloom.session import cut, written

GROUP = 256  # probes of one key in a task
PART_PAIRS, PART_ROWS = 1 << 15, 1 << 12  # of one key in a part of a block, about
POOL, SLICE = 1 << 18, 1 << 20  # pairs that a task holds at a time, and keys that it looks up at a time
FEW, SIDE, LETTERS = 256, 2048, 1 << 22  # pairs scored side by side, and letters of theirs
CELLS = 1 << 26  # of alignments that are held at a time, a byte each
LONG, LONG_LETTERS = 4096, 1 << 22  # windows beyond this go to tasks of their own, of like size, and so many letters to a task
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 1, -1, 2, 1  # a gap of n letters costs GAP_OPEN + n * GAP_EXTEND
CODES = np.full(256, 4, np.uint8)
CODES[[ord(c) for c in "ACGTacgt"]] = [0, 1, 2, 3] * 2
LETTERS_OF = np.frombuffer(b"ACGTN", np.uint8)
STRAIGHT, DOWN, LONGER, WENT_ON, SCORES, SAME = (1 << i for i in range(6))  # of a cell: the ways its score may come from, whether gaps in b and in a go on, a score above 0, equal letters


@dataclass(frozen=True)
class Search:
    """What a search is asked for; the defaults suit repeat consensus sequences of about 75 % identity."""

    k: int = 11
    window: int = 6
    share: float = 0.03
    band: int = 64
    min_identity: float = 75.0
    min_coverage: float = 0.8  # of the shorter sequence, strictly above
    both_strands: bool = True

    def needed(self, keys: int) -> int:
        """Keys that a pair shares at least, by the lesser number of keys."""
        return max(1, math.ceil(self.share * keys - 1e-9))


# ---------------------------------------------------------------- keys


def encoded(text: str | None) -> np.ndarray:
    """A, C, G, T as 0 to 3, in either case, and 4 for all else."""
    return CODES[np.frombuffer((text or "").encode("ascii", "replace"), np.uint8)]


def reversed_complement(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < 4, 3 - codes, 4)[::-1].astype(np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minimizers(codes: np.ndarray, k: int, window: int, both_strands: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, position, forward) of the distinct minimizers by key; a key that repeats counts where it is first. k-mers with other letters are none."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    ahead, back, broken = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    for j in range(k):
        part = codes[j : j + n]
        broken |= part > 3
        ahead = ahead << np.uint64(2) | (part & 3).astype(np.uint64)
        back |= (3 - (part & 3)).astype(np.uint64) << np.uint64(2 * j)
    forward = (ahead <= back) | (not both_strands)
    hashes = _mixed(np.where(forward, ahead, back) + np.uint64(k))
    hashes[broken] = np.iinfo(np.uint64).max
    wide = min(window, n)
    least = np.lib.stride_tricks.sliding_window_view(hashes, wide).argmin(axis=1) + np.arange(n - wide + 1)
    at = np.unique(least)
    at = at[~broken[at]]
    keys, first = np.unique(hashes[at].view(np.int64), return_index=True)
    return keys, at[first], forward[at[first]]


@dataclass(frozen=True)
class Keys:
    """Keys of a sequence in their order, with places and directions; ``size`` is how many it has in all, ``length`` its letters."""

    keys: np.ndarray
    at: np.ndarray
    ahead: np.ndarray
    size: int
    length: int


# ---------------------------------------------------------------- alignment


def banded_alignments(pairs: list[tuple[np.ndarray, np.ndarray, int]], band: int) -> np.ndarray:
    """``traced`` of each (a, b, diagonal), within ``band`` of the diagonal (a's position less b's)."""
    count, wide = len(pairs), 2 * band + 1
    rows = max((len(a) for a, _, _ in pairs), default=0)
    left, right = np.full((rows, count), 5, np.uint8), np.full((rows + wide, count), 6, np.uint8)
    for p, (a, b, diagonal) in enumerate(pairs):
        left[: len(a), p] = np.where(a < 4, a, 5)
        start = diagonal + band  # where b's first letter stands in the row of a's first one
        low, high = max(0, -start), min(len(b), rows + wide - start)
        if low < high:
            right[start + low : start + high, p] = np.where(b[low:high] < 4, b[low:high], 6)
    return traced(left, right, np.array([d + band for _, _, d in pairs], np.int64), band)


def reach(left: np.ndarray, right: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, a row that no best alignment starts before, and last row of what ``traced`` finds, without a way back.

    A cell is a number whose high bits are the score and whose low bits are greater the earlier its alignment starts, so one maximum
    keeps both. Of equal scores the earliest start counts. In short rows the low bits are rounded, to the earlier start.
    """
    rows, count = left.shape
    wide = 2 * band + 1
    kind, shift = (np.int16, 6) if rows + wide + 8 < 1 << 9 else (np.int32, 16) if rows + wide + 8 < 1 << 15 else (np.int64, 32)
    one, low = kind(1 << shift), kind((1 << shift) - 1)
    unit = -(-rows // int(low)) or 1
    a, b = left.astype(kind) << kind(shift + 1), right.astype(kind) << kind(shift + 1)  # letters that differ, differ by a match less a mismatch at least
    differ = np.full(count, kind(MATCH - MISMATCH) * one, kind)
    far = kind(np.iinfo(kind).min // 2)
    slope = np.arange(wide, dtype=kind)[:, None] * (kind(GAP_EXTEND) * one)
    opened = slope[1:] + kind(GAP_OPEN) * one
    score, gap, after = np.full((wide + 1, count), -(-rows // unit), kind), *(np.full((wide + 1, count), far, kind) for _ in range(2))
    score[wide] = far
    now, rest = np.empty((wide, count), kind), np.empty((wide, count), kind)
    steps = list(rest)
    best, best_row = np.full(count, low, kind), np.zeros(count, np.int64)
    for i in range(rows):
        np.bitwise_xor(b[i : i + wide], a[i], out=rest)
        np.minimum(rest, differ, out=rest)
        np.subtract(score[:wide], rest, out=now)
        now += kind(MATCH) * one
        held = after[:wide]
        np.subtract(score[1:], kind(GAP_OPEN) * one, out=rest)
        np.maximum(rest, gap[1:], out=held)
        held -= kind(GAP_EXTEND) * one
        np.maximum(now, held, out=now)
        gap, after = after, gap
        np.maximum(now, np.full(count, -(-(rows - i - 1) // unit), kind), out=now)  # an alignment that starts in the next row
        np.add(now, slope, out=rest)
        for last, step in zip(steps, steps[1:], strict=False):
            np.maximum(step, last, out=step)
        rest[:-1] -= opened
        score[0] = now[0]
        np.maximum(now[1:], rest[:-1], out=score[1:wide])
        top = now.max(axis=0)
        better = top > (best | low)
        best = np.where(better, top, best)
        best_row[better] = i
    return (best >> kind(shift)).astype(np.int64), np.maximum(0, rows - unit * (best & low).astype(np.int64)), best_row


def traced(left: np.ndarray, right: np.ndarray, begins: np.ndarray, band: int) -> np.ndarray:
    """Best local alignment of each pair: a's letters down ``left``, b's down ``right``, where b's first one stands at ``begins``.

    A row each: score, matches, columns, gaps, and first and last positions (0-based, inclusive) in a and in b. Of equal scores the end
    that is first in a, then in b; a match before a gap in b before a gap in a. Without a match all is 0.

    Letters beyond the ends equal none, and scores only fall there, so no cell has to be told apart. Pairs stand along the last axis; of
    scores two rows are held, and of all cells a byte that says the way back.
    """
    rows, count = left.shape
    wide = 2 * band + 1
    kind = np.int16 if rows + wide < 1 << 13 else np.int32
    never = np.iinfo(kind).min // 2
    slope = np.repeat(GAP_EXTEND * np.arange(wide, dtype=kind)[:, None], count, axis=1)
    opened = slope[1:] + kind(GAP_OPEN)
    places = np.arange(wide, 0, -1, dtype=np.uint8 if wide < 256 else np.int32)[:, None]  # the first step has the greatest
    score, gap, after = np.zeros((wide + 1, count), kind), *(np.full((wide + 1, count), never, kind) for _ in range(2))
    score[wide] = never
    now, most = np.empty((wide, count), kind), np.empty((wide, count), kind)
    equal, flag, ways = np.empty((wide, count), bool), np.empty((wide, count), bool), np.empty((rows, wide, count), np.uint8)
    steps = list(most)
    best, best_row, nothing = np.zeros(count, kind), np.zeros(count, np.int64), np.zeros(count, kind)
    best_place = np.full(count, wide, np.int64)
    for i in range(rows):
        way = ways[i]
        np.equal(right[i : i + wide], left[i], out=equal)
        np.multiply(equal, kind(MATCH - MISMATCH), out=now, dtype=kind, casting="unsafe")
        now += score[:wide]
        now += kind(MISMATCH)
        held = after[:wide]
        np.subtract(score[1:], kind(GAP_OPEN), out=most)
        np.greater_equal(gap[1:], most, out=flag)  # a gap in b goes on
        np.multiply(flag.view(np.uint8), np.uint8(LONGER), out=way)
        np.maximum(most, gap[1:], out=held)
        held -= kind(GAP_EXTEND)
        across = score[:wide]  # the row before is read, and now takes the way straight ahead
        across[:] = now
        np.maximum(now, held, out=now)
        np.maximum(now, nothing, out=now)
        np.add(now, slope, out=most)  # the greatest score up to a step, with the step added: where a gap in a is opened
        for last, step in zip(steps, steps[1:], strict=False):
            np.maximum(step, last, out=step)
        np.equal(most[1:], most[:-1], out=flag[:-1])
        way[2:] |= np.multiply(flag[: wide - 2].view(np.uint8), np.uint8(WENT_ON)) if wide > 2 else 0
        np.subtract(most[:-1], opened, out=most[:-1])
        np.maximum(now[1:], most[:-1], out=now[1:])
        np.equal(now, across, out=flag)
        way |= np.multiply(flag.view(np.uint8), np.uint8(STRAIGHT))
        np.equal(now, held, out=flag)
        way |= np.multiply(flag.view(np.uint8), np.uint8(DOWN))
        gap, after = after, gap
        np.greater(now, nothing, out=flag)
        way |= np.multiply(flag.view(np.uint8), np.uint8(SCORES))
        way |= np.multiply(equal.view(np.uint8), np.uint8(SAME))
        score[:wide] = now
        top = now.max(axis=0)
        better = top > best
        if better.any():
            np.equal(now, top, out=flag)
            first = np.multiply(flag, places).max(axis=0)
            np.copyto(best, top, where=better)
            best_row[better], best_place[better] = i, first[better]
    out = np.zeros((count, 8), np.int64)
    if not rows:
        return out
    out[:, 0] = best
    best_step = wide - best_place
    out[:, 5], out[:, 7] = best_row, best_row + best_step - begins
    p = np.flatnonzero(best > 0)
    row, step, mode = best_row[p], best_step[p], np.zeros(len(p), np.int64)
    while len(p):
        way = np.where(row < 0, 0, ways[row, step, p])
        straight, fresh = (way & STRAIGHT) > 0, mode == 0
        stay = ~fresh | ((way & SCORES) > 0)
        move = np.where(fresh, np.where(straight, 0, np.where(way & DOWN, 1, 2)), mode)
        diagonal = stay & fresh & straight
        q, r, s = p[diagonal], row[diagonal], step[diagonal]
        out[q, 2] += 1
        out[q, 1] += (way[diagonal] & SAME) > 0
        out[q, 4], out[q, 6] = r, r + s - begins[q]
        gapped = stay & (move > 0)
        mode = np.where(gapped, move, 0)
        row = row - diagonal
        if gapped.any():
            at = np.flatnonzero(gapped)
            q, m = p[at], mode[at]
            out[q, 2] += 1
            ended = np.where(m == 1, (way[at] & LONGER) == 0, (way[at] & WENT_ON) == 0)
            out[q, 3] += ended
            mode[at[ended]] = 0
            row[at] -= m == 1
            step[at] += np.where(m == 1, 1, -1)
        if not stay.all():
            p, row, step, mode = p[stay], row[stay], step[stay], mode[stay]
    return out


def _diagonal(found: np.ndarray, band: int) -> int:
    """The middle of the stretch of 2 * band + 1 diagonals that holds most of them, the first of equals."""
    found = np.sort(found)
    upto = np.searchsorted(found, found + 2 * band, side="right")
    i = int((upto - np.arange(len(found))).argmax())
    return int((found[i] + found[upto[i] - 1]) // 2)


COLUMNS = "score int, pident double, length int, gapopen int, qstart int, qend int, sstart int, send int, qlen int, slen int, qcov double, tcov double, strand string"


KINDS = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
WINDOW = "left string, right string, forward boolean, line int, at_a int, at_b int, la int, lb int"


def placed_pair(a: Keys, b: Keys, search: Search) -> tuple[bool, int, int, int, int, int] | None:
    """(forward, diagonal, a's window as place and size, b's window) of a pair that shares keys enough; None for others and for those that can't be hits.

    Cells within the band of the diagonal lie in these windows, so their alignment is that of the whole texts; places in b are those of its
    reverse complement where the pair isn't forward, and the diagonal is that of the windows. An alignment has no more matches than the
    shorter window has letters.
    """
    common = np.minimum(np.searchsorted(b.keys, a.keys), max(0, len(b.keys) - 1))
    ia = np.flatnonzero(b.keys[common] == a.keys) if len(b.keys) else np.zeros(0, np.int64)
    ib = common[ia]
    if not len(ia) or len(ia) < search.needed(min(a.size, b.size)):
        return None
    same = a.ahead[ia] == b.ahead[ib]
    forward = 2 * int(same.sum()) >= len(same)
    found = a.at[ia][same] - b.at[ib][same] if forward else a.at[ia][~same] - (b.length - search.k - b.at[ib][~same])
    line = _diagonal(found.astype(np.int64), search.band)
    low_a, low_b = max(0, line - search.band), max(0, -line - search.band)
    wide_a, wide_b = min(a.length, b.length + line + search.band) - low_a, min(b.length, a.length - line + search.band) - low_b
    if 100 * min(wide_a, wide_b) <= search.min_identity * search.min_coverage * min(a.length, b.length) * (1 - 1e-9):
        return None
    return forward, line - low_a + low_b, low_a, wide_a, low_b, wide_b


def _laid(letters: np.ndarray, begin: np.ndarray, size: np.ndarray, back: np.ndarray, first: np.ndarray, rows: int, none: int) -> np.ndarray:
    """(rows, windows): the letters of each window down from row ``first``, reversed and complemented where ``back``; ``none`` elsewhere and for other letters."""
    out = np.full((rows, len(size)), none, np.uint8)
    for low in range(0, rows, 256):
        at = np.arange(low, min(rows, low + 256))[:, None] - first
        inside = (at >= 0) & (at < size)
        np.copyto(at, size - 1 - at, where=back)
        at += begin
        found = np.take(letters, at, mode="clip")
        found = np.where(back & (found < 4), 3 - found, found)
        np.copyto(out[low : low + 256], found, where=inside & (found < 4), casting="unsafe")
    return out


@dataclass(frozen=True)
class Windows:
    """Pairs of windows, a value each: first letters and sizes of a's and b's, whether they are of one strand, the diagonal, the places of the windows in a and in b (as it is read), and the lengths of a and b."""

    begin_a: np.ndarray
    n_a: np.ndarray
    begin_b: np.ndarray
    n_b: np.ndarray
    forward: np.ndarray
    line: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    la: np.ndarray
    lb: np.ndarray

    def some(self, rows: np.ndarray) -> Windows:
        return Windows(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))


def _batches(sizes: np.ndarray, most: int, cells: int) -> Iterator[np.ndarray]:
    """Rows by size, greatest first: ``most`` at a time at most, and ``cells`` of the greatest one's size; beyond ``FEW`` only such as are nearly as great."""
    todo, at = np.argsort(-sizes, kind="stable"), 0
    down = -sizes[todo]
    while at < len(todo):
        like = int(np.searchsorted(down, 0.8 * down[at], side="right")) - at
        some = max(1, min(most, cells // max(1, -int(down[at])), max(FEW, like)))
        yield todo[at : at + some]
        at += some


def aligned(letters: np.ndarray, windows: Windows, search: Search) -> tuple[np.ndarray, list[np.ndarray]]:
    """The pairs that are hits, and what ``COLUMNS`` names of them. ``letters`` has the codes of all texts, which the windows' first letters point into."""
    band, wide = search.band, 2 * search.band + 1
    shorter = search.min_coverage * np.minimum(windows.la, windows.lb)

    def laid(w: Windows) -> tuple[np.ndarray, np.ndarray]:
        rows, ahead = int(w.n_a.max()), np.zeros(len(w.n_a), bool)
        return _laid(letters, w.begin_a, w.n_a, ahead, np.zeros(len(w.n_a), np.int64), rows, 5), _laid(letters, w.begin_b, w.n_b, ~w.forward, w.line + band, rows + wide, 6)

    able = []
    for part in _batches(windows.n_a, SIDE, LETTERS):
        score, first, last = reach(*laid(windows.some(part)), band)
        # columns are at most twice the matches less the score, and matches at most the letters of a
        able.append(part[2 * (last - first + 1) - score > shorter[part] - 1e-6])
    rest = np.concatenate(able) if able else np.zeros(0, np.int64)
    rows, found = [np.zeros(0, np.int64)], [np.zeros((0, 8), np.int64)]
    for part in _batches(windows.n_a[rest], SIDE, CELLS // wide):
        part = rest[part]
        w = windows.some(part)
        out = traced(*laid(w), w.line + band, band)
        hit = (out[:, 2] > 0) & (100 * out[:, 1] >= search.min_identity * out[:, 2]) & (out[:, 2] > shorter[part])
        rows.append(part[hit])
        found.append(out[hit])
    row = np.concatenate(rows)
    score, matches, columns, gaps, a0, a1, b0, b1 = np.concatenate(found).T
    w = windows.some(row)
    a0, a1, b0, b1 = a0 + w.at_a, a1 + w.at_a, b0 + w.at_b, b1 + w.at_b
    b0, b1 = np.where(w.forward, b0, w.lb - 1 - b1), np.where(w.forward, b1, w.lb - 1 - b0)
    return row, [score, 100 * matches / columns, columns, gaps, a0 + 1, a1 + 1, b0 + 1, b1 + 1, w.la, w.lb, (a1 - a0 + 1) / w.la, (b1 - b0 + 1) / w.lb, np.where(w.forward, "+", "-")]


def align_windows(pairs: list[tuple], search: Search) -> list[tuple | None]:
    """What ``COLUMNS`` names for each (window of a, window of b, forward, diagonal, place of a's, of b's, length of a, of b), or None where it is no hit."""
    out: list[tuple | None] = [None] * len(pairs)
    if not pairs:
        return out
    left, right, forward, *rest = zip(*pairs, strict=True)
    sizes = np.array([len(t) for t in (*left, *right)], np.int64)
    begins = np.cumsum(sizes) - sizes
    n = len(pairs)
    windows = Windows(begins[:n], sizes[:n], begins[n:], sizes[n:], np.array(forward, bool), *(np.array(c, np.int64) for c in rest))
    rows, columns = aligned(np.concatenate([encoded(t) for t in (*left, *right)]), windows, search)
    for i, *hit in zip(rows.tolist(), *(c.tolist() for c in columns), strict=True):
        out[i] = tuple(hit)
    return out


def align_pairs(pairs: list[tuple[str | None, str | None]], search: Search) -> list[tuple | None]:
    """What ``COLUMNS`` names for each pair of texts, or None where it is no hit: too few keys shared, or too short or unlike an alignment.

    Coordinates are 1-based, inclusive and on the forward strand of both.
    """
    out: list[tuple | None] = [None] * len(pairs)
    at, todo = [], []
    for i, (left, right) in enumerate((a or "", b or "") for a, b in pairs):
        sides = [minimizers(encoded(t), search.k, search.window, search.both_strands) for t in (left, right)]
        found = placed_pair(*(Keys(*k, len(k[0]), len(t)) for k, t in zip(sides, (left, right), strict=True)), search)
        if found:
            forward, line, low_a, wide_a, low_b, wide_b = found
            b = low_b if forward else len(right) - low_b - wide_b
            at.append(i)
            todo.append((left[low_a : low_a + wide_a], right[b : b + wide_b], forward, line, low_a, low_b, len(left), len(right)))
    for i, hit in zip(at, align_windows(todo, search), strict=True):
        out[i] = hit
    return out


# ---------------------------------------------------------------- on Spark


def copies(seqs: DataFrame, seq_id: str, seq: str) -> DataFrame:
    """(node, id): each id with the smallest id of an equal sequence, case apart; null sequences and ids are left out."""
    rows = seqs.where(F.col(seq_id).isNotNull() & F.col(seq).isNotNull()).select(F.col(seq_id).alias("id"), F.md5(F.upper(F.col(seq)).cast("binary")).alias("h"))
    return rows.join(rows.groupBy("h").agg(F.min("id").alias("node")), "h").select("node", "id")


def shared_keys(nodes: DataFrame, search: Search) -> DataFrame:
    """(node, size, key, at, ahead, n): the keys that n > 1 nodes have, with their nodes' number of keys. ``nodes`` has (node, seq)."""
    kind = nodes.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                found = [minimizers(encoded(t), search.k, search.window, search.both_strands) for t in part["seq"]]
                sizes = [len(x[0]) for x in found]
                key, place, ahead = (np.concatenate([x[c] for x in found]) for c in range(3))
                yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), sizes), "size": np.repeat(np.array(sizes, np.int32), sizes), "key": key, "at": place, "ahead": ahead})

    postings = written(nodes.select("node", "seq").mapInPandas(run, f"node {kind}, size int, key long, at int, ahead boolean"))
    often = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return postings.join(often, "key").select("node", "size", "key", "at", "ahead", "n")


def candidate_pairs(shared: DataFrame, search: Search) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes that a probe finds, among them all that share as many keys as ``search`` asks for: (block, part, node, others) once a pair, and (block, parts, node) of the probes that ``others`` names.

    ``shared`` is of ``shared_keys``. Probes with one most frequent key are in blocks of about ``GROUP``; a block's parts are dealt by the nodes met.
    """
    # keys of a single sequence are rarest of all, so the others' ranks from the end are what counts
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("n").desc(), F.col("key").desc()))
    needed = F.greatest(F.lit(1), F.ceil(F.col("size") * search.share - 1e-9))
    rows = written(shared.select("node", "size", "key", "n", (rank >= needed).alias("probes"), F.ceil(F.col("n") / GROUP).cast("int").alias("groups")))
    often = rows.where("probes").groupBy("node").agg(F.max(F.struct("n", "key")).alias("top")).select("node", "top.n", F.col("top.key").alias("label"))
    ends = often.join(often.groupBy("label").agg(F.count("*").alias("ends")), "label")
    parts = F.greatest(F.ceil(F.least("ends", F.lit(GROUP)) * F.col("n") / PART_PAIRS), F.ceil(F.col("n") / PART_ROWS)).cast("int")
    blocks = written(ends.select(F.xxhash64("label", F.pmod(F.xxhash64("node"), F.ceil(F.col("ends") / GROUP))).alias("block"), parts.alias("parts"), "node"))
    order = F.struct("size", "node")
    probe = rows.where("probes").join(blocks, "node").select("key", F.pmod(F.xxhash64("node"), "groups").cast("int").alias("g"), "block", "parts", F.col("node").alias("p"), order.alias("po"))
    index = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.col("node").alias("i"), order.alias("io"))
    met = probe.join(index, ["key", "g"]).where("po < io").select("block", F.pmod(F.xxhash64("i"), "parts").cast("int").alias("part"), F.col("i").alias("node"), "p")
    return written(met.repartition("block", "part").groupBy("block", "part", "node").agg(F.collect_set("p").alias("others"))), blocks


def _whole_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of whole runs of rows with equal ``block`` and ``part``, of about ``most`` rows at least but the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        table = pa.Table.from_batches(held)
        block, part = (table.column(c).to_numpy() for c in ("block", "part"))
        starts = np.flatnonzero((block[1:] != block[:-1]) | (part[1:] != part[:-1])) + 1
        if len(starts):
            yield table.slice(0, starts[-1])
            held = table.slice(starts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _places(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, ends: np.ndarray, keys: np.ndarray, at: np.ndarray, ahead: np.ndarray, search: Search) -> tuple[np.ndarray, ...]:
    """``placed_pair`` of many pairs (x, y) of rows: which of them are placed, and what it gives for these. A row's keys lie between ``ends``, in their order and numbered."""
    many = np.diff(ends)
    few = np.where(many[x] <= many[y], x, y)
    other = x + y - few
    counts = many[few]
    pair = np.repeat(np.arange(len(x)), counts)
    mine = np.arange(len(pair)) + np.repeat(ends[few] - np.cumsum(counts) + counts, counts)
    span = int(keys.max()) + 1 if len(keys) else 1
    every = np.repeat(np.arange(len(many)), many) * span + keys
    wanted = other[pair] * span + keys[mine]
    theirs = np.minimum(np.searchsorted(every, wanted), max(0, len(every) - 1))
    same = every[theirs] == wanted if len(every) else np.zeros(0, bool)
    pair, mine, theirs = pair[same], mine[same], theirs[same]
    swap = few[pair] != x[pair]
    ix, iy = np.where(swap, theirs, mine), np.where(swap, mine, theirs)
    shares = np.bincount(pair, minlength=len(x))
    enough = shares >= np.maximum(1, np.ceil(search.share * np.minimum(sizes[x], sizes[y]) - 1e-9))
    along = ahead[ix] == ahead[iy]
    forward = 2 * np.bincount(pair[along], minlength=len(x)) >= shares
    use = enough[pair] & (along == forward[pair])
    pair, ix, iy = pair[use], ix[use], iy[use]
    found = at[ix] - np.where(forward[pair], at[iy], lengths[y[pair]] - search.k - at[iy])
    # the stretch of diagonals that holds most of a pair's, the first of equals
    apart = 2 * (int(lengths.max()) + 2 * search.band + 1) if len(lengths) else 1
    line = np.sort(pair * apart + found)
    upto = np.searchsorted(line, line + 2 * search.band, side="right")
    within = upto - np.arange(len(line))
    row = (line + apart // 2) // apart
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    if not len(starts):
        return (starts,) * 7
    most = np.repeat(np.maximum.reduceat(within, starts), np.diff(np.r_[starts, len(row)]))
    first = np.minimum.reduceat(np.where(within == most, np.arange(len(row)), len(row)), starts)
    kept = row[starts]
    line = (line[first] + line[upto[first] - 1] - 2 * kept * apart) // 2
    x, y, forward = x[kept], y[kept], forward[kept]
    low_a, low_b = np.maximum(0, line - search.band), np.maximum(0, -line - search.band)
    wide_a, wide_b = np.minimum(lengths[x], lengths[y] + line + search.band) - low_a, np.minimum(lengths[y], lengths[x] - line + search.band) - low_b
    able = 100 * np.minimum(wide_a, wide_b) > search.min_identity * search.min_coverage * np.minimum(lengths[x], lengths[y]) * (1 - 1e-9)
    return tuple(v[able] for v in (kept, forward, line - low_a + low_b, low_a, wide_a, low_b, wide_b))


def _hits_of(table: pa.Table, search: Search) -> Iterator[pa.RecordBatch]:
    """(q, s, and what ``COLUMNS`` and ``WINDOW`` name) of the hits among a table's pairs, with no window, and of pairs of long windows, with nothing but these: rows (block, part, probe, node, id, length, size, seq, keys, at, ahead, others)."""
    table = table.combine_chunks()
    node, block, part, probe, lengths, sizes = (table.column(c).to_numpy(zero_copy_only=False) for c in ("node", "block", "part", "probe", "length", "size"))
    lengths, sizes = lengths.astype(np.int64), sizes.astype(np.int64)

    def flat(column: str) -> tuple[np.ndarray, np.ndarray]:
        lists = table.column(column).combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]

    # a probe's row in the part of each pair
    group = np.cumsum(np.r_[False, (block[1:] != block[:-1]) | (part[1:] != part[:-1])])
    names, number = np.unique(node, return_inverse=True)
    probes = np.flatnonzero(probe)
    place = group[probes] * len(names) + number[probes]
    order = np.argsort(place)
    named, ends = flat("others")
    many = np.diff(ends)
    keys, ends = flat("keys")
    keys = np.unique(keys, return_inverse=True)[1]
    at, ahead = flat("at")[0].astype(np.int64), flat("ahead")[0].astype(bool)
    codes = [encoded(t) for t in table.column("seq").to_pylist()]
    begins = np.cumsum([0, *(len(c) for c in codes)])
    letters = np.concatenate(codes)
    ids = table.column("id")
    columns = [c.split() for c in COLUMNS.split(", ")]
    met = np.repeat(np.arange(len(node)), many)
    for low in range(0, len(met), POOL):
        one, other = met[low : low + POOL], named[low : low + POOL]
        found = probes[order[np.searchsorted(place[order], group[one] * len(names) + np.searchsorted(names, other))]]
        x, y = np.where(node[one] < node[found], one, found), np.where(node[one] < node[found], found, one)
        cost = np.cumsum(np.minimum(np.diff(ends)[x], np.diff(ends)[y]) + 1)
        placed = []
        for rows in np.split(np.arange(len(x)), np.searchsorted(cost, np.arange(SLICE, int(cost[-1]), SLICE))):
            kept, *rest = _places(x[rows], y[rows], sizes, lengths, ends, keys, at, ahead, search)
            placed.append((rows[kept], *rest))
        kept, forward, line, low_a, wide_a, low_b, wide_b = (np.concatenate(c) for c in zip(*placed, strict=True))
        x, y, forward = x[kept], y[kept], forward.astype(bool)
        start = np.where(forward, low_b, lengths[y] - low_b - wide_b)
        pairs = Windows(begins[x] + low_a, wide_a, begins[y] + start, wide_b, forward, line, low_a, low_b, lengths[x], lengths[y])
        short, long = np.flatnonzero(wide_a <= LONG), np.flatnonzero(wide_a > LONG)
        rows, values = aligned(letters, pairs.some(short), search)
        rows = short[rows]
        w = pairs.some(long)
        texts = [[LETTERS_OF[letters[i : i + n]].tobytes().decode() for i, n in zip(*side, strict=True)] for side in ((w.begin_a, w.n_a), (w.begin_b, w.n_b))]
        both = np.r_[rows, long]
        made = [pa.array([*v.tolist(), *[None] * len(long)], KINDS[kind]) for v, (_, kind) in zip(values, columns, strict=True)]
        made += [pa.array([*[None] * len(rows), *v], t) for v, t in zip((*texts, w.forward.tolist(), *(c.tolist() for c in (w.line, w.at_a, w.at_b, w.la, w.lb))), (pa.string(), pa.string(), pa.bool_(), *[pa.int32()] * 5), strict=True)]
        yield from pa.table([ids.take(pa.array(x[both])), ids.take(pa.array(y[both])), *made], names=["q", "s", *(c for c, _ in columns), *(c.split()[0] for c in WINDOW.split(", "))]).to_batches()


def similarity_hits(seqs: DataFrame, seq_id: str, seq: str, search: Search | None = None) -> DataFrame:
    """(q, s, and what ``COLUMNS`` names) for each pair of distinct sequences that is a hit, q being the smaller id.

    A sequence stands under the smallest id of its copies; each further copy is a hit of that id alone, from end to end. Sequences
    without a k-mer of A, C, G and T have no hits but copies; null sequences, null ids and empty tables give none. Of rows with one id
    and several texts each text counts. Other columns aren't read.
    """
    search = search or Search()
    named = written(seqs.where(F.col(seq_id).isNotNull() & F.col(seq).isNotNull()).select(F.col(seq_id).alias("id"), F.upper(F.col(seq)).alias("seq")).withColumns({"h": F.md5(F.col("seq").cast("binary")), "n": F.length("seq")}))
    distinct = named.groupBy("h").agg(F.min("id").alias("id"), F.first("seq").alias("seq"))
    nodes = written(distinct.orderBy("id", "h").select(F.monotonically_increasing_id().alias("node"), "id", "seq"))  # a pair's smaller node is its smaller id
    shared = written(shared_keys(nodes, search))
    pairs, blocks = candidate_pairs(shared, search)
    listed = shared.groupBy("node").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("key", "at", "ahead"))).alias("k"))
    side = written(nodes.join(listed, "node").select("node", "id", F.length("seq").alias("length"), "size", "seq", F.col("k.key").alias("keys"), F.col("k.at").alias("at"), F.col("k.ahead").alias("ahead")))
    probes = blocks.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", F.lit(None).cast("array<long>").alias("others"), F.lit(True).alias("probe"))
    used = probes.join(pairs.select("block", "part").distinct(), ["block", "part"], "left_semi")
    rows = used.unionByName(pairs.withColumn("probe", F.lit(False))).join(side, "node")
    # tasks by pairs and not by bytes, which are few for the work they make
    tasks = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (pairs.agg(F.sum(F.size("others"))).first()[0] or 0) // POOL)
    placed = rows.repartition(tasks, "block", "part").sortWithinPartitions("block", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, 10_000):
            yield from _hits_of(table, search)

    kind = seqs.schema[seq_id].dataType.simpleString()
    found = written(placed.mapInArrow(run, f"q {kind}, s {kind}, {COLUMNS}, {WINDOW}"))
    names, window = ([c.split()[0] for c in x.split(", ")] for x in (COLUMNS, WINDOW))
    long = found.where("left is not null").select("q", "s", *window)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                letters += pc.sum(pc.utf8_length(batch.column("left"))).as_py() or 0
            if held and (batch is None or letters > LONG_LETTERS):
                table = pa.Table.from_batches(held)
                hits = align_windows(list(zip(*(table.column(c).to_pylist() for c in window), strict=True)), search)
                rows = [i for i, hit in enumerate(hits) if hit]
                values = zip(*(hits[i] for i in rows), strict=True) if rows else [()] * len(names)
                made = [pa.array(v, KINDS[c.split()[1]]) for v, c in zip(values, COLUMNS.split(", "), strict=True)]
                yield from pa.table([*(table.column(c).take(pa.array(rows, pa.int64())) for c in ("q", "s")), *made], names=["q", "s", *names]).to_batches()
                held, letters = [], 0

    tasks = max(1, (long.agg(F.sum(F.length("left"))).first()[0] or 0) // LONG_LETTERS)
    apart = long.repartitionByRange(tasks, F.length("left")).mapInArrow(align, f"q {kind}, s {kind}, {COLUMNS}")
    hits = found.where("left is null").select("q", "s", *names).unionByName(apart)
    n = F.col("n")
    whole = {"score": n * MATCH, "pident": F.lit(100.0), "length": n, "gapopen": F.lit(0), "qstart": F.lit(1), "qend": n, "sstart": F.lit(1), "send": n, "qlen": n, "slen": n, "qcov": F.lit(1.0), "tcov": F.lit(1.0), "strand": F.lit("+")}
    marked = named.select("id", "h", "n").distinct().where("n > 0")
    equal = marked.join(marked.groupBy("h").agg(F.min("id").alias("first")), "h").where("id > first")
    return hits.unionByName(equal.select(F.col("first").alias("q"), F.col("id").alias("s"), *(v.alias(c) for c, v in whole.items())))


def similarity_clusters(seqs: DataFrame, seq_id: str, seq: str, search: Search | None = None) -> DataFrame:
    """(id, representative): components of the hits, named by their smallest id; a sequence without hits is its own."""
    hits = similarity_hits(seqs, seq_id, seq, search)
    ids = seqs.where(F.col(seq_id).isNotNull()).select(F.col(seq_id).alias("id")).distinct()
    found = connected_components(cut(hits.select("q", "s")), "q", "s").toDF("id", "representative")
    return ids.join(found, "id", "left").select("id", F.coalesce("representative", "id").alias("representative"))


def similarity_greedy(seqs: DataFrame, seq_id: str, seq: str, search: Search | None = None) -> DataFrame:
    """(node, representative): sequences by length, longest first; each free one takes its hits' other ends that are free (``greedy_clusters``)."""
    search = search or Search()
    hits = written(similarity_hits(seqs, seq_id, seq, search).select("q", "s"))
    # a copy's hits are those of the id it stands under
    of = copies(seqs, seq_id, seq)
    nodes = seqs.select(F.col(seq_id).alias("node"), F.coalesce(F.length(F.col(seq)), F.lit(0)).alias("n"))
    alone = nodes.join(of.where("id <> node").select(F.col("id").alias("node")).distinct(), "node", "left_anti")
    chosen = greedy_clusters(alone, hits.select(F.col("q").alias("src"), F.col("s").alias("dst")), -F.col("n"))
    rest = of.where("id <> node").join(chosen, "node").select(F.col("id").alias("node"), "representative")
    return chosen.unionByName(rest)
