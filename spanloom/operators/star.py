"""Alignment of unequal copies: each copy against the centre of its stack, with gaps merged by column.

The centre is one copy of a stack; every other is aligned to it end to end, with insertions and deletions. What a copy has between two letters of the centre
stands in columns of its own, as many as the widest insertion there, so all rows of a stack get one length and
``stack_consensus`` reads them. A copy that repeats is aligned once. Copies are aligned apart from each other: a stack's rows never meet in one task, only its centre and
the widths of its insertions go to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.consensus import stack_consensus
from spanloom.session import written

MATCH, MISMATCH, GAP = 2, -2, 3
FAR = np.iinfo(np.int32).min // 2
CELLS, SIDE = 1 << 25, 1024  # of alignments that are held at a time, a byte each; alignments side by side


def against(centre: str, copy: str, band: int = 24) -> tuple[str, list[str]]:
    """The copy's letter or '-' at each letter of the centre, and its letters before each of them and after the last.

    Global alignment within ``band`` diagonals of those that the two lengths span. Of equal paths, seen from the end, a letter over a letter
    goes before a gap in the copy, and that before an insertion.
    """
    n, m = len(centre), len(copy)
    low = min(0, m - n) - band
    wide = max(0, m - n) + band - low + 1
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (centre, copy))
    step = np.arange(wide)
    padded = np.zeros(n + wide + abs(low) + m + 1, np.uint32)  # the copy's letter before column j stands at j + (number of columns left of 0)
    shift = -low
    padded[shift + 1 : shift + 1 + m] = b
    table = np.full((n + 1, wide + 1), FAR, np.int32)
    columns = low + step
    table[0, :wide] = np.where((columns >= 0) & (columns <= m), -GAP * columns, FAR)
    for i in range(1, n + 1):
        columns = i + low + step
        inside = (columns >= 0) & (columns <= m)
        equal = padded[shift + i + low : shift + i + low + wide] == a[i - 1]
        best = np.maximum(np.where(columns > 0, table[i - 1, :wide] + np.where(equal, MATCH, MISMATCH), FAR), table[i - 1, 1:] - GAP)
        best = np.where(inside, best, FAR)
        table[i, :wide] = np.where(inside, np.maximum.accumulate(best + GAP * step) - GAP * step, FAR)
    row, inserted, i, o = ["-"] * n, [""] * (n + 1), n, m - n - low
    while i > 0 or i + low + o > 0:
        j = i + low + o
        now = table[i, o]
        if i > 0 and j > 0 and now == table[i - 1, o] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH):
            row[i - 1] = copy[j - 1]
            i -= 1
        elif i > 0 and now == table[i - 1, o + 1] - GAP:
            i, o = i - 1, o + 1
        else:
            inserted[i] = copy[j - 1] + inserted[i]
            o -= 1
    return "".join(row), inserted


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _side_by_side(pairs: list[tuple[str, str]], band: int) -> list[tuple[str, list[str]]]:
    """``against`` of pairs that stand along the last axis. Of each cell a byte says the way back: 1 a letter over a letter, 2 a gap in the copy, 0 an insertion.

    Columns before a copy's first letter stay out of reach, as every way to them begins there, and no way leads back from those behind its
    last one; so only the steps beyond a pair's own band are told apart.
    """
    count = len(pairs)
    n, m = (np.array([len(x[i]) for x in pairs]) for i in (0, 1))
    low, wides = np.minimum(0, m - n) - band, np.abs(m - n) + 2 * band + 1
    rows, wide = int(n.max()), int(wides.max())
    left, right = np.zeros((rows, count), np.uint32), np.zeros((rows + wide, count), np.uint32)
    for p, (a, b) in enumerate(pairs):
        left[: len(a), p] = _points(a)
        points = _points(b)[: rows + wide + low[p]]
        right[-low[p] : len(points) - low[p], p] = points  # the copy's letter before column j stands at j - 1 - low
    step = np.arange(wide, dtype=np.int32)[:, None]
    beyond = step >= wides
    slope = np.repeat(GAP * step, count, axis=1)
    table = np.full((wide + 1, count), FAR, np.int32)
    table[:wide] = np.where((low + step >= 0) & ~beyond, -GAP * (low + step), FAR)
    ways = np.zeros((rows, wide, count), np.uint8)
    now, up, most = (np.empty((wide, count), np.int32) for _ in range(3))
    steps = list(most)
    for i in range(rows):
        np.multiply(right[i : i + wide] == left[i], np.int32(MATCH - MISMATCH), out=now, dtype=np.int32, casting="unsafe")
        now += table[:wide]
        now += np.int32(MISMATCH)
        np.subtract(table[1:], np.int32(GAP), out=up)
        np.maximum(now, up, out=most)
        most += slope
        for last, one in zip(steps, steps[1:], strict=False):
            np.maximum(one, last, out=one)
        np.subtract(most, slope, out=most)
        np.copyto(ways[i], np.where(most == now, 1, np.where(most == up, 2, 0)), casting="unsafe")
        table[:wide] = most
        np.copyto(table[:wide], FAR, where=beyond)
    taken = np.full((rows, count), -1, np.int64)
    p, i, o = np.arange(count), n.copy(), m - n - low
    added = []
    while len(p):
        j = i + low[p] + o
        todo = (i > 0) | (j > 0)
        if not todo.all():
            p, i, o, j = p[todo], i[todo], o[todo], j[todo]
        way = np.where(i > 0, ways[np.maximum(i - 1, 0), o, p], 0)
        over = way == 1
        taken[i[over] - 1, p[over]] = j[over] - 1
        new = way == 0
        added.append(np.stack([p[new], i[new], j[new] - 1]))
        i, o = i - (way > 0), o + (way == 2) - new
    owner, at, letter = np.concatenate(added, axis=1)
    out = [(["-"] * k, [""] * (k + 1)) for k in n.tolist()]
    for k, (_, copy) in enumerate(pairs):
        row = out[k][0]
        for c, x in enumerate(taken[: n[k], k].tolist()):
            if x >= 0:
                row[c] = copy[x]
    for k, c, x in zip(owner[::-1].tolist(), at[::-1].tolist(), letter[::-1].tolist(), strict=True):  # the first ones last, as seen from the end
        out[k][1][c] += pairs[k][1][x]
    return [("".join(row), extra) for row, extra in out]


def all_against(pairs: list[tuple[str, str]], band: int = 24) -> list[tuple[str, list[str]]]:
    """``against`` of each (centre, copy); those of like length together, and a copy equal to its centre is that."""
    out: list = [(c, [""] * (len(c) + 1)) if c == t else None for c, t in pairs]
    wide = [abs(len(t) - len(c)) + 2 * band + 1 for c, t in pairs]
    todo = sorted((i for i, found in enumerate(out) if found is None), key=lambda i: (wide[i] // 64, len(pairs[i][0])))
    while todo:
        rows, across = len(pairs[todo[-1]][0]), wide[todo[-1]]
        part, most = [], max(1, CELLS // ((rows + 1) * (across + 64)))
        while todo and len(part) < min(SIDE, most) and wide[todo[-1]] // 64 == across // 64 and 2 * len(pairs[todo[-1]][0]) + 64 >= rows:
            part.append(todo.pop())
        found = _side_by_side([pairs[i] for i in part], band) if 10 * len(part) > across else [against(*pairs[i], band) for i in part]
        for i, one in zip(part, found, strict=True):
            out[i] = one
    return out


def centres(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, centre): the commonest copy; of equally common ones the one of the length nearest to the median, then the first by text."""
    middle = rows.groupBy(key).agg(F.percentile(F.length(seq), 0.5).alias("__m"))
    counts = rows.groupBy(key, F.col(seq).alias("__c")).agg(F.count("*").alias("__n")).join(middle, key)
    return counts.groupBy(key).agg(F.min_by("__c", F.struct(-F.col("__n"), F.abs(F.length("__c") - F.col("__m")), "__c")).alias("centre"))


def star_alignment(rows: DataFrame, key: str, seq: str, band: int = 24, centre: DataFrame | None = None) -> DataFrame:
    """(key, aligned): every row of a key in one length, with '-' for gaps. Null texts are left out; an empty one is all gaps.

    Letters are put in upper case; insertions are written from the left of their columns.
    """
    kind = rows.schema[key].dataType.simpleString()
    usable = written(rows.where(F.col(seq).isNotNull() & F.col(key).isNotNull()).select(key, F.upper(F.col(seq)).alias("copy")))
    held = written(centre if centre is not None else centres(usable, key, "copy"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = all_against(list(zip(batch["centre"], batch["copy"], strict=True)), band)
            yield pd.DataFrame({key: batch[key], "times": batch["times"], "row": [r for r, _ in found], "extra": [[{"at": i, "x": t} for i, t in enumerate(x) if t] for _, x in found]})

    distinct = usable.groupBy(key, "copy").agg(F.count("*").alias("times"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes make much work
    aligned = written(distinct.join(held, key).repartition(tasks, key, "copy").mapInPandas(run, f"{key} {kind}, times long, row string, extra array<struct<at:int,x:string>>"))
    widths = aligned.select(key, F.explode("extra").alias("e")).groupBy(key, F.col("e.at").alias("at")).agg(F.max(F.length("e.x")).alias("w"))
    columns = widths.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("widths"))
    wide = aligned.join(columns, key, "left").select(key, "times", "row", "extra", F.coalesce("widths", F.array().cast("array<struct<at:int,w:int>>")).alias("widths"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for row, extra, found in zip(batch["row"], batch["extra"], batch["widths"], strict=True):
                own, pieces, done = {x["at"]: x["x"] for x in extra}, [], 0
                for column in found:
                    at = column["at"]
                    pieces += [row[done:at], own.get(at, "").ljust(column["w"], "-")]
                    done = at
                texts.append("".join(pieces) + row[done:])
            yield pd.DataFrame({key: batch[key], "times": batch["times"], "aligned": texts})

    whole = wide.mapInPandas(spread, f"{key} {kind}, times long, aligned string")
    return whole.select(key, "aligned", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("time")).drop("time")


def star_consensus(rows: DataFrame, key: str, seq: str, max_gap: float = 0.5, least: float = 0.4, **how) -> DataFrame:
    """``stack_consensus`` of copies of any length, aligned first."""
    return stack_consensus(star_alignment(rows, key, seq, **how), key, "aligned", max_gap, least)


def copies_between(df: DataFrame, seq_id: str, seq: str, anchors: DataFrame, spread: float = 0.3) -> DataFrame:
    """(seq_id, copy): from one occurrence of the sequence's anchor ``kmer`` to the next, in lengths within ``spread`` of their median. The ends before the first and from the last on are no copies."""
    parts = F.split(F.col(seq), F.concat(F.lit(r"\Q"), F.col("kmer"), F.lit(r"\E")))
    whole = F.when(F.size(parts) > 2, F.slice(parts, 2, F.size(parts) - 2)).otherwise(F.array().cast("array<string>"))
    found = df.select(seq_id, seq).join(anchors.select(seq_id, "kmer"), seq_id).select(seq_id, F.explode(F.transform(whole, lambda p: F.concat(F.col("kmer"), p))).alias("copy"))
    middle = found.groupBy(seq_id).agg(F.percentile(F.length("copy"), 0.5).alias("__m"))
    return found.join(middle, seq_id).where(F.abs(F.length("copy") - F.col("__m")) <= spread * F.col("__m")).select(seq_id, "copy")
