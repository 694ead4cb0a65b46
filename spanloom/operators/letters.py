"""Letters of many sequences side by side: what a sequence says about itself is worked out in Arrow batches, not as a row a letter.

The rows of an id come to one task in order (its texts cross the shuffle once), and are handed on as arrays of letters, about a
million at a time. So an id is never divided, and a task holds the letters of one chunk, or of one id where that has more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20  # letters that are worked on together


@dataclass(frozen=True)
class Letters:
    """Texts end to end: the code points, and of each one the number of its id and its 0-based place in its text."""

    ids: pa.Array
    points: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    left: np.ndarray  # letters from here to the end of the text, this one included

    def kmers(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(where, rank): the letters that start a k-mer, and numbers of these k-mers in the order of their code points."""
        where = np.flatnonzero(self.left >= k)
        used = np.flatnonzero(np.bincount(self.points)) if len(self.points) else np.zeros(0, np.int64)
        code = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
        code[used] = np.arange(len(used))
        each, rank, most = code[self.points], np.zeros(len(where), np.int64), 1
        for j in range(k):
            if most * len(used) >= 1 << 31:
                found, rank = np.unique(rank, return_inverse=True)
                most = len(found)
            rank = rank * len(used) + each[where + j]
            most *= len(used)
        if most * max(1, len(self.ids)) >= 1 << 62:
            rank = np.unique(rank, return_inverse=True)[1]
        return where, rank

    def texts(self, where: np.ndarray, rank: np.ndarray, k: int) -> pa.Array:
        """The k-mers that start at these letters; equal ranks are read once."""
        _, first, of = np.unique(rank, return_index=True, return_inverse=True)
        return pa.array(["".join(map(chr, self.points[i : i + k].tolist())) for i in where[first].tolist()], pa.string()).take(pa.array(of))


def tallied(*parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, n): the distinct combinations of parallel arrays of numbers from 0, in their order; where each is first, and how often it is."""
    key = parts[0].astype(np.int64)
    for part in parts[1:]:
        wide = int(part.max(initial=0)) + 1
        if int(key.max(initial=0)) >= (1 << 62) // wide:
            key = np.unique(key, return_inverse=True)[1]
        key = key * wide + part
    if len(key) and int(key.max()) < 4 * len(key):  # few combinations: counted, not sorted
        counts = np.bincount(key)
        found = np.flatnonzero(counts)
        first = np.zeros(len(counts), np.int64)
        first[key[::-1]] = np.arange(len(key) - 1, -1, -1)
        return first[found], counts[found]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def ordered(*keys: np.ndarray) -> np.ndarray:
    """The order by the first key, then the next; equal ones stay as they are. Small numbers are sorted digit by digit."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        small = len(key) and 0 <= int(key.min()) and int(key.max()) < 1 << 16
        order = order[np.argsort((key.astype(np.uint16) if small else key)[order], kind="stable")]
    return order


def side_by_side(ids: pa.Array, owner: np.ndarray, texts: list[str | None]) -> Letters:
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t or "") for t in texts], np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
    return Letters(ids, points, np.repeat(owner, sizes), place, np.repeat(sizes, sizes) - place)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Letters]:
    ids, owner, texts, size, kind = [], [], [], 0, pa.null()
    for batch in batches:
        kind = batch.column(0).type
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not ids or key != ids[-1]:
                if size >= CHUNK:
                    yield side_by_side(pa.array(ids, kind), np.array(owner), texts)
                    ids, owner, texts, size = [], [], [], 0
                ids.append(key)
            owner.append(len(ids) - 1)
            texts.append(text)
            size += len(text or "")
    if ids:
        yield side_by_side(pa.array(ids, kind), np.array(owner), texts)


def by_sequence(df: DataFrame, seq_id: str, seq: str, each: Callable[[Letters], tuple[np.ndarray, dict[str, object]]], columns: str) -> DataFrame:
    """(seq_id, columns): what ``each`` makes of the letters, as the rows' owners and their columns. Rows of one id count together; a null text has no letters."""
    kind = df.schema[seq_id].dataType.simpleString()
    rows = df.select(F.col(seq_id), F.col(seq)).repartition(seq_id).sortWithinPartitions(seq_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for letters in _chunks(batches):
            owner, made = each(letters)
            yield pa.RecordBatch.from_arrays([letters.ids.take(pa.array(owner)), *(pa.array(v) for v in made.values())], names=[seq_id, *made])

    return rows.mapInArrow(run, f"`{seq_id}` {kind}, {columns}")
