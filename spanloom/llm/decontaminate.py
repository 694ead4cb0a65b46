"""Benchmark decontamination by q-gram lemma filtering in diagonal bands, verified by banded alignment.

Texts are lower-cased and reduced to their words, one space apart. Each benchmark item is cut into passages of
``passage`` characters, one every ``step`` (a shorter item is one passage). A passage of m characters that lies in
a document with k edits or fewer keeps at least m - q + 1 - k q of its q-grams there, on diagonals at most k
apart. So shared q-grams are counted in bands of diagonals that overlap by half, wide enough that one of them holds
all diagonals of a match; bands that reach the bound are aligned within their diagonals and kept if the distance is
within the budget. Nothing is missed: the bound is necessary, and the alignment is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from spanloom.llm.columns import set_apart
from spanloom.llm.workers import released
from spanloom.session import cut

Q = 12
PASSAGE = 120
EDIT_RATE = 0.05
BLOCK_CHARS = 2_000_000
BROADCAST_ROWS = 500_000
WORDS = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> str:
    return " ".join(WORDS.findall((text or "").lower()))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at each position."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for i in range(q):
        found *= BASE
        found += codes[i : i + n]
    return found * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Passages:
    """A block of benchmark passages with their q-gram index; bounded by the characters that went in."""

    items: list
    starts: np.ndarray
    codes: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    q: int
    grams: np.ndarray  # sorted distinct hashes
    first: np.ndarray  # where each one's occurrences begin
    at: np.ndarray  # passage of each occurrence
    offset: np.ndarray  # its position in the passage
    seen: np.ndarray  # hash prefixes that occur
    short: dict[int, dict[str, list]]  # by number of words, the items of each text under a q-gram's length


def index_passages(items: list[tuple[object, str | None]], q: int = Q, passage: int = PASSAGE, edit_rate: float = EDIT_RATE, step: int | None = None) -> Passages:
    """Passages start every ``step`` characters, by default every half passage. Items without words have none."""
    ids, starts, codes = [], [], []
    short: dict[int, dict[str, list]] = {}
    for item, text in items:
        plain = normalise(text)
        whole = _codes(plain)
        if len(whole) < q:
            if plain:
                short.setdefault(plain.count(" ") + 1, {}).setdefault(plain, []).append(item)
            continue
        last = max(0, len(whole) - passage)
        for start in sorted({*range(0, last, step or passage // 2), last}):
            ids.append(item)
            starts.append(start)
            codes.append(whole[start : start + passage])
    sizes = np.array([len(c) for c in codes], np.int64)
    budget = np.minimum((sizes * edit_rate).astype(np.int64), (sizes - q) // q) if len(sizes) else sizes
    hashes = [_grams(c, q) for c in codes]
    joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    at = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])[order] if hashes else np.zeros(0, np.int64)
    offset = np.concatenate([np.arange(len(h)) for h in hashes])[order] if hashes else np.zeros(0, np.int64)
    grams, first = np.unique(joined[order], return_index=True)
    seen = np.zeros(1 << 22, bool)
    seen[(grams >> np.uint64(42)).astype(np.int64)] = True
    return Passages(ids, np.array(starts, np.int64), codes, budget, sizes - q + 1 - budget * q, q, grams, np.r_[first, len(joined)], at, offset, seen, short)


def banded_distance(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int] | None:
    """Least edits, and end in ``text``, of ``passage`` aligned anywhere in ``text`` on diagonals low to high; None if over budget."""
    width = high - low + 1
    far = len(passage) + width + 1
    step = np.arange(width)
    row = np.where((step + low >= 0) & (step + low <= len(text)), 0, far)  # row 0: cell on diagonal d is column d
    for i, c in enumerate(passage):
        columns = step + low + i  # of the text character that the diagonal move reads
        inside = (columns >= 0) & (columns < len(text))
        equal = np.zeros(width, bool)
        equal[inside] = text[columns[inside]] == c
        new = np.where(inside, row + ~equal, far)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where((columns + 1 >= 0) & (columns + 1 <= len(text)), new, far)
        row = np.minimum.accumulate(new - step) + step
        if row.min() > budget:
            return None
    best = int(row.argmin())
    return (int(row[best]), best + low + len(passage)) if row[best] <= budget else None


def find_passages(texts: list[str | None], index: Passages) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, passage_start, start, end, edits) of the first verified passage of each item in each text.

    start and end count characters of the normalised text.
    """
    if index.short:
        yield from _find_short(texts, index.short)
    if not len(index.grams):
        return
    at, size = 0, 0
    group: list[np.ndarray] = []
    for k, text in enumerate(texts):
        group.append(_codes(normalise(text)))
        size += len(group[-1])
        if size >= 500_000 or k == len(texts) - 1:
            yield from _find(at, group, index)
            at, size, group = k + 1, 0, []


def _find_short(texts: list[str | None], short: dict[int, dict[str, list]]) -> Iterator[tuple]:
    """The first place of each short item among the whole words of each text."""
    for row, text in enumerate(texts):
        words = normalise(text).split(" ")
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])
        done = set()
        for n, known in short.items():
            for i in range(len(words) - n + 1):
                found = " ".join(words[i : i + n])
                for item in known.get(found, ()):
                    if item not in done:
                        done.add(item)
                        yield row, item, 0, int(begins[i]), int(begins[i]) + len(found), 0


def _find(base: int, docs: list[np.ndarray], index: Passages) -> Iterator[tuple[int, int, int, int, int, int]]:
    gap = np.zeros(1, np.uint32)
    joined = np.concatenate([x for d in docs for x in (d, gap)])
    begins = np.cumsum([0, *(len(d) + 1 for d in docs)])
    hashes = _grams(joined, index.q)
    places = np.flatnonzero(index.seen[(hashes >> np.uint64(42)).astype(np.int64)])
    gram = np.searchsorted(index.grams, hashes[places])
    real = (gram < len(index.grams)) & (index.grams[np.minimum(gram, len(index.grams) - 1)] == hashes[places])
    places, gram = places[real], gram[real]
    if not len(places):
        return
    doc = np.searchsorted(begins, places, side="right") - 1
    # occurrences of each gram among the passages, a slice of the places at a time so that memory stays bounded
    counts = index.first[gram + 1] - index.first[gram]
    bands: dict[tuple[int, int, int], int] = {}
    keys = []
    for part in np.array_split(np.arange(len(places)), max(1, int(counts.sum()) // 2_000_000 + 1)):
        n = counts[part]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = np.repeat(index.first[gram[part]], n) + within
        passage, offset = index.at[hit], index.offset[hit]
        d = np.repeat(doc[part], n)
        diagonal = np.repeat(places[part] - begins[doc[part]], n) - offset
        step = index.budget[passage] + 1
        band = np.floor_divide(diagonal, step)
        # a band is two steps wide, and a q-gram of the passage counts once a band
        keys.append(np.unique(np.concatenate([np.stack([d, passage, b, offset], axis=1) for b in (band, band - 1)]), axis=0))
        if sum(map(len, keys)) > 2_000_000:  # what repeats in several slices is held once
            keys = [np.unique(np.concatenate(keys), axis=0)]
    found = np.unique(np.concatenate(keys), axis=0)
    change = np.flatnonzero(np.r_[True, (found[1:, :3] != found[:-1, :3]).any(axis=1)])
    shared = np.diff(np.r_[change, len(found)])
    done: set[tuple] = set()
    for (d, passage, b), n in zip(found[change, :3].tolist(), shared.tolist(), strict=True):
        item = index.items[passage]
        if n < index.bound[passage] or (d, item) in done:
            continue
        k = int(index.budget[passage])
        low = b * (k + 1) - k
        hit = banded_distance(index.codes[passage], docs[d], low, low + 4 * k + 2, k)
        if hit:
            done.add((d, item))
            edits, end = hit
            yield base + d, item, int(index.starts[passage]), max(0, end - len(index.codes[passage])), end, edits


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int, **how) -> Iterator[tuple[Passages, bool]]:
    """The benchmark, read as a stream, in blocks of bounded size, and whether a block is the only one."""
    block: list[tuple[object, str | None]] = []
    size, number = 0, 0
    for row in benchmark.select(item_col, text_col).toLocalIterator():
        if size >= block_chars:
            yield index_passages(block, **how), False
            block, size, number = [], 0, number + 1
        block.append((row[0], row[1]))
        size += len(row[1] or "")
    yield index_passages(block, **how), number == 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS, **how) -> DataFrame:
    """(doc_id, item_id, passage_start, start, end, edits): one row for each document row and benchmark item found in it.

    The benchmark goes to the tasks in blocks of ``block_chars`` characters. Of a larger benchmark one block is held at a time, by the driver
    and by the tasks: the documents are read once a block, and its finds are checkpointed before the next block is sent. Null and empty
    texts match nothing, nor do null items; repeated documents repeat their rows. Only the named columns are read.
    """
    schema = StructType([*docs.select(id_col).schema, StructField(item_col, benchmark.schema[item_col].dataType), *(StructField(c, IntegerType()) for c in ("passage_start", "start", "end", "edits"))])
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    source = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    found = None
    for index, only in _blocks(benchmark, item_col, item_text_col, block_chars, **how):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(find_passages(batch.column(1).to_pylist(), sent.value))
                columns = [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], item_type)]
                columns += [pa.array([r[i] for r in rows], pa.int32()) for i in (2, 3, 4, 5)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, item_col, "passage_start", "start", "end", "edits"])

        part = source.mapInArrow(released(run), schema)
        if not only:
            part = cut(part)
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS, **how) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark passage is found; all their columns stay as they are.

    Against one block rows are dropped as they are read. Against several, the hashes of texts with a find are gathered block by block,
    and their rows dropped by those.
    """
    rows, back = set_apart(docs, text_col)
    key = F.struct(F.xxhash64(text_col).alias("x"), F.crc32(F.col(text_col).cast("binary")).alias("c"))
    gone = None
    for index, only in _blocks(benchmark, item_col, item_text_col, block_chars, **how):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, keep: bool = only) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                marked = np.full(batch.num_rows, keep)
                marked[[r[0] for r in find_passages(texts, sent.value)]] = not keep
                yield batch.filter(pa.array(marked))

        if only:
            return back(rows.mapInArrow(released(run), rows.schema))
        texts = docs.select(text_col)
        part = cut(texts.mapInArrow(released(run), texts.schema).select(key.alias("__gone")).distinct())
        sent.destroy()
        gone = part if gone is None else gone.unionByName(part)
    gone = cut(gone.distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return back(rows.withColumn("__key", key).join(gone, F.col("__key").eqNullSafe(F.col("__gone")), "left_anti"))
