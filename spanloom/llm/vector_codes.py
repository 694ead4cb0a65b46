"""Vector code compression: product quantisation, codebooks fitted over all vectors by RDD treeAggregate.

Components become integers, so every sum is exact and no result depends on partitions, order or retries. A partition goes through NumPy
blocks of at most ``BLOCK`` vectors, one contiguous array a dimension: a block's distances to a part's entries accumulate dimension by dimension,
and ``np.add.at`` adds the block to int64 tensors of sums and counts. The tensors (entries x dimensions, whatever the number of vectors)
merge through the reduction tree, two levels by default, so the driver receives a few of them. Executors hold a block and a tensor.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Row
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.session import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 4096
BROADCAST_ROWS = 500_000


def limit_of(dims: int) -> int:
    """Integers beyond this are set to it: the greatest for which a squared distance over all dimensions fits a signed 64-bit integer."""
    return math.isqrt((2**63 - 1) // (4 * max(dims, 1)))


def whole_components(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of a (vectors, dimensions) array, laid out a dimension after the other."""
    most = limit_of(vectors.shape[1])
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return np.ascontiguousarray(np.clip(scaled, -most, most).astype(np.int64).T)


def nearest(block: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of one part for each vector; the lower index of equals.

    ``block`` is (dimensions of the part, vectors), ``book`` (entries, dimensions of the part).
    """
    apart = np.zeros((book.shape[0], block.shape[1]), np.int64)
    for j, values in enumerate(block):
        gap = values[None, :] - book[:, j, None]
        apart += gap * gap
    best = apart.argmin(axis=0)
    return best, apart[best, np.arange(block.shape[1])]


def _usable(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(id, v, label) of the vectors without null or non-finite components."""
    fine = F.col(vector_col).isNotNull() & F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return df.where(fine).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), (F.col(label_col) if label_col else F.lit(None)).alias("label"))


def _blocks(column: pa.ListArray, dims: int) -> np.ndarray:
    return whole_components(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def _aggregated(vectors: DataFrame, book: np.ndarray, parts: int, block: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums (parts, entries, dimensions of a part) and counts (parts, entries) of the vectors by their nearest entries."""
    entries, width = book.shape[1:]
    dims = parts * width

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = _blocks(batch.column(0).slice(at, block), dims)
                yield pa.RecordBatch.from_arrays([pa.array([part.shape[1]], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["n", "data"])

    sent = vectors.sparkSession.sparkContext.broadcast(book)

    def add(state: tuple[np.ndarray, np.ndarray], row: Row) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(row.data, np.int64).reshape(dims, row.n)
        for p in range(parts):
            own = data[p * width : (p + 1) * width]
            at, _ = nearest(own, sent.value[p])
            np.add.at(state[0][p], at, own.T)
            np.add.at(state[1][p], at, 1)
        return state

    def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return a[0] + b[0], a[1] + b[1]

    zero = (np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64))
    found = vectors.select("v").mapInArrow(columns, "n int, data binary").rdd.treeAggregate(zero, add, merge, depth)
    sent.unpersist()
    return found


def fit_codebooks(vectors: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK, depth: int = 2) -> np.ndarray:
    """(parts, entries, dimensions of a part) from (id, v): the vectors of the smallest ids at first, then means of what each entry is nearest to.

    Of fewer vectors each gives an entry. Repeated ids go by their vectors; null ids come last. The first vectors are all that is collected.
    """
    first = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    start = whole_components(np.array(first["v"].to_pylist(), np.float64).reshape(-1, dims))
    book = np.stack([start[p * (dims // parts) : (p + 1) * (dims // parts)].T for p in range(parts)])
    for _ in range(rounds):
        sums, counts = _aggregated(vectors, book, parts, block, depth)
        book = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], book)
    return book


def codebooks_digest(book: np.ndarray) -> str:
    """SHA-256 of the entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, book: np.ndarray) -> DataFrame:
    """(id, label, code, error) of each vector: two hex digits a part, and the squared distances summed."""
    parts, _, width = book.shape
    sent = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                data = _blocks(some.column(2), parts * width)
                codes, error = np.zeros((some.num_rows, parts), np.uint8), np.zeros(some.num_rows, np.int64)
                for p in range(parts):
                    best, apart = nearest(data[p * width : (p + 1) * width], sent.value[p])
                    codes[:, p] = best
                    error += apart
                text = codes.tobytes().hex()
                size = 2 * parts
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([text[k : k + size] for k in range(0, len(text), size)], pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("id", "label")}
    return vectors.select("id", "label", "v").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row for each usable row of ``df``.

    Rows go whose vector is null or holds null, infinite or NaN components. Vectors are as long as most of them are (the shorter of two
    equally common lengths), and that is a multiple of ``parts``; empty vectors and those of another length can't be compared and go too. Integers beyond
    ``limit_of`` are set to it. Equal rows have equal codes and all stay. A label's error is summed over all its rows, null labels
    together; it is null beyond 64 bits. An empty table gives no rows. Columns beyond the three named are not read.
    """
    if entries > 256:
        raise ValueError("a part's code has two hex digits: 256 entries at most")
    usable = _usable(df, id_col, vector_col, label_col)
    lengths = usable.groupBy(F.size("v").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0))
    top = lengths.orderBy(F.col("count").desc(), "n").first()
    if top is None:
        schema = f"id {usable.schema['id'].dataType.simpleString()}, label {usable.schema['label'].dataType.simpleString()}, code string, error long"
        coded, digest = df.sparkSession.createDataFrame([], schema), codebooks_digest(np.zeros((parts, 0, 0), np.int64))
    else:
        vectors = usable.where(F.size("v") == top["n"])
        book = fit_codebooks(vectors, top["n"], parts, entries, rounds)
        coded, digest = written(encode(vectors, book)), codebooks_digest(book)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s")).select(F.col("label").alias("of"), F.col("s").try_cast("long").alias("label_error"))
    few = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    return coded.join(few, F.col("label").eqNullSafe(F.col("of")), "left").select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
