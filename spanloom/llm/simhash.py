"""SimHash near-duplicate classes found by Golay-code fuzzy hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Two
fingerprints link when they differ in at most four of 64 bits. Candidates come from fuzzy keys:

* The fingerprint is cut into segments of 22, 21 and 21 bits, each padded to a word of the perfect
  binary Golay code (23, 12, 7), in which every word lies within three bits of exactly one codeword.
* Decoding a segment, and the segment with each of its bits flipped, gives one codeword index (for 13 %
  of words) or up to six. Segments that differ in at most two bits share such an index, and segments
  that differ in at most one bit hold each other's own index.
* Four errors over three segments leave some two segments with two errors or fewer between them. So the
  keys of a pair of segments are (own index, every index) and (every index, own index): about ten
  24-bit keys for each of three pairs, and any linked pair of fingerprints meets in at least one.

Only distinct fingerprints are keyed, so exact copies cost one row. Rows of one key are compared in
their task with vectorised popcounts, and only the edges of a spanning forest leave the task: a group
of near copies yields about as many rows as it has members. A key with more than ``block`` fingerprints is
dealt out as pairs of blocks, so no task holds or compares more than two blocks of a key at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.columns import set_apart
from spanloom.operators.graph import connected_components
from spanloom.llm.workers import released
from spanloom.session import cut, releasing

SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
BROADCAST_ROWS = 500_000
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the (23, 12, 7) code


# ---------------------------------------------------------------- fingerprints


def word_shingles(text: str | None, shingle: int) -> list[bytes]:
    """Word shingles of a text, all its words where it has fewer; none for a text without words, or null."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if len(words) < shingle:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle of a text, in order, repeats included."""
    grams = word_shingles(text, shingle)
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=len(grams))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; 0 for none."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit majority fingerprint of the word shingles of a text; 0 for a text without words, or null."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(released(run), f"id {kind}, fp long")


# ---------------------------------------------------------------- Golay keys


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome of 23-bit words: the remainder by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _error_table() -> np.ndarray:
    """The error of weight three or less for each of the 2048 syndromes."""
    one = [1 << i for i in range(23)]
    errors = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i])]
    errors += [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    table = np.zeros(2048, np.int64)
    table[_remainder(np.array(errors))] = errors
    return table


ERRORS = _error_table()
LOW = _remainder(np.arange(4096))
HIGH = _remainder(np.arange(2048) << 12)


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (the 12 information bits) of the codeword nearest to each 23-bit word."""
    syndrome = LOW[words & 4095] ^ HIGH[words >> 12]
    return (words ^ ERRORS[syndrome]) >> 11


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every distinct fuzzy key of each fingerprint; a key holds the pair of segments and two indices."""
    fps = fps.astype(np.uint64)
    every, own = [], []
    for low, bits in SEGMENTS:
        words = ((fps >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        own.append(codeword_index(words))
        every.append(np.stack([own[-1], *(codeword_index(words ^ (1 << b)) for b in range(bits))], axis=1))
    rows, keys = [], []
    number = np.arange(len(fps))
    for k, (a, b) in enumerate(PAIRS):
        for found in (own[a][:, None] << 12 | every[b], every[a] << 12 | own[b][:, None]):
            rows.append(np.repeat(number, found.shape[1]))
            keys.append((found | k << 24).ravel())
    joint = np.unique(np.concatenate(rows) << 26 | np.concatenate(keys))
    return joint >> 26, joint & ((1 << 26) - 1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(whole), 4096):
            fps = whole[at : at + 4096]
            rows, keys = golay_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])


# ---------------------------------------------------------------- links


class _Forest:
    """Union-find over the fingerprints that have met a link in this task."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _links(max_bits: int):
    """Rows sorted by (key, lo, hi) in; the edges of a spanning forest of the task's links out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        edges: list[tuple[int, int]] = []

        def met(a: np.ndarray, b: np.ndarray) -> None:
            edges.extend(pair for pair in zip(a.tolist(), b.tolist(), strict=True) if forest.join(*pair))

        def compare(group: np.ndarray, fps: np.ndarray) -> None:
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[starts, len(group)])
            small = np.repeat(sizes <= 64, sizes)
            g, f = group[small], fps[small]
            for step in range(1, int(sizes[sizes <= 64].max(initial=1))):  # neighbours at each distance, all small groups at once
                near = (g[step:] == g[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= max_bits)
                met(f[:-step][near], f[step:][near])
            for at, size in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
                f = fps[at : at + size]
                for i in range(0, size, 512):
                    part = f[i : i + 512]
                    a, b = np.nonzero(np.bitwise_count(part[:, None] ^ f[None, i:]) <= max_bits)
                    met(part[a], f[i:][b])

        def out() -> pa.RecordBatch:
            found = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        left = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            rows = np.concatenate([left, rows])
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            cut_at = len(rows) - int(same[::-1].argmin()) if not same.all() else 0  # the last group may go on
            left, rows = rows[cut_at:], rows[:cut_at]
            if len(rows):
                group = np.cumsum(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
                compare(group, rows[:, 3].view(np.uint64) if rows[:, 3].flags.c_contiguous else np.ascontiguousarray(rows[:, 3]).view(np.uint64))
            if edges:
                yield out()
        if len(left) > 1:
            compare(np.zeros(len(left), np.int64), np.ascontiguousarray(left[:, 3]).view(np.uint64))
        if edges:
            yield out()

    return run


def linked_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, block: int = 2048) -> DataFrame:
    """(a, b) edges that join exactly the distinct values of ``fp`` reachable over steps of ``max_bits`` or fewer.

    ``max_bits`` may be 0 to 4: beyond that the segments no longer guarantee a shared key.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the segments guarantee a shared key for 0 to 4 differing bits")
    keyed = fps.select("fp").mapInArrow(_keyed, "key long, fp long")
    hot = cut(keyed.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    # hot keys are marked before anything is shuffled by key
    dealt = keyed.join(F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot, "key", "left")
    dealt = dealt.withColumn("c", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("fp"), "blocks").cast("long")).otherwise(F.lit(0)))
    others = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    rows = dealt.withColumn("other", F.explode(others)).select("key", F.least("c", "other").alias("lo"), F.greatest("c", "other").alias("hi"), "fp")
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_links(max_bits), "a long, b long")


def with_values(df: DataFrame, values: DataFrame, key: str, n: str = "n", hot: int = 1024) -> DataFrame:
    """``df`` joined with ``values``, one row a key and its number ``n`` of rows in ``df``: keys of more than ``hot`` rows by broadcast.

    There are at most rows / ``hot`` such keys; where they are over ``BROADCAST_ROWS`` all the same, the join is a plain one. Keys are
    not null. Both tables are read twice, so they should be checkpointed.
    """
    many = values.where(F.col(n) > hot).drop(n)
    count = many.count()
    if not 0 < count <= BROADCAST_ROWS:
        return df.join(values.drop(n), key)
    rest = df.join(F.broadcast(many.select(key)), key, "left_anti").join(values.where(F.col(n) <= hot).drop(n), key)
    return rest.unionByName(df.join(F.broadcast(many), key).select(*rest.columns))


def component_names(members: DataFrame, first: str = "first") -> DataFrame:
    """``members`` (component, ..., first) with the least ``first`` of each component as component_id; large components are no hot keys."""
    members = cut(members)
    names = cut(members.groupBy("component").agg(F.min(first).alias("component_id"), F.count("*").alias("n")))
    return with_values(members, names, "component")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = MAX_BITS, block: int = 2048
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``.

    component_id is the smallest id among the documents reachable over links of at most ``max_bits`` bits.
    Null and wordless texts have fingerprint zero and link like any other; repeated ids give repeated rows,
    a null id takes part in links but never names a component unless all of its component is null.
    Columns of ``docs`` beyond the two named are not read, so their names may clash with anything.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    edges = cut(linked_fingerprints(distinct, max_bits, block))
    roots = connected_components(edges, "a", "b").withColumnRenamed("node", "fp")
    classed = distinct.join(roots, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = cut(component_names(classed).select("fp", "component_id", "n"))
    return with_values(prints, named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id names their near-duplicate class; of rows that repeat an id, one stays.

    Which of them stays is decided by a hash of the row, so reruns agree.
    """
    return keep_named(docs, near_duplicate_classes(docs, id_col, text_col, **how), id_col, text_col)


@releasing
def keep_named(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep_one_of_each`` for classes given as (doc_id, component_id).

    What stays is decided on ids and row hashes. Texts move only where rows are dropped beyond ``BROADCAST_ROWS``, or repeat as a whole.
    """
    docs, back = set_apart(docs, id_col, text_col)
    ids = classes.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__kept")).distinct()
    hashed = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    lost = F.when(F.col(id_col).isNull(), F.xxhash64(text_col))  # rows without an id are told apart by their texts
    keyed = docs.withColumns({"__id": F.col(id_col), "__lost": lost, "__h": F.xxhash64(*hashed)})
    groups = cut(keyed.groupBy("__id", "__lost", "__h").agg(F.count("*").alias("__n")))
    named = groups.join(ids, groups["__id"].eqNullSafe(ids["__kept"]), "left_semi")
    chosen = cut(named.groupBy("__id", "__lost").agg(F.min(F.struct("__h", "__n")).alias("m")).select("__id", "__lost", "m.*"))
    gone = cut(_rows_of(groups, chosen, "left_anti").select("__id", "__lost", "__h"))
    few = gone.count() <= BROADCAST_ROWS
    left = _rows_of(keyed, F.broadcast(gone), "left_anti") if few else _rows_of(keyed, chosen, "left_semi")
    repeated = chosen.where("__n > 1")
    count = repeated.count()
    if count:
        repeated = F.broadcast(repeated) if count <= BROADCAST_ROWS else repeated
        one = _rows_of(left, repeated, "left_semi").groupBy("__id", "__lost").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
        return _rows_of(left, repeated, "left_anti").select(*docs.columns).unionByName(one).transform(back)
    return back(left)


def _rows_of(df: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    other = groups.select(F.col("__id").alias("__i"), F.col("__lost").alias("__l"), F.col("__h").alias("__k"))
    return df.join(other, df["__id"].eqNullSafe(F.col("__i")) & df["__lost"].eqNullSafe(F.col("__l")) & (df["__h"] == F.col("__k")), how)
