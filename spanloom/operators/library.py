"""Search of a library in long sequences: common k-mers, chained by diagonal and position, of which the best chains are kept.

Sequences are cut into overlapping pieces, and each k-mer belongs to the piece in which it starts, with its place in the whole
sequence. Keys are worked out in Arrow batches, and those of a library that is small leave out all others there. Everything after that works on those places, so a search gives the same whole or in pieces, whatever their size. Chains
are windows over (sequence, entry, strand, band of diagonals), and such a group is no longer than the entry and a band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import reannotate
from spanloom.operators.letters import CHUNK
from spanloom.operators.similarity import encoded
from spanloom.operators.tandem import pieces
from spanloom.session import written

BROADCAST_ROWS = 500_000
BIN = 4096
BITS = 22  # of the table in which keys are looked up first


def kmer_keys(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, key, ahead) of the k-mers of A, C, G and T in letters coded 0 to 3 (4 for others): the lesser of a k-mer and its reverse complement, as a number."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    # runs of 1, 2, 4, ... letters are put together to k
    run, turned, size = (codes & 3).astype(np.int64), (3 - (codes & 3)).astype(np.int64), 1
    ahead, back, done = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    while True:
        if k & size:
            ahead = ahead << 2 * size | run[done : done + n]
            back |= turned[done : done + n] << 2 * done
            done += size
        if done == k:
            break
        run, turned = run[:-size] << 2 * size | run[size:], turned[:-size] | turned[size:] << 2 * size
        size *= 2
    other = np.r_[0, np.cumsum(codes > 3)]
    at = np.flatnonzero(other[k:] == other[:-k])
    ahead, back = ahead[at], back[at]
    return at, np.minimum(ahead, back), ahead <= back


class Known:
    """Some keys, looked up by a table of bits of their hashes first."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys.astype(np.int64))
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[self._hashed(self.keys)] = True

    @staticmethod
    def _hashed(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where a known key stands."""
        maybe = np.flatnonzero(self.bits[self._hashed(keys)])
        if not len(self.keys):
            return maybe
        return maybe[self.keys[np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)] == keys[maybe]]


def placed_kmers(seqs: DataFrame, seq_id: str, seq: str, k: int, piece: int, sample: int = 1, known: np.ndarray | None = None) -> DataFrame:
    """(seq_id, pos, key, ahead): k-mers of A, C, G and T with their 0-based places; the key is the lesser of a k-mer and its reverse complement.

    Keys are numbers of two bits a letter, so k is 31 at most. ``sample`` keeps one key in so many, by a hash of the key, so two texts
    keep the same ones. With ``known`` only these keys leave a task, and not a row a letter.
    """
    if not 1 <= k <= 31:
        raise ValueError("k is from 1 to 31")
    kind = seqs.schema[seq_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if known is None else Known(known)
        for batch in batches:
            ends = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False)) // CHUNK
            for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(ends)) + 1):
                rows = batch.take(pa.array(part))
                texts = rows.column("text").to_pylist()
                starts = np.cumsum([0, *(len(t) + 1 for t in texts)])  # a letter that breaks k-mers stands between texts
                at, key, ahead = kmer_keys(encoded("-".join(texts)), k)
                if wanted is not None:
                    found = wanted.find(key)
                    at, key, ahead = at[found], key[found], ahead[found]
                owner = np.searchsorted(starts, at, side="right") - 1
                at = at - starts[owner]
                mine = np.flatnonzero(at < rows.column("own").to_numpy(zero_copy_only=False)[owner])
                pos = (at + rows.column("at").to_numpy(zero_copy_only=False)[owner])[mine]
                yield pa.RecordBatch.from_arrays([rows.column(seq_id).take(pa.array(owner[mine])), pa.array(pos), pa.array(key[mine]), pa.array(ahead[mine])], names=[seq_id, "pos", "key", "ahead"])

    upper = seqs.select(seq_id, F.upper(F.col(seq)).alias("seq"))
    each = pieces(upper, seq_id, "seq", piece, k).select(seq_id, "at", "own", "text", F.length("text").alias("size"))
    rows = each.mapInArrow(run, f"`{seq_id}` {kind}, pos long, key long, ahead boolean")
    return rows if sample == 1 else rows.where(F.pmod(F.xxhash64("key"), F.lit(sample)) == 0)


def chains(seqs: DataFrame, library: DataFrame, seq_id: str = "seqid", seq: str = "seq", entry: str = "entry", k: int = 11, band: int = 32, gap: int = 100, least: int = 40, piece: int = 250_000, sample: int = 1) -> DataFrame:
    """(seq_id, entry, strand, s, e, es, ee, covered, seeds): runs of seeds in a band of diagonals, no further than ``gap`` apart.

    Places are 1-based and inclusive, es and ee in the entry. ``covered`` are the letters of the sequence under seeds, at least ``least``.
    A chain that stands in both bands that share a diagonal is one row. ``library`` has (entry, seq) with unique entries.
    """
    index = placed_kmers(library, entry, seq, k, piece, sample).select(F.col(entry), F.col("pos").alias("off"), "key", F.col("ahead").alias("along"))
    index = written(index)
    small = index.count() <= BROADCAST_ROWS
    known = index.select("key").distinct().toPandas()["key"].to_numpy(np.int64) if small else None
    index = F.broadcast(index) if small else index
    seqs = written(seqs.select(seq_id, F.upper(F.col(seq)).alias(seq)))  # read for the short and for the long ones
    same = F.col("ahead") == F.col("along")
    line = F.when(same, F.col("pos") - F.col("off")).otherwise(F.col("pos") + F.col("off"))
    first = F.floor(line / band)
    met = placed_kmers(seqs, seq_id, seq, k, piece, sample, known).join(index, "key")
    seeds = met.select(seq_id, entry, F.when(same, "+").otherwise("-").alias("strand"), "pos", "off", F.explode(F.array(first, first - 1)).alias("cell"))
    group = [seq_id, entry, "strand", "cell"]
    order = Window.partitionBy(*group).orderBy("pos", "off")
    step = F.col("pos") - F.lag("pos").over(order)
    marked = seeds.withColumn("step", step).withColumn("new", F.when(F.col("step") <= gap, 0).otherwise(1))
    numbered = marked.withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    added = F.when(F.col("new") == 1, k).otherwise(F.least(F.lit(k), F.col("step")))
    runs = numbered.groupBy(*group, "chain").agg((F.min("pos") + 1).alias("s"), (F.max("pos") + k).alias("e"), (F.min("off") + 1).alias("es"), (F.max("off") + k).alias("ee"), F.sum(added).cast("long").alias("covered"), F.count("*").alias("seeds"))
    return runs.where(F.col("covered") >= least).select(seq_id, entry, "strand", "s", "e", "es", "ee", "covered", "seeds").distinct()


def best_chains(found: DataFrame, seq_id: str = "seqid", entry: str = "entry", share: float = 0.8) -> DataFrame:
    """Chains of which no ``share`` or more lies in a better one of the same sequence: one with more letters covered; ties by start, end, entry, strand and place in the entry, the greater first."""
    chains_ = written(found)
    better = F.struct("covered", "s", "e", entry, "strand", "es", "ee")
    binned = chains_.withColumn("rank", better).withColumn("bin", F.explode(F.sequence(F.floor(F.col("s") / BIN), F.floor(F.col("e") / BIN))))
    other = binned.select(seq_id, "bin", F.col("s").alias("os"), F.col("e").alias("oe"), F.col("rank").alias("above"))
    shared = F.least("e", "oe") - F.greatest("s", "os") + 1
    under = binned.join(other, [seq_id, "bin"]).where((F.col("above") > F.col("rank")) & (shared >= share * (F.col("e") - F.col("s") + 1))).select(seq_id, *(c for c in chains_.columns if c != seq_id)).distinct()
    return chains_.join(under.select(seq_id, entry, "strand", "s", "e", "es", "ee", "covered"), [seq_id, entry, "strand", "s", "e", "es", "ee", "covered"], "left_anti").select(*chains_.columns)


def library_hits(seqs: DataFrame, library: DataFrame, seq_id: str = "seqid", seq: str = "seq", entry: str = "entry", name: str = "name", share: float = 0.8, **how) -> DataFrame:
    """``best_chains`` of a library (entry, name, seq), each with its entry's name. Null sequences and those under k letters have none; other letters break k-mers."""
    usable = library.where(F.col(entry).isNotNull() & F.col(seq).isNotNull())
    rows = seqs.where(F.col(seq_id).isNotNull() & F.col(seq).isNotNull())
    return best_chains(chains(rows, usable, seq_id, seq, entry, **how), seq_id, entry, share).join(usable.select(entry, name), entry)


def annotate_from_library(seqs: DataFrame, library: DataFrame, seq_id: str = "seqid", seq: str = "seq", entry: str = "entry", name: str = "name", fraction: float = 0.05, **how) -> DataFrame:
    """From sequences and a library to unambiguous spans of its names: the library's hits, and ``reannotate`` with the longest entry of each name as least length."""
    hits = written(library_hits(seqs, library, seq_id, seq, entry, name, **how).select(F.col(seq_id).alias("seqid"), F.col(name).alias("name"), "s", "e"))
    lengths = library.groupBy(F.col(name).alias("name")).agg(F.max(F.length(seq)).cast("long").alias("size"))
    return reannotate(hits, lengths, "seqid", "name", fraction)
