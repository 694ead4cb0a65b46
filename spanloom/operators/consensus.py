"""Consensus of repeat copies: cutting, fragment choice, stacking, rotation of windows, cycles of k-mer graphs, greedy clusters."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.sequences import kmers
from spanloom.session import cut, written

LETTERS = "ACGT"
GAPS = ("-", ".", " ")
FFT_CELLS = 1 << 20


def monomers(df: DataFrame, seq_id: str, seq: str, anchors: DataFrame, period: int) -> DataFrame:
    """(seq_id, copy_no, copy): ``period`` letters from each occurrence of the sequence's anchor ``kmer``; copies that would overrun the end go.

    One pass of a look-ahead a sequence. Copies may overlap where anchors do. The k-mer is at most as long as the period.
    """
    rest = F.lit(period) - F.length("kmer")
    pattern = F.concat(F.lit(r"(?s)(?=(\Q"), F.col("kmer"), F.lit(r"\E.{"), rest.cast("string"), F.lit("}))"))
    copies = F.regexp_extract_all(F.col(seq), pattern, F.lit(1))
    return df.select(seq_id, seq).join(anchors.select(seq_id, "kmer"), seq_id).select(seq_id, F.posexplode(copies).alias("copy_no", "copy"))


def keep_fragments(df: DataFrame, key: str, length: str, copies: str, min_copies: float = 2, min_share: float = 0.5) -> DataFrame:
    """Fragments with enough copies that are not much shorter than their key's median fragment."""
    middle = df.groupBy(key).agg(F.percentile(length, 0.5).alias("__median"))
    return df.join(middle, key).where((F.col(copies) >= min_copies) & (F.col(length) >= min_share * F.col("__median"))).drop("__median")


def chosen_fragments(df: DataFrame, key: str, length: str, copies: str, seq: str) -> DataFrame:
    """(key, seq, method): the fragment of greatest length times copies, for keys that ``keep_fragments`` leaves a single one; other keys have no row.

    These need no alignment: their fragment stands as the consensus.
    """
    kept = keep_fragments(df, key, length, copies)
    best = kept.groupBy(key).agg(F.count("*").alias("n"), F.max_by(seq, F.struct((F.col(length) * F.col(copies)).alias("w"), F.col(seq))).alias(seq))
    return best.where("n = 1").select(key, seq, F.lit("single").alias("method"))


def _weighted_median(lengths: list[float], counts: list[int]) -> float:
    order = np.argsort(lengths)
    values, upto = np.array(lengths)[order], np.cumsum(np.array(counts)[order])
    total = upto[-1]
    low, high = (np.searchsorted(upto, k, side="right") for k in ((total - 1) // 2, total // 2))
    return float(values[low] + values[high]) / 2


def length_clusters(df: DataFrame, key: str, length: str, copies: str, tolerance: float = 0.15) -> DataFrame:
    """(key, length, bucket, dominant): single-link buckets of fragment lengths, longest first, by distance to a bucket's running median.

    Equal lengths always share a bucket, so what a task holds is the distinct lengths of a key with their numbers. The dominant
    bucket has most copies times length; the first one wins ties. Rows with a null length or key are left out.
    """
    kind, size = (df.schema[c].dataType.simpleString() for c in (key, length))
    distinct = df.where(F.col(length).isNotNull() & F.col(key).isNotNull()).groupBy(key, length).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col(copies), F.lit(0)) * F.col(length)).cast("double").alias("w"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(length, ascending=False)
        buckets: list[list[list]] = []
        medians: list[float] = []
        found, weight = [], []
        for value, n, w in zip(group[length].tolist(), group["n"].tolist(), group["w"].tolist(), strict=True):
            b = next((i for i, m in enumerate(medians) if abs(value - m) <= tolerance * abs(m)), len(medians))
            if b == len(medians):
                buckets.append([[], []])
                medians.append(value)
                weight.append(0.0)
            buckets[b][0].append(value)
            buckets[b][1].append(n)
            medians[b] = _weighted_median(*buckets[b])
            weight[b] += w
            found.append(b + 1)
        top = int(np.argmax(weight)) + 1
        return pd.DataFrame({key: group[key].iloc[0], length: group[length].to_numpy(), "bucket": found, "dominant": [b == top for b in found]})

    return distinct.groupBy(key).applyInPandas(run, f"{key} {kind}, {length} {size}, bucket int, dominant boolean")


def flattest_window(df: DataFrame, key: str, col: str, gap: str, width: int) -> DataFrame:
    """(key, start, end): the window of ``width`` alignment columns with least gaps, the first of equals; all columns where there are no more than that."""
    by = Window.partitionBy(key).orderBy(col)
    run = df.select(key, col, F.sum(gap).over(by.rowsBetween(0, width - 1)).alias("gaps"), F.count("*").over(by.rowsBetween(0, width - 1)).alias("n"), F.last(col).over(by.rowsBetween(0, width - 1)).alias("to"))
    whole = F.min(F.struct(F.when(F.col("n") == width, 0).otherwise(1).alias("o"), F.when(F.col("n") == width, F.col("gaps")).alias("g"), F.col(col).alias("s"), F.col("to").alias("e")))
    return run.groupBy(key).agg(whole.alias("b")).select(key, F.col("b.s").alias("start"), F.col("b.e").alias("end"))


def stack_consensus(rows: DataFrame, key: str, seq: str, max_gap: float = 0.5, least: float = 0.4) -> DataFrame:
    """(key, consensus, n_kept, n_dropped, n_n, mean_entropy) of aligned rows, column by column.

    Columns with gaps (or no letter) in over ``max_gap`` of the rows go, and so do those without A, C, G or T. The commonest base stands,
    ties in the order A, C, G, T; N where it has less than ``least`` of the bases.
    """
    # an empty row has one empty letter, so the entries of the first column are the rows
    letters = rows.select(key, F.posexplode(F.split(F.upper(F.col(seq)), "")).alias("col", "base"))
    tally = letters.groupBy(key, "col").agg(F.count("*").alias("__rows"), F.count_if((F.length("base") > 0) & ~F.col("base").isin(*GAPS)).alias("filled"), *(F.count_if(F.col("base") == b).alias(b) for b in LETTERS), F.max(F.length("base")).alias("__any"))
    counts = tally.withColumn("__depth", F.max(F.when(F.col("col") == 0, F.col("__rows"))).over(Window.partitionBy(key))).where("__any > 0")
    bases = F.nullif(sum((F.col(b) for b in LETTERS[1:]), F.col("A")), F.lit(0))
    top = F.greatest(*LETTERS)
    first = F.when(F.col("A") == top, "A").when(F.col("C") == top, "C").when(F.col("G") == top, "G").otherwise("T")
    part = lambda b: F.when(F.col(b) > 0, -(F.col(b) / bases) * F.log2(F.col(b) / bases)).otherwise(0.0)
    kept = (1 - F.col("filled") / F.col("__depth") <= max_gap) & bases.isNotNull()
    each = counts.select(key, "col", kept.alias("kept"), F.when(top / bases < least, "N").otherwise(first).alias("base"), sum((part(b) for b in LETTERS[1:]), part("A")).alias("entropy"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("col", "base")))), lambda s: s["base"]), "")
    return each.groupBy(key).agg(text.alias("consensus"), F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_dropped"), F.count_if(F.col("kept") & (F.col("base") == "N")).alias("n_n"), F.avg(F.when(F.col("kept"), F.col("entropy"))).alias("mean_entropy"))


def variants(tally: DataFrame, seq_id: str, least: float = 0.2) -> DataFrame:
    """(seq_id, pos, bases, n_bases): of each consensus column the bases with over ``least`` of its weight, the heaviest first, ties in the order of the letters.

    ``n_bases`` counts all bases that occur; columns with more than one are the variable ones. ``tally`` has (seq_id, pos, base, n), with
    '-' for gaps where there are any, and n may be a weight.
    """
    total = tally.groupBy(seq_id, "pos").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("n_bases"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("base")))).alias("b"))
    strong = F.filter("b", lambda x: -x["o"] / F.col("total") > least)
    return total.select(seq_id, "pos", F.array_join(F.transform(strong, lambda x: x["base"]), "").alias("bases"), "n_bases")


def weighted_tally(rows: DataFrame, key: str, seq: str, weight: str) -> DataFrame:
    """(key, pos, base, n): the summed weights of the rows that have a base, or a gap, in an aligned column."""
    letters = rows.select(key, weight, F.posexplode(F.split(F.upper(F.col(seq)), "")).alias("pos", "base")).where(F.col("base").isin(*LETTERS, "-"))
    return letters.groupBy(key, "pos", "base").agg(F.sum(weight).alias("n"))


def commonest_kmer(df: DataFrame, seq_id: str, seq: str, k: int) -> DataFrame:
    """(seq_id, kmer): the k-mer that occurs most often in a sequence, the least of equals."""
    counts = df.select(seq_id, F.explode(kmers(F.col(seq), k)).alias("kmer")).groupBy(seq_id, "kmer").agg(F.count("*").alias("n"))
    return counts.groupBy(seq_id).agg(F.min(F.struct((-F.col("n")).alias("o"), "kmer")).alias("b")).select(seq_id, "b.kmer")


def plain_consensus(df: DataFrame, seq_id: str, seq: str, k: int, window: int) -> DataFrame:
    """A stand-alone consensus: windows from each occurrence of the commonest k-mer, stacked column by column."""
    return stack_consensus(monomers(df, seq_id, seq, commonest_kmer(df, seq_id, seq, k), window), seq_id, "copy")


def window_tally(df: DataFrame, seq_id: str, seq: str, period: int, window: int) -> DataFrame:
    """(seq_id, window_no, pos, base, n): bases at each position modulo the period, window by window; a short tail belongs to the last whole window."""
    letters = df.select(seq_id, F.greatest(F.floor(F.length(seq) / window) - 1, F.lit(0)).alias("last"), F.posexplode(F.split(F.upper(F.col(seq)), "")).alias("i", "base"))
    return letters.where(F.col("base").isin(*LETTERS)).groupBy(seq_id, F.least(F.floor(F.col("i") / window), "last").alias("window_no"), F.pmod("i", F.lit(period)).alias("pos"), "base").agg(F.count("*").alias("n"))


def window_shifts(tally: DataFrame, seq_id: str, period: int) -> DataFrame:
    """(seq_id, window_no, shift): the rotation at which a window agrees best with the sequence's sharpest one, by FFT cross-correlation.

    The sharpest window has the greatest share of its bases at one position; the first wins ties, as the smallest shift does. Windows are
    rows of counts, and a batch of them goes through one transform; a batch holds at most ``FFT_CELLS`` counts at a time.
    """
    kind = tally.schema[seq_id].dataType.simpleString()
    cell = F.struct((F.col("pos") * 4 + F.array_position(F.array(*map(F.lit, LETTERS)), F.col("base")) - 1).cast("int").alias("at"), F.col("n").cast("double").alias("n"))
    windows = tally.groupBy(seq_id, "window_no", "pos").agg(F.sum("n").alias("h"), F.collect_list(cell).alias("c")).groupBy(seq_id, "window_no").agg((F.max("h") / F.sum("h")).alias("sharp"), F.flatten(F.collect_list("c")).alias("c"))
    windows = written(windows.select(seq_id, "window_no", "sharp", F.transform("c", lambda x: x["at"]).alias("at"), F.transform("c", lambda x: x["n"]).alias("n")))
    reference = windows.groupBy(seq_id).agg(F.min_by(F.struct("at", "n"), F.struct(-F.col("sharp"), "window_no")).alias("r")).select(seq_id, F.col("r.at").alias("ref_at"), F.col("r.n").alias("ref_n"))

    def dense(at: pd.Series, n: pd.Series) -> np.ndarray:
        counts = np.zeros((len(at), period * 4))
        counts[np.repeat(np.arange(len(at)), at.map(len)), np.concatenate(at.to_list())] = np.concatenate(n.to_list())
        counts = counts.reshape(-1, period, 4)
        return np.fft.fft(counts - counts.mean(axis=1, keepdims=True), axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = max(1, FFT_CELLS // (4 * period))
        for batch in batches:
            for k in range(0, len(batch), some):
                part = batch.iloc[k : k + some]
                agreement = np.fft.ifft(np.conj(dense(part["ref_at"], part["ref_n"])) * dense(part["at"], part["n"]), axis=1).real.sum(axis=2).round(6)
                yield pd.DataFrame({seq_id: part[seq_id], "window_no": part["window_no"], "shift": agreement.argmax(axis=1)})

    return windows.select(seq_id, "window_no", "at", "n").join(reference, seq_id).mapInPandas(run, f"{seq_id} {kind}, window_no long, shift int")


def rotated_tally(tally: DataFrame, shifts: DataFrame, seq_id: str, period: int) -> DataFrame:
    """(seq_id, pos, base, n): the windows' counts added up after turning each by its shift."""
    turned = tally.join(shifts, [seq_id, "window_no"])
    return turned.groupBy(seq_id, F.pmod(F.col("pos") - F.col("shift"), F.lit(period)).alias("pos"), "base").agg(F.sum("n").alias("n"))


def harmonics(tally: DataFrame, seq_id: str, period: int, most: int = 5, pseudo: float = 0.5) -> DataFrame:
    """(seq_id, k, strength): for k from 2, the greatest share over the bases of the spectrum's magnitude at k cycles a period; 0 for short periods."""
    kind = tally.schema[seq_id].dataType.simpleString()
    ks = range(2, most + 1)
    cell = F.struct((F.col("pos") * 4 + F.array_position(F.array(*map(F.lit, LETTERS)), F.col("base")) - 1).cast("int").alias("at"), F.col("n").cast("double").alias("n"))
    each = tally.groupBy(seq_id).agg(F.collect_list(cell).alias("c")).select(seq_id, F.transform("c", lambda x: x["at"]).alias("at"), F.transform("c", lambda x: x["n"]).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = max(1, FFT_CELLS // (4 * period))
        for batch in batches:
            for i in range(0, batch.num_rows, some):
                part = batch.slice(i, some)
                at, n = part.column(1), part.column(2)
                counts = np.full((len(at), period * 4), pseudo)
                rows = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
                np.add.at(counts, (rows, at.flatten().to_numpy()), n.flatten().to_numpy())
                counts = counts.reshape(-1, period, 4)
                share = counts / counts.sum(axis=2, keepdims=True)
                size = np.abs(np.fft.rfft(share - share.mean(axis=1, keepdims=True), axis=1))[:, 1:]
                total = size.sum(axis=1)
                strength = np.zeros((len(at), len(ks)))
                if period >= 2 * most:
                    strength = np.stack([np.where(total > 1e-12, size[:, k - 1] / np.maximum(total, 1e-12), 0).max(axis=1) for k in ks], axis=1)
                owner = np.repeat(np.arange(len(at)), len(ks))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(np.tile(np.array(ks, np.int32), len(at))), pa.array(strength.ravel())], names=[seq_id, "k", "strength"])

    return each.mapInArrow(run, f"`{seq_id}` {kind}, k int, strength double")


def strong_components(follow: dict[str, list[str]]) -> list[list[str]]:
    """Strongly connected components of two nodes or more, largest first; two walks, forward for an order and backward to gather."""
    order, seen = [], set()
    for root in follow:
        stack = [(root, iter(follow[root]))] if root not in seen else []
        seen.add(root)
        while stack:
            node, ahead = stack[-1]
            step = next((x for x in ahead if x not in seen), None)
            if step is None:
                order.append(node)
                stack.pop()
            else:
                seen.add(step)
                stack.append((step, iter(follow[step])))
    back: dict[str, list[str]] = {x: [] for x in follow}
    for a, ends in follow.items():
        for b in ends:
            back[b].append(a)
    found, placed = [], set()
    for root in reversed(order):
        if root in placed:
            continue
        placed.add(root)
        part, todo = [], [root]
        while todo:
            node = todo.pop()
            part.append(node)
            fresh = [x for x in back[node] if x not in placed]
            placed.update(fresh)
            todo += fresh
        if len(part) > 1:
            found.append(sorted(part))
    return sorted(found, key=lambda p: (-len(p), p))


def _followers(kmers: list[str]) -> dict[str, list[str]]:
    starts: dict[str, list[str]] = {}
    for x in kmers:
        starts.setdefault(x[:-1], []).append(x)
    return {x: starts.get(x[1:], []) for x in kmers}


def cheapest_cycles(counts: dict[str, int], least_nodes: int = 20, least_mass: float = 0.45) -> list[tuple[str, float]]:
    """(monomer, mean count) of the cheapest cycle through each unbranched k-mer of the leading component; shortest first.

    The commonest k-mers, half of the mass at first and twice as many a step, give the graph, until its largest strongly connected
    component has over ``least_nodes`` nodes and ``least_mass`` of the mass, or no k-mer is left. A step costs the geometric mean of both
    counts to the power -3. A k-mer on a cycle already found starts no other. A monomer is given in its least rotation.
    """
    kmers = sorted(counts, key=lambda x: (-counts[x], x))
    mass = np.cumsum([counts[x] for x in kmers])
    take = max(1, int((mass < 0.5 * mass[-1]).sum())) if kmers else 0
    core: list[str] = []
    while kmers:
        parts = strong_components(_followers(kmers[:take]))
        core = parts[0] if parts else []
        if take >= len(kmers) or (len(core) > least_nodes and sum(counts[x] for x in core) >= least_mass * mass[-1]):
            break
        take = min(2 * take, len(kmers))
    follow = _followers(core)
    before: dict[str, int] = dict.fromkeys(core, 0)
    for ends in follow.values():
        for x in ends:
            before[x] += 1
    found, covered = {}, set()
    for seed in sorted(core, key=lambda x: (-counts[x], x)):
        if seed in covered or len(follow[seed]) != 1 or before[seed] != 1:
            continue
        best, came, heap = {}, {}, [(0.0, seed, "")]
        while heap:
            cost, node, source = heapq.heappop(heap)
            if node in best and (node != seed or source == ""):
                continue
            if source:
                came[node] = source
                if node == seed:
                    break
            best[node] = cost
            for x in follow[node]:
                if x not in best or x == seed:
                    heapq.heappush(heap, (cost + (counts[node] * counts[x]) ** -1.5, x, node))
        cycle, node = [seed], came[seed]
        while node != seed:
            cycle.append(node)
            node = came[node]
        covered.update(cycle)
        text = "".join(x[-1] for x in reversed(cycle))
        found[min(text[i:] + text[:i] for i in range(len(text)))] = float(np.mean([counts[x] for x in cycle]))
    return sorted(found.items(), key=lambda f: (len(f[0]), f[0]))


def monomer_cycles(counts: DataFrame, key: str, **how) -> DataFrame:
    """(key, monomer, length, support) from (key, kmer, n): ``cheapest_cycles`` of each key, whose task holds its distinct k-mers."""
    kind = counts.schema[key].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        cycles = cheapest_cycles(dict(zip(group["kmer"], group["n"].tolist(), strict=True)), **how)
        return pd.DataFrame([(group[key].iloc[0], m, len(m), s) for m, s in cycles], columns=[key, "monomer", "length", "support"])

    return counts.select(key, "kmer", "n").groupBy(key).applyInPandas(run, f"{key} {kind}, monomer string, length int, support double")


def greedy_clusters(nodes: DataFrame, edges: DataFrame, rank: Column, max_rounds: int = 200) -> DataFrame:
    """(node, representative): what taking nodes by ``rank`` gives when each free one becomes a representative and its neighbours join.

    Equal ranks go by a hash of the node, then by the node, so that a chain of ties is no longer than chance makes it. A node that is
    listed twice counts once, with its least rank; null nodes and edges to unlisted nodes are left out. A node stands once no free
    neighbour precedes it, so whole layers are settled a round; members then pick their first representative. Rounds are as many as
    the longest chain of such waits; more than ``max_rounds``, or a round that settles nothing, is an error. Edges count both ways.
    """
    least = nodes.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(rank).alias("r"))
    order = cut(least.select("node", F.struct("r", F.xxhash64("node").alias("h"), F.col("node").alias("i")).alias("k")))
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("u"), F.col("dst").alias("v")), F.struct(F.col("dst").alias("u"), F.col("src").alias("v")))).alias("e")).select("e.u", "e.v").distinct()
    ahead = cut(ends.join(order.toDF("u", "ku"), "u").join(order.toDF("v", "kv"), "v").where("ku < kv").select("u", "v"))
    free, live, layers = order.select("node"), ahead, []
    for _ in range(max_rounds):
        waiting = live.select(F.col("v").alias("node")).distinct()
        layers.append(cut(free.join(waiting, "node", "left_anti")))
        taken = live.join(layers[-1].withColumnRenamed("node", "u"), "u", "left_semi").select(F.col("v").alias("node")).distinct()
        free = cut(free.join(waiting, "node", "left_semi").join(taken, "node", "left_anti"))
        if free.isEmpty():
            break
        if layers[-1].isEmpty():
            raise RuntimeError("a round of clusters settled no node")
        live = cut(live.join(free.withColumnRenamed("node", "u"), "u", "left_semi").join(free.withColumnRenamed("node", "v"), "v", "left_semi"))
    else:
        raise RuntimeError(f"clusters did not settle in {max_rounds} rounds")
    chosen = layers[0]
    for layer in layers[1:]:
        chosen = chosen.unionByName(layer)
    # a node that joins is preceded by a representative, so the edges from earlier to later nodes suffice
    joined = ahead.join(chosen.withColumnRenamed("node", "u").join(order.toDF("u", "ku"), "u"), "u").groupBy(F.col("v").alias("node")).agg(F.min("ku").alias("k"))
    members = joined.join(chosen, "node", "left_anti").select("node", F.col("k.i").alias("representative"))
    return chosen.select("node", F.col("node").alias("representative")).unionByName(members)


def pattern_pivot(df: DataFrame, pattern: str, sample: str, member: str, detail: str, samples: tuple[str, ...]) -> DataFrame:
    """A row a pattern, and for each sample its first member with that member's detail; null where it has none."""
    first = lambda s, value: F.min(F.when(F.col(sample) == s, F.struct(member, detail)))[value].alias(f"{s}_{value}")
    return df.where(F.col(pattern).isNotNull()).groupBy(pattern).agg(*(first(s, c) for s in samples for c in (member, detail)))
