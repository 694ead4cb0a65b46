"""Sequence algebra: k-mers, complements, motifs, repeats, base tallies, consensus, complexity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.intervals import union_length
from spanloom.operators.letters import Letters, by_sequence, ordered, tallied
from spanloom.session import written

BASES, COMPLEMENTS = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"  # fixed values: the IUPAC codes and their complements
PART = 4096  # rows of a group in a task
SSR_CODES = np.full(256, 4, np.uint8)
SSR_CODES[[ord(c) for c in "acgt"]] = range(4)
SSR_LIMITS = ((1, 20), (2, 9), (3, 6), *((n, 5) for n in range(4, 15)))  # fixed values: motif length, least repeats


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), BASES, COMPLEMENTS))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order; none for shorter sequences. One pass of a look-ahead: substring by position would start over for each."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def kmer_counts(df: DataFrame, seq: str, k: int, by: tuple[str, ...] = (), skip_n: bool = False, omit_last: bool = False) -> DataFrame:
    """(by, kmer, n); counting may skip k-mers with N, and the last k-mer of each sequence."""
    source = F.expr(f"substring({seq}, 1, greatest(length({seq}) - 1, 0))") if omit_last else F.col(seq)
    if len(by) == 1:
        found = by_sequence(df.select(*by, source.alias("__seq")), by[0], "__seq", lambda x: _kmer_rows(x, k), "kmer string, n long")
        return found.where(~F.contains("kmer", F.lit("N"))) if skip_n else found
    found = df.select(*by, F.explode(kmers(source, k)).alias("kmer"))
    if skip_n:
        found = found.where(~F.contains("kmer", F.lit("N")))
    return found.groupBy(*by, "kmer").agg(F.count("*").alias("n"))


def _kmer_rows(letters: Letters, k: int) -> tuple[np.ndarray, dict]:
    where, rank = letters.kmers(k)
    first, n = tallied(letters.owner[where], rank)
    return letters.owner[where[first]], {"kmer": letters.texts(where[first], rank[first], k), "n": n}


def gap_rows(letters: Letters, k: int, max_gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, gap, n) of ``kmer_gaps``."""
    where, rank = letters.kmers(k)
    owner, place = letters.owner[where], letters.place[where]
    once = ((owner[1:] > owner[:-1]) | (place[1:] > place[:-1])).all()  # one text an id: its places ascend
    order = ordered(owner, rank) if once else ordered(owner, rank, place)
    o, r, p = owner[order], rank[order], place[order]
    gap = p[1:] - p[:-1]
    near = (o[1:] == o[:-1]) & (r[1:] == r[:-1]) & (gap <= max_gap)
    o, gap = o[1:][near], gap[near]
    first, n = tallied(o, gap)
    return o[first], gap[first].astype(np.int32), n


def kmer_gaps(df: DataFrame, seq_id: str, seq: str, k: int, max_gap: int) -> DataFrame:
    """(seq_id, gap, n): histogram of the distances between neighbouring occurrences of equal k-mers, up to ``max_gap``."""

    def each(letters: Letters) -> tuple[np.ndarray, dict]:
        owner, gap, n = gap_rows(letters, k, max_gap)
        return owner, {"gap": gap, "n": n}

    return by_sequence(df, seq_id, seq, each, "gap int, n long")


def rotations(motif: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(motif), F.lit(1))), lambda i: F.concat(F.substring(motif, i, F.length(motif)), F.substring(motif, F.lit(1), i - 1)))


def canonical_motif(motif: Column) -> Column:
    """The least rotation of a motif or of its reverse complement."""
    upper = F.upper(motif)
    return F.least(F.array_min(rotations(upper)), F.array_min(rotations(reverse_complement(upper))))


def unique_motifs(motifs: Column) -> Column:
    """Motifs that are no whole repetition of a shorter one in the list; shortest first, order kept among equals."""
    shorter = lambda m, x: (F.length(x) < F.length(m)) & (F.length(m) % F.length(x) == 0)
    kept = F.filter(motifs, lambda m: ~F.exists(motifs, lambda x: shorter(m, x) & (F.replace(m, x, F.lit("")) == "")))
    return F.transform(F.array_sort(F.transform(kept, lambda m, i: F.struct(F.length(m).alias("n"), i.alias("i"), m.alias("m")))), lambda s: s["m"])


def _repeats(text: str) -> Iterator[tuple[int, int, int]]:
    """(motif length, start, end): what a search for each motif length finds in lower-case letters from left to right, 0-based and half-open.

    A repeat is a run of letters that equal the one a motif further on. The longest that starts first is taken, and the search goes on
    behind it.
    """
    codes = SSR_CODES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    for size, least in SSR_LIMITS:
        if len(codes) < size * least:
            continue
        equal = (codes[size:] == codes[:-size]) & (codes[size:] < 4)
        edges = np.flatnonzero(np.diff(np.r_[False, equal, False].view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        need, behind = size * (least - 1), 0
        long = ends - starts >= need
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            start = max(start, behind)
            if end - start >= need:
                behind = start + size * (1 + (end - start) // size)
                yield size, start, behind


def find_ssrs(seq: str | None) -> list[dict]:
    """Short tandem repeats of one sequence: motif, repeats, start and end (1-based, inclusive); the first found at a start stays.

    Repeats of one letter, under whatever motif length, count only where the sequence has no other; then all runs of 20 or more stand.
    """
    return [r for _, r in ssrs_of([seq])]


def ssrs_of(seqs: list[str | None]) -> list[tuple[int, dict]]:
    """(number of the sequence, repeat) of ``find_ssrs`` for several sequences, which are searched end to end."""
    lower = [(t or "").lower() for t in seqs]
    begins = np.cumsum([0, *(len(t) + 1 for t in lower)])
    text = "\n".join(lower)
    found: dict[int, dict[int, dict]] = {}
    runs: dict[int, list[dict]] = {}
    for size, start, end in _repeats(text):
        of = int(np.searchsorted(begins, start, side="right")) - 1
        at, motif = start - int(begins[of]), text[start : start + size]
        row = {"motif": motif, "repeats": (end - start) // size, "start": at + 1, "end": end - int(begins[of])}
        if len(set(motif)) > 1:
            found.setdefault(of, {}).setdefault(at, row)
        elif size == 1:
            runs.setdefault(of, []).append(row)
    return [(of, r) for of in sorted(found.keys() | runs.keys()) for r in ([found[of][k] for k in sorted(found[of])] if of in found else runs[of])]


def ssr_scan(df: DataFrame, seq_id: str, seq: str) -> DataFrame:
    """(seq_id, motif, repeats, start, end): back-references need the positions of matches, so this runs in Arrow batches."""
    kind = df.schema[seq_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = ssrs_of(part.column(1).to_pylist())
                columns = [pa.array([r[c] for _, r in rows], t) for c, t in (("motif", pa.string()), ("repeats", pa.int32()), ("start", pa.int32()), ("end", pa.int32()))]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([of for of, _ in rows], pa.int64())), *columns], names=[seq_id, "motif", "repeats", "start", "end"])

    return df.select(seq_id, seq).mapInArrow(run, f"`{seq_id}` {kind}, motif string, repeats int, start int, end int")


def ssr_summary(ssrs: DataFrame, lengths: DataFrame, seq_id: str, length: str) -> DataFrame:
    """(seq_id, motif, percent): share of the sequence in repeats of each canonical motif."""
    total = ssrs.withColumn("motif", canonical_motif(F.col("motif"))).groupBy(seq_id, "motif").agg(F.sum(F.col("repeats") * F.length("motif")).alias("bp"))
    return total.join(lengths.select(seq_id, length), seq_id).select(seq_id, "motif", (100 * F.col("bp") / F.col(length)).alias("percent"))


def describe_ssrs(summary: DataFrame, sequences: DataFrame, seq_id: str, digits: int = 2) -> DataFrame:
    """(seq_id, description): 'MOTIF (12.34%25), ...' by share, largest first, ties by motif; empty where there are no repeats."""
    listed = summary.groupBy(seq_id).agg(F.array_sort(F.collect_list(F.struct((-F.col("percent")).alias("o"), F.col("motif").alias("m")))).alias("x"))
    text = F.array_join(F.transform("x", lambda x: F.concat(x["m"], F.lit(" ("), F.format_string(f"%.{digits}f", -x["o"]), F.lit("%25)"))), ", ")
    return sequences.select(seq_id).join(listed, seq_id, "left").select(seq_id, F.coalesce(text, F.lit("")).alias("description"))


def ssr_coverage(ssrs: DataFrame, lengths: DataFrame, seq_id: str, length: str) -> DataFrame:
    """(seq_id, covered): the share of each sequence under the union of its repeats; 0 without any."""
    union = union_length(ssrs.select(seq_id, F.col("start").cast("long").alias("s"), F.col("end").cast("long").alias("e")), [seq_id]).withColumnRenamed("length", "__bp")
    return lengths.select(seq_id, length).join(union, seq_id, "left").select(seq_id, (F.coalesce("__bp", F.lit(0)) / F.nullif(F.col(length), F.lit(0))).alias("covered"))


def is_homopolymer(seq: Column, n: int) -> Column:
    """Whether a sequence holds one letter ``n`` times in a row or more."""
    return F.rlike(F.lower(seq), F.lit(rf"([gatc])\1{{{n - 1},}}"))


def motif_length(attributes: Column) -> Column:
    """Letters of the motif behind ``ssr=`` in an attribute text; null without one."""
    return F.nullif(F.length(F.regexp_extract(attributes, r"ssr=\s*([A-Za-z]+)", 1)), F.lit(0))


def parse_ssr_list(text: Column, least: float = 10.0, times: int = 200) -> Column:
    """(motif, percent, seq) of the items of 'MOTIF (p%), ...' above ``least``, each motif repeated ``times`` times."""
    items = F.transform(F.split(text, ", "), lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z]+)", 1).alias("motif"), F.regexp_extract(x, r"\(([0-9.]+)%", 1).try_cast("double").alias("percent")))
    return F.transform(F.filter(items, lambda x: x["percent"] > least), lambda x: F.struct(x["motif"], x["percent"], F.repeat(x["motif"], F.lit(times)).alias("seq")))


def tiled(seq: Column, least: int = 4000) -> Column:
    """A library sequence repeated whole until one more repetition would pass ``least`` letters; longer ones stay as they are."""
    return F.when(F.length(seq).between(1, least - 1), F.repeat(seq, F.floor(least / F.length(seq)).cast("int"))).otherwise(seq)


def subsequences(features: DataFrame, seqs: DataFrame, seq_id: str = "seqid", seq: str = "seq", s: str = "s", e: str = "e") -> DataFrame:
    """(id, seq) of features on sequences, 1-based and inclusive; the id is seqid_start_end."""
    joined = features.select(seq_id, s, e).join(seqs.select(seq_id, seq), seq_id)
    return joined.select(F.concat_ws("_", F.col(seq_id).cast("string"), F.col(s).cast("string"), F.col(e).cast("string")).alias("id"), F.substring(F.col(seq), F.col(s).cast("int"), (F.col(e) - F.col(s) + 1).cast("int")).alias("seq"))


def multimer(seq: Column, size: int = 10_000) -> Column:
    """A sequence repeated beyond ``size`` and cut to it."""
    times = F.bround(1 + size / F.length(seq)).cast("int")
    return F.substring(F.repeat(seq, times), 1, size)


def base_tally(df: DataFrame, seq_id: str, seq: str, period: int) -> DataFrame:
    """(seq_id, pos, base, n): counts of A, C, G and T at each position modulo the period."""

    def each(letters: Letters) -> tuple[np.ndarray, dict]:
        code = np.full(256, 4, np.int64)
        code[[ord(b) for b in "ACGT"]] = range(4)
        base = code[np.where(letters.points < 256, letters.points, 0)]
        known = base < 4
        owner, pos, base = letters.owner[known], letters.place[known] % period, base[known]
        first, n = tallied(owner, pos, base)
        return owner[first], {"pos": pos[first].astype(np.int32), "base": pa.array(list("ACGT")).take(pa.array(base[first])), "n": n}

    return by_sequence(df.select(seq_id, F.upper(F.col(seq)).alias("__seq")), seq_id, "__seq", each, "pos int, base string, n long")


def consensus(tally: DataFrame, seq_id: str, pseudo: float = 0.5) -> DataFrame:
    """(seq_id, pos, base, share, entropy): the commonest base (ties in the order A, C, G, T), its share and the column's entropy in bits, with pseudocounts."""
    wide = tally.groupBy(seq_id, "pos").pivot("base", ["A", "C", "G", "T"]).agg(F.sum("n")).na.fill(0)
    total = sum((F.col(b) for b in "CGT"), F.col("A")) + 4 * pseudo
    share = {b: (F.col(b) + pseudo) / total for b in "ACGT"}
    top = F.greatest(*share.values())
    base = F.when(share["A"] == top, "A").when(share["C"] == top, "C").when(share["G"] == top, "G").otherwise("T")
    entropy = -sum((p * F.log2(p) for p in list(share.values())[1:]), share["A"] * F.log2(share["A"]))
    return wide.select(seq_id, "pos", base.alias("base"), top.alias("share"), entropy.alias("entropy"))


def anchor_kmer(df: DataFrame, seq_id: str, seq: str, k: int, period: int, least: int) -> DataFrame:
    """(seq_id, kmer, phase_share, n): the k-mer whose occurrences agree best on a phase, among those seen ``least`` times or more; ties by count, then k-mer."""

    def each(letters: Letters) -> tuple[np.ndarray, dict]:
        where, rank = letters.kmers(k)
        at, c = tallied(letters.owner[where], rank, letters.place[where] % period)
        where, rank = where[at], rank[at]
        owner = letters.owner[where]
        starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (rank[1:] != rank[:-1])][: len(owner)])
        n, top = (f.reduceat(c, starts) if len(starts) else c for f in (np.add, np.maximum))
        often = n >= least
        where, rank, n, top = where[starts][often], rank[starts][often], n[often], top[often]
        owner, share = letters.owner[where], top / n
        order = np.lexsort((rank, -n, -share, owner))
        best = order[np.r_[True, owner[order][1:] != owner[order][:-1]][: len(order)]]
        return owner[best], {"kmer": letters.texts(where[best], rank[best], k), "phase_share": share[best], "n": n[best]}

    return by_sequence(df, seq_id, seq, each, "kmer string, phase_share double, n long")


def dust_score(df: DataFrame, seq_id: str, seq: str, window: int = 64) -> DataFrame:
    """(seq_id, window_no, score): triplet repetition, sum c (c - 1) / 2 over the triplets of each window, by their number less one."""

    def each(letters: Letters) -> tuple[np.ndarray, dict]:
        where, rank = letters.kmers(3)
        owner, number = letters.owner[where], letters.place[where] // window
        first, c = tallied(owner, number, rank)
        owner, number = owner[first], number[first]
        starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])][: len(owner)])
        pairs, n = (np.add.reduceat(v, starts) if len(starts) else v for v in (c * (c - 1) // 2, c))
        return owner[starts], {"window_no": number[starts], "score": pairs / np.maximum(n - 1, 1)}

    return by_sequence(df, seq_id, seq, each, "window_no long, score double")


def masked_share(scores: DataFrame, sequences: DataFrame, seq_id: str, level: float = 2.0) -> DataFrame:
    """(seq_id, share): the share of a sequence's windows whose triplet repetition is above ``level``; 0 for sequences without a window."""
    over = scores.groupBy(seq_id).agg(F.avg((F.col("score") > level).cast("int")).alias("share"))
    return sequences.select(seq_id).join(over, seq_id, "left").select(seq_id, F.coalesce("share", F.lit(0.0)).alias("share"))


def _commoner_half(texts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The commoner half of the k-mers as numbers of 7 bits a letter; with other letters than ASCII's, or too many, as rows of letters."""
    windows = [np.lib.stride_tricks.sliding_window_view(t, k) for t in texts if len(t) >= k]
    if not windows:
        return np.zeros(0, np.int64), None
    place, every = np.concatenate([np.arange(len(w)) for w in windows]), np.concatenate(windows)
    packed = k <= 8 and int(every.max()) < 128
    key = _packed(every) if packed else np.unique(every, axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    counts, first = np.diff(np.r_[starts, len(key)]), np.minimum.reduceat(place[order], starts)
    half = order[starts[np.lexsort((first, -counts))[: len(starts) // 2]]]
    return (key[half], None) if packed else (np.zeros(0, np.int64), every[half])


def _packed(windows: np.ndarray) -> np.ndarray:
    key = np.zeros(len(windows), np.int64)
    for j in range(windows.shape[1]):
        key = key << 7 | windows[:, j]
    return key


def _met(half: tuple[np.ndarray, np.ndarray | None], numbers: np.ndarray, rows: set[bytes]) -> int:
    key, other = half
    if other is not None:
        return sum(row.tobytes() in rows for row in other)
    at = np.searchsorted(numbers, key)
    return int((numbers[np.minimum(at, len(numbers) - 1)] == key).sum()) if len(numbers) else 0


def orientation(df: DataFrame, group: str, seq_id: str, seq: str, k: int = 8) -> DataFrame:
    """(group, seq_id, forward): whether the commoner half of a sequence's k-mers meets more of its group's longest sequence than the commoner half of its reverse complement's does.

    Half of the distinct k-mers, rounded down, the most frequent first and of equal ones the first met. Ties between directions count as
    reversed; of the longest sequences the one with the smallest id is the reference. A group is dealt out in parts of about ``PART``
    rows, and its reference goes to each part ahead of them; k-mers are no rows.
    """
    of, kind = (df.schema[c].dataType.simpleString() for c in (group, seq_id))
    usable = df.where(F.col(group).isNotNull() & F.col(seq_id).isNotNull() & F.col(seq).isNotNull()).select(group, seq_id, F.upper(F.col(seq)).alias("__s"))
    parts = usable.groupBy(group).agg(F.ceil(F.count("*") / PART).cast("int").alias("__parts"), F.min(F.struct((-F.length("__s")).alias("o"), F.col(seq_id).alias("i"))).alias("__first"))
    parts = written(parts.select(group, "__parts", F.col("__first.i").alias(seq_id)))
    longest = usable.join(parts, [group, seq_id]).groupBy(group, seq_id, "__parts").agg(F.max_by("__s", F.struct(F.length("__s"), "__s")).alias("__s"))
    ahead = longest.select(group, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"), F.lit(0).alias("__kind"), seq_id, "__s")
    own = usable.join(parts.drop(seq_id), group).select(group, F.pmod(F.xxhash64(seq_id), F.col("__parts")).cast("int").alias("__part"), F.lit(1).alias("__kind"), seq_id, "__s")
    rows = ahead.unionByName(own).repartition(group, "__part").sortWithinPartitions(group, "__part", "__kind", seq_id)
    complement = np.arange(128, dtype=np.uint32)
    complement[[ord(b) for b in BASES]] = [ord(b) for b in COMPLEMENTS]

    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, others, held, texts, types = np.zeros(0, np.int64), set(), None, [], None

        def vote() -> bool:
            back = [np.where(t < 128, complement[np.minimum(t, 127)], t)[::-1] for t in texts]
            return _met(_commoner_half(texts, k), numbers, others) > _met(_commoner_half(back, k), numbers, others)

        for batch in batches:
            types, out = (batch.column(0).type, batch.column(3).type), []
            for name, first, key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if held is not None and (first == 0 or held != (name, key)):
                    out.append((*held, vote()))
                    held, texts = None, []
                if first == 0:
                    p = points(text)
                    windows = np.lib.stride_tricks.sliding_window_view(p, k) if len(p) >= k else np.zeros((0, k), np.uint32)
                    plain = (windows < 128).all(axis=1) & (k <= 8)
                    numbers, others = np.unique(_packed(windows[plain])), {w.tobytes() for w in windows}
                else:
                    held = (name, key)
                    texts.append(points(text))
            yield _votes(out, types, group, seq_id)
        if held is not None:
            yield _votes([(*held, vote())], types, group, seq_id)

    found = rows.mapInArrow(run, f"`{group}` {of}, `{seq_id}` {kind}, forward boolean")
    return df.select(group, seq_id).join(found, [group, seq_id], "left").select(group, seq_id, F.coalesce("forward", F.lit(False)).alias("forward"))


def _votes(rows: list[tuple], types: tuple, group: str, seq_id: str) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((*types, pa.bool_()))]
    return pa.RecordBatch.from_arrays(columns, names=[group, seq_id, "forward"])
