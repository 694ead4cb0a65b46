"""Interval algebra on closed integer intervals [start, end], as DataFrame operators.

Inputs have a start and an end column of type long and any key columns. Range joins get an equality key from coordinate bins,
so they run as hash or sort-merge joins with a residual and never as nested loops; ``width`` is the bin's size. By default it is
taken from the rows (``fit_width``, one aggregate over keys, starts and ends): no bins where keys are small, else as many rows a bin.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import cut

WIDTH = 1 << 16
AUTO = 0  # a width taken from the rows
BIN_ROWS, JOIN_ROWS = 1 << 16, 256  # rows that a bin holds on average: of those that are sorted, and of those that meet in a join


def fit_width(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", rows: int = BIN_ROWS) -> int | None:
    """The size of bins that hold about ``rows`` rows where keys have more than that, and are no narrower than intervals are on average; None where no key has.

    It runs a job: a row a key is aggregated, and one comes to the driver.
    """
    each = df.groupBy(*keys).agg(F.count(s).alias("n"), F.min(s).alias("low"), F.max(s).alias("high"), F.sum((F.col(e) - F.col(s) + 1).cast("double")).alias("long")).where(F.col("n") > rows)
    found = each.agg(F.sum("n").alias("n"), F.sum((F.col("high") - F.col("low") + 1).cast("double")).alias("extent"), F.sum("long").alias("long")).first()
    return max(1, int(found["extent"] / found["n"] * rows), int(found["long"] / found["n"])) if found["n"] else None


def _join_width(width: int, df: DataFrame, keys: Sequence[str], s: str, e: str) -> int:
    """A given width, or one that suits a join; a key with few rows is one bin."""
    return width or fit_width(df, keys, s, e, JOIN_ROWS) or 1 << 40


def _islands(df: DataFrame, keys: Sequence[str], s: str, e: str, touch: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(s, e)
    reach = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(s) > reach + touch), 1).otherwise(0)
    numbered = df.withColumn("__new", fresh).withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__island").agg(F.min(s).alias(s), F.max(e).alias(e), F.sum("__n").alias("__n")).drop("__island")


def _carried(bins: DataFrame, keys: Sequence[str], value: str, into: str, how: Callable[[str], Column], last: int = -1) -> DataFrame:
    """(keys, __bin, into): an aggregate of a per-bin value over the bins before. What is ordered is one row for each occupied bin."""
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, last)
    return bins.select(*keys, "__bin", how(value).over(before).alias(into))


def merge_intervals(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", touch: int = 1, width: int | None = AUTO) -> DataFrame:
    """(keys, s, e, n): maximal runs of intervals that overlap or lie within ``touch`` of each other, and how many made each.

    Intervals are merged within coordinate bins of ``width`` first; an island belongs to the bin of its start. Islands that the greatest end
    of earlier bins reaches continue a run and are added up by bin, and only the last island that starts a run in its bin can be
    continued. So a key's final pass orders at most two rows a bin. Without a width a key's rows are ordered as they are. Other columns
    are dropped; rows with a null end are left out.
    """
    width = fit_width(df, keys, s, e) if width == AUTO else width
    rows = df.select(*keys, s, e).where(F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn("__n", F.lit(1).cast("long"))
    if not width:
        return _islands(rows, keys, s, e, touch).withColumnRenamed("__n", "n")
    by = [*keys, "__bin"]
    islands = _islands(rows.withColumn("__bin", F.floor(F.col(s) / width)), by, s, e, touch)
    reach = _carried(islands.groupBy(*by).agg(F.max(e).alias("__top")), keys, "__top", "__reach", F.max)
    fresh = F.col("__reach").isNull() | (F.col(s) > F.col("__reach") + touch)
    last = F.max(F.when(F.col("__fresh"), F.col(s))).over(Window.partitionBy(*by))
    placed = islands.join(reach, by).withColumn("__fresh", fresh).withColumn("__last", last)
    inner = F.col("__fresh") & (F.col(s) < F.col("__last"))
    done = placed.where(inner).select(*keys, s, e, "__n")
    edge = placed.where(~inner).groupBy(*by, "__fresh").agg(F.min(s).alias(s), F.max(e).alias(e), F.sum("__n").alias("__n"))
    runs = _islands(edge.select(*keys, s, e, "__n"), keys, s, e, touch)
    return done.unionByName(runs).withColumnRenamed("__n", "n")


def union_length(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", inclusive: bool = True, width: int | None = AUTO) -> DataFrame:
    """(keys, length): positions covered by the union; ``inclusive=False`` counts end - start of each merged run."""
    return merge_intervals(df, keys, s, e, width=width).groupBy(*keys).agg(F.sum(F.col(e) - F.col(s) + (1 if inclusive else 0)).alias("length"))


def total_span(df: DataFrame, name: str, s: str = "s", e: str = "e") -> DataFrame:
    """(name, size): the sum of end - start over all rows of a name, overlaps counted again."""
    return df.groupBy(name).agg(F.sum(F.col(e) - F.col(s)).alias("size"))


def rank_families(df: DataFrame, name: str, inner_keys: Sequence[str], s: str = "s", e: str = "e", prefix: str = "FAM_") -> DataFrame:
    """Families ranked by merged size (sum of end - start), largest first, ties by name: (name, size, rank, family)."""
    sizes = union_length(df, [name, *inner_keys], s, e, inclusive=False).groupBy(name).agg(F.sum("length").alias("size"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("size").desc(), name)))
    return ranked.withColumn("family", F.concat(F.lit(prefix), F.col("rank").cast("string")))


def _in_bins(df: DataFrame, s: Column, e: Column, width: int) -> DataFrame:
    return df.withColumn("__bin", F.explode(F.sequence(F.floor(s / width), F.floor(e / width))))


def _with_next(points: DataFrame, keys: Sequence[str], at: str, into: str, width: int) -> DataFrame:
    """Points with the next one of their key: within coordinate bins, and for a bin's last point the first one of the next occupied bin."""
    by = [*keys, "__bin"]
    binned = points.withColumn("__bin", F.floor(F.col(at) / width))
    firsts = binned.groupBy(*by).agg(F.min(at).alias("__first"))
    after = firsts.select(*by, F.lead("__first").over(Window.partitionBy(*keys).orderBy("__bin")).alias("__after"))
    inside = F.lead(at).over(Window.partitionBy(*by).orderBy(at))
    return binned.withColumn(into, inside).join(after, by).withColumn(into, F.coalesce(into, "__after")).drop("__after")


def segments(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """(keys, a, b): the half-open pieces between neighbouring breakpoints (starts, and ends + 1) of each key."""
    width = width or fit_width(df, keys, s, e) or 1 << 40
    points = df.select(*keys, F.explode(F.array(F.col(s), F.col(e) + 1)).alias("a")).distinct()
    return _with_next(points, keys, "a", "b", width).where(F.col("b").isNotNull()).drop("__bin")


def covering(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """Each piece of ``segments`` with every interval that covers it."""
    width = _join_width(width, df, keys, s, e)
    pieces = segments(df, keys, s, e, width).withColumn("__bin", F.floor(F.col("a") / width))
    return _in_bins(df, F.col(s), F.col(e), width).join(pieces, [*keys, "__bin"]).where((F.col(s) <= F.col("a")) & (F.col(e) + 1 >= F.col("b"))).drop("__bin")


def split_segments(df: DataFrame, keys: Sequence[str], name: str = "name", s: str = "s", e: str = "e", width: int = AUTO, strand: str | None = None) -> DataFrame:
    """(keys, s, e, names): disjoint pieces and the sorted, '|'-joined set of the names over each.

    With ``strand`` a piece also has that column: the strand that all intervals over it share, else '.'.
    """
    names = F.array_join(F.array_sort(F.collect_set(name)), "|").alias("names")
    common = [F.when(F.min(strand) == F.max(strand), F.min(strand)).otherwise(".").alias(strand)] if strand else []
    found = covering(df, keys, s, e, width).groupBy(*keys, "a", "b").agg(names, *common)
    return found.select(*keys, F.col("a").alias("s"), (F.col("b") - 1).alias("e"), "names", *([strand] if strand else []))


def drop_ambiguous(pieces: DataFrame, names: str = "names") -> DataFrame:
    """Pieces under a single name."""
    return pieces.where(~F.contains(names, F.lit("|")))


def contained(df: DataFrame, outer: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """Rows of ``df`` that lie within some interval of ``outer`` with equal keys.

    The greatest outer end among earlier starts decides it, within coordinate bins and carried from bin to bin: no pairs are formed.
    """
    width = width or fit_width(df, keys, s, e) or 1 << 40
    by = [*keys, "__bin"]
    data = df.withColumn("__outer", F.lit(1))
    other = outer.select(*keys, s, e).withColumn("__outer", F.lit(0))
    both = data.unionByName(other, allowMissingColumns=True).withColumn("__bin", F.floor(F.col(s) / width))
    order = Window.partitionBy(*by).orderBy(s, "__outer").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("__outer") == 0, F.col(e))).over(order)
    tops = _carried(both.groupBy(*by).agg(F.max(F.when(F.col("__outer") == 0, F.col(e))).alias("__top")), keys, "__top", "__before", F.max)
    held = both.withColumn("__reach", reach).where("__outer = 1").join(tops, by)
    return held.where(F.greatest("__reach", "__before") >= F.col(e)).select(*df.columns)


def best_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """(left_id, right_id, overlap): for each left row the right row it shares most positions with; ties go to the smaller right id."""
    width = _join_width(width, right, keys, s, e)
    a = _in_bins(left.select(*keys, left_id, F.col(s).alias("ls"), F.col(e).alias("le")), F.col("ls"), F.col("le"), width)
    b = _in_bins(right.select(*keys, right_id, F.col(s).alias("rs"), F.col(e).alias("re")), F.col("rs"), F.col("re"), width)
    met = a.join(b, [*keys, "__bin"]).where((F.col("ls") <= F.col("re")) & (F.col("rs") <= F.col("le")) & (F.col("__bin") == F.floor(F.greatest("ls", "rs") / width)))
    scored = met.withColumn("overlap", F.least("le", "re") - F.greatest("ls", "rs") + 1)
    best = scored.groupBy(left_id).agg(F.min(F.struct((-F.col("overlap")).alias("w"), F.col(right_id).alias("r"))).alias("best"))
    return best.select(left_id, F.col("best.r").alias(right_id), (-F.col("best.w")).alias("overlap"))


def resolve_overlaps(df: DataFrame, keys: Sequence[str], name: str = "name", s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """(keys, name, s, e): contested positions go to the name of the greatest total length, then the greatest name.

    Total length is the sum of end - start over all rows of a name. Neighbouring pieces of one name are joined again.
    """
    final = width or fit_width(df, [*keys, name], s, e)
    width = _join_width(width, df, keys, s, e)
    totals = df.groupBy(name).agg(F.sum(F.col(e) - F.col(s)).alias("__total"))
    owned = covering(df.join(totals, name), keys, s, e, width).groupBy(*keys, "a", "b").agg(F.max(F.struct("__total", name)).alias("w"))
    pieces = owned.select(*keys, F.col(f"w.{name}").alias(name), F.col("a").alias(s), (F.col("b") - 1).alias(e))
    return merge_intervals(pieces, [*keys, name], s, e, width=final).drop("n")


def absorbed_names(df: DataFrame, resolved: DataFrame, name: str = "name") -> DataFrame:
    """Names that own no position after resolution."""
    return df.select(name).distinct().join(resolved.select(name).distinct(), name, "left_anti")


def extend(df: DataFrame, sizes: DataFrame, name: str = "name", size: str = "size", fraction: float = 0.05, s: str = "s", e: str = "e") -> DataFrame:
    """Widen both ends by min(size of the name, 2 * fraction * (end - start)), truncated; starts stay at 1 or above."""
    by = F.least(F.col(size).cast("double"), (F.col(e) - F.col(s)) * 2 * fraction).cast("long")
    return df.join(sizes.select(name, size), name).withColumns({s: F.greatest(F.lit(1).cast("long"), F.col(s) - by), e: F.col(e) + by}).drop(size)


def gaps(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e") -> DataFrame:
    """(keys, n_gaps, max_gap, gap_total) between the merged intervals of each key."""
    after = F.lead(s).over(Window.partitionBy(*keys).orderBy(s)) - F.col(e) - 1
    return merge_intervals(df, keys, s, e).withColumn("gap", after).groupBy(*keys).agg(F.count("gap").alias("n_gaps"), F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_total"))


def depth(df: DataFrame, keys: Sequence[str], s: str = "s", e: str = "e", width: int = AUTO) -> DataFrame:
    """(keys, s, e, depth): pieces of constant, positive coverage depth, from counted entries and exits.

    The running sum is taken within coordinate bins, on top of the sum of the bins before.
    """
    width = width or fit_width(df, keys, s, e) or 1 << 40
    steps = df.select(*keys, F.explode(F.array(F.struct(F.col(s).alias("p"), F.lit(1).alias("d")), F.struct((F.col(e) + 1).alias("p"), F.lit(-1).alias("d")))).alias("x"))
    summed = steps.groupBy(*keys, F.col("x.p").alias("p")).agg(F.sum("x.d").alias("d"))
    by = [*keys, "__bin"]
    run = _with_next(summed, keys, "p", "next", width)
    before = _carried(run.groupBy(*by).agg(F.sum("d").alias("__sum")), keys, "__sum", "__before", F.sum)
    inside = F.sum("d").over(Window.partitionBy(*by).orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
    deep = run.withColumn("depth", inside).join(before, by).withColumn("depth", F.col("depth") + F.coalesce("__before", F.lit(0)))
    return deep.where("depth > 0").select(*keys, F.col("p").alias("s"), (F.col("next") - 1).alias("e"), "depth")


def deduplicate(df: DataFrame, keys: Sequence[str], last: str) -> DataFrame:
    """Of rows with equal keys, the one with the greatest ``last`` stays."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*(c for c in df.columns if c not in keys)), last).alias("r")).select(*keys, "r.*")


def split_by_length(df: DataFrame, minimum: int, s: str = "s", e: str = "e") -> tuple[DataFrame, DataFrame]:
    """(long, short): rows with end - start above ``minimum``, and the rest."""
    return df.where(F.col(e) - F.col(s) > minimum), df.where(~(F.col(e) - F.col(s) > minimum))


def chunk_map(sizes: DataFrame, seq: str, length: str, chunk: int, overlap: int) -> DataFrame:
    """(seq, chunk_no, start0, end0): half-open chunks; only sequences over twice the chunk size are cut, each chunk runs on by ``overlap``."""
    n = F.when(F.col(length) > 2 * chunk, F.floor(F.col(length) / chunk)).otherwise(F.lit(1)).cast("long")
    parts = sizes.select(seq, length, n.alias("__n")).withColumn("__step", F.floor(F.col(length) / F.col("__n"))).withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    end = F.when(F.col("chunk_no") == F.col("__n") - 1, F.col(length)).otherwise(F.least(F.col(length), (F.col("chunk_no") + 1) * F.col("__step") + overlap))
    return parts.select(seq, "chunk_no", (F.col("chunk_no") * F.col("__step")).alias("start0"), end.alias("end0"))


def to_chunks(df: DataFrame, chunks: DataFrame, seq: str, s: str = "s", e: str = "e", width: int = WIDTH) -> DataFrame:
    """One row for each chunk that holds an interval whole, in the chunk's own coordinates.

    A chunk that holds an interval holds its start, so intervals meet the chunks over the bin of their start only; ``width`` is best
    about a chunk's size.
    """
    over = _in_bins(chunks, F.col("start0"), F.col("end0") - 1, width)
    met = df.withColumn("__bin", F.floor(F.col(s) / width)).join(over, [seq, "__bin"]).where((F.col("start0") <= F.col(s)) & (F.col(e) < F.col("end0")))
    return met.withColumn(s, F.col(s) - F.col("start0")).withColumn(e, F.col(e) - F.col("start0")).drop("start0", "end0", "__bin")


def from_chunks(df: DataFrame, chunks: DataFrame, seq: str, s: str = "s", e: str = "e") -> DataFrame:
    """Chunk coordinates back to those of the sequence."""
    return df.join(chunks.select(seq, "chunk_no", "start0"), [seq, "chunk_no"]).withColumn(s, F.col(s) + F.col("start0")).withColumn(e, F.col(e) + F.col("start0")).drop("start0")


def mask_sequences(seqs: DataFrame, regions: DataFrame, seq_id: str = "seq_id", seq: str = "seq", s: str = "s", e: str = "e", letter: str = "N", block: int = WIDTH) -> DataFrame:
    """(seq_id, seq): sequences with the union of their regions (1-based, inclusive) overwritten by ``letter``.

    Sequences are cut into blocks of ``block`` letters, which are masked apart and put together again: no region makes its whole sequence be
    copied. Ids are unique; a null sequence stays null, and one without regions as it is.
    """
    merged = merge_intervals(regions, [seq_id], s, e).where(F.col(e) >= 1).select(seq_id, F.greatest(F.col(s), F.lit(1)).alias("__s"), F.col(e).alias("__e"))
    parts = merged.select(seq_id, "__s", "__e", F.explode(F.sequence(F.floor((F.col("__s") - 1) / block), F.floor((F.col("__e") - 1) / block))).alias("__block"))
    low = F.col("__block") * block
    local = F.struct(F.greatest(F.col("__s") - low, F.lit(1)).cast("int").alias("s"), F.least(F.col("__e") - low, F.lit(block)).cast("int").alias("e"))
    spans = parts.groupBy(seq_id, "__block").agg(F.array_sort(F.collect_list(local)).alias("r"))
    blocks = seqs.select(seq_id, F.posexplode(F.regexp_extract_all(F.col(seq), F.lit(f"(?s).{{1,{block}}}"), F.lit(0))).alias("__block", "__text")).withColumn("__block", F.col("__block").cast("long"))

    def piece(r: Column, i: Column) -> Column:
        at = F.coalesce(F.get(F.col("r"), i - 1)["e"], F.lit(0))
        covered = F.greatest(F.lit(0), F.least(r["e"], F.length("__text")) - r["s"] + 1)
        return F.concat(F.substring(F.col("__text"), at + 1, r["s"] - at - 1), F.repeat(F.lit(letter), covered))

    rest = F.substring(F.col("__text"), F.element_at("r", -1)["e"] + 1, F.length("__text"))
    masked = F.when(F.col("r").isNull(), F.col("__text")).otherwise(F.concat(F.array_join(F.transform("r", piece), ""), rest))
    whole = blocks.join(spans, [seq_id, "__block"], "left").select(seq_id, F.struct("__block", masked.alias("t")).alias("b")).groupBy(seq_id).agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["t"]), "").alias("__masked"))
    return seqs.join(whole, seq_id, "left").select(seq_id, F.coalesce("__masked", seq).alias(seq))


def reannotate(hits: DataFrame, lengths: DataFrame, seq: str = "seqid", name: str = "name", fraction: float = 0.05) -> DataFrame:
    """Library hits to clean, unambiguous spans: merge, extend, merge, drop the short, keep what extended spans contain, split, drop the ambiguous.

    ``lengths`` has (name, size), the longest library entry of each name. What is read several times, the merged and the
    contained spans, is checkpointed; the width of bins is taken from the hits once.
    """
    width = fit_width(hits, [seq, name])
    merged = cut(merge_intervals(hits, [seq, name], width=width).drop("n"))
    widened = merge_intervals(extend(merged, lengths, name, "size", fraction), [seq, name], width=width).drop("n")
    long_enough = widened.join(lengths, name).where(F.col("e") - F.col("s") >= F.col("size")).drop("size")
    held = cut(contained(merged, long_enough, [seq, name], width=width or 1 << 40))
    return drop_ambiguous(split_segments(held, [seq], name))
