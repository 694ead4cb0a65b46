"""Mixing sources to target weights by capped water-filling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.columns import set_apart
from spanloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SEED = 17
BUCKET_BITS = 42  # of 52: 1024 buckets
BROADCAST_ROWS = 500_000


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, size: str = "source_size", weight: str = "weight", max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add each source's ``target``: its share by weight of the sum of all sizes, at most ``max_epochs`` times its size.

    Clamping the sources above their cap and resharing the excess by weight until none is above has one fixed point,
    found directly: with sources in order of cap over weight, a source is clamped if the level that remains once all
    before it are clamped is above its own ratio. ``sources`` has one row for each source.
    """
    everything = Window.partitionBy()
    before = Window.orderBy("__ratio", F.col(weight), F.col(size), "__tie").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col(size) * F.lit(max_epochs)
    ranked = (
        sources.withColumn("__ratio", cap / F.col(weight))
        .withColumn("__tie", F.xxhash64(*(c for c in sources.columns)))
        .withColumn("__left", F.sum(size).over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("__weight_left", F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0)))
        .withColumn("__level", F.col("__left") / F.col("__weight_left"))
        .withColumn("__clamped", F.col("__level") > F.col("__ratio"))
    )
    level = F.min(F.when(~F.col("__clamped"), F.struct("__ratio", F.col(weight), F.col(size), "__tie", "__level"))).over(everything)["__level"]
    filled = ranked.withColumn("target", F.when(F.col("__clamped"), cap.cast("double")).otherwise(F.col(weight) * level))
    return filled.drop("__ratio", "__tie", "__left", "__weight_left", "__level", "__clamped")


def _draw(id_col: Column, seed: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), F.lit(str(seed))).cast("binary")), 1, 13), 16, 10).cast("long")


def _plan(groups: DataFrame, max_epochs: int) -> DataFrame:
    """One row a source: source_size, target, whole repetitions, and the group of rows in which the rest ends (t_key, t_reach, t_n).

    ``groups`` has (doc_id, source, size, n, draw, bucket). The run that makes up the rest is found from hash-bucket sums: only the bucket in
    which it ends is ordered group by group.
    """
    sums = groups.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    per_source = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    weighed = per_source.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    want = F.round("target").cast("long")
    plan = cut(
        water_fill(weighed, max_epochs=max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("rest", want - F.col("whole") * F.col("source_size"))
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    ends = _by_source(buckets, plan.select("source", "rest")).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    ends = ends.select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), (F.col("rest") - F.col("before")).alias("left"))
    last = groups.join(ends, groups["source"].eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b"))).drop("__s", "__b")
    inside = Window.partitionBy("source").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("n")
    ordered = last.withColumn("reach", F.col("left") - F.coalesce(F.sum(words).over(inside), F.lit(0))).where((F.col("reach") >= 0) & (F.col("reach") < words))
    turn = ordered.select("source", F.struct("draw", "doc_id", "size").alias("t_key"), F.col("reach").alias("t_reach"), F.col("n").alias("t_n"))
    return cut(_by_source(plan, turn, "left"))


def _by_source(df: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Join with a table of one row a source, by broadcast where there are at most ``BROADCAST_ROWS`` of them."""
    named = sources.withColumnRenamed("source", "__source")
    named = F.broadcast(named) if sources.count() <= BROADCAST_ROWS else named
    return df.join(named, df["source"].eqNullSafe(F.col("__source")), how).drop("__source")


def _extra(key: Column, size: Column, k: Column) -> Column:
    """What the rest takes of a row: all of it before the last group, and in that what is left for the k-th of its equal rows."""
    partly = F.greatest(F.lit(0), F.least(size, F.col("t_reach") - k * size))
    return F.when(F.col("t_key").isNull(), F.lit(0)).when(key < F.col("t_key"), size).when(key == F.col("t_key"), partly).otherwise(F.lit(0))


def _grouped(rows: DataFrame, seed: int) -> DataFrame:
    counted = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    return cut(counted.withColumn("draw", _draw(F.col("doc_id"), seed)).withColumn("bucket", F.shiftright("draw", BUCKET_BITS)))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, taken.

    size counts words; sources in code-point order, null last, weigh 1, 2, 3, repeating. A source's target, rounded to
    words, is taken as so many whole repetitions of every document, and the rest as a run of documents in the order of a
    seeded hash of the id; the last document of the run is taken in part, so a source's taken words
    equal its rounded target and no document exceeds ``max_epochs`` times its size. Documents of no words
    are taken as 0. Rows equal in id, source and size are counted first and share what their group takes. Empty input gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    groups = _grouped(rows, seed)
    planned = _by_source(groups, _plan(groups, max_epochs))
    spread = planned.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    extra = _extra(F.struct("draw", "doc_id", "size"), F.col("size"), F.col("k"))
    return spread.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", chars_col: str = "n_chars", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; a fraction of a repetition is the text's first so many words.

    Documents without words carry nothing and stay out. Extra columns go with their row. What a row gives is worked out from its source's
    plan where the row is read, so no text is shuffled; only where equal rows share the last place of a run are those numbered.
    """
    docs, back = set_apart(docs, id_col, source_col, text_col, chars_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    plan = _plan(_grouped(rows, seed), max_epochs).select(F.col("source").alias("__source"), F.col("whole").alias("__whole"), "t_key", "t_reach", "t_n")
    few = plan.count() <= BROADCAST_ROWS
    key = F.struct(_draw(F.col(id_col), seed).alias("draw"), F.col(id_col).alias("doc_id"), F.col("__size").alias("size"))
    sized = docs.withColumn("__size", word_count(F.col(text_col))).where("__size > 0").withColumn("__key", key)
    planned = sized.join(F.broadcast(plan) if few else plan, F.col(source_col).cast("string").eqNullSafe(F.col("__source")))
    if plan.where("t_n > 1").isEmpty():
        numbered = planned.withColumn("__k", F.lit(0))
    else:
        shared = F.coalesce((F.col("__key") == F.col("t_key")) & (F.col("t_n") > 1), F.lit(False))
        nth = Window.partitionBy("__source", "__key").orderBy(F.xxhash64(F.col(text_col)))
        numbered = planned.where(~shared).withColumn("__k", F.lit(0)).unionByName(planned.where(shared).withColumn("__k", F.row_number().over(nth) - 1))
    taken = numbered.withColumn("__taken", F.col("__whole") * F.col("__size") + _extra(F.col("__key"), F.col("__size"), F.col("__k")))
    part = F.col("__taken") % F.col("__size")
    copies = F.concat(F.array_repeat(F.col("__size"), F.floor(F.col("__taken") / F.col("__size")).cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    out = taken.withColumn("__take", F.explode(copies))
    cut_text = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.col("__take").cast("int")), "")
    out = out.withColumn(text_col, F.when(F.col("__take") < F.col("__size"), cut_text).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col("__take") < F.col("__size"), F.length(text_col).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)))
    return back(out)
