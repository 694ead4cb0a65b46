"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

Shards are the leaves of a tree: ``fan[1]`` shards make a rack, ``fan[0]`` racks make a region. Every document
has a hash draw at each shard, exponential with the shard's weight as its rate. A rack's draw is the least of its
shards' draws and a region's the least of its racks', so a node's draw is exponential with the total weight below it:
descending from the root to the child with the least draw visits regions, racks and shards in proportion
to their weights. A draw depends on the document's id and the shard alone. So when a shard is added or its
weight changes, only draws of its own rack and region change, and documents move only into the
subtree that gained weight (or only out of the one that lost).

With draws coupled like this the descent ends where the least draw of all leaves is: the tree equals a flat weighted hash over its
shards, at a draw a shard. Draws of their own for regions and racks would save those, but a region that gains weight would then
pull documents into its old shards too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import cut

FAN = (4, 4)
BUCKETS = 256


def _least_of(children: Column, size: int, count: int) -> Column:
    """The least child of each of ``count`` consecutive groups of ``size``; not a lambda, in which the children would be drawn anew each time."""
    return F.array(*(F.array_min(F.slice(children, i * size + 1, size)) for i in range(count)))


def with_shard(df: DataFrame, key: Column, n_shards: int, into: str = "shard", weights: list[float] | None = None, fan: tuple[int, int] = FAN, seed: int = 7) -> DataFrame:
    """Add the path (region, rack, shard) a key descends to, as a struct named ``into``.

    ``weights`` gives a positive weight for each shard (all 1 by default). A null key is a key of its own.
    """
    if n_shards < 1 or (weights is not None and (len(weights) != n_shards or min(weights) <= 0)):
        raise ValueError("one positive weight for each shard")
    rates = F.array(*(F.lit(float(w)) for w in weights or [1.0] * n_shards))
    text = key.cast("string")

    def draw(i: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), i, text), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(unit) / F.element_at(rates, i + 1)).alias("draw"), i.alias("shard"))

    racks = -(-n_shards // fan[1])
    regions = -(-racks // fan[0])
    return (
        df.withColumn("__leaves", F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), draw))
        .withColumn("__racks", _least_of(F.col("__leaves"), fan[1], racks))
        .withColumn("__regions", _least_of(F.col("__racks"), fan[0], regions))
        .withColumn("__shard", F.array_min("__regions")["shard"])
        .withColumn(into, F.struct((F.col("__shard") / (fan[0] * fan[1])).cast("int").alias("region"), (F.col("__shard") / fan[1]).cast("int").alias("rack"), F.col("__shard").alias("shard")))
        .drop("__leaves", "__racks", "__regions", "__shard")
    )


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", fan: tuple[int, int] = FAN) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard.

    size is the text's UTF-8 bytes (null: none) plus 16; grown_shard is the shard with one more shard in the tree, and
    differs from ``shard`` only where the row moves into the new one. slot numbers a shard's rows
    from 0 without gaps: shards are cut into hash buckets whose counts give each bucket its first slot, so no task
    orders a whole shard. Rows that repeat are counted before they are dealt out. A null text has the checksum of
    the empty text; a null id is one more id. Only the two named columns are read, so others may have any name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = with_shard(with_shard(rows, F.col("doc_id"), n_shards, "at", fan=fan), F.col("doc_id"), n_shards + 1, "grown", fan=fan)
    groups = placed.groupBy("doc_id", "size", "text_crc32", "at", "grown").agg(F.count("*").alias("n"))
    placed = cut(groups.withColumn("bucket", F.pmod(F.xxhash64(F.lit(11), F.col("doc_id").cast("string"), "size", "text_crc32"), F.lit(BUCKETS)).cast("int")).withColumn("shard", F.col("at.shard")))
    in_shard = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("shard", "bucket").agg(F.sum("n").alias("rows")).select("shard", "bucket", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("first"))
    in_bucket = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("before", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
    joined = numbered.join(F.broadcast(first), ["shard", "bucket"])  # at most n_shards * BUCKETS rows
    return joined.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "at.region", "at.rack", "shard", (F.col("first") + F.col("before") + F.col("k")).alias("slot"), F.col("grown.shard").alias("grown_shard")
    )
