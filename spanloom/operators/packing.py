"""Numbers, running totals and parts over a whole table in an order, without a task that has all rows.

Rows are dealt to ranges of the order and sorted there; one row a range, its count or total, says where the range starts. So a table
of any size is numbered with as many tasks as it has ranges, and what stands in one window is one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import written

ROW_BITS = 33  # monotonically_increasing_id has the partition above these bits, and the row's place in it below


def _in_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows with __range and __at, their range and place in it; written, since ranges are drawn anew with each run."""
    if "__range" in df.columns or "__at" in df.columns:
        raise ValueError("columns __range and __at are in use")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    return written(ranged.select(*df.columns, F.shiftright("__id", ROW_BITS).alias("__range"), F.col("__id").bitwiseAND((1 << ROW_BITS) - 1).alias("__at")))


def _starts(rows: DataFrame, amount: Column) -> DataFrame:
    """(__r, __start): what the ranges before have of an amount."""
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(rows.groupBy(F.col("__range").alias("__r")).agg(amount.alias("__sum")).select("__r", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start")))


def row_numbers(df: DataFrame, order: Sequence[str | Column], into: str = "number") -> DataFrame:
    """``df`` with each row's number in the order, from 0. Of rows equal in the order any may come first."""
    rows = _in_ranges(df, order)
    return rows.join(_starts(rows, F.count("*")), F.col("__range") == F.col("__r")).withColumn(into, F.col("__start") + F.col("__at")).drop("__range", "__at", "__r", "__start")


def running_before(df: DataFrame, amount: str, order: Sequence[str | Column], into: str = "before") -> DataFrame:
    """``df`` with the sum of a whole number over all earlier rows of the order; null counts nothing."""
    rows = _in_ranges(df, order)
    inside = Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn(into, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(_starts(rows, F.coalesce(F.sum(amount), F.lit(0))), F.col("__range") == F.col("__r")).withColumn(into, F.col(into) + F.col("__start")).drop("__range", "__at", "__r", "__start")


def pack_by_size(df: DataFrame, size: str, part_size: int, order: Sequence[str | Column], into: str = "part") -> DataFrame:
    """Rows in parts of about ``part_size``, neighbours of the order together: a row goes to the part in which it starts on the running total.

    A part that is neither first nor last differs from ``part_size`` by less than the largest row, and each row is in one part. Parts
    that a row larger than two of them spans stay empty.
    """
    return running_before(df, size, order, "__before").withColumn(into, F.floor(F.col("__before") / part_size)).drop("__before")


def round_robin_parts(df: DataFrame, size: str, parts: int, key: str, into: str = "part") -> DataFrame:
    """Rows by size, largest first, ties by key, dealt to ``parts`` parts in turn."""
    return row_numbers(df, [F.col(size).desc(), F.col(key)], "__n").withColumn(into, F.pmod("__n", F.lit(parts)).cast("int")).drop("__n")


def even_parts(df: DataFrame, parts: int, order: Sequence[str | Column], into: str = "part") -> DataFrame:
    """Rows in order in ``parts`` runs of equal counts, rounded up, so the last ones may have fewer."""
    numbered = row_numbers(df, order, "__n")
    each = max(1, -(-df.count() // parts))
    return numbered.withColumn(into, F.floor(F.col("__n") / each).cast("int")).drop("__n")


def index_names(df: DataFrame, name: str, order: Sequence[str | Column]) -> DataFrame:
    """(index, name): short names from 1 in the order, for outputs that limit the length of a name; names are unique."""
    return row_numbers(df.select(name, *(c for c in order if isinstance(c, str) and c != name)), order, "__n").select((F.col("__n") + 1).cast("string").alias("index"), name)


def restore_names(df: DataFrame, names: DataFrame, column: str, name: str) -> DataFrame:
    """Indices of ``index_names`` in a column back to names; what is no index stays as it is."""
    known = names.select(F.col("index").alias("__index"), F.col(name).alias("__name"))
    return df.join(known, F.col(column) == F.col("__index"), "left").withColumn(column, F.coalesce("__name", column)).drop("__index", "__name")
