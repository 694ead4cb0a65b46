"""Numbers and lengths as shown in tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(value: Column, digits: int) -> Column:
    """A number with fixed digits, ties to even; empty where it is null."""
    return F.when(value.isNull(), "").otherwise(F.format_string(f"%.{digits}f", F.bround(value.cast("double"), digits)))


def bp_text(n: Column) -> Column:
    """A length for display: 1.23 Mbp, 4.5 kbp or 678 bp."""
    return F.when(n >= 1e6, F.concat(number_text(n / 1e6, 2), F.lit(" Mbp"))).when(n >= 1e3, F.concat(number_text(n / 1e3, 1), F.lit(" kbp"))).otherwise(F.concat(n.cast("long").cast("string"), F.lit(" bp")))
