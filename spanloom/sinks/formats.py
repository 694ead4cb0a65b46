"""Writers of the text formats of sequence analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


HEADER = "##gff-version 3"  # fixed value


def gff_line(keys: list[str]) -> Column:
    """A feature as a line; attributes in the order of ``keys``, missing ones left out."""
    attributes = F.array_join(F.filter(F.array(*(F.concat(F.lit(f"{k}="), F.col("attributes")[k]) for k in keys)), lambda x: x.isNotNull()), ";")
    return F.concat_ws("\t", "seqid", "source", "type", F.col("start").cast("string"), F.col("end").cast("string"), "score", "strand", "frame", attributes)


def gff3_lines(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(gff_line(keys).alias("value"))


def write_gff3(df: DataFrame, path: str, keys: list[str]) -> None:
    """Features as text; every part file begins with the version line, so each is a file of its own right."""
    _write_lines(gff3_lines(df, keys).toDF(HEADER), path)


def write_gff3_by_name(df: DataFrame, path: str, keys: list[str], name: str = "Name") -> None:
    """One folder for each name, the whole replaced."""
    lines = df.select(F.col("attributes")[name].alias(name), gff_line(keys).alias(HEADER))
    _write_lines(lines, path, name)


def _write_lines(lines: DataFrame, path: str, *by: str) -> None:
    """Lines of one column, whose name heads each file; nothing is quoted or escaped."""
    writer = lines.write.mode("overwrite").partitionBy(*by) if by else lines.write.mode("overwrite")
    writer.option("comment", "\u0002").csv(path, header=True, sep="\u0001", quote="", escapeQuotes=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")


def with_attributes(features: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Features with more attributes, from a table that has one row a ``key`` (an attribute's name); features without a row stay as they are."""
    named = values.select(F.col(key).alias("__key"), *(F.col(c).cast("string").alias(f"__{c}") for c in columns))
    joined = features.withColumn("__key", F.col("attributes")[key]).join(named, "__key", "left")
    fresh = F.map_filter(F.create_map(*(x for c in columns for x in (F.lit(c), F.col(f"__{c}")))), lambda _, v: v.isNotNull())
    kept = F.map_filter("attributes", lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return joined.withColumn("attributes", F.map_concat(kept, fresh)).select(*features.columns)


def write_fasta(df: DataFrame, path: str, seq_id: str = "seq_id", seq: str = "seq", upper: bool = True) -> None:
    letters = F.upper(seq) if upper else F.col(seq)
    df.select(F.concat(F.lit(">"), F.col(seq_id).cast("string"), F.lit("\n"), letters).alias("value")).write.mode("overwrite").text(path)


def write_bed(df: DataFrame, path: str, seq: str = "seqid", s: str = "s", e: str = "e") -> None:
    """Closed 1-based intervals as half-open 0-based ones."""
    df.select(seq, (F.col(s) - 1).alias(s), e).write.mode("overwrite").csv(path, sep="\t")


def ragged_lines(df: DataFrame, key: str, label: str, value: str) -> DataFrame:
    """All labels of a key on one line, tab-joined label-value pairs by value, largest first."""
    listed = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("o"), F.col(label).alias("l"), F.col(value).cast("string").alias("v")))).alias("x"))
    return listed.select(F.concat_ws("\t", F.col(key).cast("string"), F.array_join(F.flatten(F.transform("x", lambda x: F.array(x["l"], x["v"]))), "\t")).alias("value"))


def report_document(families: DataFrame, arrays: DataFrame, family: str) -> DataFrame:
    """(family, document): each family with its arrays as one JSON text, arrays in order of their columns."""
    nested = arrays.groupBy(family).agg(F.array_sort(F.collect_list(F.struct(*(c for c in arrays.columns if c != family)))).alias("arrays"))
    return families.join(nested, family, "left").select(family, F.to_json(F.struct(*(c for c in families.columns), "arrays")).alias("document"))


def text_cells(df: DataFrame) -> DataFrame:
    """Every column as the text of a table cell: null is empty, truth values are true and false, lists are joined by ', '."""
    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        return F.coalesce(F.array_join(c.cast("array<string>"), ", ") if kind.startswith("array") else c.cast("string"), F.lit("")).alias(name)

    return df.select(*(cell(n, k) for n, k in df.dtypes))


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """A table with a header in each part file."""
    text_cells(df).write.mode("overwrite").csv(path, sep=sep, header=True, emptyValue="")


def write_bundle(tables: dict[str, tuple[DataFrame, dict[str, str]]], path: str) -> DataFrame:
    """Each table, cut to its described columns, in a folder of its own below ``path``, and their dictionary as ``columns``.

    ``tables`` has for each name the rows and a description for each column, in order. What is returned is the dictionary:
    (table, position, column, description).
    """
    described = []
    for name, (df, columns) in tables.items():
        write_table(df.select(*columns), f"{path}/{name}")
        described += [(name, i, column, says) for i, (column, says) in enumerate(columns.items())]
    spark = next(iter(tables.values()))[0].sparkSession
    dictionary = spark.createDataFrame(described, "table string, position int, column string, description string")
    write_table(dictionary, f"{path}/columns")
    return dictionary


def write_superfamilies(df: DataFrame, path: str) -> None:
    """(Superfamily, TRC, fallback) as CSV, truth values in capitals."""
    df.select(F.col("superfamily").alias("Superfamily"), F.col("member").alias("TRC"), F.upper(F.col("attached").cast("string")).alias("fallback")).write.mode("overwrite").csv(path, header=True)


def write_statistics(df: DataFrame, path: str) -> None:
    """One-row statistics as JSON."""
    df.write.mode("overwrite").json(path)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Vertices and edges as Parquet folders."""
    vertices.write.mode("overwrite").parquet(f"{path}/vertices")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
