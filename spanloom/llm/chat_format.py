"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are context, its reply alone is trainable.
A turn is written ``<turn:ROLE>`` newline, text, ``</turn>`` newline. Inside roles and texts a backslash is written
as two, ``<`` as ``\\l`` and (in roles) ``>`` as ``\\g``: no control string can occur inside a text, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import cut

OPEN, OPENED, CLOSE = "<turn:", ">\n", "</turn>\n"
LIMIT, BLOCK = 1 << 25, 64
BROADCAST_ROWS = 500_000


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: doubled backslashes split the text into parts that hold single ones only."""
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(parts, "\\")


def _written(role: Column, text: Column) -> tuple[Column, Column]:
    """Mark and role, and text, as they are written before the closing mark."""
    return F.concat(F.lit(OPEN), F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit(OPENED)), escape(text)


def prefix_target_examples(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target_role: str = "assistant", limit: int = LIMIT, block: int = BLOCK
) -> DataFrame:
    """conv_id, example, examples, text, loss_start, loss_chars: one row for each assistant turn, plus what follows the last one.

    ``text`` holds all turns up to and with the target; the loss mask is the ``loss_chars`` code points from
    ``loss_start`` (0-based), which is the escaped reply without its marks; ``examples`` counts the conversation's. Turns after a
    conversation's last reply make one more row with a null ``example`` and an empty mask, so every turn can be read back. Turns go
    by ``turn``, then role and text (null turns first); repeated rows stay; null roles and texts are empty; a null conv_id is one
    conversation.

    An example is one row and holds its whole prefix, so the output of a conversation grows with the square of its turns. Conversations
    whose examples have up to ``limit`` code points are put together in one row; those of longer ones from blocks of turns, so that
    a task holds a prefix at a time and never all of a conversation's examples.
    """
    turns = conversations.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    size = F.sum(F.length("t.text") + F.length("t.role") + len(OPEN + OPENED + CLOSE))
    long = cut(turns.groupBy("conv_id").agg((size * F.count_if(F.col("t.role") == target_role)).alias("work")).where(F.col("work") > limit).select(F.col("conv_id").alias("__long")))
    number = long.count()
    if not number:
        return _short_examples(turns, target_role)
    long = F.broadcast(long) if number <= BROADCAST_ROWS else long
    here = turns["conv_id"].eqNullSafe(long["__long"])
    return _short_examples(turns.join(long, here, "left_anti"), target_role).unionByName(_long_examples(turns.join(long, here, "left_semi"), target_role, block))


def _short_examples(turns: DataFrame, target_role: str) -> DataFrame:
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def written(t: Column) -> Column:
        head, body = _written(t["role"], t["text"])
        return F.struct(F.concat(head, body, F.lit(CLOSE)).alias("all"), F.length(body).alias("body"), (t["role"] == target_role).alias("target"))

    formed = listed.withColumn("formed", F.transform("turns", written)).drop("turns")
    numbers = F.sequence(F.lit(1), F.size("formed"))
    targets = F.filter(numbers, lambda i: F.element_at(F.col("formed"), i)["target"])
    placed = formed.withColumn("targets", targets).withColumn("last", F.coalesce(F.array_max("targets"), F.lit(0)))
    tail = F.when(F.col("last") < F.size("formed"), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
    one = placed.select("conv_id", "formed", "last", F.size("targets").alias("examples"), F.posexplode(F.concat("targets", tail)).alias("number", "at"))
    is_tail = F.col("at").isNull()
    parts = F.when(is_tail, F.slice("formed", F.col("last") + 1, F.size("formed"))).otherwise(F.slice("formed", F.lit(1), F.coalesce("at", F.lit(1))))
    whole = F.array_join(F.transform(parts, lambda p: p["all"]), "")
    target = F.element_at("formed", F.coalesce("at", F.lit(1)))
    return one.select(
        "conv_id",
        F.when(~is_tail, F.col("number")).alias("example"),
        "examples",
        whole.alias("text"),
        F.when(is_tail, F.lit(0)).otherwise(F.length(whole) - len(CLOSE) - target["body"]).alias("loss_start"),
        F.when(is_tail, F.lit(0)).otherwise(target["body"]).alias("loss_chars"),
    )


def _long_examples(turns: DataFrame, target_role: str, block: int) -> DataFrame:
    """The same rows: each block of turns gets the text of all blocks before it, and each reply that text and its own block's up to it."""
    head, body = _written(F.col("t.role"), F.col("t.text"))
    order = Window.partitionBy("conv_id").orderBy("t")
    target = F.col("t.role") == target_role
    numbered = turns.select("conv_id", (F.row_number().over(order) - 1).alias("i"), target.alias("target"), F.concat(head, body, F.lit(CLOSE)).alias("all"), F.length(body).alias("body"))
    blocks = cut(numbered.groupBy("conv_id", F.floor(F.col("i") / block).alias("b")).agg(F.array_sort(F.collect_list(F.struct("i", "target", "all", "body"))).alias("turns"), F.count_if("target").alias("n"), F.max(F.when(F.col("target"), F.col("i"))).alias("last")))
    joined = lambda turns: F.array_join(F.transform(turns, lambda t: t["all"]), "")
    sums = blocks.groupBy("conv_id").agg(F.sum("n").cast("int").alias("examples"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    own = blocks.select(F.col("conv_id").alias("__c"), F.col("b").alias("__b"), joined(F.col("turns")).alias("piece"), F.col("n").alias("before"))
    met = blocks.select("conv_id", "b").join(own, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("__b") < F.col("b")), "left")
    prefix = met.groupBy("conv_id", "b").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__b", "piece"))), lambda p: F.coalesce(p["piece"], F.lit(""))), "").alias("prefix"), F.coalesce(F.sum("before"), F.lit(0)).cast("int").alias("first"))
    prefix = cut(prefix.withColumn("chars", F.length("prefix"))).select(F.col("conv_id").alias("__c"), F.col("b").alias("__b"), "prefix", "first", "chars")

    here = F.filter("turns", lambda t: t["target"])
    inner = blocks.select("conv_id", "b", "turns", F.posexplode(here).alias("k", "t"))
    inner = inner.select("conv_id", "b", "k", F.col("t.body").alias("body"), joined(F.filter("turns", lambda t: t["i"] <= F.col("t.i"))).alias("own"))
    keyed = sums.select(F.col("conv_id").alias("__s"), "examples")
    one = inner.join(keyed, F.col("conv_id").eqNullSafe(F.col("__s"))).join(prefix, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("b") == F.col("__b")))
    replies = one.select("conv_id", (F.col("first") + F.col("k")).alias("example"), "examples", F.concat("prefix", "own").alias("text"), (F.col("chars") + F.length("own") - len(CLOSE) - F.col("body")).alias("loss_start"), F.col("body").alias("loss_chars"))
    after = sums.select(F.col("conv_id").alias("__s"), "examples", F.col("last").alias("__last"))
    late = blocks.select("conv_id", F.explode("turns").alias("t")).join(after, F.col("conv_id").eqNullSafe(F.col("__s"))).where(F.col("t.i") > F.col("__last"))
    tails = late.groupBy("conv_id", "examples").agg(joined(F.array_sort(F.collect_list("t"))).alias("text"))
    tails = tails.select("conv_id", F.lit(None).cast("int").alias("example"), "examples", "text", F.lit(0).alias("loss_start"), F.lit(0).alias("loss_chars"))
    return replies.unionByName(tails)


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    pieces = F.filter(F.split(text, CLOSE), lambda p: F.startswith(p, F.lit(OPEN)))

    def one(piece: Column) -> Column:
        halves = F.split(piece, OPENED, 2)
        return F.struct(unescape(F.substring(halves[0], F.lit(len(OPEN) + 1), F.length(halves[0]))).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, one)


def digest(examples: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the examples.

    formatted_chars is the code points of all of a conversation's output rows. Of each example only its reply and its length are
    gathered; the turns are read from the last one, which holds them all, and from what follows it.
    """
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_chars")))
    full = F.when(F.col("example").isNull() | (F.col("example") == F.col("examples") - 1), F.col("text"))
    rows = examples.select("conv_id", F.length("text").cast("long").alias("chars"), F.struct(F.coalesce("example", F.lit(2147483647)).alias("order"), full.alias("full"), loss.alias("loss")).alias("e"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("e")).alias("e"), F.sum("chars").alias("formatted_chars"))
    whole = F.array_join(F.transform(F.filter("e", lambda e: e["full"].isNotNull()), lambda e: e["full"]), "")
    read = listed.withColumn("turns", read_turns(whole)).withColumn("loss", F.array_join(F.transform("e", lambda e: e["loss"]), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
