"""Quotation linking for conversations (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir

MARKS = r"^(?:[ \t]*>)+"
_BREAK = "\x01"


def quote_level(line: Column) -> Column:
    """How deep a line is quoted: its leading ``>`` marks."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(line: Column) -> Column:
    """A line without quote marks, white space and case differences."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\r]+", " ")))


def own_text(text: Column) -> Column:
    """The unquoted lines of a message.

    A line that ends in ``wrote:`` goes too if what follows it, blank lines aside, is quoted.
    """
    text = F.regexp_replace(text, r"(?md)^[^\n]*wrote:[ \t\r]*\n(?=[ \t\r\n]*>)", "")
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^[ \t]*>"))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^[\n\r\t ]+|[\n\r\t ]+$", "")


def parsed(text: Column) -> Column:
    """The lines that are more than white space and quote marks, as ``(level, norm)``."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(quote_level(x).alias("level"), F.translate(normalised(x), _BREAK, " ").alias("norm")))
    return F.filter(lines, lambda x: x["norm"] != "")


def passages(lines: Column, level: Column) -> Column:
    """Runs of lines of a level, as texts; lines of other levels part them."""
    marked = F.transform(lines, lambda x: F.when(x["level"] == level, x["norm"]).otherwise(_BREAK))
    return F.filter(F.transform(F.split(F.array_join(marked, "\n"), _BREAK), lambda x: F.regexp_replace(x, r"^\n+|\n+$", "")), lambda x: x != "")


def _origins(base: DataFrame, folder: str) -> DataFrame:
    """``c, t, origin, quoted_lines`` of the messages whose quotations are found.

    Unquoted lines are looked at in windows as long as some passage of the conversation. Passages of
    ``d`` lengths have at least ``d * d / 2`` lines, so windows grow with the square root of what is
    quoted, times the lines.
    """
    read = materialise(base.select("c", "t", parsed(F.col("text")).alias("lines")), folder, "lines")
    levels = read.select("c", "t", "lines", F.explode(F.array_distinct("lines.level")).alias("level")).where("level > 0")
    quoted = levels.select("c", "t", "level", F.explode(passages(F.col("lines"), F.col("level"))).alias("key"))
    quoted = materialise(quoted.withColumn("n", F.size(F.split("key", "\n")).cast("long")), folder, "passages")
    lengths = quoted.select("c", "n").unionByName(quoted.select("c", F.lit(1).cast("long").alias("n"))).distinct()
    own = read.select("c", "t", F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["norm"]).alias("own")).join(lengths, "c").where("n <= size(own)")
    own = own.select("c", "t", F.explode(F.expr("transform(sequence(1, size(own) - n + 1), p -> array_join(slice(own, p, n), '\n'))")).alias("key"))
    lines = quoted.select("c", "t", "level", F.explode(F.split("key", "\n")).alias("key"))
    every = own.select("c", "t", F.lit(0).alias("level"), F.lit(False).alias("whole"), "key", F.lit(0).cast("long").alias("n"))
    every = every.unionByName(quoted.select("c", "t", "level", F.lit(True).alias("whole"), "key", "n")).unionByName(lines.select("c", "t", "level", F.lit(False).alias("whole"), "key", F.lit(1).cast("long").alias("n")))
    every = every.withColumn("h", F.unhex(F.sha2("key", 256))).groupBy("c", "t", "level", "whole", "h").agg(F.sum("n").alias("n"))
    seen = F.max(F.when(F.col("level") == 0, F.col("t"))).over(Window.partitionBy("c", "h").orderBy("t").rangeBetween(Window.unboundedPreceding, -1))
    votes = every.withColumn("origin", seen).where("level > 0 and origin is not null").groupBy("c", "t", "level", "whole", "origin").agg(F.sum("n").alias("n"))
    best = votes.groupBy("c", "t").agg(F.max(F.struct(-F.col("level"), F.col("whole"), F.col("n"), F.col("origin"))).alias("b"))
    return best.select("c", "t", F.col("b.origin").alias("origin"), F.col("b.n").alias("quoted_lines"))


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Messages without their quotations, each with what it replies to.

    Columns: ``conv_col, turn_col, role_col, text_col, reply_to, linked_by, quoted_lines, depth,
    position``. Every line's quote level is parsed. Lines of one level that follow each other, blank
    ones aside, are a passage; a passage as a whole, and each of its lines, is looked up among the
    unquoted lines of earlier turns of the conversation, where a passage must stand in one piece
    (SHA-256 of the normalised lines, one sorted pass over (conversation, digest), no pairs; of
    several bearers the latest counts). Of what a message quotes the shallowest level found counts,
    one level up from its own words; there whole passages go before single lines, then the turn that
    most lines point to, then the later turn. A message without a resolved quotation replies to the
    turn before. Quotations are linked inside a conversation, not across.
    ``depth`` counts replies up to the first turn: along runs of turns that answer the turn before by
    position, between runs by pointer doubling over the runs' first turns that aren't settled yet; ``position`` numbers
    the conversation's turns by depth, then turn: every message comes after the one it answers.

    Null texts count as empty. Rows with a null conversation or turn are left out. Rows equal in
    conversation and turn count as one message with several texts; each row is returned. Empty
    lines and lines of quote marks alone link nothing.
    """
    spark = messages.sparkSession
    folder = shared_dir(spark)
    base = messages.select(
        F.col(conv_col).alias("c"), F.col(turn_col).cast("long").alias("t"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where("c is not null and t is not null")
    best = _origins(base, folder)
    turns = base.select("c", "t").distinct()
    earlier = F.lag("t").over(Window.partitionBy("c").orderBy("t"))
    linked = turns.withColumn("before", earlier).join(best, ["c", "t"], "left")
    nodes = linked.select(
        "c", "t", F.coalesce("origin", "before").alias("reply_to"), F.coalesce("quoted_lines", F.lit(0)).cast("long").alias("quoted_lines"),
        F.when(F.col("origin").isNotNull(), "quote").when(F.col("before").isNotNull(), "previous").otherwise("start").alias("linked_by"),
    )
    nodes = materialise(nodes, folder, "nodes")
    # turns that answer the turn before form runs; only the runs' heads need following upwards
    order = Window.partitionBy("c").orderBy("t")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.col("linked_by") != "previous"
    runs = nodes.withColumn("rn", F.row_number().over(order)).select(
        "c", "t", "reply_to", head.alias("is_head"), F.max(F.when(head, F.col("t"))).over(upto).alias("head"), (F.col("rn") - F.max(F.when(head, F.col("rn"))).over(upto)).cast("long").alias("off"),
    )
    runs = materialise(runs, folder, "runs")
    target = runs.select("c", F.col("t").alias("reply_to"), F.col("head").alias("up"), (F.col("off") + 1).alias("depth"))
    heads = runs.where("is_head").select("c", "head", "reply_to")
    hops = heads.where("reply_to is not null").join(target, ["c", "reply_to"]).select("c", "head", "up", "depth")
    hops = hops.unionByName(heads.where("reply_to is null").select("c", "head", F.lit(None).cast("long").alias("up"), F.lit(0).cast("long").alias("depth")))
    for k in range(64):
        hops = materialise(hops, folder, f"hops-{k}")
        if not hops.where("up is not null").limit(1).count():
            break
        above = hops.select("c", F.col("head").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        moved = hops.where("up is not null").join(above, ["c", "up"]).select("c", "head", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"))
        hops = hops.where("up is null").unionByName(moved)
    hops = runs.select("c", "t", "head", "off").join(hops.select("c", "head", "depth"), ["c", "head"]).select("c", "t", (F.col("depth") + F.col("off")).alias("depth"))
    placed = hops.select("c", "t", "depth", F.row_number().over(Window.partitionBy("c").orderBy("depth", "t")).cast("long").alias("position"))
    out = base.select("c", "t", "turn", "role", own_text(F.col("text")).alias("own")).join(nodes.join(placed, ["c", "t"]), ["c", "t"])
    return out.select(F.col("c").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("own").alias(text_col), "reply_to", "linked_by", "quoted_lines", "depth", "position")
