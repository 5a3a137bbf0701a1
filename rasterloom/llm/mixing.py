"""Mixing sources to target weights by hierarchical token budgets (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir

KEY_BITS = 60
#: Each round looks closer at the one bucket of keys in which a leaf's tokens run out.
BUCKET_BITS = (12, 24)
#: Leaves up to which the plan (a row a leaf) is broadcast; more are joined by a shuffle.
BROADCAST_LEAVES = 50_000


def words(text: Column) -> Column:
    """The default measure: the number of words; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def epoch_key(id_col: Column, epoch: Column, seed: int) -> Column:
    """A 60-bit number that orders documents within a seeded epoch."""
    text = F.concat(F.lit(f"{seed}/"), epoch.cast("string"), F.lit("/"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    w = F.lit(1)
    for value, number in weights.get(level, {}).items():
        w = F.when(F.col(level) == value, F.lit(int(number))).otherwise(w)
    return w.cast("long")


def _share(children: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """Water-filling within siblings: ``budget`` of the parent over children of ``cap`` and ``w``.

    In ascending order of cap/w a child is filled while its cap is at most its share of what is
    left; the others divide the rest by weight, exactly to the token.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), level)
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(*parent)
    x = children.withColumn("c0", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("w1", F.sum("w").over(onward))
    x = x.withColumn("full", F.col("cap") * F.col("w1") <= F.col("w") * (F.col("parent_budget") - F.col("c0")))
    x = x.withColumn("rest", F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)))
    open_w = F.when(~F.col("full"), F.col("w"))
    x = x.withColumn("w_all", F.sum(open_w).over(every)).withColumn("w_to", F.sum(open_w).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.expr("rest * w_to div w_all - rest * (w_to - w) div w_all")
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(part)).drop("c0", "w1", "full", "rest", "w_all", "w_to", "parent_budget")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], total: int, max_epochs: int) -> DataFrame:
    """``levels, available, budget`` for a row a leaf of ``leaves(levels, available)``.

    Weights are positive integers by level and value, 1 where not given. A node may get at most
    ``max_epochs`` times what lies below it. Budgets go down the tree; within each group of
    siblings what one can't use goes to the others by weight, and only what the whole group can't
    use stays with the parent's siblings, since the parent's own cap says so.
    """
    nodes = leaves.withColumn("cap", F.col("available") * F.lit(max_epochs))
    known = nodes.groupBy().agg(F.least(F.sum("cap"), F.lit(total).cast("long")).alias("parent_budget"))
    for depth, level in enumerate(levels, 1):
        here = list(levels[:depth])
        children = nodes.groupBy(*here).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, weights))
        children = children.join(known, here[:-1]) if depth > 1 else children.crossJoin(F.broadcast(known))  # one row
        known = _share(children, here[:-1], level).select(*here, F.col("budget").alias("parent_budget"))
    return leaves.join(known.withColumnRenamed("parent_budget", "budget"), list(levels))


def _bucket(key: Column, bits: int) -> Column:
    return F.shiftright(key, KEY_BITS - bits).cast("int")


def plan(sizes: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], total: int, max_epochs: int, seed: int) -> DataFrame:
    """A row a leaf: ``levels, available, budget, whole, rest, cut, base``.

    Every document of the leaf is taken ``whole`` times; in the epoch after those, documents in
    key order until ``rest`` tokens are used. ``cut`` is the key bucket in which that happens and
    ``base`` the tokens before it, from a histogram of 4096 buckets a leaf and a second one of
    4096 parts of the bucket that it finds: only documents in that one part, a leaf's 1/2**24, have
    to be sorted, so a leaf with a third of all rows needs no long sort. ``sizes`` holds ``id,
    levels, n``.
    """
    spark, names = sizes.sparkSession, list(levels)
    leaves = sizes.groupBy(*levels).agg(F.sum("n").alias("available"))
    got = budgets(leaves, levels, weights, total, max_epochs)
    got = got.withColumn("whole", F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(F.lit(0).cast("long")))
    got = got.withColumn("rest", F.col("budget") - F.col("whole") * F.col("available")).withColumns({"cut": F.lit(0), "base": F.lit(0).cast("long")})
    got = materialise(got, shared_dir(spark), "budgets")
    known = 0  # of no bits there is one bucket, with all keys
    for bits in BUCKET_BITS:
        keyed = join_plan(sizes, got, levels).withColumn("key", epoch_key(F.col("id"), F.col("whole"), seed)).where(_bucket(F.col("key"), known) == F.col("cut"))
        filled = keyed.groupBy(*levels, _bucket(F.col("key"), bits).alias("bucket")).agg(F.sum("n").alias("n"), F.max("rest").alias("rest"), F.max("base").alias("base"))
        upto = F.col("base") + F.sum("n").over(Window.partitionBy(*levels).orderBy("bucket"))
        over = filled.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy(*levels).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("base"))).alias("c"))
        found = got.drop("cut", "base").join(over, names, "left").withColumns({"cut": F.coalesce("c.bucket", F.lit(1 << bits)), "base": F.coalesce("c.base", F.lit(0).cast("long"))})
        got, known = materialise(found.drop("c"), shared_dir(spark), f"cut-{bits}"), bits
    return got


def join_plan(rows: DataFrame, leaves: DataFrame, levels: Sequence[str]) -> DataFrame:
    small = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if small else leaves, list(levels))


def _copies(rows: DataFrame, leaves: DataFrame, levels: Sequence[str], seed: int, size: Column) -> DataFrame:
    """``rows(id, levels, ...)`` with ``copies``; ``size`` is evaluated in the cut buckets only."""
    keyed = join_plan(rows, leaves, levels).withColumn("key", epoch_key(F.col("id"), F.col("whole"), seed))
    keyed = keyed.withColumn("bucket", _bucket(F.col("key"), BUCKET_BITS[-1]))
    clear = keyed.where("bucket <> cut").withColumn("copies", F.col("whole") + (F.col("bucket") < F.col("cut")).cast("long"))
    near = keyed.where("bucket = cut").withColumn("n", size)
    used = F.col("base") + F.sum("n").over(Window.partitionBy(*levels).orderBy("key"))  # equal keys count together
    near = near.withColumn("copies", F.col("whole") + (used <= F.col("rest")).cast("long")).drop("n")
    return clear.unionByName(near).drop("key", "bucket", "cut", "base", "rest", "whole", "available", "budget")


def _levels(levels: Mapping[str, Column]) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("")).alias(name) for name, c in levels.items()]


def mix_report(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], share: float = 1.0, max_epochs: int = 2,
    seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row a document: ``id_col, levels, n_tokens, copies`` (0: not selected).

    ``levels``: the tree's columns from the root, e.g. domain, language, source. The target is
    ``share`` of all tokens. Null levels are the level ''. A document without words belongs to an
    epoch like any other but costs nothing; rows with equal identifiers stand or fall together.
    """
    rows = docs.select(F.col(id_col).alias("id"), *_levels(levels), words(F.col(text_col)).alias("n"))
    rows = materialise(rows, shared_dir(docs.sparkSession), "sizes")
    total = rows.agg(F.sum("n")).first()[0] or 0
    leaves = plan(rows, list(levels), weights, int(total * share), max_epochs, seed)
    out = _copies(rows.withColumnRenamed("n", "n_tokens"), leaves, list(levels), seed, F.col("n_tokens"))
    return out.select(F.col("id").alias(id_col), *levels, "n_tokens", "copies")


def mix(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], share: float = 1.0, max_epochs: int = 2,
    seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The selected rows of ``docs``, all columns as they are, each as often as it is taken.

    Texts aren't shuffled but for those in a leaf's cut bucket.
    """
    inner = {f"_level{i}": c for i, c in enumerate(levels.values())}
    inner_weights = {f"_level{i}": weights.get(name, {}) for i, name in enumerate(levels)}
    folder = shared_dir(docs.sparkSession)
    sizes = materialise(docs.select(F.col(id_col).alias("id"), *_levels(inner), words(F.col(text_col)).alias("n")), folder, "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    leaves = plan(sizes, list(inner), inner_weights, int(total * share), max_epochs, seed)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("id"), *_levels(inner))
    out = _copies(rows, leaves, list(inner), seed, words(F.col("_row")[text_col]))
    taken = out.where("copies > 0").select(F.explode(F.expr("array_repeat(_row, cast(copies as int))")).alias("_row"))
    return taken.select("_row.*")
