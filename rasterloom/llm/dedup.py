"""Exact deduplication by sorting content (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir


def _sorted_runs(
    docs: DataFrame, normalised: Column | None, id_col: str, text_col: str, keep: str, prefix_chars: int, hot_share: int, salts: int, *carried: Column,
) -> tuple[DataFrame, WindowSpec]:
    """The range-partitioned rows and the window in which equal texts lie side by side."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    text = F.coalesce(F.col(text_col) if normalised is None else normalised, F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"), *carried).withColumn("h", F.xxhash64("t"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1000, docs.count() // (hot_share * parts))
    hot = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > limit).select("h", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    salted = rows.join(F.broadcast(hot), "h", "left").withColumn("salt", salt)
    ranged = salted.withColumn("p", F.substring("t", 1, prefix_chars)).repartitionByRange("p", "h", "salt")
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    return ranged, Window.partitionBy("p", "h", "salt", "t").orderBy(order)


def distinct_texts(
    docs: DataFrame, normalised: Column | None = None, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    prefix_chars: int = 48, hot_share: int = 8, salts: int = 64,
) -> DataFrame:
    """The rows that ``exact_duplicates`` keeps, all columns as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    ranged, run = _sorted_runs(docs, normalised, id_col, text_col, keep, prefix_chars, hot_share, salts, row)
    first = ranged.withColumn("r", F.row_number().over(run)).where("r = 1")
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    # a hot text has one row left per salt
    merged = first.where("hot").withColumn("r", F.row_number().over(Window.partitionBy("t").orderBy(order))).where("r = 1")
    return first.where("hot is null").select("_row.*").unionByName(merged.select("_row.*"))


def exact_duplicates(
    docs: DataFrame,
    normalised: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    prefix_chars: int = 48,
    hot_share: int = 8,
    salts: int = 64,
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``.

    Sampled splitters range-partition the leading characters (a 64-bit hash of the whole text
    breaks ties, so a prefix that many texts share doesn't pile up, and splitters stay short), an
    external sort puts equal texts side by side, and a window over the *whole* text compares them
    in full. A text that fills more than ``1/hot_share`` of a partition is salted by identifier:
    each salt's run is reduced where it lies, and the few runs of such texts are joined by
    SHA-256 (at most ``hot_share * partitions`` texts, hence a broadcast of bounded size).

    ``normalised``: what is compared, by default ``text_col`` itself. ``keep``: "smallest" or
    "largest" identifier stays. Null texts count as empty; a null identifier loses to any other;
    of rows equal in text and identifier exactly one is kept. Other columns are ignored.
    """
    ranged, run = _sorted_runs(docs, normalised, id_col, text_col, keep, prefix_chars, hot_share, salts)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ranged.select(
        "id", "hot", "salt", F.first("id").over(whole).alias("best"), F.count(F.lit(1)).over(whole).alias("n"),
        F.row_number().over(run).alias("r"), F.sha2("t", 256).alias("sha"),
    )
    runs = materialise(runs, shared_dir(docs.sparkSession), "runs")
    pick = F.min if keep == "smallest" else F.max
    merged = runs.where("hot and r = 1").groupBy("sha").agg(pick("best").alias("hot_best"), F.sum("n").alias("hot_n"))
    out = runs.join(F.broadcast(merged), "sha", "left").withColumn("k", F.when(F.col("hot"), F.col("hot_best")).otherwise(F.col("best")))
    first = (F.col("r") == 1) & F.col("id").eqNullSafe(F.col("k"))
    # all null identifiers share one salt, so this holds for them too
    return out.select(
        F.col("id").alias(id_col), F.col("k").alias("keep_id"), F.coalesce(F.when(F.col("hot"), F.col("hot_n")), F.col("n")).alias("group_size"),
        first.alias("kept"), F.col("sha").alias("text_sha256"),
    )
