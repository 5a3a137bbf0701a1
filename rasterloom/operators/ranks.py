"""Values of given rank in groups of any size, by radix histograms: no group is sorted as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir

#: Distinct values that one task sorts, at most; buckets with more are narrowed first.
SORTED = 1 << 16
_DIGIT = 16
_LEAST = 2.0**-1022  # the smallest double with an exponent of its own


def ordered_bits(v: Column) -> Column:
    """A double as a whole number of 64 bits that sorts as it does (0 and -0 are one).

    The exponent is found by a logarithm and put right by at most one; divisions by powers of two
    are exact, so the 52 bits below it are too. Not for NaN; infinities come first and last.
    """
    x = F.abs(v)
    guess = F.least(F.floor(F.log2(F.greatest(x, F.lit(_LEAST)))), F.lit(1023)).cast("int")
    scaled = x / F.pow(F.lit(2.0), guess)
    exponent = F.when(scaled >= 2, guess + 1).when(scaled < 1, guess - 1).otherwise(guess)
    fraction = F.when(scaled >= 2, scaled / 2).when(scaled < 1, scaled * 2).otherwise(scaled) - 1.0
    normal = F.shiftleft((exponent + 1023).cast("long"), 52) + (fraction * F.lit(2.0**52)).cast("long")
    small = (x / F.lit(_LEAST) * F.lit(2.0**52)).cast("long")
    bits = F.when(x == float("inf"), F.lit(2047 << 52)).when(x < _LEAST, small).otherwise(normal)
    return F.when(v < 0, -bits).otherwise(bits)


def _pick(values: DataFrame, wanted: DataFrame, group: Sequence[str], order: str, n: str = "n") -> DataFrame:
    """``wanted`` with the row of its group whose ``n`` covers its ``rank``, which then counts from that row's first."""
    at = F.sum(n).over(Window.partitionBy(*group).orderBy(order)) - F.col(n)
    placed = values.withColumn("_from", at).withColumn("_to", F.col("_from") + F.col(n))
    met = placed.join(wanted, [*group]).where("rank >= _from and rank < _to")
    return met.withColumn("rank", F.col("rank") - F.col("_from")).drop("_from", "_to", n)


def quantiles(counts: DataFrame, group: Sequence[str], ps: Sequence[float], sorted_values: int = SORTED) -> DataFrame:
    """``group, p``: the quantiles ``ps`` of each group, linearly interpolated, from ``counts(group, v, n)``.

    ``v``: distinct doubles of a group, without null and NaN; ``n``: how often each occurs. ``counts``
    is read several times, so it should be written. While a bucket with a wanted rank holds more than
    ``sorted_values`` values, its values are counted by the next 16 bits of their order and only those
    of the buckets that cover wanted ranks are kept; after at most four rounds a bucket is one value.
    """
    group = list(group)
    folder = shared_dir(counts.sparkSession)
    totals = counts.groupBy(*group).agg(F.sum("n").alias("total"))
    ends = [f(F.lit(float(p)) * (F.col("total") - 1)).cast("long") for p in ps for f in (F.floor, F.ceil)]
    wanted = totals.select(*group, F.lit(0).cast("long").alias("bucket"), F.posexplode(F.array(*ends)).alias("j", "rank"))
    kept = counts.select(*group, "v", "n", F.lit(0).cast("long").alias("bucket"))
    for shift in (48, 32, 16, 0):
        most = kept.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0
        if most <= sorted_values:
            break
        digits = kept.drop("bucket").withColumn("bucket", F.shiftright(ordered_bits(F.col("v")), shift))
        above = F.shiftright("bucket", _DIGIT) if shift < 48 else F.lit(0).cast("long")
        histogram = digits.groupBy(*group, "bucket").agg(F.sum("n").alias("n")).withColumn("above", above)
        wanted = _pick(histogram, wanted.withColumnRenamed("bucket", "above"), [*group, "above"], "bucket").drop("above")
        wanted = materialise(wanted, folder, f"wanted-{shift}")
        kept = materialise(digits.join(F.broadcast(wanted.select(*group, "bucket").distinct()), [*group, "bucket"], "left_semi"), folder, f"kept-{shift}")
    found = _pick(kept, wanted, [*group, "bucket"], "v").groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("x"))  # two entries a quantile
    found = found.join(totals, group)
    part = lambda p: F.lit(float(p)) * (F.col("total") - 1) - F.floor(F.lit(float(p)) * (F.col("total") - 1))
    value = [F.element_at("x", F.lit(2 * k)) * (F.lit(1.0) - part(p)) + F.element_at("x", F.lit(2 * k + 1)) * part(p) for k, p in enumerate(ps)]
    return found.select(*group, F.array(*value).alias("p"))
