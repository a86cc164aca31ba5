"""Exact percentiles per group by histogram rounds.

Every wanted rank of a group has a bracket of values that holds it. A round
counts the group's rows inside the bracket in equal bins (partial and final
aggregate, at most ``bins`` rows per rank), picks the bin the rank falls in,
and takes that bin's least and greatest value as the next bracket. A round
at least separates the bracket's two ends, and on usual data leaves a
thousandth; it is over when they are equal. No list of a group's values is
ever made, and a group holding a third of the rows is counted by all tasks.

Percentiles are interpolated between the two nearest ranks, as
``percentile`` does, unless values of the group are asked for. Defined results: null values and those that are not
numbers don't count; a group without others has no row; null keys are a
group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import checked_broadcast

INFINITE = ("Infinity", "-Infinity")


def exact_percentiles(df: DataFrame, on: list[str], value: str, shares: list[float], bins: int = 1024, interpolate: bool = True) -> DataFrame:
    """(on, n, share, percentile) of ``value``, a column of doubles, per group and each of ``shares`` (0 to 1).

    Without ``interpolate`` it is the least value that at least the share of
    the rows does not exceed, a value of the group, as ``percentile_disc``.
    """
    if not all(0 <= s <= 1 for s in shares) or bins < 2:
        raise ValueError("shares lie between 0 and 1, and a round needs two bins")
    key = [f"_k{i}" for i in range(len(on))]
    v = F.col(f"`{value}`").cast("double")
    group = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(k) for c, k in zip(on, key)])
    # Every round reads the values: they are computed once, and filters on them stop here.
    rows = materialize(df.select(group.alias("_g"), v.alias("_v")), "percentile-values").filter("_v IS NOT NULL AND NOT isnan(_v)")
    stats = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    each = stats.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")) if shares else stats.withColumn("share", F.lit(0.0)).limit(0)
    place = F.col("share") * (F.col("n") - 1)
    if not interpolate:
        place = F.greatest(F.ceil(F.col("share") * F.col("n")) - 1, F.lit(0))
    each = materialize(each.withColumn("below", F.floor(place)).withColumn("above", F.ceil(place)), "percentile-ranks")
    ranks = each.select("_g", "lo", "hi", F.explode(F.array("below", "above")).alias("rank")).distinct().withColumn("skipped", F.lit(0).cast("bigint"))
    ranks = materialize(ranks, "percentile-round")
    while not ranks.filter("lo < hi").isEmpty():
        narrow = ranks.filter("lo < hi").groupBy("_g").agg(F.collect_list(F.struct("rank", "lo", "hi", "skipped")).alias("_want"))
        small = checked_broadcast(narrow)
        inside = rows.join(small if small is not None else narrow, "_g").select("_g", "_v", F.explode("_want").alias("w")).select("_g", "_v", "w.*").filter("_v >= lo AND _v <= hi")
        # Halves are subtracted, so the width of a bracket is finite; an infinite end is a bin of its own.
        part = (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        number = F.when(F.col("lo").cast("string").isin(*INFINITE) | F.col("hi").cast("string").isin(*INFINITE),
                        F.when(F.col("_v") == F.col("lo"), 0).when(F.col("_v") == F.col("hi"), 2).otherwise(1)).otherwise(
                            F.least(F.floor(part * bins).cast("int"), F.lit(bins - 1)))
        counts = inside.groupBy("_g", "rank", "skipped", number.alias("bin")).agg(F.count(F.lit(1)).alias("m"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        upto = Window.partitionBy("_g", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        summed = counts.withColumn("end", F.col("skipped") + F.sum("m").over(upto)).withColumn("skipped", F.col("end") - F.col("m"))
        chosen = summed.filter((F.col("rank") >= F.col("skipped")) & (F.col("rank") < F.col("end"))).select("_g", "lo", "hi", "rank", "skipped")
        ranks = materialize(ranks.filter("lo >= hi").select("_g", "lo", "hi", "rank", "skipped").unionByName(chosen), "percentile-round")
    at = ranks.select("_g", "rank", F.col("lo").alias("value"))
    low = at.select("_g", F.col("rank").alias("below"), F.col("value").alias("_low"))
    high = at.select("_g", F.col("rank").alias("above"), F.col("value").alias("_high"))
    found = each.join(low, ["_g", "below"]).join(high, ["_g", "above"])
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("share") * (F.col("n") - 1) - F.col("below")))
    return found.select(*[F.col(f"_g.{k}").alias(c) for c, k in zip(on, key)], "n", "share", between.alias("percentile"))
