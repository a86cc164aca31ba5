"""Sketches that are stored per day (or any key) and merged later: distinct counts and quantiles.

A sketch is a binary value of bounded size, so a table of them answers for
any span of days without the rows: HyperLogLog for distinct values, KLL for
quantiles. Sketches are built by a partial and final aggregate, and merging
is one too, in any order. With the defaults a distinct count is within
``DISTINCT_ERROR`` of the true one (five standard errors), and a quantile's
true rank within ``RANK_ERROR`` of the one asked for; small sets are exact.

Nulls don't count; a key whose values are all null has a distinct count of
0 and no quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14                       # 16,384 registers: a standard error of 0.8 %
KLL_K = 800
DISTINCT_ERROR = 0.04
RANK_ERROR = 0.01


def sketch(df: DataFrame, keys: list[str], distinct: str, value: str, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """(keys, n, distincts, quantiles): a sketch of the values of ``distinct`` and one of the doubles ``value`` per key."""
    v = F.col(f"`{value}`").cast("double")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col(f"`{distinct}`"), lg_k).alias("distincts"),
                                 F.kll_sketch_agg_double(F.when(~F.isnan(v), v), k).alias("quantiles"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("distincts").alias("distincts"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def estimate(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """(other columns, n, distinct_estimate, quantile_estimates): the last in the order of ``shares``."""
    rest = [c for c in sketches.columns if c not in ("distincts", "quantiles")]
    some = F.kll_sketch_get_n_double("quantiles") > 0
    asked = F.array(*[F.when(some, F.kll_sketch_get_quantile_double(F.col("quantiles"), F.lit(float(s)))) for s in shares])
    return sketches.select(*rest, F.hll_sketch_estimate("distincts").alias("distinct_estimate"), asked.alias("quantile_estimates"))
