"""Counts and sums over several groupings at once: grouping sets, rollup and cube.

The rows are reduced to the finest grouping first (partial and final
aggregate); only its groups are expanded into the coarser ones, so the
expansion multiplies groups, never rows, and a key holding most of the rows
is one group by then. ``grouping_id`` tells a total from a key that is null:
its bits, the first key's the highest, are 1 for the keys a row totals over.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouping_sets(df: DataFrame, keys: list[str], sets: list[list[str]], sums: list[str] | None = None) -> DataFrame:
    """(keys, grouping_id, count, total_<sum> ...) of each of ``sets``, subsets of ``keys``; a key a set lacks is null."""
    sums = list(sums or [])
    unknown = {c for s in sets for c in s} - set(keys)
    if unknown:
        raise ValueError(f"not among the keys: {sorted(unknown)}")
    finest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    chosen = [list(s) for s in dict.fromkeys(tuple(sorted(set(s), key=keys.index)) for s in sets)]
    # One row per group and set, with the set's number of bits for what it leaves out.
    members = F.array(*[F.struct(*[(F.col(k) if k in s else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys],
                                 F.lit(sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s)).cast("bigint").alias("grouping_id")) for s in chosen])
    each = finest.select(F.explode(members).alias("_g"), "_n", *[f"_sum_{c}" for c in sums]).select("_g.*", "_n", *[f"_sum_{c}" for c in sums])
    out = each.groupBy(*keys, "grouping_id").agg(F.sum("_n").alias("count"), *[F.sum(f"_sum_{c}").alias(f"total_{c}") for c in sums])
    # The grand total of no rows is a row, as in SQL.
    if [] in chosen:
        none = out.agg(F.count(F.lit(1)).alias("_m")).filter("_m = 0")
        zero = none.select(*[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys], F.lit(2 ** len(keys) - 1).cast("bigint").alias("grouping_id"),
                           F.lit(0).cast("bigint").alias("count"), *[F.lit(None).cast(out.schema[f"total_{c}"].dataType).alias(f"total_{c}") for c in sums])
        out = out.unionByName(zero)
    return out


def rollup(df: DataFrame, keys: list[str], sums: list[str] | None = None) -> DataFrame:
    """Every prefix of ``keys``, down to the grand total."""
    return grouping_sets(df, keys, [keys[:i] for i in range(len(keys), -1, -1)], sums)


def cube(df: DataFrame, keys: list[str], sums: list[str] | None = None) -> DataFrame:
    """Every subset of ``keys``."""
    return grouping_sets(df, keys, [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)], sums)
