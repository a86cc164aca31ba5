"""What changed between two versions of an extract.

``bag_difference`` counts: a row that is in one version more often than in
the other comes out with by how many, copies included. Both versions are
reduced to one row per distinct row on the map side, so a large group of
copies, or of rows that did not change, is never in one place.

``keyed_difference`` reads the same counts as inserts, deletes and updates
of keyed rows; rows that did not change are gone before anything is grouped
by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE = "change"


def bag_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(columns of ``old``, change): the rows that ``new`` has more (positive) or fewer of (negative) than ``old``."""
    if CHANGE in old.columns or set(old.columns) != set(new.columns):
        raise ValueError("both versions need the same columns, and none named change")
    columns = old.columns
    both = old.select(*columns, F.lit(-1).alias("_d")).unionByName(new.select(*columns, F.lit(1).alias("_d")))
    return both.groupBy(*columns).agg(F.sum("_d").alias(CHANGE)).filter(F.col(CHANGE) != 0)


def apply_bag_difference(old: DataFrame, difference: DataFrame) -> DataFrame:
    """``old`` with the changes made: the version that the difference leads to."""
    columns = old.columns
    counts = old.groupBy(*columns).agg(F.count(F.lit(1)).alias(CHANGE)).unionByName(difference.select(*columns, CHANGE))
    left = counts.groupBy(*columns).agg(F.sum(CHANGE).alias("_n")).filter("_n > 0")
    return left.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i")).drop("_i")


def keyed_difference(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(action, columns): ``insert``, ``delete`` and ``update`` rows that turn ``old`` into ``new``; an update has the new values.

    A key with just one row that went and one that came is an update. Where
    a key is repeated and several of its rows changed, what went is deleted
    and what came is inserted, a row per copy. Null keys are keys.
    """
    columns = old.columns
    rest = [c for c in columns if c not in key]
    changed = bag_difference(old, new)
    sides = changed.groupBy(*key).agg(F.sum(F.when(F.col(CHANGE) > 0, F.col(CHANGE)).otherwise(0)).alias("_came"),
                                      F.sum(F.when(F.col(CHANGE) < 0, -F.col(CHANGE)).otherwise(0)).alias("_went"))
    named = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)]
    sides = sides.select(*named, ((F.col("_came") == 1) & (F.col("_went") == 1)).alias("_one"))
    match = None
    for i, k in enumerate(key):
        c = changed[k].eqNullSafe(sides[f"_key_{i}"])
        match = c if match is None else match & c
    rows = changed.join(sides, match)
    came = F.col(CHANGE) > 0
    action = F.when(F.col("_one"), F.lit("update")).when(came, F.lit("insert")).otherwise(F.lit("delete"))
    rows = rows.filter(~F.col("_one") | came).withColumn("action", action)
    return rows.select("action", *key, *rest, F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs(CHANGE))).alias("_i")).select("action", *columns)


def apply_keyed_difference(old: DataFrame, difference: DataFrame, key: list[str]) -> DataFrame:
    """``old`` with the inserts, deletes and updates made."""
    columns = old.columns
    updates = difference.filter("action = 'update'").select(*columns)
    named = updates.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
    match = None
    for i, k in enumerate(key):
        c = old[k].eqNullSafe(named[f"_key_{i}"])
        match = c if match is None else match & c
    # An updated key's row goes; rows of a key are only updated if it had one that changed.
    went = bag_difference(old.join(named, match, "left_semi"), updates).filter(F.col(CHANGE) < 0)
    deletes = difference.filter("action = 'delete'").groupBy(*columns).agg((-F.count(F.lit(1))).alias(CHANGE))
    inserts = difference.filter("action IN ('insert', 'update')").groupBy(*columns).agg(F.count(F.lit(1)).alias(CHANGE))
    return apply_bag_difference(old, went.unionByName(deletes).unionByName(inserts))
