"""As-of join: to every row the latest earlier row of its key.

Both sides are first reduced to one row per key and time: the right to the
row that wins its ties, the left to the times that are asked for. These are
put in one order per key and time bucket, in which the last right row is
carried forward; what a bucket starts with is carried between buckets in a
small table of one row per key and bucket. So a key that holds a third of
all rows is spread over its buckets, and rows that share a key and time are
one row. The answers are then joined back to the left rows, hot times
salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import _all_known, _refuse_shared
from .joins import ROWS_PER_SALT, salted_join
from .times import seconds


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, ties: list[str],
              bucket: int = 86400, same_time: bool = True, max_age: int | None = None, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every left row with the columns of the latest right row of its key that is not later.

    Of right rows at one time the largest in ``ties`` wins (rows equal in
    them too: the largest in their other columns). ``same_time=False`` takes
    only strictly earlier rows, ``max_age`` (seconds) none older. ``bucket``
    is a bucket's length in seconds.

    Defined results: a left row with a null key or time, or with no earlier
    row, has null right columns; right rows with a null key or time match
    nothing; repeated left rows stay; names that both sides have are refused.
    """
    _refuse_shared(left, right, on)
    extra = [c for c in right.columns if c not in on]
    rest = [c for c in extra if c not in ties and c != right_at]
    spot = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(on)]
    key = [f"_k{i}" for i in range(len(on))]
    known = _all_known(right, [right_at, *on])
    rows = known.select(*spot, F.col(right_at).alias("_at"), F.floor(seconds(right, right_at) / bucket).alias("_bucket"), F.struct(*ties, *rest, right_at).alias("_row"))
    rows = rows.groupBy(*key, "_at", "_bucket").agg(F.max("_row").alias("_row"))
    asked = _all_known(left, [left_at, *on]).select(*spot, F.col(left_at).alias("_at"), F.floor(seconds(left, left_at) / bucket).alias("_bucket")).distinct()
    # What each bucket starts with: the last row of the buckets before it.
    ends = rows.groupBy(*key, "_bucket").agg(F.max(F.struct("_at", "_row")).alias("_end"))
    buckets = asked.select(*key, "_bucket").distinct().join(ends, [*key, "_bucket"], "full")
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*key, "_bucket", F.last("_end", ignorenulls=True).over(before)["_row"].alias("_carry"))
    one = asked.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)).withColumn("_asks", F.lit(1))
    both = one.unionByName(rows.withColumn("_asks", F.lit(0)).select(*one.columns))
    order = F.col("_asks").asc() if same_time else F.col("_asks").desc()
    upto = Window.partitionBy(*key, "_bucket").orderBy("_at", order).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_row", F.last("_row", ignorenulls=True).over(upto)).filter("_asks = 1").join(carried, [*key, "_bucket"], "left")
    answers = seen.select(F.struct(*key, "_at").alias("_there"), F.coalesce("_row", "_carry").alias("_row"))
    placed = left.withColumn("_here", F.when(_known(on, left_at), F.struct(*spot, F.col(left_at).alias("_at"))))
    found = salted_join(placed.filter("_here IS NOT NULL"), answers, "_here", "_there", rows_per_salt).drop("_here", "_there")
    none = placed.filter("_here IS NULL").drop("_here").withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType))
    out = found.unionByName(none).select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in extra])
    if max_age is None:
        return out
    young = seconds(left, left_at) - seconds(right, right_at) <= max_age
    return out.select(*left.columns, *[F.when(young, F.col(f"`{c}`")).alias(c) for c in extra])


def _known(on: list[str], at: str):
    cond = F.col(f"`{at}`").isNotNull()
    for c in on:
        cond = cond & F.col(f"`{c}`").isNotNull()
    return cond
