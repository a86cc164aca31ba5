"""Joins with an explicit physical strategy.

Strategies (the name -> Spark physical node):

* ``auto``          no hint; Catalyst's size estimate and AQE's runtime
                    statistics choose (broadcast for a small side, else
                    sort-merge, with AQE skew splitting).
* ``broadcast``     ``BroadcastHashJoin``, but only after the build side
                    has been *checked* to hold at most ``max_bytes``;
                    beyond that the join is planned as ``auto``.
* ``merge``         ``SortMergeJoin`` (both sides shuffled and sorted).
* ``shuffle_hash``  ``ShuffledHashJoin`` (both sides shuffled, the right
                    one hashed per partition).
* ``salted``        a shuffled join on the key plus a salt. Keys that hold
                    many rows of the big side are found by a distributed
                    count; only their rows are salted and only their rows
                    of the small side are replicated, so one hot key is
                    spread over many tasks and nothing else is copied.

A shuffle-and-replicate nested loop (cartesian product filtered by the
condition) is deliberately not offered: it compares every pair of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "salted")
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
# Rows of one key that one task may hold before the key is salted.
ROWS_PER_SALT = 1_000_000


def data_bytes(df: DataFrame) -> int:
    """Bytes of ``df``'s values, by a distributed sum: text by its length, other columns by 16 bytes a value."""
    def width(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        return F.lit(16)

    row = sum((width(f) for f in df.schema), F.lit(16).cast("bigint"))
    return df.agg(F.sum(row)).first()[0] or 0


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame | None:
    """``F.broadcast(df)`` if its data is within the bound, else ``None``."""
    return F.broadcast(df) if data_bytes(df) <= max_bytes else None


def _hinted(df: DataFrame, strategy: str) -> DataFrame:
    if strategy in ("merge", "shuffle_hash"):
        return df.hint(strategy)
    return df


def join_with_strategy(left: DataFrame, right: DataFrame, on, how: str = "inner",
                       strategy: str = "auto",
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``left`` with ``right`` (the smaller side) using ``strategy``."""
    if strategy not in STRATEGIES or strategy == "salted":
        if strategy == "salted":
            raise ValueError("use salted_join() for the salted strategy")
        raise ValueError(f"unknown join strategy {strategy!r}; one of {STRATEGIES}")
    if strategy == "broadcast":
        small = checked_broadcast(right, max_bytes)
        return left.join(small if small is not None else right, on, how)
    return left.join(_hinted(right, strategy), on, how)


def null_safe_condition(left: DataFrame, right: DataFrame,
                        pairs: list[tuple[str, str]]) -> Column:
    """``l.a <=> r.b AND ...``: null keys match each other."""
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def equi_condition(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """``l.a = r.b AND ...`` for the given column pairs."""
    cond = None
    for lc, rc in pairs:
        c = left[lc] == right[rc]
        cond = c if cond is None else cond & c
    return cond


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                rows_per_salt: int = ROWS_PER_SALT, salt_source: str | None = None) -> DataFrame:
    """Inner equi-join that survives hot keys on the big side.

    A key with n rows on the big side gets ceil(n / ``rows_per_salt``)
    salts. Its big rows are spread over them by a hash of the row (or of
    ``salt_source``), its small rows are replicated once per salt; rows of
    other keys are neither salted nor replicated. So the small side grows by
    its rows of hot keys times their salts, no more, and the table of hot
    keys, which is broadcast, has at most (big rows / ``rows_per_salt``) of
    them. The join itself has no hint and no fixed partition number:
    adaptive execution sizes it. The salt column is dropped from the result.

    The salt is a hash of the row, so it is the same on every recomputation
    (a retried task sends each row where it went before). Identical rows get
    the same salt: pass ``salt_source`` (e.g. a hash of the full source row)
    when the big side's projected rows can repeat.
    """
    hot = (big.groupBy(F.col(big_key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > rows_per_salt)
           .select("_hot", F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")))
    src = [F.col(salt_source)] if salt_source else [F.col(c) for c in big.columns]
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    b = (big.join(F.broadcast(hot), F.col(big_key) == F.col("_hot"), "left")
            .withColumn("_salt", F.pmod(F.hash(*src), salts)).drop("_hot", "_salts"))
    s = (small.join(F.broadcast(hot), F.col(small_key) == F.col("_hot"), "left")
              .withColumn("_copy", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_hot", "_salts"))
    return b.join(s, (b[big_key] == s[small_key]) & (b["_salt"] == s["_copy"])).drop("_salt", "_copy")


def null_safe_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Inner join on keys where null matches null; the columns of both sides.

    The right side is first reduced to one row per key (the greatest of its
    other columns, compared in order), so a key repeated on both sides gives
    one row per left row, never all pairs. Right key columns are dropped.
    """
    keys = [rc for _, rc in pairs]
    rest = [c for c in right.columns if c not in keys]
    clash = set(rest) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    one = right.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_rest")) if rest else right.select(*keys).distinct()
    one = one.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *(["_rest.*"] if rest else []))
    named = [(lc, f"_key_{i}") for i, (lc, _) in enumerate(pairs)]
    return left.join(one, null_safe_condition(left, one, named)).drop(*[k for _, k in named])
