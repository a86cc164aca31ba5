"""Union of overlapping extracts.

``union_all`` keeps every row (UNION ALL). ``union_distinct`` keeps one
copy of each distinct row (UNION): Spark plans it as a hash aggregate on
all columns with a map-side partial step, so even a group of identical
copies holding a large share of the data is collapsed inside each map
task before the shuffle and never lands whole in one reducer.

Both resolve columns by name against the first frame's layout, so two
files whose columns come in different orders still line up; with
``by_name=False`` the positional (SQL) union is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame, by_name: bool = True) -> DataFrame:
    """UNION ALL of ``frames`` (by column name unless ``by_name=False``)."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    op = (lambda a, b: a.unionByName(b)) if by_name else (lambda a, b: a.union(b))
    return reduce(op, frames)


def union_distinct(*frames: DataFrame, key: list[str] | None = None,
                   by_name: bool = True) -> DataFrame:
    """Whole-row de-duplication by default.

    ``key`` de-duplicates on those columns instead (keeping an arbitrary
    row per key); only use it when the key is a true row identity, as it
    lets the optimizer prune the other columns out of the shuffle.
    """
    u = union_all(*frames, by_name=by_name)
    return u.dropDuplicates(key) if key else u.distinct()
