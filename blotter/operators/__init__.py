"""DataFrame -> DataFrame operators."""

from .aggregate import group_count, one_per_key, sum_by_key
from .asof import asof_join
from .difference import apply_bag_difference, apply_keyed_difference, bag_difference, keyed_difference
from .filters import (firearm_with_coordinates, in_half_open, nonzero, where_equals, where_like,
                      where_not_null)
from .intervals import interval_join, overlap_join
from .islands import islands
from .joins import (STRATEGIES, checked_broadcast, equi_condition, join_with_strategy,
                    null_safe_condition, null_safe_join, salted_join)
from .nearest import k_nearest
from .percentiles import exact_percentiles
from .rollup import cube, grouping_sets, rollup
from .sets import union_all, union_distinct
from .topk import bottom_k, top_k
from .window import rank_within, top_n_per_group

__all__ = [
    "STRATEGIES", "apply_bag_difference", "apply_keyed_difference", "asof_join", "bag_difference", "bottom_k", "checked_broadcast", "cube", "equi_condition", "exact_percentiles",
    "firearm_with_coordinates", "group_count", "grouping_sets", "in_half_open", "interval_join", "islands",
    "join_with_strategy", "k_nearest", "keyed_difference", "nonzero",
    "null_safe_condition", "null_safe_join", "one_per_key", "overlap_join", "rank_within", "rollup", "salted_join",
    "sum_by_key", "top_k",
    "top_n_per_group", "union_all", "union_distinct", "where_equals", "where_like",
    "where_not_null",
]
