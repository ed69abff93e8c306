"""DataFrame -> DataFrame building blocks.

Every operator is lazy and built from Spark's own aggregates and joins, so
partial (map-side) aggregation, pushdown and AQE apply.  None collects data to
the driver.
"""

from billow.operators.aggregate import group_count
from billow.operators.dedup import (drop_row_duplicates, duplicate_groups, keep_first,
                                    keep_last, keep_latest, row_duplicate_count)
from billow.operators.joins import left_join, semi_join
from billow.operators.nulls import null_counts, present, require_not_null

__all__ = [
    "group_count",
    "drop_row_duplicates", "duplicate_groups", "keep_first", "keep_last", "keep_latest",
    "row_duplicate_count", "left_join", "semi_join", "null_counts", "present",
    "require_not_null",
]
