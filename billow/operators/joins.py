"""Joins.

No join here forces a broadcast: what Spark broadcasts is decided by
``spark.sql.autoBroadcastJoinThreshold`` against the estimated size, and by
AQE against the measured size of a finished shuffle stage.  Both are checked
sizes; a dimension that grows with the data falls back to a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join on same-named keys; right rows may fan out the left."""
    return left.join(right, list(keys), "left")


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key exists in ``right`` (no fan-out, no right columns)."""
    return left.join(right.select(right[right_key].alias(left_key)), [left_key], "left_semi")
