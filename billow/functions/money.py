"""Money arithmetic.

Sums run over an exact decimal and come back as double: the result does not
depend on how rows are split across partitions or in which order a retried
task re-adds them, which a double sum does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from billow.spec import MONEY_PRECISION, MONEY_SCALE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Amount as an exact decimal: units of 1e-9, totals up to 1e29 (parameters in ``spec``)."""
    return _col(c).cast(DecimalType(MONEY_PRECISION, scale))


def money_sum(c: Column | str, scale: int = MONEY_SCALE, empty_as_zero: bool = True) -> Column:
    """Exact sum as double; a group of only nulls sums to 0.0 (not null)."""
    total = F.sum(money(c, scale)).cast("double")
    return F.coalesce(total, F.lit(0.0)) if empty_as_zero else total


def round_money(c: Column | str, digits: int = 2, scale: int = MONEY_SCALE) -> Column:
    """Round half-up on the decimal value, so binary noise never decides a tie."""
    return F.round(_col(c).cast(DecimalType(MONEY_PRECISION, scale)), digits).cast("double")
