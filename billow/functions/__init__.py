"""Column expressions: all built-in Spark SQL functions, no Python UDFs."""

from billow.functions.dates import (dayfirst_date, lenient_date, lenient_timestamp,
                                    month_period)
from billow.functions.money import money, money_sum, round_money
from billow.functions.text import (churn_flag, is_null_token, normalise_dataset_name,
                                   null_tokens_to_null, sale_type)

__all__ = [
    "dayfirst_date", "lenient_date", "lenient_timestamp", "month_period",
    "money", "money_sum", "round_money",
    "churn_flag", "is_null_token", "normalise_dataset_name", "null_tokens_to_null",
    "sale_type",
]
