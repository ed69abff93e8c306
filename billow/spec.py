"""Declarative dataset specs: required keys, date rules, keep-last keys.

One spec per dataset drives cleaning (``plans.clean``), the data-quality
report (``plans.quality``) and the pipeline (``plans.pipeline``).  Column
names are parameters, so the same plans run on the billing tables and on the
role views derived from the TPC-H-ish test tables (``sources.roles``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import DoubleType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Datasets in processing order, with their required (not-null) columns.
REQUIRED_COLUMNS = {
    "customers": ("customer_id",),
    "subscriptions": ("subscription_id", "Customer"),
    "invoicing": ("subscription_id",),
    "costs": ("subscription_id",),
    "sales_tags": ("subscription_id",),
}
# Datasets checked by the post-transform quality gate, with their key columns.
POST_DQ_KEYS = {
    "customers": ("customer_id",),
    "subscriptions": ("subscription_id", "Customer"),
    "invoicing": ("subscription_id",),
    "costs": ("subscription_id",),
}
# Invoicing columns whose name contains one of these (any case) are timestamps.
INVOICE_DATE_NAME_PARTS = ("created", "start")
# Costs: the latest record per these columns is kept.
COST_KEEP_LAST_KEY = ("subscription_id", "month")
# Churn: a status matching this pattern (lower-cased) marks a churned subscription.
CHURN_STATUS_PATTERN = "cancel|terminate|churn"
# Sales tags look like "type:detail"; the sale type is the part before this.
TAG_DELIMITER = ":"
# Text read as null from CSV (the default missing-value tokens of pandas' CSV reader).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
# ---------------------------------------------------------------------------

# Money is summed as an exact decimal of this scale and returned as double,
# so sums do not depend on partitioning or row order.
MONEY_PRECISION = 38
MONEY_SCALE = 9

# Name of the per-row ordinal column carried from the CSV scan (see sources.csv).
ORDINAL = "_row_order"


@dataclass(frozen=True)
class DatasetSpec:
    """How one dataset is cleaned from bronze to silver."""

    name: str
    required: tuple[str, ...] = ()
    keep_last_by: tuple[str, ...] = ()           # keep the latest row per key
    timestamp_name_parts: tuple[str, ...] = ()   # name patterns -> lenient UTC date
    dayfirst_date_columns: tuple[str, ...] = ()  # text dates, ISO or dd/MM/yyyy
    date_order: str = "ymd"                      # "ydm" reproduces the reference's swap
    order_by: tuple[str, ...] = (ORDINAL,)       # what "latest"/"first" means
    post_dq_keys: tuple[str, ...] | None = None  # None: not in the post-DQ gate
    keep_row_order: bool = True                  # carry the ordinal into silver

    def with_order(self, *cols: str) -> "DatasetSpec":
        return replace(self, order_by=tuple(cols))


def billing_specs(order_by: tuple[str, ...] = (ORDINAL,)) -> dict[str, DatasetSpec]:
    """The five billing datasets in processing order.

    Only customers and subscriptions keep their row order in silver: the gold
    dimensions take the first row per key.  Invoicing, costs and tags need no
    order after cleaning, so their dedupe is a plain hash aggregation.
    """
    return {
        "customers": DatasetSpec("customers", REQUIRED_COLUMNS["customers"],
                                 order_by=order_by,
                                 post_dq_keys=POST_DQ_KEYS["customers"]),
        "subscriptions": DatasetSpec("subscriptions", REQUIRED_COLUMNS["subscriptions"],
                                     order_by=order_by,
                                     post_dq_keys=POST_DQ_KEYS["subscriptions"]),
        "invoicing": DatasetSpec("invoicing", REQUIRED_COLUMNS["invoicing"],
                                 timestamp_name_parts=INVOICE_DATE_NAME_PARTS,
                                 order_by=order_by, keep_row_order=False,
                                 post_dq_keys=POST_DQ_KEYS["invoicing"]),
        "costs": DatasetSpec("costs", REQUIRED_COLUMNS["costs"],
                             keep_last_by=COST_KEEP_LAST_KEY,
                             dayfirst_date_columns=("month",),
                             order_by=order_by, keep_row_order=False,
                             post_dq_keys=POST_DQ_KEYS["costs"]),
        "sales_tags": DatasetSpec("sales_tags", REQUIRED_COLUMNS["sales_tags"],
                                  order_by=order_by, keep_row_order=False),
    }


# Columns that are numbers in the billing exports; the rest stays text.
AMOUNT_COLUMNS = {"invoicing": ("calculated_cost",), "costs": ("Cost",)}


def billing_schemas() -> dict[str, StructType]:
    """Types of the columns that are not text, by dataset."""
    return {name: StructType([StructField(c, DoubleType()) for c in cols]) for name, cols in AMOUNT_COLUMNS.items()}


@dataclass(frozen=True)
class BillingColumns:
    """Column names the gold marts use; override to run on other schemas."""

    subscription_id: str = "subscription_id"
    customer_ref: str = "Customer"
    customer_id: str = "customer_id"
    status: str = "status"
    cancelled_at: str = "cancelled_at"
    invoice_amount: str = "calculated_cost"
    invoice_start: str = "start"
    cost_month: str = "month"
    cost_amount: str = "Cost"
    tag: str = "tag"


COLS = BillingColumns()
