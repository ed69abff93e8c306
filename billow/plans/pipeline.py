"""Full run: raw CSV -> bronze -> silver -> quality gate -> gold tables.

Every layer is written to shared storage before the next stage reads it, so
each stage restarts from the previous layer, not from raw, after a failure.
A manifest names the tables a stage wrote; the next one reads those and no others.
Dropped rows and values that a date parse nulled are counted by the tasks that
write a table (no extra pass, and a retried task counts once).
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from billow.plans import marts
from billow.plans.clean import cleaned, count_exprs, group_for_clean, loss_exprs, parse_dates, steps_from_counts
from billow.plans.enrich import enrich_subscriptions
from billow.plans.quality import REPORT_SCHEMA, dq_rows, gate, raw_vs_bronze
from billow.session import apply_scale_settings, freed_shuffles, scratch_path, setting, task_slots
from billow.sources.csv import delete_path, folder_bytes, list_csv_datasets, read_csv, write_csv
from billow.sources.layers import (Buckets, Layers, ingest, read_layer, run_concurrently, save_gold_table,
                                   write_layer, write_observed)
from billow.sources.manifest import Entry, schema_hash, verified, write_manifest
from billow.spec import COLS, REQUIRED_COLUMNS, BillingColumns, DatasetSpec, billing_schemas, billing_specs

STEP_SCHEMA = StructType([
    StructField("dataset", StringType()), StructField("step", StringType()),
    StructField("rows_before", LongType()), StructField("rows_after", LongType()),
    StructField("rows_dropped", LongType()),
])


@dataclass
class RunResult:
    run_id: str = ""
    ingested: dict[str, int] = field(default_factory=dict)
    malformed: dict[str, int] = field(default_factory=dict)   # records in quarantine, by dataset
    losses: list[tuple] = field(default_factory=list)         # (dataset, layer, column, values nulled)
    silver: dict[str, Entry] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    steps: list[tuple] = field(default_factory=list)
    dq: DataFrame | None = None
    gold: dict[str, str] = field(default_factory=dict)


#: Datasets whose silver tables are stored in hash buckets of the subscription id.
BUCKETED = ("subscriptions", "invoicing", "costs")


def _silver_buckets(spark: SparkSession, layers: Layers, datasets: Mapping[str, Entry], specs: Mapping[str, DatasetSpec],
                    cols: BillingColumns, database: str, run_id: str) -> Buckets | None:
    """Buckets for the silver tables of this run, or None where they would be uneven.

    Rows are counted by bucket in bronze (a scan of one column).  A bucket is one task's work, so if any has more than
    twice ``BUCKET_ROWS`` (a subscription with very many rows), no silver table is bucketed and every later step
    shuffles by itself, after partial sums.  Rows without the key are not in silver."""
    key = cols.subscription_id
    present = [n for n in BUCKETED if n in datasets and n in specs]
    if not present or any(key not in specs[n].required for n in present):
        return None
    n = max(bucket_counts({k: e.rows for k, e in datasets.items()})["subscription_id"],
            min(task_slots(spark), -(-max(e.rows for e in datasets.values()) // SLOT_ROWS)))
    bronze = {name: read_layer(spark, layers.table("bronze", name)) for name in (*present, *({"sales_tags"} & set(datasets)))}
    if any(key not in df.columns for df in bronze.values()):
        return None

    def load(df: DataFrame) -> tuple[int | None, int | None]:
        """Rows of the largest bucket, rows without the key."""
        bucket = F.when(F.col(key).isNotNull(), F.pmod(F.hash(key), F.lit(n))).alias("bucket")
        return df.groupBy(bucket).count().agg(F.max(F.when(F.col("bucket").isNotNull(), F.col("count"))),
                                              F.max(F.when(F.col("bucket").isNull(), F.col("count")))).first()
    loads = run_concurrently({name: (lambda df=df: load(df)) for name, df in bronze.items()})
    if any((largest or 0) > 2 * BUCKET_ROWS for largest, _ in loads.values()):
        return None
    return Buckets(database, run_id, n, key, frozenset(name for name, (_, without) in loads.items() if without))


def _in_buckets(buckets: Buckets | None, silver: Mapping[str, Entry]) -> list[str]:
    """The silver tables that are stored in buckets: of those meant to be, all with rows."""
    return [n for n in BUCKETED if buckets and n in silver and silver[n].rows]


def _clean_one(spark: SparkSession, layers: Layers, name: str, spec: DatasetSpec,
               cols: BillingColumns, tags: bool, buckets: Buckets | None = None) -> tuple[list[tuple], list[tuple], Entry]:
    """Write one silver table; (dropped-row steps, lost values, manifest entry)."""
    buckets = buckets if name in BUCKETED else None
    parsed, apart = parse_dates(read_layer(spark, layers.table("bronze", name)), spec, losses=True), None
    if buckets and name in buckets.null_keys:
        # rows that cleaning drops for their key are only counted; in one bucket they could be very many
        apart = group_for_clean(parsed.where(F.col(buckets.column).isNull()), spec)
        parsed = parsed.where(F.col(buckets.column).isNotNull())
    g = group_for_clean(parsed, spec, buckets.count, buckets.column) if buckets else group_for_clean(parsed, spec)
    exprs, steps = count_exprs(g)
    lost = loss_exprs(g)
    obs = Observation(f"clean_{name}")
    g.rows = g.rows.observe(obs, *exprs, *lost.values())
    silver, path = cleaned(g), layers.table("silver", name)
    staged = None
    if name == "subscriptions":
        pairs = read_layer(spark, layers.table("bronze", "sales_tags")) if tags else None
        in_place = buckets and pairs is not None and dict(silver.dtypes).get(buckets.column) == dict(pairs.dtypes).get(buckets.column)
        if tags and not in_place:
            # counts belong to the tasks that write; below the join a recomputed stage would count again
            staged = scratch_path(spark, "clean_subscriptions")
            write_layer(silver, staged)
            silver = spark.read.parquet(staged)
        # in buckets of one key, grouping, join and write are one stage
        silver = enrich_subscriptions(silver, pairs, cols, buckets.count if in_place else None)
    if not buckets and staged is None and g.required:
        # rows of a key beside each other pack closer, here and in the shuffles of what reads them (the join sorts by it)
        silver = silver.sortWithinPartitions(f"`{g.required[0]}`")
    rows = write_observed(silver, path, f"silver_{name}", buckets, buckets.table(name) if buckets else None)
    if staged is not None:
        delete_path(spark, staged)
    counts = obs.get
    if apart:
        more = apart.rows.agg(*exprs, *lost.values()).first().asDict()
        counts = {k: (counts[k] or 0) + (v or 0) for k, v in more.items()}
    losses = [(name, "silver", c, int(counts[k])) for k, c in zip(lost, g.parsed)]
    return steps_from_counts(name, counts, steps), losses, Entry(rows, schema_hash(silver))


def transform(spark: SparkSession, layers: Layers, specs: Mapping[str, DatasetSpec],
              cols: BillingColumns = COLS, result: RunResult | None = None,
              datasets: Collection[str] | None = None, buckets: Buckets | None = None) -> RunResult:
    """Bronze -> silver for every spec'd dataset (independent jobs, run concurrently).

    ``datasets``: the bronze tables of this run; None: those of the newest bronze manifest.
    ``buckets``: how the silver tables of subscriptions are stored; None: as plain files.
    Each silver table depends on bronze only (subscriptions also on bronze
    sales tags), so the datasets do not wait for each other.
    """
    result = result or RunResult(run_id=uuid.uuid4().hex)
    if datasets is None:
        datasets = verified(spark, layers.root, "bronze")[1]
    done = run_concurrently({name: (lambda n=name, s=spec: _clean_one(spark, layers, n, s, cols, "sales_tags" in datasets, buckets))
                             for name, spec in specs.items() if name in datasets})
    for name in specs:
        if name not in done:
            result.skipped.append(name)
            continue
        steps, losses, result.silver[name] = done[name]
        result.steps.extend(steps)
        result.losses.extend(losses)
    write_manifest(spark, layers.root, "silver", result.run_id, result.silver)
    return result


# Gold tables stored in hash buckets of their join key (one row per key, or
# per key and month / sale type, so no key can dominate a bucket).
GOLD_BUCKET_KEYS = {
    "dim_customer": "customer_id",
    "dim_subscription": "subscription_id",
    "fct_profitability": "subscription_id",
    "fct_churn": "subscription_id",
}


#: Spark's setting to shuffle both sides of a join that are partitioned by some of its keys only.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
#: Rows of a bucket of a gold table, by the rows of the silver tables it is made of.
BUCKET_ROWS = 1_000_000
#: Smaller tables have a bucket for each task slot, but none for fewer rows than these.
SLOT_ROWS = 100_000
#: Silver tables that bound the rows of the gold tables bucketed on a key; tables of one key share a bucket count.
BUCKET_SOURCES = {"customer_id": ("customers",), "subscription_id": ("subscriptions", "invoicing", "costs", "sales_tags")}


def bucket_counts(rows: Mapping[str, int]) -> dict[str, int]:
    """Buckets by join key, from the row counts of the silver or bronze tables (one at least)."""
    return {key: max(1, -(-max(rows.get(n, 0) for n in names) // BUCKET_ROWS)) for key, names in BUCKET_SOURCES.items()}


def model(spark: SparkSession, layers: Layers, cols: BillingColumns = COLS,
          database: str = "gold", buckets: int | None = None,
          datasets: Mapping[str, Entry] | None = None, stored: Buckets | None = None) -> dict[str, str]:
    """Silver -> gold catalog tables (always replaced, also when empty).

    ``datasets``: the silver tables of this run; None: those of the newest silver manifest.
    Facts and dimensions joined on subscription id share their hash buckets, so the fact-to-dimension
    join over gold needs no shuffle.  Their number follows from the silver row counts
    (``bucket_counts``) unless ``buckets`` gives one.
    ``stored``: how silver tables are stored in buckets already; the facts and dimensions made of them need no shuffle then.
    """
    if datasets is None:
        datasets = verified(spark, layers.root, "silver")[1]
    silver = {n: read_layer(spark, layers.table("silver", n)) if n in datasets else None
              for n in ("customers", "subscriptions", "invoicing", "costs")}
    sized = bucket_counts({n: e.rows for n, e in datasets.items()})
    keyed = dict(silver)
    if stored:
        sized["subscription_id"] = stored.count
        keyed.update({n: spark.table(stored.table(n)) for n in _in_buckets(stored, datasets)})
    count = lambda n: buckets or sized.get(GOLD_BUCKET_KEYS.get(n))
    tables: dict[str, DataFrame] = {}
    if silver["customers"] is not None:
        tables["dim_customer"] = marts.dim_customer(silver["customers"], cols)
    if silver["subscriptions"] is not None:
        tables["dim_subscription"] = marts.dim_subscription(keyed["subscriptions"], cols)
        tables["fct_churn"] = marts.fct_churn(silver["subscriptions"], cols)
    if silver["invoicing"] is not None:
        tables["fct_sales"] = marts.fct_sales(silver["invoicing"])
        tables["fct_profitability"] = marts.fct_profitability(keyed["invoicing"], keyed["costs"], cols, count("fct_profitability"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{layers.gold}'")
    keys = {n: (cols.customer_id if k == "customer_id" else cols.subscription_id)
            for n, k in GOLD_BUCKET_KEYS.items()}
    # buckets of the join's first key are even (``_silver_buckets``), so its sides stay where they are
    with setting(spark, CO_PARTITION, "false") if stored else nullcontext():
        return run_concurrently({name: (lambda n=name, df=df: save_gold_table(
            spark, df, n, database, bucket_by=keys.get(n), buckets=count(n)))
            for name, df in tables.items()})


STAGES = ("ingest", "transform", "model")


def _pre_checks(spark: SparkSession, layers: Layers, schemas: Mapping[str, StructType], written: Collection[str],
                multiline: bool | None) -> None:
    """Raw against bronze for every dataset with required columns; a raw dataset without bronze table fails."""
    reports = []
    for name, path in list_csv_datasets(spark, layers.raw).items():
        if name not in REQUIRED_COLUMNS:
            continue
        if name not in written:
            reports.append(spark.createDataFrame([(name, "present", None, None, None, False)], REPORT_SCHEMA))
            continue
        # malformed records are counted apart, so both sides are compared without them
        raw = read_csv(spark, path, schemas.get(name), multiline=multiline, malformed="keep")
        raw = raw.where(raw["_malformed"].isNull()).drop("_malformed")
        reports.append(raw_vs_bronze(name, raw, read_layer(spark, layers.table("bronze", name)), REQUIRED_COLUMNS[name]))
    if reports:
        gate(reduce(DataFrame.unionByName, reports))


def _loss_rows(result: RunResult) -> list[tuple]:
    """Report rows of what ingest and cleaning could not keep.  Malformed records and amounts that are no
    numbers fail the gate; text that is no date becomes null by rule, and is counted only."""
    rows = [(n, "malformed_rows", None, k, 0, k == 0) for n, k in result.malformed.items()]
    return rows + [(n, f"lost_values:{layer}", c, k, 0 if layer == "bronze" else None, k == 0 if layer == "bronze" else None)
                   for n, layer, c, k in result.losses]


def run_pipeline(spark: SparkSession, layers: Layers,
                 schemas: Mapping[str, StructType] | None = None,
                 specs: Mapping[str, DatasetSpec] | None = None,
                 cols: BillingColumns = COLS, database: str = "gold",
                 pre_checks: bool = False, post_gate: bool = True,
                 size_session: bool = False, multiline: bool | None = None,
                 start_at: str = "ingest", export_csv: bool = False, keep_raw: bool = True) -> RunResult:
    """Ingest, (optional pre-check), transform, post-check + gate, model.

    ``schemas``: types by dataset (default: the billing amounts are numbers).
    ``size_session``: derive shuffle and split sizes from the raw input size
    (``session.apply_scale_settings``) for settings the cluster left unset.
    ``start_at``: "transform" or "model" restarts a failed run from the layer
    the previous stage already wrote (bronze or silver) instead of from raw: its manifest
    names the tables, which must still be as it says.
    ``export_csv``: also write each gold table that has rows as CSV under ``<gold>_csv``.
    ``keep_raw``: False for a raw folder that is a copy made for this run: it is deleted when bronze is
    written (and compared with it, if ``pre_checks``); nothing later reads it.
    The quality check before the model always runs.
    """
    if start_at not in STAGES:
        raise ValueError(f"start_at must be one of {STAGES}")
    with freed_shuffles(spark):
        return _run(spark, layers, schemas, specs, cols, database, pre_checks, post_gate, size_session, multiline,
                    start_at, export_csv, keep_raw)


def _run(spark: SparkSession, layers: Layers, schemas: Mapping[str, StructType] | None, specs: Mapping[str, DatasetSpec] | None,
         cols: BillingColumns, database: str, pre_checks: bool, post_gate: bool, size_session: bool, multiline: bool | None,
         start_at: str, export_csv: bool, keep_raw: bool) -> RunResult:
    specs = specs or billing_specs()
    schemas = billing_schemas() if schemas is None else schemas
    result = RunResult(run_id=uuid.uuid4().hex)
    if size_session:
        apply_scale_settings(spark, folder_bytes(spark, layers.raw))
    if start_at == "ingest":
        done = ingest(spark, layers.raw, layers.bronze, schemas, multiline)
        bronze = {n: Entry(d.rows, d.schema_hash) for n, d in done.items()}
        write_manifest(spark, layers.root, "bronze", result.run_id, bronze)
        result.ingested = {n: d.rows for n, d in done.items()}
        result.malformed = {n: d.malformed for n, d in done.items()}
        result.losses = [(n, "bronze", c, k) for n, d in done.items() for c, k in d.losses.items()]
        result.warnings.extend(f"{n}: not in raw, skipped" for n in specs if n not in result.ingested)
        if pre_checks:
            _pre_checks(spark, layers, schemas, done, multiline)
        if not keep_raw:
            delete_path(spark, layers.raw)
    else:
        _, bronze = verified(spark, layers.root, "bronze")
    buckets = None
    try:
        if start_at in ("ingest", "transform"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{layers.gold}'")
            buckets = _silver_buckets(spark, layers, bronze, specs, cols, database, result.run_id)
            transform(spark, layers, specs, cols, result, bronze, buckets)
        else:
            _, result.silver = verified(spark, layers.root, "silver")
        _check_and_model(spark, layers, specs, cols, database, post_gate, bronze, buckets, result)
    finally:
        for name in BUCKETED if buckets else ():
            spark.sql(f"DROP TABLE IF EXISTS {buckets.table(name)}")  # the files stay: silver is read by path
    if export_csv:
        for name, table in result.gold.items():
            df = spark.table(table)
            if not df.isEmpty():
                write_csv(df, f"{layers.gold}_csv/{name}")
    return result


def _check_and_model(spark: SparkSession, layers: Layers, specs: Mapping[str, DatasetSpec], cols: BillingColumns, database: str,
                     post_gate: bool, bronze: Mapping[str, Entry], buckets: Buckets | None, result: RunResult) -> None:
    bucketed = _in_buckets(buckets, result.silver)
    silver = {n: read_layer(spark, layers.table("silver", n)) if n in result.silver else None for n in specs}
    silver |= {n: spark.table(buckets.table(n)) for n in bucketed}
    # bronze row counts stand in the manifest: observed while ingest wrote bronze
    report = dq_rows(silver, {n: e.rows for n, e in bronze.items()},
                     {n: s.post_dq_keys for n, s in specs.items() if s.post_dq_keys is not None}, {n: [buckets.column] for n in bucketed})
    # a few dozen rows: computed once, kept, so reading the report later does
    # not scan the silver tables again
    result.dq = spark.createDataFrame([*report, *_loss_rows(result)], REPORT_SCHEMA)
    if post_gate:
        gate(result.dq)
    result.gold = model(spark, layers, cols, database, datasets=result.silver, stored=buckets)


def steps_frame(spark: SparkSession, result: RunResult) -> DataFrame:
    """The observed dropped-row counts as a small DataFrame."""
    return spark.createDataFrame(result.steps, STEP_SCHEMA)
