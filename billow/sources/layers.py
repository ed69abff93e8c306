"""Bronze / silver / gold layers.

Each layer is a written table on shared storage.  Writing a layer cuts the
lineage: a lost executor later in the run re-reads the layer instead of
recomputing from raw.  Gold tables are catalog tables answering Spark SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billow.sources.csv import MALFORMED, list_csv_datasets, path_exists, read_records, typed
from billow.sources.manifest import schema_hash
from billow.spec import ORDINAL


@dataclass(frozen=True)
class Layers:
    """Folder per layer under one root (on the cluster's shared file system)."""

    root: str
    raw_dir: str | None = None

    @property
    def raw(self) -> str:
        return self.raw_dir or f"{self.root}/raw"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}/{name}"


# Independent per-dataset jobs are submitted from a few driver threads, so a
# small dataset's job does not leave executors idle while a large one runs.
MAX_CONCURRENT_JOBS = 4


def run_concurrently(tasks: Mapping[str, Callable[[], object]],
                     max_workers: int = MAX_CONCURRENT_JOBS) -> dict[str, object]:
    """Run independent Spark actions from a thread pool; re-raise the first failure."""
    if len(tasks) <= 1 or max_workers <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


#: Codec of layer tables: about a quarter smaller than Spark's default (snappy).
COMPRESSION = "zstd"


def write_layer(df: DataFrame, path: str) -> None:
    """Overwrite a layer table as Parquet (also when it has 0 rows)."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """A layer table, or None when it was never written."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


@dataclass(frozen=True)
class Buckets:
    """How the layer tables of a run are stored in hash buckets of a column: the catalog holds them beside their path."""

    database: str
    run_id: str
    count: int
    column: str
    null_keys: frozenset[str] = frozenset()  # datasets with rows that have none

    def table(self, name: str) -> str:
        return f"`{self.database}`.`silver_{name}_{self.run_id[:12]}`"


def write_observed(df: DataFrame, path: str, name: str, buckets: Buckets | None = None, table: str | None = None) -> int:
    """Write a layer table and return its row count, counted during the write.

    ``buckets``, ``table``: stored in buckets, as that (external) catalog table too, if it has rows."""
    obs = Observation(name)
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if buckets:
        save_bucketed(df, table, buckets.column, buckets.count, path)
    else:
        write_layer(df, path)
    rows = int(obs.get["rows"])
    if buckets and not rows:
        write_layer(df.sparkSession.createDataFrame([], df.schema), path)  # no bucket leaves no file, and so no schema
    return rows


def save_bucketed(df: DataFrame, table: str, column: str, n: int, path: str | None = None) -> None:
    """Replace a catalog table, stored in ``n`` hash buckets of ``column`` and sorted by it in each.  Rows are first
    hash-partitioned the same way, so each task writes one file; Spark leaves that out where they already are."""
    writer = (df.repartition(n, F.col(f"`{column}`")).write.bucketBy(n, column).sortBy(column)
              .mode("overwrite").format("parquet").option("compression", COMPRESSION))
    (writer.option("path", path) if path else writer).saveAsTable(table)


@dataclass(frozen=True)
class Ingested:
    """What one dataset's ingest wrote and what it could not keep."""

    rows: int
    malformed: int                                          # records in quarantine
    losses: dict[str, int] = field(default_factory=dict)    # column -> values that its cast nulled
    schema_hash: str = ""


def quarantine(bronze: str, name: str) -> str:
    """Table of the records of ``name`` with more fields than the header: their text and ordinal."""
    return f"{bronze}/_quarantine/{name}"


def ingest_dataset(spark: SparkSession, path: str, bronze: str, name: str, schema: StructType | None = None,
                   multiline: bool | None = None) -> Ingested:
    """One raw CSV dataset -> ``bronze/name``.

    Missing-value tokens become null, known columns get their types, and the row ordinal is
    stored so later stages need not rebuild it.  Records with more fields than the header go to the
    quarantine table (written only if there are any, else removed).  Rows, malformed records and values
    that a cast turned to null are counted by the tasks that write bronze, so a retried task counts once.
    """
    raw = read_records(spark, path, multiline)
    values, lost = typed(raw, schema)
    good = F.col(MALFORMED).isNull()
    names = {f"lost_{i}": n for i, n in enumerate(lost)}
    obs = Observation(f"ingest_{name}")
    seen = raw.observe(obs, F.count_if(good).alias("rows"), F.count_if(~good).alias("malformed"),
                       *[F.count_if(good & lost[n]).alias(k) for k, n in names.items()])
    df = seen.where(good).select(*values.values())
    write_layer(df, f"{bronze}/{name}")
    counts = obs.get
    bad = raw.where(~good).select(F.col(MALFORMED).alias("record"), ORDINAL)
    if counts["malformed"]:
        write_layer(bad, quarantine(bronze, name))
    elif path_exists(spark, quarantine(bronze, name)):
        write_layer(spark.createDataFrame([], bad.schema), quarantine(bronze, name))  # an earlier run's records
    return Ingested(int(counts["rows"]), int(counts["malformed"]), {n: int(counts[k]) for k, n in names.items()}, schema_hash(df))


def ingest(spark: SparkSession, raw: str, bronze: str, schemas: Mapping[str, StructType] | None = None,
           multiline: bool | None = None) -> dict[str, Ingested]:
    """Every raw ``*.csv`` -> bronze Parquet of the same (normalised) name.

    ``multiline``: None looks which files hold quoted line breaks (a pass over the text); False takes
    it that none does.  Every file is read by as many tasks as it has splits either way.
    """
    schemas = schemas or {}
    return run_concurrently({name: (lambda n=name, p=path: ingest_dataset(spark, p, bronze, n, schemas.get(n), multiline))
                             for name, path in list_csv_datasets(spark, raw).items()})


def save_gold_table(spark: SparkSession, df: DataFrame, name: str, database: str = "gold",
                    location: str | None = None, bucket_by: str | None = None,
                    buckets: int | None = None) -> str:
    """Replace catalog table ``database.name`` (always, also with 0 rows).

    ``bucket_by``: store the table in ``buckets`` hash buckets of that column,
    so joins of two tables bucketed the same way on it need no shuffle.  Meant for tables with
    a bounded number of rows per key (dimensions, per-key aggregates).
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    full = f"`{database}`.`{name}`"
    if bucket_by:
        save_bucketed(df, full, bucket_by, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    else:
        df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION).saveAsTable(full)
    return full


def read_gold_sql(spark: SparkSession, query: str) -> DataFrame:
    """Answer SQL over the gold catalog tables."""
    return spark.sql(query)
