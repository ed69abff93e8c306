"""Which tables a run wrote to a layer.

A stage ends by appending one small file to ``<root>/_manifest``: run id, layer, dataset,
rows and a hash of the schema.  The file appears with the commit of its write or not at
all.  Later stages read the datasets that the newest entry of their layer names, and nothing else: a
table folder left by an earlier run is not taken for one of this run.  On a restart the
tables are compared with what the entry says of them.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billow.sources.csv import path_exists

_SCHEMA = "run_id string, seq long, layer string, dataset string, rows long, schema_hash string"


class ManifestError(RuntimeError):
    """A layer is not what its manifest says, or has none."""


@dataclass(frozen=True)
class Entry:
    rows: int
    schema_hash: str


def schema_hash(df: DataFrame) -> str:
    """Names and types in order (nullability changes when a table is read back)."""
    return hashlib.sha256(repr(df.dtypes).encode()).hexdigest()[:16]


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def write_manifest(spark: SparkSession, root: str, layer: str, run_id: str, tables: dict[str, Entry]) -> None:
    """One file, committed as a whole; a run that wrote no table says so by an entry without dataset."""
    seq = time.time_ns()
    rows = [(run_id, seq, layer, n, e.rows, e.schema_hash) for n, e in tables.items()] or [(run_id, seq, layer, None, None, None)]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(_folder(root))


def read_manifest(spark: SparkSession, root: str, layer: str) -> tuple[str, dict[str, Entry]] | None:
    """(run id, tables) of the newest entry of ``layer``; a few rows reach the driver."""
    if not path_exists(spark, _folder(root)):
        return None
    found = spark.read.schema(_SCHEMA).parquet(_folder(root)).where(F.col("layer") == layer)
    last = found.agg(F.max("seq").alias("seq")).first().seq
    if last is None:
        return None
    rows = found.where(F.col("seq") == last).collect()
    return rows[0].run_id, {r.dataset: Entry(r.rows, r.schema_hash) for r in rows if r.dataset is not None}


def verified(spark: SparkSession, root: str, layer: str) -> tuple[str, dict[str, Entry]]:
    """The newest entry of ``layer`` after comparing row counts (file footers) and schemas of its tables with it."""
    found = read_manifest(spark, root, layer)
    if found is None:
        raise ManifestError(f"no finished {layer} under {root}")
    run_id, tables = found
    for name, entry in tables.items():
        path = f"{root.rstrip('/')}/{layer}/{name}"
        if not path_exists(spark, path):
            raise ManifestError(f"{path} of run {run_id} is missing")
        df = spark.read.parquet(path)
        if schema_hash(df) != entry.schema_hash or df.count() != entry.rows:
            raise ManifestError(f"{path} is not what run {run_id} wrote")
    return run_id, tables
