"""Session construction and the shared scratch folder.

Intermediate tables (layers written by a pipeline run, round-trip checks) go
under the folder the cluster names in ``spark.checkpoint.dir``.  That setting
is read from the session; a folder is chosen here only when the session has
none (local tests), and then it is placed under the warehouse folder rather
than a machine-local temp directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "billow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings the library relies on.

    UTC session time zone (dates are cut in UTC), ANSI left at its default
    (on), AQE with partition coalescing and skew-join splitting on.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


MB = 1 << 20


def scale_settings(input_bytes: int, cores: int, max_width: int | None = None) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` on ``cores`` task slots.

    Scan splits of 256 MB; an initial shuffle width of about one partition per
    256 MB of input (at least 2 waves of the cluster; no upper bound unless
    ``max_width`` gives one) that AQE then coalesces towards 128 MB per partition.  Partial aggregation shrinks most
    shuffles far below the input size, which the coalescing absorbs; skewed
    join partitions are split by AQE.
    """
    width = max(2 * cores, input_bytes // (256 * MB) + 1)
    if max_width:
        width = min(width, max_width)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
    }


def task_slots(spark: SparkSession) -> int:
    """Tasks that run at once."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect: judge by the session conf
        return int(spark.conf.get("spark.default.parallelism", "200"))


def apply_scale_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Set ``scale_settings`` on the session, but only where the cluster left them unset."""
    try:
        launched = spark.sparkContext.getConf()
        was_set = launched.contains
    except Exception:  # noqa: BLE001 - Spark Connect: judge by the session conf
        was_set = lambda k: spark.conf.get(k, None) is not None
    applied = {}
    for k, v in scale_settings(input_bytes, task_slots(spark)).items():
        if not was_set(k):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def _session_checkpoint_dir(spark: SparkSession) -> str | None:
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        opt = spark.sparkContext._jsc.sc().getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext in this client (Spark Connect)
        return None
    return opt.get() if opt.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    found = _session_checkpoint_dir(spark)
    if found:
        return found
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    chosen = warehouse.rstrip("/") + "/_billow_checkpoints"
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 - Spark Connect: the server's folders are not known here
        master = "local"
    if not master.startswith("local") and (chosen.startswith("file:") or "://" not in chosen):
        raise RuntimeError(f"{chosen} is a folder of this machine: set spark.checkpoint.dir to a shared one")
    try:
        spark.sparkContext.setCheckpointDir(chosen)
    except Exception:  # noqa: BLE001 - Spark Connect: scratch tables only need the path
        return chosen
    return _session_checkpoint_dir(spark) or chosen


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "billow", uuid.uuid4().hex, *parts])


#: Spark's setting to delete a query's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Inside, the session's setting ``key`` is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, each query deletes its shuffle files when it ends, for jobs whose results are stored tables: else the files
    stay until the driver happens to collect its garbage."""
    return setting(spark, FREE_SHUFFLES, "true")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared scratch folder and read back, so that its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
