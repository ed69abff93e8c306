"""Small shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billow.session import scratch_path

#: White space of all word rules here: space and the ASCII controls 9 to 13.
WS = r"[\x20\x09-\x0D]+"

#: Spark's setting to delete a query's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and whole text only (null text: empty), so that no other column of the input can clash."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def one_text_each(rows: DataFrame) -> DataFrame:
    """One row for each doc_id with the same other columns: that of the smallest text hash.  Repeated ids meet in
    partial aggregates, so a sample of few ids stays small however often one is repeated."""
    keys = [c for c in rows.columns if c != "text"]
    return rows.groupBy(*keys).agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select(*keys, "least.text")


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written once to the shared scratch folder (apart by the columns ``by``) and read back: lineage ends there,
    and a lost executor loses nothing.  Nothing reads the write's shuffles afterwards, so they are freed."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_apart(df: DataFrame, name: str, by: str, *values: str) -> list[DataFrame]:
    """``df`` stored in one pass as a table for each of the ``values`` of its column ``by``: each can be discarded by itself."""
    whole, out = stored(df, name, by), []
    for value in values:
        out.append(whole.where(F.col(by) == value).drop(by))
        out[-1]._scratch = f"{whole._scratch}/{by}={value}"
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: whatever was made from them is stored itself."""
    for df in tables:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


#: Rows that Spark is asked to broadcast at most; beyond, it joins by shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a stored table), marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df
