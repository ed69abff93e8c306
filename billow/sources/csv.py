"""CSV scans and sinks.

``read_csv`` reads every field as text in one pass (no inference pass),
turns missing-value tokens into null, and casts the known columns with
``try_cast`` so a bad value becomes null instead of failing the job.  Unknown
columns stay text.  It also attaches the row ordinal ``_row_order``: one number made of
the file's rank in the listing, the split's start and the row within the scan task,
taken directly at the scan before any shuffle: Spark has no row order, and
keep-first/keep-last in file order needs one.  Being one number, its minimum is a
hash aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from billow.functions.text import normalise_dataset_name, null_tokens_to_null
from billow.session import stored
from billow.sources import records
from billow.spec import NULL_TOKENS, ORDINAL


def _hadoop_fs(spark: SparkSession, path: str):
    """Hadoop file system of ``path``, or None without JVM access (Spark Connect)."""
    try:
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath
    except Exception:  # noqa: BLE001 - no SparkContext / JVM in this client
        return None


def _file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``length`` of every file under ``folder``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(folder).select("path", "length"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """File-system metadata check on the driver (no data is read)."""
    fs = _hadoop_fs(spark, path)
    if fs is not None:
        return bool(fs[0].exists(fs[1]))
    try:
        _file_listing(spark, path).schema
        return True
    except Exception as exc:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return False
        raise


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete scratch files that nothing reads any more (without JVM access they stay)."""
    fs = _hadoop_fs(spark, path)
    if fs is not None:
        fs[0].delete(fs[1], True)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Total size of the files under ``folder`` (file-system metadata only)."""
    fs = _hadoop_fs(spark, folder)
    if fs is not None:
        return int(fs[0].getContentSummary(fs[1]).getLength()) if fs[0].exists(fs[1]) else 0
    if not path_exists(spark, folder):
        return 0
    return int(_file_listing(spark, folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def list_csv_datasets(spark: SparkSession, folder: str) -> dict[str, str]:
    """Every ``*.csv`` entry directly in ``folder`` (not recursive) -> dataset name.

    An entry may be a file or a folder of part files.  Names are normalised:
    ``Sales tags.csv`` -> ``sales_tags``.
    """
    base = folder.rstrip("/")
    fs = _hadoop_fs(spark, folder)
    if fs is not None:
        jvm = spark.sparkContext._jvm
        statuses = fs[0].globStatus(jvm.org.apache.hadoop.fs.Path(base + "/*.csv")) or []
        entries = [(st.getPath().getName(), st.getPath().toString()) for st in statuses]
    else:
        entries = _entries_from_listing(spark, base)
    found: dict[str, str] = {}
    for file_name, path in sorted(entries, key=lambda e: e[1]):
        name = normalise_dataset_name(file_name)
        if name in found:
            raise ValueError(f"{found[name]} and {path} are both dataset {name!r}")
        found[name] = path
    return found


def _entries_from_listing(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """Top-level ``*.csv`` entries of ``base`` from a file listing (paths only reach the driver)."""
    if not path_exists(spark, base):
        return []
    if "://" in base:
        base_path = base.split("://", 1)[1]
    else:
        base_path = base[len("file:"):] if base.startswith("file:") else base
    base_path = base_path.rstrip("/") + "/"
    entries: dict[str, str] = {}
    # the part of each path up to the first slash after the folder: one row an entry comes to the driver
    after = F.substring_index(F.substring(F.col("path"), F.locate(base_path, F.col("path")) + F.lit(len(base_path)), F.length("path")), "/", 1)
    before = F.substring(F.col("path"), F.lit(1), F.locate(base_path, F.col("path")) + F.lit(len(base_path) - 1))
    tops = _file_listing(spark, base).where(F.contains("path", F.lit(base_path))).select(before.alias("before"), after.alias("top"))
    for row in tops.where(F.endswith("top", F.lit(".csv"))).distinct().collect():
        entries[row.top] = row.before + row.top
    return sorted(entries.items())


#: The ordinal is one number: rank of the file, byte offset of the split (14 digits), row within the scan task (10 digits).
ORDINAL_TYPE = DecimalType(38, 0)
#: Files whose ranks Spark is asked to broadcast; beyond, it decides how to join them.
BROADCAST_FILES = 1_000_000


# RFC 4180 quoting: a quote inside a quoted field is doubled.
DIALECT = {"quote": '"', "escape": '"'}
#: Text of a record with more fields than the header.
MALFORMED = "_malformed"
FROM_CSV = DIALECT | {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def natural_key(path: str) -> list:
    """Sort key in which digits count as numbers (``part-99999`` before ``part-100000``)."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"([0-9]+)", path) if x]


def file_ranks(files: Sequence[str]) -> dict[str, int]:
    """Rank of each file in natural order of the paths, under the spellings that Spark has for them."""
    ranks: dict[str, int] = {}
    for spell in (lambda f: f, unquote):
        for n, f in enumerate(sorted(files, key=lambda f: (natural_key(unquote(f)), f))):
            rest = re.sub(r"^file:/+", "", spell(f))
            for name in ([f"file:/{rest}", f"file:///{rest}"] if f.startswith("file:/") else [rest]):
                ranks.setdefault(name, n)
    return ranks


def _with_ordinal(df: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """The columns ``__file``, ``__offset``, ``__row`` as one number.  A file without a rank is an error."""
    if len(set(ranks.values())) == 1:
        rank = F.lit(0)
    else:
        table = df.sparkSession.createDataFrame(list(ranks.items()), "__file string, __rank bigint")
        df = df.join(F.broadcast(table) if len(ranks) <= BROADCAST_FILES else table, "__file", "left")
        rank = F.coalesce("__rank", F.raise_error(F.concat(F.lit("file is not in the listing: "), "__file")).cast("bigint"))
    in_task = F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))  # the id's other bits are the task's number
    packed = (rank.cast("decimal(13,0)") * F.lit(10 ** 14).cast("decimal(15,0)") + F.col("__offset")).cast("decimal(28,0)")
    number = (packed * F.lit(10 ** 10).cast("decimal(11,0)") + in_task).cast(ORDINAL_TYPE)
    return df.withColumn(ORDINAL, number).drop("__file", "__offset", "__row", "__rank")


def csv_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The data files under ``path`` (a listing; nothing is read)."""
    return spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()


def _plain(path: str) -> str:
    """One spelling of a path: without escapes, ``file:/x`` for ``file:///x``."""
    return re.sub(r"^file:/+", "file:/", unquote(path))


def field_count(record: Column) -> Column:
    """Fields of a record: commas outside quoted fields, and one."""
    bare = F.regexp_replace(record, r'(?s)(?<=^|,)"(?:[^"]++|"")*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def _extra_fields(df: DataFrame, n_columns: int) -> DataFrame:
    """``MALFORMED`` stays only where a record has more fields than the header (short ones are filled with nulls)."""
    extra = F.col(MALFORMED).isNotNull() & (field_count(F.col(MALFORMED)) > n_columns)
    # Spark refuses a scan of this column alone: name another one beside it
    text = F.concat(MALFORMED, F.substring(F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit("")), 1, 0))
    return df.withColumn(MALFORMED, F.when(extra, text))


def _text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in (*names, MALFORMED)])


def _scan(spark: SparkSession, paths: Sequence[str], ranks: dict[str, int]) -> DataFrame:
    """Splittable scan of files without quoted line breaks."""
    reader = spark.read.options(**DIALECT).option("header", True).option("inferSchema", False)
    names = reader.csv(list(paths)).columns
    # a malformed record is only seen when all fields are parsed, so columns are not pruned
    raw = (reader.option("mode", "PERMISSIVE").option("enforceSchema", False).option("columnPruning", False)
           .option("columnNameOfCorruptRecord", MALFORMED).schema(_text_schema(names)).csv(list(paths)))
    placed = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__offset"),
                        F.monotonically_increasing_id().alias("__row"))
    return _extra_fields(_with_ordinal(placed, ranks), len(names))


def _scan_records(spark: SparkSession, paths: Sequence[str], ranks: dict[str, int]) -> DataFrame:
    """Scan of files with quoted line breaks: records put together from the lines of all splits."""
    names = (spark.read.options(**DIALECT).option("header", True).option("inferSchema", False)
             .option("multiLine", True).csv(paths[0]).columns)
    found = records.records(spark, paths, stored)
    heads = stored(found.groupBy("file").agg(F.min(F.struct("offset", "row", "text")).alias("head")), "csv_heads")
    numbered = [f"c{i}" for i in range(len(names))]  # any text may be a name
    as_row = lambda c: F.from_csv(c, F.lit(", ".join(f"{n} string" for n in (*numbered, MALFORMED))), FROM_CSV)
    cells = F.array(*[F.lower(F.col("row").getField(n)) for n in numbered])
    other = heads.select("file", as_row(F.regexp_replace("head.text", "^\ufeff", "")).alias("row")) \
        .where(F.col("row").getField(MALFORMED).isNotNull() | ~cells.eqNullSafe(F.array(*[F.lit(n.lower()) for n in names]))).first()
    if other is not None:
        raise ValueError(f"the header of {other.file} differs: {names} expected")
    first = heads.select("file", F.col("head.offset").alias("head_offset"), F.col("head.row").alias("head_row"))
    body = found.join(first, "file").where("offset <> head_offset OR row <> head_row")  # one row a file: Spark broadcasts it if small
    body = _with_ordinal(body.select(as_row(F.col("text")).alias("__r"), F.col("file").alias("__file"), F.col("offset").alias("__offset"),
                                     F.col("row").alias("__row")), ranks)
    return _extra_fields(body.select(*[F.col("__r").getField(c).alias(n) for c, n in zip((*numbered, MALFORMED), (*names, MALFORMED))], ORDINAL), len(names))


def read_records(spark: SparkSession, path: str | Sequence[str], multiline: bool | None = None) -> DataFrame:
    """Every field as text, the row ordinal, and ``MALFORMED``: the record's text where it has more fields than the header.

    Files whose headers differ are an error (``enforceSchema`` off), never read by position.
    ``multiline``: None looks which files hold quoted line breaks; True takes it that all may, False that none does.
    Either way every file is read by as many tasks as it has splits.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = csv_files(spark, paths)
    ranks = file_ranks(files)
    if multiline is False:
        return _scan(spark, paths, ranks)
    plain = set(map(_plain, files))
    broken = plain if multiline else set(map(_plain, records.files_with_breaks(spark, paths)))
    parts = [_scan(spark, paths, ranks)] if not broken else []
    if broken:
        whole = sorted(plain - broken)
        parts = [_scan_records(spark, sorted(broken), ranks), *([_scan(spark, whole, ranks)] if whole else [])]
        # files without a line (the first task of a write leaves one if it has no rows) have no header to compare
        parts = [p for p in parts if p.columns != [MALFORMED, ORDINAL]]
    if len(parts) == 2 and [c.lower() for c in parts[0].columns] != [c.lower() for c in parts[1].columns]:
        raise ValueError(f"headers differ: {parts[0].columns[:-2]} and {parts[1].columns[:-2]}")
    return reduce(DataFrame.union, parts)


def typed(raw: DataFrame, schema: StructType | None, null_tokens: Sequence[str] = NULL_TOKENS) -> tuple[dict[str, Column], dict[str, Column]]:
    """(column -> its value: null tokens to null, known columns cast; column -> whether the cast lost its text)."""
    types = {f.name.lower(): f.dataType for f in (schema.fields if schema else [])}
    values, lost = {}, {}
    for name in raw.columns:
        if name == MALFORMED:
            continue
        c = F.col(f"`{name}`")
        if name != ORDINAL:
            c = null_tokens_to_null(c, tuple(null_tokens))
            dtype = types.get(name.lower())
            if dtype is not None and not isinstance(dtype, StringType):
                lost[name] = c.isNotNull() & c.try_cast(dtype).isNull()
                c = c.try_cast(dtype)
        values[name] = c.alias(name)
    return values, lost


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
             null_tokens: Sequence[str] = NULL_TOKENS, with_ordinal: bool = True,
             multiline: bool | None = None, malformed: str = "raise") -> DataFrame:
    """Header CSV -> typed DataFrame with null tokens and an optional row ordinal.

    ``malformed``: what becomes of records with more fields than the header: "raise" stops the job
    that reads them, "keep" keeps them with their text in the column ``MALFORMED``.
    """
    raw = read_records(spark, path, multiline)
    values, _ = typed(raw, schema, null_tokens)
    if malformed == "raise":
        text = F.concat(F.lit("record with more fields than the header: "), F.substring(MALFORMED, 1, 200))
        raw = raw.where(F.when(F.col(MALFORMED).isNull(), True).otherwise(F.raise_error(text).cast("boolean")))
    keep = [c for n, c in values.items() if with_ordinal or n != ORDINAL]
    return raw.select(*keep, *([MALFORMED] if malformed == "keep" else []))


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Header CSV with Spark's type inference (an extra pass over the sample)."""
    return (spark.read.options(**DIALECT).option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path))


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text."""
    return spark.read.options(**DIALECT).option("header", True).option("inferSchema", False).csv(path)


def read_optional(spark: SparkSession, path: str, schema: StructType, reader=None) -> DataFrame:
    """Read ``path`` if it exists, else a typed empty table (downstream plans stay valid)."""
    if path_exists(spark, path):
        return reader(spark, path) if reader else read_csv(spark, path, schema)
    fields = list(schema.fields)
    if reader is None and ORDINAL not in schema.fieldNames():
        fields.append(StructField(ORDINAL, ORDINAL_TYPE))
    return spark.createDataFrame([], StructType(fields))


#: Rows of a compressed part file, which one task reads whole.
COMPRESSED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, drop: Sequence[str] = (ORDINAL,), compression: str | None = None) -> None:
    """Overwrite ``path`` with header CSV (no index column); values keep their white space.

    ``compression``: e.g. gzip.  Such a file has one split, so files end after ``COMPRESSED_ROWS`` rows."""
    keep = [f"`{c}`" for c in df.columns if c not in set(drop)]
    writer = (df.select(*keep).write.mode("overwrite").options(**DIALECT).option("header", True)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        writer = (writer.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_ROWS)
                  .option("zlib.compress.level", "BEST_SPEED"))  # gzip: about as fast as plain text
    writer.csv(path)
