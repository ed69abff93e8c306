"""CSV records of files whose quoted fields hold line breaks, without giving up splits.

A split of such a file may begin inside a quoted field, and nothing in the split
itself says so.  Each line is a function from "begins outside a quoted field" and
"begins inside one" to the same two states: it keeps the state, flips it, or ends
in one state however it began.  Functions of lines compose to functions of splits,
functions of splits (one small row each) compose along the file, and so every split
learns how it begins, every line where its record begins.

Lines that are records by themselves stay where they were read but for one exchange by split;
only lines of broken records are grouped, one group a record.  No file is read by one task.
Quotes count only where a field begins (``5" pipe`` is plain text), a doubled quote stays in its field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUTSIDE, INSIDE, QUOTED = 0, 1, 2  # QUOTED: after a quote within a quoted field, its end or half a doubled one


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"), F.monotonically_increasing_id().alias("row"))


def ends_inside(line: str, begins_inside: bool) -> Column:
    """Whether a quoted field goes on after ``line``, given how the line begins (1 or 0)."""
    start = INSIDE if begins_inside else OUTSIDE
    state = F.expr(f"""aggregate(slice(split({line}, '"', -1), 1, size(split({line}, '"', -1)) - 1),
        named_struct('state', {start}, 'first', true), (a, p) -> named_struct('state', CASE
            WHEN a.state = {INSIDE} THEN {QUOTED}
            WHEN a.state = {QUOTED} AND p = '' THEN {INSIDE}
            WHEN endswith(p, ',') OR (a.first AND p = '') THEN {INSIDE}
            ELSE {OUTSIDE} END, 'first', false), a -> a.state)""")
    return F.when(F.contains(line, F.lit('"')), (state == INSIDE).cast("int")).otherwise(F.lit(int(begins_inside)))


def files_with_breaks(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files in which a line that begins outside a quoted field ends inside one.

    Without such a line no line of the file begins inside, so the test is exact.
    Whole quoted fields are taken out first; only lines with quotes left are followed quote by quote."""
    left = F.regexp_replace("line", '(?<=^|,)"[^"]*"(?=,|\r?$)', "")
    open_lines = _lines(spark, paths).where(F.contains("line", F.lit('"'))).where(F.contains(left, F.lit('"'))) \
        .where(ends_inside("line", False) == 1)
    return sorted(r.file for r in open_lines.select("file").distinct().collect())


def _begin(value: str, flips: str, entry: Column | int, order) -> tuple[Column, Column]:
    """State before each row from the last row that fixes it (column ``value``) and the flips since; (state, fixed before?)."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum(flips).over(before), F.lit(0))
    # flips up to and with a fixing row, carried along with its value
    fixed = F.last(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("__total").alias("t"))), ignorenulls=True).over(before)
    return F.when(fixed.isNull(), (F.lit(entry) + so_far) % 2).otherwise((fixed["v"] + so_far - fixed["t"]) % 2), fixed.isNotNull()


def _as_function(df: DataFrame, order) -> DataFrame:
    """Columns from_out, from_in (states after) -> value (null: not fixed), flips, __total (flips up to here)."""
    df = df.withColumns({"value": F.when(F.col("from_out") == F.col("from_in"), F.col("from_out")),
                         "flips": ((F.col("from_out") == 1) & (F.col("from_in") == 0)).cast("int")})
    return df.withColumn("__total", F.sum("flips").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def split_states(lines: DataFrame) -> DataFrame:
    """file, offset, begins_inside, ends_inside of every split; one row each."""
    by_split = Window.partitionBy("file", "offset").orderBy("row")
    by_file = Window.partitionBy("file").orderBy("offset")
    # only lines that do something, without their text
    some = _as_function(lines.where("NOT (from_out = 0 AND from_in = 1)").select("file", "offset", "row", "from_out", "from_in"), by_split)
    last = some.groupBy("file", "offset").agg(
        F.max(F.when(F.col("value").isNotNull(), F.struct("row", "value", F.col("__total").alias("at")))).alias("fix"), F.sum("flips").alias("all"))
    after = lambda begin: F.when(F.col("fix").isNull(), (F.lit(begin) + F.col("all")) % 2).otherwise((F.col("fix.value") + F.col("all") - F.col("fix.at")) % 2)
    splits = lines.select("file", "offset").distinct().join(
        last.select("file", "offset", after(0).alias("from_out"), after(1).alias("from_in")), ["file", "offset"], "left")
    splits = _as_function(splits.withColumns({"from_out": F.coalesce("from_out", F.lit(0)), "from_in": F.coalesce("from_in", F.lit(1))}), by_file)
    begin, _ = _begin("value", "flips", 0, by_file)
    splits = splits.withColumn("begins_inside", begin.cast("int"))
    return splits.select("file", "offset", "begins_inside",
                         F.when(F.col("begins_inside") == 1, F.col("from_in")).otherwise(F.col("from_out")).cast("int").alias("ends_inside"))


class UnclosedQuote(ValueError):
    """A file ends inside a quoted field."""


def records(spark: SparkSession, paths: Sequence[str], table) -> DataFrame:
    """text, file, offset, row of every record that is not blank; the last three are those of its first line.

    ``table``: function that writes a DataFrame to shared scratch storage and reads it back."""
    lines = _lines(spark, paths).withColumns({"from_out": ends_inside("line", False), "from_in": ends_inside("line", True)})
    splits = table(split_states(lines), "csv_splits")
    last = splits.groupBy("file").agg(F.max_by("ends_inside", "offset").alias("open")).where("open = 1")
    if not last.isEmpty():
        raise UnclosedQuote(f"{last.first().file} ends inside a quoted field")
    by_split = Window.partitionBy("file", "offset").orderBy("row")
    lines = _as_function(lines.join(splits.select("file", "offset", "begins_inside"), ["file", "offset"]), by_split)
    begin, _ = _begin("value", "flips", 0, by_split)
    begin_in, _ = _begin("value", "flips", 1, by_split)
    lines = lines.withColumn("inside", F.when(F.col("begins_inside") == 1, begin_in).otherwise(begin).cast("int"))
    lines = lines.withColumn("open", F.when(F.col("inside") == 1, F.col("from_in")).otherwise(F.col("from_out")))
    # the row of the record's first line, unknown where the record began in an earlier split
    lines = lines.withColumn("first", F.last(F.when(F.col("inside") == 0, F.col("row")), ignorenulls=True).over(by_split.rowsBetween(Window.unboundedPreceding, 0)))
    lines = table(lines.select("file", "offset", "row", "line", "inside", "open", "first"), "csv_lines")
    whole = lines.where("inside = 0 AND open = 0").select("line", "file", "offset", "row")
    # first line of the record that is open at the end of each split, for the splits after it
    by_file = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.where("inside = 0 AND open = 1").groupBy("file", "offset").agg(F.max("row").alias("start"))
    starts = splits.select("file", "offset").join(starts, ["file", "offset"], "left") \
        .withColumn("from", F.last(F.when(F.col("start").isNotNull(), F.struct("offset", "start")), ignorenulls=True).over(by_file))
    broken = lines.where("inside = 1 OR open = 1").join(starts.select("file", "offset", "from"), ["file", "offset"])
    broken = broken.withColumns({"at": F.when(F.col("first").isNull(), F.col("from.offset")).otherwise(F.col("offset")),
                                 "first": F.coalesce("first", "from.start")})
    # one group is one record
    joined = broken.groupBy("file", F.col("at").alias("o"), "first").agg(F.array_sort(F.collect_list(F.struct("offset", "row", "line"))).alias("lines"))
    joined = joined.select(F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("line"), "file", F.col("o").alias("offset"), F.col("first").alias("row"))
    return whole.unionByName(joined).select(F.regexp_replace("line", "\r$", "").alias("text"), "file", "offset", "row").where(F.length(F.trim("text")) > 0)
