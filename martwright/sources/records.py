"""Reading quoted CSV files in many tasks, line breaks in quotes included.

A file with line breaks inside quotes cannot be cut at just any line: Spark's
``multiLine`` reader therefore takes a whole file in one task. But whether a line
begins inside quotes follows from the number of quotes before it, and numbers of
quotes add up over pieces. So:

1. one pass over the lines counts quotes: for each piece (file, start of the
   split) its parity, and whether any line alone has an odd number;
2. a file in which every line has an even number holds no quoted line break and
   is read split by the ordinary reader;
3. the lines of other files are read again and stored, with a running sum of
   quotes inside their piece; a prefix sum over the parities of these pieces (a row
   for each piece) tells how each begins, and so how each line does.
   A line that begins and ends outside quotes is a record; only the others are put
   together, by the record that they belong to, in the piece where it begins.

Records are parsed by Spark's own ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martwright.session import stash


def _lines(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    """file, piece (start of the split), at (order in the piece), line, quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"))


def quote_pieces(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, piece, odd, broken): parity of the piece's quotes, and whether one
    of its lines has an odd number. A row for each split of the input."""
    return _lines(spark, path, quote).groupBy("file", "piece").agg(
        F.pmod(F.sum("quotes"), F.lit(2)).cast("int").alias("odd"), F.max(F.pmod("quotes", F.lit(2))).cast("boolean").alias("broken"))


def _whole_records(spark: SparkSession, files: list[str], quote: str) -> DataFrame:
    """(file, piece, at, head, record): every record of the files, at the line where
    it begins; ``head`` marks the first of a file.

    The lines are read once and stored with what their piece alone tells of them: how
    splits fall depends on all files of a scan and on the cores of the moment, so pieces
    of another read need not be the same."""
    upto = Window.partitionBy("file", "piece").orderBy("at")
    held = _lines(spark, files, quote).withColumn("odd", F.pmod("quotes", F.lit(2))).withColumn(
        "before", F.pmod(F.sum("odd").over(upto) - F.col("odd"), F.lit(2)))
    # the last line of an even, an odd number of quotes before it: where a record began, whichever way the piece begins
    last = lambda parity: F.last(F.when(F.col("before") == parity, F.col("at")), ignorenulls=True).over(upto)
    held = held.withColumn("even_at", last(0)).withColumn("odd_at", last(1)).withColumn(
        "head", (F.col("piece") == 0) & (F.row_number().over(upto) == 1))
    held = stash(held.select("file", "piece", "at", "line", "odd", "before", "even_at", "odd_at", "head"), "csv-lines")
    pieces = held.groupBy("file", "piece").agg(F.pmod(F.sum("odd"), F.lit(2)).alias("odd"))
    earlier_pieces = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each split; AQE chooses the joins from its measured size
    begins = stash(pieces.select("file", "piece", F.pmod(F.coalesce(F.sum("odd").over(earlier_pieces), F.lit(0)), F.lit(2)).alias("inside")), "csv-begins")
    marked = held.join(begins, ["file", "piece"]).select(
        "file", "piece", "at", "line", "head", (F.col("before") == F.col("inside")).alias("starts"),
        F.pmod(F.col("before") + F.col("odd") + F.col("inside"), F.lit(2)).alias("after"),
        F.when(F.col("inside") == 0, F.col("even_at")).otherwise(F.col("odd_at")).alias("began"))
    # a caller's filter may be pushed below this one and the join: a part of a record is no record there either
    whole_line = F.expr("starts AND after = 0")
    single = marked.where(whole_line).select("file", "piece", "at", "head", F.when(whole_line, F.col("line")).alias("record"))
    parts = marked.where("NOT (starts AND after = 0)")
    # lines before the first beginning of a piece go on with a record of an earlier piece
    open_ = parts.groupBy("file", "piece").agg(F.max("began").alias("last_began"))
    earlier = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = open_.select("file", "piece", F.last("last_began", ignorenulls=True).over(earlier).alias("_began"),
                           F.last(F.when(F.col("last_began").isNotNull(), F.col("piece")), ignorenulls=True).over(earlier).alias("_piece"))
    owned = parts.join(carried, ["file", "piece"]).select(
        "file", F.coalesce(F.when(F.col("began").isNotNull(), F.col("piece")), F.col("_piece")).alias("owner"),
        F.coalesce("began", "_began").alias("began"), "piece", "at", "line", "head")
    joined = owned.groupBy("file", "owner", "began").agg(
        F.sort_array(F.collect_list(F.struct("piece", "at", "line"))).alias("lines"), F.bool_or("head").alias("head"))
    whole = joined.select("file", F.col("owner").alias("piece"), F.col("began").alias("at"), "head",
                          F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    return single.unionByName(whole)


def read_records(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The rows of the CSV file(s) at ``path``, all columns as text, like the
    reader with ``multiLine`` gives them. ``options`` are the reader's (a header
    is required; quotes inside quotes are doubled). Blank lines are no rows."""
    quote = options["quote"]
    pieces = stash(quote_pieces(spark, path, quote), "csv-pieces")
    broken = [r["file"] for r in pieces.where("broken").select("file").distinct().collect()]  # names of files
    if not broken:
        return spark.read.options(**options, multiLine="false").csv(path)
    columns = spark.read.options(**options, multiLine="true").csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in columns])
    records = _whole_records(spark, broken, quote)
    trimmed = records.select("head", F.regexp_replace("record", "\r$", "").alias("record"))
    # A cast of the reader's columns may be tried before this filter (a caller's filter is
    # pushed below it), so a header or blank line is no record there either: it gives nulls.
    is_row = ~F.col("head") & (F.col("record") != "")
    parser = {k: v for k, v in options.items() if k not in ("header", "inferSchema")}
    rows = trimmed.where(is_row).select(F.from_csv(F.when(is_row, F.col("record")), _ddl(columns), parser).alias("r")).select("r.*")
    clean = [r["file"] for r in pieces.groupBy("file").agg(F.max("broken").alias("b")).where("NOT b").collect()]
    if clean:
        rows = rows.unionByName(spark.read.options(**options, multiLine="false").schema(schema).csv(clean))
    return rows


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
