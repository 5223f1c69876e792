"""Delimited files and JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ";",
                   multi_line: bool = False) -> DataFrame:
    """';'-separated text with a header row. The schema is declared (no
    inference pass over the data). ``multi_line`` keeps quoted line breaks
    inside one record, at the price of one task per file; without it a
    file is split over many tasks. A UTF-8 BOM is stripped by the reader. Columns are
    named by position from the schema, so a duplicated header such as
    ``title`` twice does not matter (T16)."""
    return (spark.read.schema(schema).option("sep", sep).option("header", True)
            .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .option("enforceSchema", True).csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite", bom: bool = False) -> None:
    """';'-separated UTF-8 with a header (S4). With ``bom`` (S5, for
    spreadsheets) every part file starts with a UTF-8 byte-order mark: the
    writer has no BOM option, so the mark is carried as the first character
    of the header, which is the first thing each part file holds."""
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    (df.write.mode(mode).option("sep", sep).option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON Lines with a declared nested schema (S6); no inference pass."""
    return spark.read.schema(schema).json(path)


def parse_json_lines(lines: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """The same parse applied to a column of JSON text (landed pages,
    responses, or lines produced inside a plan): ``from_json`` then
    expand the struct."""
    return lines.select(F.from_json(F.col(col), schema).alias("_j")).select("_j.*")


class TooManyBadLines(ValueError):
    """More lines could not be read than the run allows."""


def read_jsonl_checked(spark: SparkSession, path: str, schema: StructType, quarantine: str | None = None,
                       most_bad: float = 0.0) -> DataFrame:
    """JSON Lines of which broken lines are set aside instead of lost.

    A line that is no JSON of the declared types goes to the table
    ``quarantine`` (file, block: start of the file's part that holds it, line)
    and not into the result; blank lines are none of either. If more than the
    share ``most_bad`` of the lines is broken, the run stops with
    ``TooManyBadLines``, the broken lines being in the table by then."""
    good, bad, n = split_json_lines(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")), schema)
    if quarantine is not None:
        bad.write.mode("overwrite").parquet(quarantine)
    counts = n.first()
    if counts["bad"] > most_bad * (counts["good"] + counts["bad"]):
        raise TooManyBadLines(f"{counts['bad']} of {counts['good'] + counts['bad']} lines of {path} are broken")
    return good


def split_json_lines(lines: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of the lines that can be read, broken lines, one row with the
    numbers of both) of lines with the columns value, file and block."""
    marked = StructType([*schema.fields, StructField("_broken", StringType())])
    parsed = lines.filter(F.trim("value") != "").withColumn("_j", F.from_json(
        "value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    broken = F.col("_j").isNull() | F.col("_j._broken").isNotNull()
    good = parsed.filter(~broken).select(*[F.col(f"_j.`{f.name}`").alias(f.name) for f in schema.fields])
    bad = parsed.filter(broken).select("file", "block", F.col("value").alias("line"))
    return good, bad, parsed.agg(F.count_if(~broken).alias("good"), F.count_if(broken).alias("bad"))
