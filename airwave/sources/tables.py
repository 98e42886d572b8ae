"""Scans and catalog views (S1-S4), broken log lines kept as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.schemas import RAW_LOG

BROKEN = "_corrupt_record"


def read_play_log(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The ``;``-separated log with a header, every column a string.

    The schema is given, not inferred, so no extra pass over the files;
    empty fields read as NULL and quoted separators stay inside the value.
    """
    return spark.read.schema(RAW_LOG).option("sep", sep).option("header", True).csv(path)


def line_fault(line: Column, fields: int, sep: str = ";") -> Column:
    """Why a line is no row of ``fields`` values: a quote out of place, too few or too many values; NULL if it is one.

    A value is in quotes as a whole, with a backslash before each quote inside, or holds none.
    """
    value = rf'(?:"(?:[^"\\]++|\\.)*+"|[^"{sep}]*+)'
    plain = F.regexp_replace(line, r'"(?:[^"\\]++|\\.)*+"', "")
    values = F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1
    return (F.when(~line.rlike(rf"^{value}(?:{sep}{value})*+$"), "open quote").when(values < fields, "too few values")
            .when(values > fields, "too many values"))


def read_checked_log(spark: SparkSession, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    """The log with its broken lines as data: the columns, ``line`` (the text of a broken line) and ``reason``.

    Lines are judged as text, then parsed; what Spark's CSV parser still cannot
    take as a row (its corrupt-record column) is broken too.  A broken line's
    values are NULL, so no half-read row is kept.  Blank lines are skipped.
    """
    names = RAW_LOG.names
    lines = spark.read.text(path).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.col("value") != sep.join(names))
    layout = ", ".join(f"`{c}` string" for c in [*names, BROKEN])
    row = F.from_csv(F.col("value"), layout, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    judged = lines.select("value", row.alias("row"), F.coalesce(
        line_fault(F.col("value"), len(names), sep), F.when(row.getField(BROKEN).isNotNull(), "unreadable")).alias("reason"))
    good = F.col("reason").isNull()
    return judged.select(*[F.when(good, F.col("row").getField(c)).alias(c) for c in names],
                         F.when(~good, F.col("value")).alias("line"), "reason")


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name or a path in ``fmt``."""
    if "/" not in source and spark.catalog.tableExists(source):
        return spark.table(source)
    return spark.read.format(fmt).load(source)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 64,
              properties: dict | None = None) -> DataFrame:
    """A database table read in parallel slices of ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", partitions))
    return reader.load()


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog (S3)."""
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable (S4) -- schema only, no job."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")
