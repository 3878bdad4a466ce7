"""Raw CSV files to a typed Parquet lake, and the lake as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from tradewind.functions.storage import stored
from tradewind.operators.cleaning import one_row_per_key
from tradewind.schema import TABLES, Table


def read_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """CSV with a header under the table's schema; a malformed field becomes null."""
    return spark.read.schema(table.schema).option("header", True).option("encoding", "UTF-8") \
        .option("mode", "PERMISSIVE").csv(path)


MALFORMED = "_malformed"


def read_csv_checked(spark: SparkSession, path: str, table: Table) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantine): a line with a field that does not fit its type, or too few or too many fields, is not
    typed with nulls but put aside as ``(table_name, <key> as text, line)``."""
    schema = StructType([*table.schema.fields, StructField(MALFORMED, StringType())])
    rows = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8") \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(path)
    # the parser tells a malformed line only where all its fields are read, so the lines are read once, whole
    whole = stored(rows, "csv-lines")
    typed = whole.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    aside = whole.where(F.col(MALFORMED).isNotNull()).select(
        F.lit(table.name).alias("table_name"), F.col(table.key).cast("string").alias("key"), F.col(MALFORMED).alias("line"))
    return typed, aside


def ingest_checked(spark: SparkSession, csv: str, lake: str, table: Table) -> DataFrame:
    """Ingest one table with its malformed lines put aside in ``<lake>/quarantine/<table>``; returns the audit (table_name,
    rows_read, rows_kept, rows_removed, rows_quarantined), in which rows read are typed ones and those put aside."""
    typed, aside = read_csv_checked(spark, csv, table)
    write_lake(aside, f"{lake}/quarantine", table.name)
    seen, kept = Observation(f"{table.name}_typed"), Observation(f"{table.name}_clean")
    rows = typed.observe(seen, F.count(F.lit(1)).alias("n"))
    write_lake(one_row_per_key(rows, table.key).observe(kept, F.count(F.lit(1)).alias("n")), lake, table.name)
    n_aside = read_lake(spark, f"{lake}/quarantine", table.name).count()
    n_typed, n_kept = seen.get["n"], kept.get["n"]
    return spark.createDataFrame(
        [(table.name, n_typed + n_aside, n_kept, n_typed - n_kept, n_aside)],
        "table_name string, rows_read bigint, rows_kept bigint, rows_removed bigint, rows_quarantined bigint")


def read_csv_lenient(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """CSV read as text and converted field by field; what does not convert becomes null."""
    names = table.schema.fieldNames()
    raw = spark.read.schema(", ".join(f"{c} string" for c in names)).option("header", True) \
        .option("encoding", "UTF-8").csv(path)

    def convert(field):
        text = F.trim(F.col(field.name))
        if isinstance(field.dataType, DateType):
            # a date may come with a time of day
            return F.coalesce(F.try_to_date(text), F.try_to_timestamp(text).cast("date"))
        if isinstance(field.dataType, TimestampType):
            return F.try_to_timestamp(text)
        if isinstance(field.dataType, StringType):
            return F.col(field.name)
        return text.try_cast(field.dataType)

    return raw.select(*[convert(f).alias(f.name) for f in table.schema])


def write_lake(df: DataFrame, lake: str, name: str, partition_by: str | None = None) -> None:
    """Replace a table of the lake; running it again gives the same table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{lake}/{name}")


def write_sales_by_month(sales: DataFrame, lake: str, files: int = 8) -> None:
    """Sales in one folder per month, ``month=YYYY-MM``. Only the months that ``sales`` has are replaced, whole; running it
    again gives the same table. A month is written by up to ``files`` tasks, so a hot one is not one task's work."""
    part = F.pmod(F.xxhash64("sale_id"), F.lit(files))
    sales.withColumn("month", F.date_format("sale_date", "yyyy-MM")).repartition("month", part) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{lake}/sales_by_month")


def read_sales_between(spark: SparkSession, lake: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Sales of ``first``..``last`` (``YYYY-MM-DD``, both included); other months' folders are not read."""
    rows = spark.read.schema(_by_month(spark, lake)).parquet(f"{lake}/sales_by_month")
    for bound, keeps in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
        if bound is not None:
            rows = rows.where(keeps(F.col("month"), F.lit(bound[:7])) & keeps(F.col("sale_date"), F.lit(bound).cast("date")))
    return rows.drop("month")


def _by_month(spark: SparkSession, lake: str) -> StructType:
    """The table's schema with the month as text, not as what its folder names look like."""
    found = spark.read.parquet(f"{lake}/sales_by_month").schema
    return StructType([StructField(f.name, StringType() if f.name == "month" else f.dataType) for f in found])


def ingest_table(spark: SparkSession, csv: str, lake: str, table: Table, lenient: bool = False) -> tuple[str, int, int]:
    """Read, clean and write one table in one pass: (name, rows read, rows kept)."""
    source = (read_csv_lenient if lenient else read_csv)(spark, csv, table)
    seen, kept = Observation(f"{table.name}_read"), Observation(f"{table.name}_kept")
    rows = source.observe(seen, F.count(F.lit(1)).alias("n"))
    clean = one_row_per_key(rows, table.key).observe(kept, F.count(F.lit(1)).alias("n"))
    write_lake(clean, lake, table.name)
    return table.name, seen.get["n"], kept.get["n"]


def ingest(spark: SparkSession, csv_dir: str, lake: str, lenient: bool = False) -> DataFrame:
    """Ingest all five tables from ``<csv_dir>/<table>.csv``; returns the audit."""
    counts = [ingest_table(spark, f"{csv_dir}/{t.name}.csv", lake, t, lenient) for t in TABLES.values()]
    audit = spark.createDataFrame(counts, "table_name string, rows_read bigint, rows_kept bigint")
    return audit.withColumn("rows_removed", F.col("rows_read") - F.col("rows_kept"))


def read_lake(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{lake}/{name}")


def register_views(spark: SparkSession, lake: str) -> None:
    """The lake's tables as SQL views."""
    for name in TABLES:
        read_lake(spark, lake, name).createOrReplaceTempView(name)


def save_tables(spark: SparkSession, lake: str, database: str = "default") -> None:
    """The lake's tables as catalogue tables, replaced if present."""
    for name in TABLES:
        read_lake(spark, lake, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")
