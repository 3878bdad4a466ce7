"""The stream of sales: enrichment, JSON messages, live totals.

Every function takes and returns DataFrames, streaming or not; the ``run_*`` functions
process what is available and stop. A run starts from the beginning of the source
unless it is given the checkpoint of an earlier run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradewind.functions.running import with_running_sums
from tradewind.schema import SALE_EVENT, UNKNOWN

TOPIC = "transactions"


def kafka_source(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """Messages of a topic from its beginning, as ``value`` text."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic).option("startingOffsets", "earliest").options(**options)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def kafka_sink(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> StreamingQuery:
    """Write ``value`` messages to a topic until the source is exhausted."""
    return messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def file_source(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def text_source(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """JSON lines of a folder as ``value`` messages, the file twin of :func:`kafka_source`."""
    return spark.readStream.format("text").options(**options).load(folder)


def enrich(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sale events with product name and category; unknown products become ``?``."""
    names = products.select("product_id", F.col("name").alias("product"), "category")
    return sales.join(names, "product_id", "left").select(
        F.col("sale_id").cast("string").alias("sale_id"), "client_id",
        F.coalesce("product", F.lit(UNKNOWN)).alias("product"),
        F.coalesce("category", F.lit(UNKNOWN)).alias("category"),
        F.col("sale_date").cast("string").alias("sale_date"), "quantity", "amount")


def encode(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*SALE_EVENT.fieldNames())).alias("value"))


def decode(messages: DataFrame) -> DataFrame:
    """Flat sale events from ``value`` messages; unreadable messages drop out."""
    return messages.select(F.from_json("value", SALE_EVENT).alias("e")).select("e.*") \
        .where(F.col("sale_id").isNotNull())


def totals_by_category(events: DataFrame) -> DataFrame:
    """Live count and revenue per category: the state holds one row per category."""
    return events.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_sales"), F.coalesce(F.sum("amount"), F.lit(0)).alias("revenue"))


def totals(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n_sales"), F.coalesce(F.sum("amount"), F.lit(0)).alias("revenue"))


def _empty_first(schema_of: DataFrame, out: str, fmt: str = "parquet") -> None:
    """A stream that never delivers still leaves a readable result without rows."""
    spark = schema_of.sparkSession
    spark.createDataFrame([], schema_of.schema).write.mode("ignore").format(fmt).save(out)


def run_append(stream: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append the stream's rows to files, exactly once per checkpoint, then stop."""
    _empty_first(stream, out, fmt)
    stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()


_POINTER = "run int, batch bigint, checkpoint string"


def _pointer(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_POINTER).parquet(f"{out}/pointer")


def run_complete(aggregate: DataFrame, out: str, checkpoint: str) -> None:
    """Publish the full results of a streaming aggregate as versions of ``out``, then stop.

    Every batch writes a version of its own and then one row into the pointer table, by which :func:`read_current` finds the
    latest: a reader sees the version before or the one after, never a part. A repeated batch writes its version again, with
    the same rows. Every call is a run, whose versions supersede those of the runs before: with a known checkpoint they go on
    from its totals, with a new one on an old ``out`` they begin anew and nothing of the older results stays. A new checkpoint
    whose stream delivers nothing leaves a version without rows.
    """
    spark = aggregate.sparkSession
    spark.createDataFrame([], _POINTER).write.mode("append").parquet(f"{out}/pointer")
    last = _pointer(spark, out).agg(
        F.coalesce(F.max("run"), F.lit(0)).alias("run"), F.count_if(F.col("checkpoint") == checkpoint).alias("known")).first()
    run = last["run"] + 1

    def publish(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/versions/run-{run}/batch-{batch}")
        rows.sparkSession.range(1).select(
            F.lit(run).alias("run"), F.lit(batch).cast("bigint").alias("batch"), F.lit(checkpoint).alias("checkpoint")) \
            .coalesce(1).write.mode("append").parquet(f"{out}/pointer")

    if not last["known"]:
        publish(spark.createDataFrame([], aggregate.schema), -1)
    aggregate.writeStream.outputMode("complete").foreachBatch(publish) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """The latest version that :func:`run_complete` has published in ``out``."""
    at = _pointer(spark, out).agg(F.max(F.struct("run", "batch")).alias("at")).first()["at"]
    return spark.read.parquet(f"{out}/versions/run-{at['run']}/batch-{at['batch']}")


def run_running_totals(events: DataFrame, out: str, checkpoint: str, order: list[str]) -> None:
    """Per-event running count and revenue across micro-batches.

    Each batch writes its rows and its closing totals into folders named by the batch id
    and starts from the totals of the batches before it, so that a batch that is run
    again replaces its own output and nothing else.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_running_sums(batch.withColumn("one", F.lit(1)), order,
                                 {"total_sales": "one", "total_revenue": "amount"}).drop("one")
        if batch_id > 0:
            before = spark.read.parquet(f"{out}/closing").where(F.col("batch") == batch_id - 1)
            rows = rows.withColumn("total_sales", F.col("total_sales") + before.agg(F.max("n")).scalar()) \
                .withColumn("total_revenue", F.col("total_revenue") + before.agg(F.max("revenue")).scalar())
            opening = before.select("n", "revenue")
        else:
            opening = spark.range(1).select(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("revenue"))
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        here = batch.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("amount"), F.lit(0)).alias("revenue"))
        opening.unionByName(here).agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue")) \
            .write.mode("overwrite").parquet(f"{out}/closing/batch={batch_id}")

    events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
