"""The daily summary kept up to date from a stream of order files.

Each micro-batch is reduced to one row per day, channel and buyer and written to
its own folder, named by batch id, so a repeated batch overwrites itself. Buyers
stay exact because the summary counts them from these partial rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwise.functions.exprs import is_paid, round_to


def partials(orders: DataFrame) -> DataFrame:
    """Per day, channel and buyer: orders and amounts of paid orders."""
    return (orders.where(is_paid()).groupBy("order_date", "channel", "user_id")
            .agg(F.count("order_id").alias("orders"), F.sum("paid_amount").alias("paid"), F.sum("discount_amount").alias("discount")))


def start(spark: SparkSession, source: str, schema: StructType, partial_path: str, checkpoint: str) -> StreamingQuery:
    """Process all files that have arrived and stop; run again for the next ones."""
    def write(batch: DataFrame, batch_id: int) -> None:
        partials(batch).write.mode("overwrite").parquet(f"{partial_path}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def summary(spark: SparkSession, partial_path: str) -> DataFrame:
    """The daily summary from all batches so far."""
    p = spark.read.parquet(partial_path)
    per_buyer = p.groupBy("order_date", "channel", "user_id").agg(F.sum("orders").alias("orders"), F.sum("paid").alias("paid"),
                                                                  F.sum("discount").alias("discount"))
    return (per_buyer.groupBy(F.col("order_date").alias("summary_date"), "channel")
            .agg(F.sum("orders").alias("orders"), F.count("user_id").alias("buyers"), round_to(F.sum("paid")).alias("gmv"),
                 round_to(F.sum("discount")).alias("discount_amount"),
                 round_to(F.sum("paid") / F.sum("orders")).alias("avg_order_value")))
