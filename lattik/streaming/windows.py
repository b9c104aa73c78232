"""Rate windows over event streams, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str, late: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """``key, start, n`` for each window; works on streams (state goes when the watermark passes) and on tables."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("_ts", late)
    return rows.groupBy(F.window("_ts", width).alias("w"), F.col(key)).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.where(F.col("n") > limit)


def too_close(events: DataFrame, seconds: int, key: str, ts: str, tie: str) -> DataFrame:
    """Events less than ``seconds`` behind the one before of the same key."""
    before = F.lag(F.col(ts).cast("timestamp")).over(Window.partitionBy(key).orderBy(ts, tie))
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(before)
    return events.withColumn("gap_us", gap).where(F.col("gap_us") < seconds * 1_000_000)


def replay(spark: SparkSession, path: str, schema: str, out: str, checkpoint: str, width: str, late: str, limit: int) -> None:
    """Read Parquet files as a stream, keep windows over the limit, until all that is there is read."""
    stream = spark.readStream.schema(schema).parquet(path)
    over = over_limit(tumbling(stream, width, late), limit)
    over.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def changed(old: DataFrame, new: DataFrame, key: str, now) -> DataFrame:
    """``new`` with ``seen_at``: the old one where the content is the same, else ``now``."""
    digest = lambda df: F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in (key, "seen_at")))), 256)
    before = old.select(F.col(key), digest(old).alias("_d"), F.col("seen_at").alias("_s"))
    joined = new.withColumn("_n", digest(new)).join(before, key, "left")
    return joined.withColumn("seen_at", F.when(F.col("_n") == F.col("_d"), F.col("_s")).otherwise(now)).drop("_n", "_d", "_s")
