"""Event windows; the batch twins of the streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.queries import query, table
from lattik.streaming import windows


@query("""SELECT user_id, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def str01_over_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of tumbling windows over a limit (STR01, WIN12)."""
    over = windows.over_limit(windows.tumbling(table(spark, sf, "events"), "1 hour", "1 hour"), 1)
    return over.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("""SELECT event_id, gap_us FROM (SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap_us FROM events) WHERE gap_us < 600000000""")
def str02_too_close(spark: SparkSession, sf: str) -> DataFrame:
    return windows.too_close(table(spark, sf, "events"), 600, "user_id", "ts", "event_id").select("event_id", "gap_us")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'now' ELSE 'then' END AS seen_at FROM customer""")
def str05_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps that move only where the content does (STR05, SNK02)."""
    new = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old = new.withColumn("c_name", F.when(F.col("c_custkey") % 3 == 0, F.upper(F.concat("c_name", F.lit("x")))).otherwise(F.col("c_name"))).withColumn("seen_at", F.lit("then"))
    return windows.changed(old, new, "c_custkey", F.lit("now")).select("c_custkey", "seen_at")
