"""Files of collection runs: one JSON document each, as collectors write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HEALTH = "struct<venue_slug:string,status:string,instrument_count:bigint,ticker_count:bigint,parse_failures:bigint,requests_attempted:bigint>"
_TICKER = "struct<venue_slug:string,symbol_native:string,last_price:double,bid_price:double,ask_price:double,quote_volume_24h:double,collector_receive_time:bigint>"
SCHEMA = f"run_id string, origin string, collection_started_at bigint, collection_finished_at bigint, health array<{_HEALTH}>, tickers array<{_TICKER}>, _corrupt_record string"


def collected(spark: SparkSession, folder: str, now_ms: int, oldest_s: int = 7200) -> DataFrame:
    """One row per file, by name: what it brings, and its status. A file that cannot be read, has no run, or is too old stays as an explicit failed row and brings nothing."""
    rows = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(folder)
    named = rows.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    age = (now_ms - F.col("collection_finished_at")) / 1000
    reason = F.when(F.col("_corrupt_record").isNotNull(), "unreadable").when(F.col("run_id").isNull(), "no_run").when(F.col("collection_finished_at").isNull() | (age > oldest_s), "too_old")
    out = named.withColumn("reason", reason)
    empty = lambda c: F.when(F.col("reason").isNull(), F.coalesce(c, F.array()))
    return out.select("file", "run_id", "origin", F.when(F.col("reason").isNull(), "success").otherwise("failed").alias("status"), "reason", empty("health").alias("health"), empty("tickers").alias("tickers")).orderBy("file")


def tickers(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'success'").select("run_id", F.inline("tickers"))


def venue_health(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'success'").select("run_id", F.inline("health"))
