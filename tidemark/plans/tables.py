"""All tables that are stored beside the market states, from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import views as V
from tidemark.plans.catalogue import _judged
from tidemark.plans.state_queries import venue_rows
from tidemark.sources.datasets import MarketClient, carried


def _id(column: str):
    return F.concat(F.lit("asset:named:part:P"), column)


def tables(spark: SparkSession, sf_dir: str, generation: str, at_ms: int, before: MarketClient | None = None) -> dict[str, DataFrame]:
    """A generation's tables. before: the client of the generation before, from which assets and instruments carry when they were first seen."""
    obs, parts = V.obs(spark, sf_dir), V.table(spark, sf_dir, "part")
    was = lambda name: None if before is None else before.table(name)
    traded = obs.groupBy(F.col("asset").alias("t_asset")).agg(F.count_distinct("venue").alias("venue_count"))
    assets = parts.join(traded, F.col("p_partkey") == F.col("t_asset"), "left").select(
        _id("p_partkey").alias("asset_id"), F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.col("p_name").alias("name"), F.lit("resolved").alias("resolution_state"), F.lit(False).alias("is_stablecoin"), F.lit(False).alias("is_fiat"), F.coalesce("venue_count", F.lit(0)).alias("venue_count"),
    )
    listed = obs.select("asset", "venue").distinct()
    aliases = listed.select(_id("asset").alias("asset_id"), F.col("venue").cast("string").alias("venue_slug"), F.concat(F.lit("P"), "asset").alias("venue_symbol"), F.lit("resolved").alias("resolution_state"), F.array(F.lit("listed name")).alias("evidence"))
    first = parts.groupBy(F.col("p_name").alias("f_name")).agg(F.min("p_partkey").alias("f_part"))
    alike = parts.join(first, (F.col("p_name") == F.col("f_name")) & (F.col("p_partkey") > F.col("f_part"))).select(_id("p_partkey").alias("from_asset_id"), _id("f_part").alias("to_asset_id"), F.lit("shares_name").alias("relationship"), F.lit("catalogue").alias("source"))
    markets = obs.select("asset", "venue", "kind", "ccy").distinct()
    instruments = markets.select(
        F.concat_ws(":", F.lit("instrument"), "venue", "asset", "kind", "ccy").alias("instrument_id"), F.col("venue").cast("string").alias("venue_slug"), F.col("kind").alias("instrument_type"), F.when(F.col("kind") == "perpetual", "linear-perp").otherwise(F.col("kind")).alias("instrument_class"),
        F.concat(F.lit("P"), "asset", F.lit("/c"), "ccy").alias("symbol_normalized"), _id("asset").alias("base_asset_id"), F.concat(F.lit("c"), "ccy").alias("quote_asset_id"), F.when(F.col("kind") == "perpetual", "perpetual").when(F.col("kind") == "future", "dated").alias("settlement_period"), F.lit(True).alias("active"),
    )
    health = obs.groupBy(F.col("venue").cast("string").alias("venue_slug")).agg(F.lit("success").alias("status"), F.count_distinct("asset", "kind", "ccy").alias("instrument_count"), F.count("*").alias("ticker_count"))
    # a reason comes out of a generator, behind which the test stays: as a plain column it is worked out again in the test, in one method that is too large to be compiled
    judged = _judged(spark, sf_dir).select("venue", "asset", "age_s", F.stack(F.lit(1), F.col("reason")).alias("reason"))
    events = judged.filter("reason is not null").select(
        F.lit(generation).alias("generation_id"), F.col("venue").cast("string").alias("venue_slug"), _id("asset").alias("asset_id"), F.col("reason").alias("event_type"), F.lit("warning").alias("severity"), (at_ms - F.col("age_s") * 1000).cast("long").alias("observed_at"),
    )
    return {
        "assets": carried(assets, was("assets"), "asset_id", at_ms), "asset_aliases": aliases, "asset_relationships": alike, "instruments": carried(instruments, was("instruments"), "instrument_id", at_ms, "active"), "adapter_health": health, "quality_events": events,
        "venue_asset_state": venue_rows(spark, sf_dir),
    }
