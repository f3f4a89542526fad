"""The row of each asset and venue: what makes a reference price auditable from stored tables alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import bps, ratio
from tidemark.operators import derivatives, liquidity, pricing


def spreads(levels: DataFrame) -> DataFrame:
    """spread_bps of each (asset, venue) whose best levels do not cross."""
    best = levels.groupBy("asset", "venue").agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("ask"))
    return best.select("asset", "venue", F.when(F.col("bid") <= F.col("ask"), (F.col("ask") - F.col("bid")) / ((F.col("ask") + F.col("bid")) / 2) * 10_000.0).alias("spread_bps"))


def depths(levels: DataFrame) -> DataFrame:
    """depth_50bps_usd and liquidity_share of each (asset, venue): both sides, and its part of all venues that have any."""
    d = liquidity.depth_bands(levels, ["asset", "venue"]).select("asset", "venue", (F.col("depth_50_bid") + F.col("depth_50_ask")).alias("depth_50bps_usd"))
    every = d.filter("depth_50bps_usd > 0").groupBy("asset").agg(F.sum("depth_50bps_usd").alias("_every"))
    return d.join(every, "asset", "left").select("asset", "venue", "depth_50bps_usd", F.when(F.col("depth_50bps_usd") > 0, F.col("depth_50bps_usd") / F.col("_every")).alias("liquidity_share"))


def derived(derivs: DataFrame) -> DataFrame:
    """Funding and mark of the market with most open interest of each (asset, venue), and open interest of all its markets."""
    known = derivatives.funding(derivs).filter("kind = 'perpetual' and funding_raw is not null")
    most = F.struct(F.coalesce("oi_raw", F.lit(-1.0)).alias("a"), F.col("funding_raw").alias("b"), F.coalesce("funding_hours", F.lit(-1.0)).alias("c"), F.coalesce("rate_8h", F.lit(-9.0)).alias("d"), F.col("price").alias("e"))
    funding = known.groupBy("asset", "venue").agg(F.max_by(F.struct("funding_raw", "funding_hours", "rate_8h", "price"), most).alias("f"))
    interest = derivatives.open_interest(derivs).groupBy("asset", "venue").agg(F.sum("oi_raw").alias("open_interest_raw"), F.sum("usd_equivalent").alias("open_interest_usd"))
    return interest.join(funding, ["asset", "venue"], "full").select(
        "asset", "venue", F.col("f.funding_raw").alias("funding_rate_raw"), F.col("f.funding_hours").alias("funding_interval_hours"), F.col("f.rate_8h").alias("funding_rate_8h"), F.col("f.price").alias("mark_price_usd"), "open_interest_raw", "open_interest_usd",
    )


def venue_rows(obs: DataFrame, derivs: DataFrame, levels: DataFrame, conversions: DataFrame, asset_id: Column, quote: Column, base_volume: Column, as_of_ms: int, last: list[str]) -> DataFrame:
    """A row for each asset and venue, nested as it is told: the observation that stands for it, how its quote turns into USD, its part in the price, volume and depth, funding and open interest.

    conversions: currency, conversion (ingest.conversions), a row for each currency,
    which are few and go to all tasks; quote is the currency of an observation. Index prices are not known per venue. All parts are
    partitioned by (asset, venue) or by asset.
    """
    rates = conversions.select("currency", F.col("conversion.rate").alias("_rate"))  # of a conversion only this is asked of every observation
    named = obs.withColumns({"quote": quote, "base_volume": base_volume}).join(F.broadcast(rates), F.col("quote") == F.col("currency"), "left").drop("currency")
    p = pricing.provenance(named)
    best = pricing.representative(p, ["asset", "venue"], F.col("_rate"), last)
    counts = obs.groupBy("asset", "venue").agg(F.count("*").alias("instrument_count"), F.sum(F.when(F.col("volume") > 0, F.col("volume"))).alias("_v"))
    shares = counts.join(counts.groupBy("asset").agg(F.sum("_v").alias("_every")), "asset").select("asset", "venue", "instrument_count", ratio("_v", "_every").alias("volume_share"))
    j = best.join(shares, ["asset", "venue"]).join(F.broadcast(conversions), F.col("quote") == F.col("currency"), "left")
    for part in (spreads(levels), depths(levels), derived(derivs)):
        j = j.join(part, ["asset", "venue"], "left")
    return j.select(
        asset_id.alias("asset_id"), F.col("venue").cast("string").alias("venue_slug"), (as_of_ms - F.col("age_s") * 1000).cast("long").alias("observed_at"), F.col("price").alias("price_usd"), F.col("source").alias("price_source"),
        bps(F.col("price"), F.col("reference_price")).alias("deviation_bps"), F.col("weight").alias("reference_weight"), "spread_bps", F.col("base_volume").alias("reported_base_volume_24h"), F.col("volume").alias("reported_quote_volume_24h"), (F.col("volume") * F.col("conversion.rate")).alias("reported_volume_24h_usd"),
        "volume_share", "liquidity_share", "depth_50bps_usd", "funding_rate_raw", "funding_interval_hours", "funding_rate_8h", "mark_price_usd", F.lit(None).cast("double").alias("index_price_usd"), "open_interest_raw", "open_interest_usd", "instrument_count", "conversion",
        F.col("included").alias("included_in_reference_price"), F.col("reason").alias("exclusion_reason"),
    )
