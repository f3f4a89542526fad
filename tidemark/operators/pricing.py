"""Reference prices: one robust price per asset from many observations, each kept with its weight or reason.

Columns of observations: asset, venue, kind (spot, perpetual, future, option),
price, volume (null: not reported), age_s (null: no venue time), source (mid,
last, mark, index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import bps
from tidemark.operators.robust import over_median

STALE_S, FRESHNESS_FLOOR, LEAST_WEIGHT, MOST_SHARE, MOST_DEVIATION_BPS = 1800.0, 0.25, 1e-3, 0.35, 2000.0
SOURCE_QUALITY = {"mid": 1.0, "last": 0.6, "mark": 0.5, "index": 0.5}


def freshness(age: Column) -> Column:
    """1 for new observations, falling in proportion to age down to a floor; the floor without a time."""
    falling = 1.0 - (1.0 - FRESHNESS_FLOOR) * age / STALE_S
    return F.when(age.isNull() | (age >= STALE_S), F.lit(FRESHNESS_FLOOR)).when(age <= 0, F.lit(1.0)).otherwise(falling)


def source_quality(source: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for name, quality in SOURCE_QUALITY.items():
        out = out.when(source == name, F.lit(quality))
    return out


def raw_weight(volume: Column, age: Column, source: Column) -> Column:
    size = F.when(volume > 0, F.sqrt(volume)).otherwise(F.lit(LEAST_WEIGHT))
    return F.greatest(F.lit(LEAST_WEIGHT), size * freshness(age) * source_quality(source))


def mid_price(bid: Column, ask: Column) -> Column:
    return F.when(bid <= ask, (bid + ask) / 2)


def capped_shares(rows: DataFrame, keys: list[str], weight: str, most: float = MOST_SHARE) -> DataFrame:
    """cap_weights() on rows: adds `share`, null where there is no weight.

    Sums go through a group's rows in the order that they have: behind over_median()
    that is by value and weight, so which share is exactly half of all does not
    depend on how rows came.
    """
    by = Window.partitionBy(*keys)
    begun = rows.withColumns({"_n": F.count(weight).over(by), "_every": F.sum(weight).over(by)}).withColumn("_s", F.col(weight) / F.col("_every"))
    over, room = F.greatest(F.lit(0.0), F.col("_s") - most), F.greatest(F.lit(0.0), most - F.col("_s"))  # greatest() passes over nulls, so rows without a weight are left out below
    known = F.col(weight).isNotNull()
    out = begun.withColumns({"_over": F.sum(F.when(known, over)).over(by), "_room": F.sum(F.when(known, room)).over(by)})
    moved = F.when(F.col("_s") >= most, F.lit(most)).otherwise(F.col("_s") + F.col("_over") * (most - F.col("_s")) / F.col("_room"))
    out = out.withColumn("_s", F.when((F.col("_over") <= 1e-12) | (F.col("_room") <= 1e-12), F.col("_s")).otherwise(moved))
    share = F.when(known, F.when(F.col("_every") <= 0, F.lit(0.0)).when(most * F.col("_n") <= 1.0, 1.0 / F.col("_n")).otherwise(F.col("_s")))
    return out.withColumn("share", share).drop("_n", "_every", "_over", "_room", "_s")


def provenance(obs: DataFrame) -> DataFrame:
    """Every observation with: weight (capped share, null where left out), included, reason, reference_price.

    Centre, shares and price come from windows over an asset's rows, which sort
    and spill: one exchange on asset, and the same cost per row however many
    observations an asset has.
    """
    asset = Window.partitionBy("asset")
    eligible = obs.withColumn("has_spot", F.max(F.when(F.col("kind") == "spot", 1).otherwise(0)).over(asset) == 1)
    priced = F.col("price").isNotNull() & ~F.isnan("price")
    chosen = (F.col("kind") != "option") & (~F.col("has_spot") | (F.col("kind") == "spot"))
    weighed = eligible.withColumn("raw_weight", F.when(chosen & priced, raw_weight(F.col("volume"), F.col("age_s"), F.col("source"))))
    centred = over_median(weighed, ["asset"], "price", "raw_weight", ["raw_weight"], "centre")
    far = F.coalesce(F.abs(bps(F.col("price"), F.col("centre"))) > MOST_DEVIATION_BPS, F.lit(False))
    reason = F.when(F.col("kind") == "option", F.lit("not_priced")).when(~chosen, F.lit("spot_preferred")).when(~priced, F.lit("missing_price")).when(far, F.lit("extreme_deviation"))
    reasoned = centred.withColumn("reason", reason).withColumn("_kept", F.when(F.col("reason").isNull(), F.col("raw_weight")))
    shared = capped_shares(reasoned, ["asset"], "_kept").withColumnRenamed("share", "weight").withColumn("included", F.col("reason").isNull()).drop("_kept")
    return over_median(shared, ["asset"], "price", "weight", ["raw_weight"], "reference_price")


def ordered(rows: DataFrame, instrument: list[str]) -> DataFrame:
    """provenance() rows with their place among an asset's, as they are told: included ones first, then by venue and instrument."""
    order = Window.partitionBy("asset").orderBy(F.desc("included"), "venue", *instrument)
    return rows.withColumn("place", F.row_number().over(order))


def representative(rows: DataFrame, keys: list[str], rate: Column, last: list[str]) -> DataFrame:
    """Of each group's provenance() rows the one that stands for it, by included, no option, spot, convertible, weight, volume and `last`; one aggregate, whatever a group's size."""
    no = lambda c: F.when(c, 0).otherwise(1)
    order = F.struct(no(F.col("reason").isNull()).alias("a"), no(F.col("kind") != "option").alias("b"), no(F.col("kind") == "spot").alias("c"), no(rate.isNotNull()).alias("d"), (-F.coalesce("weight", F.lit(0.0))).alias("e"), (-F.coalesce("volume", F.lit(0.0))).alias("f"), *last)
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("_best")).select(*keys, "_best.*")


def reference_prices(obs: DataFrame) -> DataFrame:
    """A row per asset: the price, its method, venues, counts, reasons and dispersion.

    Venues are counted as a set, of few: a distinct count would bring the percentiles'
    values through groups by asset and venue, whole, several times.
    """
    rows = provenance(obs).withColumn("off", F.when(F.col("included"), F.abs(F.col("price") - F.col("reference_price"))))
    rows = over_median(rows, ["asset"], "off", "weight", ["weight"], "mad")
    kept = F.when(F.col("included"), F.col("price"))
    grouped = rows.groupBy("asset").agg(
        F.max("reference_price").alias("reference_price"), F.max("has_spot").alias("has_spot"),
        F.size(F.collect_set(F.when(F.col("included"), F.col("venue")))).cast("long").alias("venue_count"),
        F.count_if("included").alias("included_count"), F.count_if(~F.col("included")).alias("excluded_count"),
        F.count_if(F.col("reason") == "spot_preferred").alias("n_spot_preferred"), F.count_if(F.col("reason") == "extreme_deviation").alias("n_extreme_deviation"),
        F.min(kept).alias("min_price"), F.max(kept).alias("max_price"),
        F.percentile(kept, F.lit(0.1)).alias("p10"), F.percentile(kept, F.lit(0.9)).alias("p90"), F.max("off").alias("max_off"), F.max("mad").alias("mad"),
    )
    several, centre = F.col("included_count") >= 2, F.col("reference_price")
    method = F.when(centre.isNull(), "unavailable").when(~F.col("has_spot"), "derivative_fallback").when(F.col("included_count") == 1, "single_venue_spot").otherwise("spot_weighted_median")
    return grouped.withColumns({
        "method": method, "mad_bps": F.when(several, F.col("mad") / centre * 10_000.0),
        "p10_p90_bps": F.when(F.col("included_count") >= 4, (F.col("p90") - F.col("p10")) / centre * 10_000.0), "max_dev_bps": F.when(several, F.col("max_off") / centre * 10_000.0),
    }).drop("mad", "p10", "p90", "max_off", "has_spot")
