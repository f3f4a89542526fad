"""Order books: depth in bands around the reference price, the cost of walking them, and how liquidity is spread.

Levels: asset, venue, side (bid, ask), price, size, reference_price, quote_usd,
kind, inverse, multiplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio

BANDS, NOTIONALS = (5, 10, 25, 50, 100), (10_000.0, 100_000.0, 1_000_000.0)


def build_levels(rows: Column, depth: int, descending: bool) -> Column:
    """Levels from an array of [price, size, ...] texts: positive numbers only, best first, cut at depth; and whether it was cut."""
    pair = F.transform(rows, lambda r: F.struct(F.get(r, F.lit(0)).try_cast("double").alias("price"), F.get(r, F.lit(1)).try_cast("double").alias("size")))
    sound = F.filter(pair, lambda p: (p["price"] > 0) & (p["size"] > 0))
    ordered = F.reverse(F.array_sort(sound)) if descending else F.array_sort(sound)
    return F.struct(F.slice(ordered, 1, depth).alias("levels"), (F.size(sound) > depth).alias("truncated"))


def notional() -> Column:
    """USD value of a level; null where a derivative's multiplier is missing."""
    linear = F.col("price") * F.col("size") * F.col("quote_usd")
    return F.when(F.col("kind") == "spot", linear).when(F.col("multiplier").isNull(), None).when(F.col("inverse"), F.col("size") * F.col("multiplier") * F.col("quote_usd")).otherwise(linear * F.col("multiplier"))


def depth_bands(levels: DataFrame, keys: list[str]) -> DataFrame:
    """depth_<band>_<side>: 0 where there are levels but none inside; null where one inside cannot be valued or there is no level."""
    valued = levels.withColumn("usd", notional())
    sums = []
    for band in BANDS:
        for side, sign in (("bid", -1), ("ask", 1)):
            on_side = F.col("side") == side
            edge = F.col("reference_price") * (1.0 + sign * band / 10_000.0)
            inside = on_side & ((F.col("price") >= edge) if sign < 0 else (F.col("price") <= edge)) & (F.col("reference_price") > 0)
            unknown = F.count_if(inside & F.col("usd").isNull()) > 0
            sums.append(F.when(F.count_if(on_side & (F.col("reference_price") > 0)) > 0, F.when(~unknown, F.coalesce(F.sum(F.when(inside, F.col("usd"))), F.lit(0.0)))).alias(f"depth_{band}_{side}"))
    return valued.groupBy(*keys).agg(*sums)


def walk(levels: DataFrame, keys: list[str], target: float) -> DataFrame:
    """impact_bps of consuming `target` USD outward, by side; null where the levels do not hold that much."""
    best_first = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    order = Window.partitionBy(*keys, "side").orderBy(best_first, "size", "venue").rowsBetween(Window.unboundedPreceding, -1)
    valued = levels.withColumn("usd", notional()).filter("usd > 0 and reference_price > 0")
    taken = valued.withColumn("before", F.coalesce(F.sum("usd").over(order), F.lit(0.0))).withColumn("take", F.greatest(F.lit(0.0), F.least(F.col("usd"), target - F.col("before"))))
    out = taken.groupBy(*keys, "side").agg(F.sum("usd").alias("there"), F.sum(F.col("price") * F.col("take")).alias("paid"), F.sum("take").alias("got"), F.max("reference_price").alias("reference"))
    off = (F.col("paid") / F.col("got") - F.col("reference")) / F.col("reference") * 10_000.0
    impact = F.greatest(F.lit(0.0), F.when(F.col("side") == "ask", off).otherwise(-off))
    return out.select(*keys, "side", F.when(F.col("there") >= target, impact).alias("impact_bps"))


def spreads(levels: DataFrame) -> DataFrame:
    """Best and (of two or more venues) median spread per asset; a venue's only if its best ask is over its best bid."""
    top = levels.groupBy("asset", "venue").agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("ask"))
    spread = top.filter("ask > bid and bid > 0").withColumn("bps", (F.col("ask") - F.col("bid")) / ((F.col("ask") + F.col("bid")) / 2) * 10_000.0)
    return spread.groupBy("asset").agg(F.min("bps").alias("best_spread_bps"), F.when(F.count("bps") >= 2, F.median("bps")).alias("median_spread_bps"), F.count("bps").alias("venue_count"))


def depth_shares(depth: DataFrame) -> DataFrame:
    """By asset over venues (asset, venue, d): venues, depth in all, the largest share and whose it is, and the Herfindahl index. Sums by asset are joined back, so that a venue's row is read once."""
    every = depth.groupBy("asset").agg(F.sum("d").alias("_every"))
    shared = depth.join(every, "asset").withColumn("_s", F.col("d") / F.col("_every"))
    return shared.groupBy("asset").agg(F.count("*").alias("venues"), F.sum("d").alias("depth"), F.max("_s").alias("largest_share"), F.sum(F.col("_s") * F.col("_s")).alias("hhi"), F.max_by("venue", F.struct(F.round("d", 4), -F.col("venue"))).alias("largest_venue"))


def imbalance(depth: DataFrame, band: int = 50) -> DataFrame:
    bid, ask = F.col(f"depth_{band}_bid"), F.col(f"depth_{band}_ask")
    return depth.withColumn("imbalance", ratio(bid - ask, bid + ask))
