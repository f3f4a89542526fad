"""Which assets and instruments are looked at: ranked universes, and order books within budgets."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ELIGIBLE = ("resolved", "manual_override")
#: Assets that are followed live.
LIVE_ASSETS = 150


def universe(states: DataFrame, name: str) -> DataFrame:
    """Assets of a named universe; ranked ones are cut with the id as last tie-break. states: asset_id, resolution_state, venue_count, volume, spot_venues, perp_venues, depth_50."""
    ok = states.filter(F.col("resolution_state").isin(*ELIGIBLE))
    match name:
        case "all_resolved":
            return ok
        case "multi_venue":
            return ok.filter("venue_count >= 3")
        case "liquid":
            return ok.filter("venue_count >= 2 and volume >= 1000000")
        case "spot_only":
            return ok.filter("spot_venues > 0 and coalesce(perp_venues, 0) = 0")
        case "derivative_active":
            return ok.filter("perp_venues > 0")
        case "top_100" | "top_500":
            return ok.filter("depth_50 is not null").orderBy(F.desc("depth_50"), "asset_id").limit(int(name[4:]))
    raise ValueError(f"no universe {name!r}")


def book_plan(candidates: DataFrame, total: int = 600, per_venue: int = 60, per_asset: int = 6) -> DataFrame:
    """Instruments whose books are fetched, by rank, within budgets for each asset, each venue and all; a skipped one costs nothing.

    Whether a candidate fits depends on those picked before, but few can matter.
    No more than total / per_asset assets and total / per_venue venues are ever
    full, so a candidate is out

    - behind the first per_asset of its asset and venue: the asset is full, or the venue was when one of them was skipped;
    - behind the first per_venue + full assets * per_asset of its venue: no more of those before it can have been skipped for their assets;
    - behind the first per_asset + full venues * per_asset of its asset, likewise;
    - behind the first total + full assets * (the limit of an asset) + full venues * (that of a venue) of all.

    So windows and one top-k leave some thousands of rows, whatever the number of
    candidates, and the driver goes through them once.
    """
    full_assets, full_venues = total // per_asset, total // per_venue
    of_venue, of_asset = per_venue + full_assets * per_asset, per_asset + full_venues * per_asset
    first = lambda df, keys, most: df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "instrument"))).filter(F.col("_k") <= most).drop("_k")
    few = candidates.select("asset", "venue", "instrument", "rank")
    for keys, most in ((("asset", "venue"), per_asset), (("asset",), of_asset), (("venue",), of_venue)):
        few = first(few, keys, most)
    by_asset, by_venue, picked = Counter(), Counter(), []
    for r in few.orderBy("rank", "instrument").limit(total + full_assets * of_asset + full_venues * of_venue).collect():
        if len(picked) < total and by_asset[r.asset] < per_asset and by_venue[r.venue] < per_venue:
            by_asset[r.asset] += 1
            by_venue[r.venue] += 1
            picked.append((r.asset, r.venue, r.instrument, r.rank, len(picked) + 1))
    return candidates.sparkSession.createDataFrame(picked, "asset long, venue long, instrument string, rank long, picked int")


def live_universe(states: DataFrame, meta: DataFrame, most: int = LIVE_ASSETS, least_venues: int = 2, probable: bool = True) -> DataFrame:
    """The assets that are followed live, by volume: rank, asset_id, symbol, price. states: asset_id, price, volume, venue_count; meta: asset_id, symbol, resolution_state, is_stablecoin."""
    allowed = [*ELIGIBLE, *(["probable"] if probable else [])]
    joined = states.join(meta, "asset_id").filter(F.col("resolution_state").isin(*allowed) & ~F.col("is_stablecoin") & (F.col("venue_count") >= least_venues) & F.col("price").isNotNull())
    first = joined.orderBy(F.desc_nulls_last("volume"), "asset_id").limit(most)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("volume"), "asset_id"))).select("rank", "asset_id", "symbol", "price")


def live_instruments(instruments: DataFrame, universe: DataFrame, rates: DataFrame, classes: tuple[str, ...] = ("spot", "perpetual_linear", "perpetual_inverse")) -> DataFrame:
    """Active instruments of followed assets whose quote has a usable rate, by semi joins. instruments: venue, class, symbol, base_id, quote_id, active; rates: quote_id."""
    usable = instruments.filter(F.col("active") & F.col("class").isin(*classes)).join(rates, "quote_id", "left_semi")
    return usable.join(universe.select(F.col("asset_id").alias("base_id")), "base_id", "left_semi")
