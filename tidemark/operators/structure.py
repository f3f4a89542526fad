"""What the parts say about a market's structure: fragmentation, pressure, crowding, life cycle, likeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio

SATURATION_BPS, LEAST_POINTS, WARMING, AVAILABLE, LEAST_SHARED = 50.0, 8, 672, 2688, 3
SLOT_MS, HOUR_MS, MONTH_HOURS, BASELINE_HOURS, LEAST_BASELINE, NEAREST_MS = 900_000, 3_600_000, 720, 24, 16, 45 * 60_000
#: Points of 30 days of slots from which on a percentile of them is one: at most 35 % may be missing.
LEAST_MONTH = 1872


def fragmentation_index(venues: Column, effective: Column, largest: Column, dispersion: Column) -> Column:
    """Mean of breadth, balance and, where known, price separation; null below two venues."""
    breadth = F.when(effective > 0, 1.0 - 1.0 / effective).otherwise(F.lit(0.0))
    separation = F.least(dispersion / SATURATION_BPS, F.lit(1.0))
    mean = F.when(dispersion.isNull(), (breadth + 1.0 - largest) / 2).otherwise((breadth + 1.0 - largest + separation) / 3)
    return F.when((venues >= 2) & effective.isNotNull() & largest.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean)))


def z_score(value: Column, mean: Column, deviation: Column, points: Column) -> Column:
    return F.when((points >= LEAST_POINTS) & (deviation > 0), (value - mean) / deviation)


def lifecycle(points: Column) -> Column:
    return F.when(points >= AVAILABLE, "available").when(points >= WARMING, "warming_up").otherwise("insufficient_history")


def distance(a: Column, b: Column) -> Column:
    """Root mean square difference over features that both maps have; null below three."""
    shared = F.array_intersect(F.map_keys(F.map_filter(a, lambda _, v: v.isNotNull())), F.map_keys(F.map_filter(b, lambda _, v: v.isNotNull())))
    squares = F.aggregate(F.transform(shared, lambda k: F.pow(F.element_at(a, k) - F.element_at(b, k), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(shared) >= LEAST_SHARED, F.sqrt(squares / F.size(shared)))


def family_ages(families: dict[str, DataFrame]) -> DataFrame:
    """By asset, how old the newest observation of each family is, and the newest and oldest of all; only observations with a venue's time count. families: name -> (asset, age_s)."""
    rows = None
    for name, df in families.items():
        part = df.select("asset", F.lit(name).alias("family"), "age_s")
        rows = part if rows is None else rows.unionByName(part)
    known = rows.filter("age_s is not null")
    return known.groupBy("asset").agg(*[F.min(F.when(F.col("family") == n, F.col("age_s"))).alias(f"{n}_age_s") for n in families], F.min("age_s").alias("freshest_age_s"), F.max("age_s").alias("oldest_age_s"))


def venue_counts(obs: DataFrame) -> DataFrame:
    by = lambda kind: F.count_distinct(F.when(F.col("kind") == kind, F.col("venue")))
    n = lambda kind: F.count_if(F.col("kind") == kind)
    return obs.groupBy("asset").agg(by("spot").alias("spot_venues"), by("perpetual").alias("perp_venues"), by("future").alias("future_venues"), n("spot").alias("spot_count"), n("perpetual").alias("perp_count"), n("future").alias("future_count"), F.count_distinct("ccy").alias("currencies"))


def history_measures(current: DataFrame, history: DataFrame, as_of_ms: int, baseline_hours: int = BASELINE_HOURS, least_month: int = LEAST_MONTH) -> DataFrame:
    """What an asset's history says about its current values, in one pass over the rows before as_of_ms.

    current: asset, funding_8h, basis_bps, open_interest_usd, volume_usd,
    book_imbalance, oi_to_volume, perp_dominance. history: asset, ts_ms, id,
    funding_8h, basis_bps, open_interest_usd, volume_usd. Adds z-scores and
    percentiles over 30 days, the open interest of the last slot and of a day ago,
    and the median volume of the baseline, each null where there is too little.
    """
    now = current.select(F.col("asset").alias("c_asset"), F.col("funding_8h").alias("c_funding"), F.col("basis_bps").alias("c_basis"))
    rows = history.filter(F.col("ts_ms") < as_of_ms).join(now, F.col("asset") == F.col("c_asset"))
    month = F.col("ts_ms") >= as_of_ms - MONTH_HOURS * HOUR_MS
    at, off = F.struct("ts_ms", "id"), F.abs(F.col("ts_ms") - (as_of_ms - 24 * HOUR_MS))
    baseline = F.when(F.col("ts_ms") >= as_of_ms - baseline_hours * HOUR_MS, F.col("volume_usd"))
    made = [F.max("ts_ms").alias("last_ms"), F.count_if(month).alias("month_points"), F.max_by("open_interest_usd", at).alias("oi_last"), F.count(baseline).alias("baseline_points"), F.median(baseline).alias("baseline_volume"),
        F.min_by("open_interest_usd", F.when((off <= NEAREST_MS) & F.col("open_interest_usd").isNotNull(), F.struct(off, F.col("ts_ms"), F.col("id")))).alias("oi_day_ago")]
    for name, own in (("funding", "c_funding"), ("basis", "c_basis")):
        value = F.when(month, F.col("funding_8h" if name == "funding" else "basis_bps"))
        made += [F.count(value).alias(f"{name}_n"), F.avg(value).alias(f"{name}_mean"), F.stddev_samp(value).alias(f"{name}_sd"), F.count_if(value < F.col(own)).alias(f"{name}_below"), F.count_if(value == F.col(own)).alias(f"{name}_equal")]
    seen = rows.groupBy("asset").agg(*made).withColumnRenamed("asset", "h_asset")
    j = current.join(seen, F.col("asset") == F.col("h_asset"), "left")
    rank = lambda n: F.when(F.col("month_points") >= least_month, F.try_divide(F.col(f"{n}_below") + F.col(f"{n}_equal") / 2, F.col(f"{n}_n")) * 100)
    previous = F.when(as_of_ms - F.col("last_ms") <= 2 * SLOT_MS, F.col("oi_last"))
    change = lambda then: F.when(then > 0, F.col("open_interest_usd") / then - 1)
    return j.withColumns({
        "funding_deviation_z": z_score(F.col("funding_8h"), F.col("funding_mean"), F.col("funding_sd"), F.col("funding_n")), "basis_deviation_z": z_score(F.col("basis_bps"), F.col("basis_mean"), F.col("basis_sd"), F.col("basis_n")),
        "oi_change": change(previous), "volume_acceleration": ratio(F.col("volume_usd"), F.when(F.col("baseline_points") >= LEAST_BASELINE, F.col("baseline_volume"))),
        "funding_percentile_30d": F.when(F.col("funding_8h").isNotNull(), rank("funding")), "basis_percentile_30d": F.when(F.col("basis_bps").isNotNull(), rank("basis")), "oi_change_24h": change(F.col("oi_day_ago")),
    })


PRESSURE = ("book_imbalance", "funding_deviation_z", "basis_deviation_z", "oi_change", "volume_acceleration")
CROWDING = ("funding_percentile_30d", "oi_to_volume", "perp_dominance", "oi_change_24h", "basis_percentile_30d")


def vector(measured: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """A vector's components and how many of them an asset has; vectors compare only where the same ones are there."""
    there = [F.col(n).isNotNull().cast("int") for n in names]
    return measured.select("asset", *names, sum(there[1:], there[0]).alias("components_available"))


def genome_features(states: DataFrame) -> Column:
    """Features of an asset as a map, log scale for depth; those that are unknown are left out. Columns: volatility_24h, depth_50, venue_count, effective_count, perp_dominance, funding_8h, dispersion_bps, oi_to_volume."""
    named = {"volatility_24h": F.col("volatility_24h"), "log_depth_50bps": F.when(F.col("depth_50") > 0, F.log10("depth_50")), "venue_count": F.when(F.col("venue_count") > 0, F.col("venue_count").cast("double")), "effective_venue_count": F.col("effective_count"),
        "perp_dominance": F.col("perp_dominance"), "funding_8h": F.col("funding_8h"), "price_dispersion_bps": F.col("dispersion_bps"), "oi_to_volume": F.col("oi_to_volume")}
    every = F.map_from_arrays(F.array(*map(F.lit, named)), F.array(*[c.cast("double") for c in named.values()]))
    return F.map_filter(every, lambda _, v: v.isNotNull())


def nearest_genomes(features: DataFrame, asset) -> DataFrame:
    """Every asset's distance from one asset (asset, features), and the features that both have: one row meets all others, no pairs."""
    one = features.filter(F.col("asset") == asset).select(F.col("features").alias("own")).limit(1)
    both = features.filter(F.col("asset") != asset).join(F.broadcast(one))
    shared = F.array_sort(F.array_intersect(F.map_keys("features"), F.map_keys("own")))
    return both.select("asset", distance(F.col("features"), F.col("own")).alias("distance"), F.array_join(shared, ",").alias("shared"))
