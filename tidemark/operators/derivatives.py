"""Funding, open interest and basis of derivatives.

Columns: asset, venue, kind, instrument, price (mark), reference_price, quote_usd,
funding_raw, funding_hours, funding_semantics (relative, absolute, undocumented),
inverse, oi_raw, oi_unit (usd, base_asset, quote_currency, contracts, unknown),
oi_base, oi_usd (as published), multiplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import bps, ratio

TARGET_HOURS, PERIODS_PER_YEAR = 8.0, 1095


def with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """rows (instrument, price) with the last known mark of their instrument as price, else their own. marks: instrument, ts_ms, id, mark."""
    last = marks.filter("mark is not null").groupBy(F.col("instrument").alias("m_instrument")).agg(F.max_by("mark", F.struct("ts_ms", "id")).alias("m_mark"))
    return rows.join(last, F.col("instrument") == F.col("m_instrument"), "left").withColumn("price", F.coalesce("m_mark", "price")).drop("m_instrument", "m_mark")


def with_intervals(rows: DataFrame, instruments: DataFrame) -> DataFrame:
    """rows with the funding interval of the observation, else of the instrument. instruments: instrument, hours."""
    known = instruments.select(F.col("instrument").alias("i_instrument"), F.col("hours").alias("i_hours"))
    return rows.join(known, F.col("instrument") == F.col("i_instrument"), "left").withColumn("funding_hours", F.coalesce("funding_hours", "i_hours")).drop("i_instrument", "i_hours")


def weighting_volume(quote_volume, base_volume, price, rate):
    """USD volume that only weights prices: what the venue reports in its quote currency, else its base volume at its own price; never published."""
    return F.when(rate.isNotNull(), F.coalesce(quote_volume * rate, base_volume * price * rate))


def funding(rows: DataFrame) -> DataFrame:
    """rate_8h, or the reason why there is none. Absolute rates are turned into relative ones by the mark price."""
    mark = F.col("price")
    relative = F.when(F.col("funding_semantics") == "relative", F.col("funding_raw")).when(F.col("funding_semantics") == "absolute", F.when(mark > 0, F.when(F.col("inverse"), F.col("funding_raw") * mark).otherwise(F.col("funding_raw") / mark)))
    reason = (
        F.when(F.col("kind") != "perpetual", "not_perpetual").when(F.col("funding_raw").isNull(), "no_rate")
        .when(~F.col("funding_semantics").isin("relative", "absolute"), "undocumented_funding_semantics")
        .when(F.coalesce(F.col("funding_hours"), F.lit(0.0)) <= 0, "no_interval").when(relative.isNull(), "missing_price")
    )
    return rows.withColumn("funding_reason", reason).withColumn("rate_8h", F.when(F.col("funding_reason").isNull(), relative * TARGET_HOURS / F.col("funding_hours")))


def funding_by_asset(rows: DataFrame) -> DataFrame:
    known = funding(rows).filter("rate_8h is not null")
    return known.groupBy("asset").agg(
        F.median("rate_8h").alias("rate_8h_median"), F.min("rate_8h").alias("rate_8h_min"), F.max("rate_8h").alias("rate_8h_max"),
        (F.median("rate_8h") * PERIODS_PER_YEAR).alias("annualised_simple"), F.when(F.count("rate_8h") >= 2, (F.max("rate_8h") - F.min("rate_8h")) * 10_000.0).alias("dispersion_bps"),
        F.size(F.collect_set("venue")).cast("long").alias("venue_count"), F.array_sort(F.collect_set("funding_hours")).alias("intervals"),
    )


def open_interest(rows: DataFrame) -> DataFrame:
    """base_equivalent and usd_equivalent, or the reason why the unit allows neither. Published figures win."""
    raw, price, quote, unit = F.col("oi_raw"), F.when(F.col("reference_price") > 0, F.col("reference_price")), F.when(F.col("quote_usd") > 0, F.col("quote_usd")), F.coalesce("oi_unit", F.lit("unknown"))
    contracts = raw * F.col("multiplier")
    usd_first = F.when(unit == "usd", raw).when(unit == "quote_currency", raw * quote).when((unit == "contracts") & F.col("inverse"), contracts * quote)
    base_first = F.when(unit == "base_asset", raw).when((unit == "contracts") & ~F.col("inverse"), contracts)
    usd, base = F.coalesce("oi_usd", usd_first), F.coalesce("oi_base", base_first)
    both = F.col("oi_usd").isNotNull() & F.col("oi_base").isNotNull()
    refused = F.when(~both & (unit == "contracts") & F.col("multiplier").isNull(), "unknown_contract_multiplier").when(~both & ~unit.isin("usd", "base_asset", "quote_currency", "contracts"), "schema_failure")
    out = rows.filter(raw.isNotNull()).withColumns({"_no": refused, "_usd": usd, "_base": base})
    out = out.withColumns({"usd_equivalent": F.when(F.col("_no").isNull(), F.coalesce("_usd", F.col("_base") * price)), "base_equivalent": F.when(F.col("_no").isNull(), F.coalesce("_base", F.col("_usd") / price))})
    neither = F.col("usd_equivalent").isNull() & F.col("base_equivalent").isNull()
    return out.withColumn("oi_reason", F.coalesce("_no", F.when(neither, F.lit("invalid_quote_conversion")))).drop("_no", "_usd", "_base")


def open_interest_by_asset(rows: DataFrame) -> DataFrame:
    usd = F.col("usd_equivalent")
    return open_interest(rows).groupBy("asset").agg(
        F.sum("usd_equivalent").alias("total_usd"), F.sum("base_equivalent").alias("total_base"), F.sum(F.when(F.col("kind") == "perpetual", usd)).alias("perpetual_usd"), F.sum(F.when(F.col("kind") == "future", usd)).alias("future_usd"),
        F.count_distinct(F.when(F.col("oi_reason").isNull(), F.col("venue"))).alias("venue_count"), F.count("oi_reason").alias("excluded_count"),
    )


def basis_by_asset(rows: DataFrame) -> DataFrame:
    off = rows.withColumn("off", bps(F.col("price"), F.col("reference_price"))).filter("off is not null")
    return off.groupBy("asset").agg(F.median(F.when(F.col("kind") == "perpetual", F.col("off"))).alias("perp_basis_bps_median"), F.median(F.when(F.col("kind") == "future", F.col("off"))).alias("futures_basis_bps_median"))


def volume_by_segment(obs: DataFrame) -> DataFrame:
    """Sums by kind, null where nothing of that kind reports; all together; shares of derivatives."""
    part = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("volume")))
    out = obs.groupBy("asset").agg(part("spot").alias("spot_usd"), part("perpetual").alias("perp_usd"), part("future").alias("futures_usd"), part("option").alias("options_usd"), F.sum("volume").alias("total_usd"), part("perpetual", "future").alias("derivative_usd"))
    return out.withColumn("perp_dominance", ratio("perp_usd", "total_usd"))
