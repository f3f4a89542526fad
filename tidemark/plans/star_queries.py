"""Every metric of the market at once, against the SQL of its family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.mql.metrics import METRICS
from tidemark.operators import series, structure
from tidemark.plans import views as V
from tidemark.plans.catalogue import ORACLE_SQL, _trail, query, r
from tidemark.plans.market import engine

_MONTH_MS = structure.MONTH_HOURS * 3_600_000


def _part(name: str) -> str:
    return f"({ORACLE_SQL[name]})"


def _change(hours: int) -> str:
    return f"(WITH {V.POINTS}, t AS ({_trail(hours)}) SELECT asset, CASE WHEN count(*) >= 2 THEN arg_max(price, (ts_ms, id)) / arg_min(price, (ts_ms, id)) - 1 END AS x FROM t GROUP BY asset)"


def _realised(hours: int, least: int) -> str:
    return f"""(WITH {V.POINTS}, t AS ({_trail(hours)}), l AS (SELECT asset, price, CASE WHEN price > 0 AND lag(price) OVER o > 0 THEN ln(price / lag(price) OVER o) END AS x FROM t WINDOW o AS (PARTITION BY asset ORDER BY ts_ms, id))
SELECT asset, CASE WHEN count(*) >= {least} AND 1 - count(*) / {hours * 4.0} <= 0.35 THEN stddev_samp(x) * sqrt(35040) END AS x FROM l GROUP BY asset)"""


_FUNDING = f"(WITH {V.DERIVATIVES} SELECT asset, median(rate_8h) AS f FROM f8 WHERE rate_8h IS NOT NULL GROUP BY asset)"
_PERCENTILE = f"""(WITH {V.HISTORY}, fu AS {_FUNDING}, h AS (SELECT hist.*, f AS cf, ts_ms >= {V.AS_OF_MS - _MONTH_MS} AS m FROM hist JOIN fu USING (asset) WHERE ts_ms < {V.AS_OF_MS})
SELECT asset, CASE WHEN count(*) FILTER (m) >= {structure.LEAST_MONTH} THEN (count(*) FILTER (m AND funding_8h < cf) + count(*) FILTER (m AND funding_8h = cf) / 2.0) / nullif(count(funding_8h) FILTER (m), 0) * 100 END AS x FROM h GROUP BY asset)"""
#: By metric, its SQL and the decimals that are compared (None: as it is).
_STAR = {
    "asset": ("'P' || pr.asset", None), "asset_id": ("'asset:named:part:P' || pr.asset", None), "symbol": ("'P' || pr.asset", None), "asset_name": ("p_name", None), "resolution_state": ("CASE WHEN coalesce(p_name, '') = '' THEN 'unresolved' ELSE 'resolved' END", None), "observed_at": (f"{V.AS_OF_MS}", None),
    "coverage_tier": ("CASE WHEN sp.venue_count IS NOT NULL THEN 'B' ELSE 'A' END", None), "reference_price": ("pr.reference_price", 6), "reference_price_method": ("pr.method", None), "reference_price_venue_count": ("pr.venue_count", None), "included_venue_count": ("pr.included_count", None), "excluded_venue_count": ("pr.excluded_count", None),
    "venue_count": ("pr.venue_count", None), "min_qualified_price": ("pr.min_price", 6), "max_qualified_price": ("pr.max_price", 6), **{f"price_change_{w}": (f"c{w}.x", 9) for w in ("1h", "24h", "7d")},
    "price_dispersion_bps": ("pr.mad_bps", 5), "weighted_mad_bps": ("pr.mad_bps", 5), "p10_p90_spread_bps": ("pr.p10_p90_bps", 5), "reported_spot_volume_24h_usd": ("vo.spot_usd", 2), "reported_perp_volume_24h_usd": ("vo.perp_usd", 2), "reported_futures_volume_24h_usd": ("vo.futures_usd", 2), "reported_volume_24h_usd": ("vo.total_usd", 2),
    **{f"realised_volatility_{w}": (f"r{w}.x", 6) for w in ("1h", "4h", "24h", "7d")}, "atr_14_bps": ("at.atr_bps", 6), "best_spread_bps": ("sp.best_spread_bps", 6), "median_spread_bps": ("sp.median_spread_bps", 6), "liquidity_venue_count": ("sp.venue_count", None), "largest_venue_liquidity_share": ("lc.largest_share", 6), "liquidity_concentration_hhi": ("lc.hhi", 6),
    "spot_venue_count": ("sc.spot_venues", None), "perp_venue_count": ("sc.perp_venues", None), "funding_rate_8h_median": ("fu.f", 8), "funding_rate_annualised_simple": ("fa.annualised", 8), "funding_venue_count": ("fa.venue_count", None), "funding_dispersion_bps": ("fa.dispersion_bps", 8),
    "open_interest_usd": ("oi.total_usd", 2), "open_interest_base": ("ob.b", 3), "open_interest_venue_count": ("oi.venue_count", None), "perp_basis_bps_median": ("ba.perp", 6), "futures_basis_bps_median": ("ba.futures", 6), "effective_venue_count": ("hh.effective_count", 6), "volume_concentration_hhi": ("hh.hhi", 6), "largest_venue_volume_share": ("hh.largest_share", 6),
    "fragmentation_index": ("fi.fragmentation_index", 6), "rsi_14": ("rs.rsi", 6), "ema_12": ("em.ema_12", 6), "ema_26": ("em.ema_26", 6), "crowding_funding_percentile_30d": ("pc.x", 6), "crowding_oi_to_volume": ("ov.oi_to_volume", 6), "crowding_perp_dominance": ("vo.perp_dominance", 6),
    "genome_status": (f"CASE WHEN np.n >= {structure.AVAILABLE} THEN 'available' WHEN np.n >= {structure.WARMING} THEN 'warming_up' ELSE 'insufficient_history' END", None), "coverage_ratio": ("least(1, pr.venue_count / ag.venues)", 6), "freshest_observation_age_seconds": ("ag.low", None), "oldest_observation_age_seconds": ("ag.high", None),
    "ambiguous_identity_count": ("coalesce(am.n, 0)", None), "partial_data": ("pr.reference_price IS NULL", None),
}
_JOINS = {
    "vo": "vo", "hh": "hh", "sp": _part("spread_best_median"), "sc": _part("structure_counts"), "fa": _part("funding_aggregate"), "fu": _FUNDING, "oi": _part("open_interest_aggregate"), "ob": f"(WITH {V.DERIVATIVES} SELECT asset, sum(base_equivalent) AS b FROM oi GROUP BY asset)", "ba": _part("basis_bps"), "lc": _part("liquidity_concentration"),
    "at": _part("atr_14"), "rs": _part("rsi_14"), "em": _part("ema_12_26_macd"), "ov": _part("oi_to_volume"), "pc": _PERCENTILE, "np": f"(WITH {V.POINTS} SELECT asset, count(*) AS n FROM points GROUP BY asset)", "ag": "(SELECT asset, min(age_s) AS low, max(age_s) AS high, count(DISTINCT venue)::DOUBLE AS venues FROM obs GROUP BY asset)",
    **{f"c{w}": _change(series.WINDOW_HOURS[w]) for w in ("1h", "24h", "7d")}, **{f"r{w}": _realised(series.WINDOW_HOURS[w], series.LEAST[w]) for w in ("1h", "4h", "24h", "7d")},
}
_FROM = "pr LEFT JOIN part ON p_partkey = pr.asset LEFT JOIN (SELECT p_name AS a_name, count(*) - 1 AS n FROM part GROUP BY p_name) AS am ON a_name = p_name LEFT JOIN (SELECT replace(asset_id, 'asset:named:part:P', '')::BIGINT AS asset, fragmentation_index FROM " + _part("fragmentation_index") + ") AS fi ON fi.asset = pr.asset " + " ".join(
    f"LEFT JOIN {sql} AS \"{name}_\" ON \"{name}_\".asset = pr.asset" for name, sql in _JOINS.items()
)


def _told(name: str) -> str:
    sql, digits = _STAR[name]
    for short in sorted(_JOINS, key=len, reverse=True):
        sql = sql.replace(f"{short}.", f'"{short}_".') if sql.startswith(f"{short}.") or f"({short}." in sql or f" {short}." in sql else sql
    return (f"round({sql}, {digits})" if digits is not None else sql) + f" AS {name}"


@query(f"WITH {V.PRICES}, {V.VOLUMES} SELECT {', '.join(_told(n) for n in METRICS)} FROM {_FROM}")
def market_star(spark, sf_dir):
    """All metrics of all assets."""
    out = engine(spark, sf_dir).run("SELECT * FROM market")
    return out.select(*[r(n, _STAR[n][1]).alias(n) if _STAR[n][1] is not None else F.col(n) for n in METRICS])
