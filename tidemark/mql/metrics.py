"""Names that queries may use, and the columns that hold them."""

from __future__ import annotations

from dataclasses import dataclass

# Metric, column, kind (s text, i whole number, f number, b truth value), in the order that `*` gives.
_TABLE = """
asset symbol s
asset_id asset_id s
symbol symbol s
asset_name name s
resolution_state resolution_state s
observed_at observed_at i
coverage_tier coverage_tier s
reference_price reference_price__value f
reference_price_method reference_price__method s
reference_price_venue_count reference_price__venue_count i
included_venue_count reference_price__included_venue_count i
excluded_venue_count reference_price__excluded_venue_count i
venue_count venue_count i
min_qualified_price reference_price__min_qualified_price f
max_qualified_price reference_price__max_qualified_price f
price_change_1h returns__change_1h f
price_change_24h returns__change_24h f
price_change_7d returns__change_7d f
price_dispersion_bps dispersion__price_dispersion_bps f
weighted_mad_bps dispersion__weighted_mad_bps f
p10_p90_spread_bps dispersion__p10_p90_spread_bps f
reported_spot_volume_24h_usd volume__reported_spot_volume_24h_usd f
reported_perp_volume_24h_usd volume__reported_perp_volume_24h_usd f
reported_futures_volume_24h_usd volume__reported_futures_volume_24h_usd f
reported_volume_24h_usd reported_volume_24h_usd f
realised_volatility_1h volatility__realised_1h f
realised_volatility_4h volatility__realised_4h f
realised_volatility_24h volatility__realised_24h f
realised_volatility_7d volatility__realised_7d f
atr_14_bps volatility__atr_14_bps f
best_spread_bps liquidity__best_spread_bps f
median_spread_bps liquidity__median_spread_bps f
liquidity_venue_count liquidity__venue_count i
largest_venue_liquidity_share liquidity__largest_venue_share f
liquidity_concentration_hhi liquidity__concentration_hhi f
spot_venue_count structure__spot_venue_count i
perp_venue_count structure__perp_venue_count i
funding_rate_8h_median funding__rate_8h_median f
funding_rate_annualised_simple funding__annualised_simple f
funding_venue_count funding__venue_count i
funding_dispersion_bps funding__dispersion_bps f
open_interest_usd open_interest__total_usd f
open_interest_base open_interest__total_base f
open_interest_venue_count open_interest__venue_count i
perp_basis_bps_median basis__perp_basis_bps_median f
futures_basis_bps_median basis__futures_basis_bps_median f
effective_venue_count fragmentation__effective_venue_count f
volume_concentration_hhi fragmentation__volume_concentration_hhi f
largest_venue_volume_share fragmentation__largest_venue_volume_share f
fragmentation_index fragmentation__fragmentation_index f
rsi_14 technical__rsi_14 f
ema_12 technical__ema_12 f
ema_26 technical__ema_26 f
crowding_funding_percentile_30d crowding__funding_percentile_30d f
crowding_oi_to_volume crowding__oi_to_volume f
crowding_perp_dominance crowding__perp_dominance f
genome_status genome__status s
coverage_ratio quality__coverage__coverage_ratio f
freshest_observation_age_seconds quality__freshness__freshest_observation_age_seconds f
oldest_observation_age_seconds quality__freshness__oldest_observation_age_seconds f
ambiguous_identity_count quality__coverage__ambiguous_identity_count i
partial_data is_partial b
"""


@dataclass(frozen=True)
class Metric:
    name: str
    column: str
    kind: str

    @property
    def filterable(self) -> bool:
        return self.name != "asset_name"


METRICS = {name: Metric(name, column, kind) for name, column, kind in (line.split() for line in _TABLE.strip().splitlines())}
SQL_TYPES = {"s": "string", "i": "long", "f": "double", "b": "boolean"}
