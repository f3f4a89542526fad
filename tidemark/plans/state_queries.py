"""Queries of the parts of a state: vectors, genomes, venue rows, joins of marks and rates, ingest checks, roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import derivatives as D
from tidemark.operators import genomes, ingest, liquidity, pricing, robust, series, storage, structure, universes
from tidemark.operators import venue_rows as venue_parts
from tidemark.plans import views as V
from tidemark.plans.catalogue import _DEPTHS, _SLOT, _judged, _TICK, _trail, query, r
from tidemark.sources import datasets, files

#: The middle of the events, so that there is history before it.
AS_OF = V.AS_OF_MS - 12 * 86_400_000
MONTH, HOUR = 720 * 3_600_000, 3_600_000
LEAST_MONTH, BASELINE_HOURS = 20, 480


# --- what an asset's history says

_CURRENT = V.BOOK + "," + V.DERIVATIVES.split("obs AS", 1)[1].split("FROM lineitem JOIN part ON l_partkey = p_partkey),", 1)[1] + "," + V.VOLUMES + f""",
fu AS (SELECT asset, median(rate_8h) AS funding_8h FROM f8 WHERE rate_8h IS NOT NULL GROUP BY asset),
ba AS (SELECT asset, median((price - reference_price) / reference_price * 10000) FILTER (kind = 'perpetual' AND reference_price > 0) AS basis_bps FROM deriv GROUP BY asset),
ot AS (SELECT asset, sum(usd_equivalent) AS open_interest_usd FROM oi GROUP BY asset),
dp AS (SELECT asset, depth_50_bid AS db, depth_50_ask AS da FROM (SELECT asset, {_DEPTHS} FROM book GROUP BY asset)),
cu AS (SELECT vo.asset, funding_8h, basis_bps, open_interest_usd, total_usd AS volume_usd, (db - da) / nullif(db + da, 0) AS book_imbalance, open_interest_usd / nullif(total_usd, 0) AS oi_to_volume, perp_dominance FROM vo LEFT JOIN fu USING (asset) LEFT JOIN ba USING (asset) LEFT JOIN ot USING (asset) LEFT JOIN dp USING (asset))"""
_MEASURED = _CURRENT + "," + V.HISTORY + f""",
hr AS (SELECT h.*, h.ts_ms >= {AS_OF - MONTH} AS month, c.funding_8h AS cf, c.basis_bps AS cb, abs(h.ts_ms - {AS_OF - 24 * HOUR}) AS off FROM hist AS h JOIN cu AS c USING (asset) WHERE h.ts_ms < {AS_OF}),
hm AS (SELECT asset, max(ts_ms) AS last_ms, count(*) FILTER (month) AS points, arg_max(struct_pack(v := open_interest_usd), (ts_ms, id)).v AS oi_last, median(volume_usd) FILTER (ts_ms >= {AS_OF - BASELINE_HOURS * HOUR}) AS base_v, count(volume_usd) FILTER (ts_ms >= {AS_OF - BASELINE_HOURS * HOUR}) AS base_n,
  arg_min(open_interest_usd, (off, ts_ms, id)) FILTER (off <= 2700000 AND open_interest_usd IS NOT NULL) AS oi_day,
  count(funding_8h) FILTER (month) AS fn, avg(funding_8h) FILTER (month) AS fm, stddev_samp(funding_8h) FILTER (month) AS fs, count(*) FILTER (month AND funding_8h < cf) AS fb, count(*) FILTER (month AND funding_8h = cf) AS fe,
  count(basis_bps) FILTER (month) AS bn, avg(basis_bps) FILTER (month) AS bm, stddev_samp(basis_bps) FILTER (month) AS bs, count(*) FILTER (month AND basis_bps < cb) AS bb, count(*) FILTER (month AND basis_bps = cb) AS be FROM hr GROUP BY asset),
me AS (SELECT cu.*, CASE WHEN fn >= 8 AND fs > 0 THEN (funding_8h - fm) / fs END AS funding_deviation_z, CASE WHEN bn >= 8 AND bs > 0 THEN (basis_bps - bm) / bs END AS basis_deviation_z, CASE WHEN {AS_OF} - last_ms <= 1800000 AND oi_last > 0 THEN open_interest_usd / oi_last - 1 END AS oi_change,
  CASE WHEN base_n >= 16 THEN volume_usd / nullif(base_v, 0) END AS volume_acceleration, CASE WHEN points >= {LEAST_MONTH} AND funding_8h IS NOT NULL THEN (fb + fe / 2.0) / nullif(fn, 0) * 100 END AS funding_percentile_30d, CASE WHEN points >= {LEAST_MONTH} AND basis_bps IS NOT NULL THEN (bb + be / 2.0) / nullif(bn, 0) * 100 END AS basis_percentile_30d,
  CASE WHEN oi_day > 0 THEN open_interest_usd / oi_day - 1 END AS oi_change_24h FROM cu LEFT JOIN hm USING (asset))"""


def current(spark, sf_dir, lines=None):
    """Today's values that history is held against."""
    d, o = V.derivatives(spark, sf_dir, lines), V.obs(spark, sf_dir, lines)
    depth = liquidity.imbalance(liquidity.depth_bands(V.book(spark, sf_dir, lines), ["asset"])).select("asset", F.col("imbalance").alias("book_imbalance"))
    parts = [D.funding_by_asset(d).select("asset", F.col("rate_8h_median").alias("funding_8h")), D.basis_by_asset(d).select("asset", F.col("perp_basis_bps_median").alias("basis_bps")), D.open_interest_by_asset(d).select("asset", F.col("total_usd").alias("open_interest_usd")), depth]
    out = D.volume_by_segment(o).select("asset", F.col("total_usd").alias("volume_usd"), "perp_dominance")
    for part in parts:
        out = out.join(part, "asset", "left")
    return out.withColumn("oi_to_volume", C.ratio("open_interest_usd", "volume_usd"))


def measured(spark, sf_dir):
    return structure.history_measures(current(spark, sf_dir), V.history(spark, sf_dir), AS_OF, BASELINE_HOURS, LEAST_MONTH)


def _vector_sql(names):
    return f"WITH {_MEASURED} SELECT asset, {', '.join(f'round({n}, 5) AS {n}' for n in names)}, {' + '.join(f'({n} IS NOT NULL)::INT' for n in names)} AS components_available FROM me"


def _rounded(df, names):
    return df.select("asset", *[r(n, 5).alias(n) for n in names], "components_available")


@query(_vector_sql(structure.PRESSURE))
def pressure_vector(spark, sf_dir):
    return _rounded(structure.vector(measured(spark, sf_dir), structure.PRESSURE), structure.PRESSURE)


@query(_vector_sql(structure.CROWDING))
def crowding_vector(spark, sf_dir):
    return _rounded(structure.vector(measured(spark, sf_dir), structure.CROWDING), structure.CROWDING)


@query(f"WITH {V.HISTORY} SELECT asset, funding_8h AS latest, a.newest FROM hist JOIN (SELECT asset, max((ts_ms, id)) AS k, max(ts_ms) AS newest FROM hist WHERE ts_ms < {AS_OF} AND funding_8h IS NOT NULL GROUP BY asset) AS a USING (asset) WHERE (ts_ms, id) = k")
def history_join(spark, sf_dir):
    """The latest known funding of each asset before the moment, joined to the asset."""
    h = V.history(spark, sf_dir).filter((F.col("ts_ms") < AS_OF) & F.col("funding_8h").isNotNull())
    return h.groupBy("asset").agg(F.max_by("funding_8h", F.struct("ts_ms", "id")).alias("latest"), F.max("ts_ms").alias("newest"))


# --- genome

_PARTS = "effective_count perp_dominance funding_8h oi_to_volume venue_count log_depth volatility dispersion".split()
_GENOME = _CURRENT + "," + V.PRICES.removeprefix(V.OBS).lstrip(", \n") + "," + V.POINTS + f""",
tr AS ({_trail(720)}), lr AS (SELECT asset, CASE WHEN price > 0 AND lag(price) OVER o > 0 THEN ln(price / lag(price) OVER o) END AS x FROM tr WINDOW o AS (PARTITION BY asset ORDER BY ts_ms, id)), vl AS (SELECT asset, stddev_samp(x) AS volatility FROM lr GROUP BY asset),
vc AS (SELECT asset, count(DISTINCT venue) AS venue_count FROM obs GROUP BY asset),
ge AS (SELECT cu.asset, effective_count, cu.perp_dominance, funding_8h, oi_to_volume, venue_count::DOUBLE AS venue_count, CASE WHEN db + da > 0 THEN log10(db + da) END AS log_depth, volatility, mad_bps AS dispersion FROM cu LEFT JOIN hh USING (asset) LEFT JOIN dp USING (asset) LEFT JOIN vc USING (asset) LEFT JOIN vl USING (asset) LEFT JOIN (SELECT asset, mad_bps FROM pr) USING (asset))"""


@query(f"""WITH {_GENOME}, p AS (SELECT g.asset, {', '.join(f'g.{n} - o.{n} AS {n}' for n in _PARTS)} FROM ge AS g, (SELECT * FROM ge WHERE asset = 77) AS o WHERE g.asset <> 77),
q AS (SELECT asset, {' + '.join(f'({n} IS NOT NULL)::INT' for n in _PARTS)} AS shared, {' + '.join(f'coalesce({n} * {n}, 0)' for n in _PARTS)} AS total FROM p) SELECT asset, CASE WHEN shared >= 3 THEN round(sqrt(total / shared), 6) END AS distance, shared FROM q""")
def genome_similarity(spark, sf_dir):
    """How far every asset's features are from those of one asset."""
    s = _genomes(spark, sf_dir)
    near = structure.nearest_genomes(s.select("asset", structure.genome_features(s).alias("features")), 77)
    return near.select("asset", r("distance").alias("distance"), F.size(F.split("shared", ",")).alias("shared"))


def _genomes(spark, sf_dir):
    """All features of assets: of today, of books, of venues, and of their series (thin ones, so a month of log returns with no gate)."""
    lines = V.kept_lines(spark, sf_dir)
    obs, points = V.obs(spark, sf_dir, lines), V.points(spark, sf_dir)
    depth = liquidity.depth_bands(V.book(spark, sf_dir, lines), ["asset"]).select("asset", (F.col("depth_50_bid") + F.col("depth_50_ask")).alias("depth_50"))
    parts = [
        robust.concentration(obs, "asset", "venue", "volume"), depth, obs.groupBy("asset").agg(F.count_distinct("venue").alias("venue_count")), pricing.reference_prices(obs).select("asset", F.col("mad_bps").alias("dispersion_bps")),
        series.log_returns(series.trailing(points, 720)).groupBy("asset").agg(F.stddev_samp("log_return").alias("volatility_24h")),
    ]
    s = current(spark, sf_dir, lines)
    for part in parts:
        s = s.join(part, "asset", "left")
    return s


@query(f"""WITH {_GENOME}, p AS (SELECT g.asset, o.asset AS neighbour, {', '.join(f'g.{n} - o.{n} AS {n}' for n in _PARTS)} FROM ge AS g JOIN ge AS o ON g.asset <> o.asset),
q AS (SELECT asset, neighbour, {' + '.join(f'({n} IS NOT NULL)::INT' for n in _PARTS)} AS shared, {' + '.join(f'coalesce({n} * {n}, 0)' for n in _PARTS)} AS total FROM p), d AS (SELECT asset, neighbour, shared, sqrt(total / shared) AS distance FROM q WHERE shared >= 3)
SELECT asset, neighbour, round(distance, 6) AS distance, shared, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY distance, neighbour) AS rank FROM d) WHERE rank <= 10""")
def genome_nearest(spark, sf_dir):
    """The ten nearest of every asset by all eight features."""
    s = _genomes(spark, sf_dir)
    named = s.select("asset", "effective_count", "perp_dominance", "funding_8h", "oi_to_volume", F.col("venue_count").cast("double").alias("venue_count"), F.when(F.col("depth_50") > 0, F.log10("depth_50")).alias("log_depth"), F.col("volatility_24h").alias("volatility"), F.col("dispersion_bps").alias("dispersion"))
    return genomes.nearest(files.stored(named, "genomes"), _PARTS, leaf=200).withColumn("distance", r("distance"))


# --- joins of rates, marks and intervals


@query(f"WITH {V.OBS} SELECT asset, venue, round(sum(CASE WHEN {V.FX_SQL} IS NOT NULL THEN coalesce(volume * {V.FX_SQL}, l_quantity * price * {V.FX_SQL}) END), 6) AS weighting_volume, round(sum(volume * {V.FX_SQL}), 6) AS reported_volume FROM obs GROUP BY asset, venue")
def weighting_volume(spark, sf_dir):
    """Volumes that weight prices, beside those that are published."""
    o = V.obs(spark, sf_dir).withColumn("rate", V.quote_usd(F.col("ccy")))
    return o.groupBy("asset", "venue").agg(r(F.sum(D.weighting_volume(F.col("volume"), F.col("l_quantity"), F.col("price"), F.col("rate"))), 6).alias("weighting_volume"), r(F.sum(F.col("volume") * F.col("rate")), 6).alias("reported_volume"))


_RATES = """
ed AS (SELECT 'c' || (s_suppkey % 5) AS src, 'c' || CASE s_suppkey % 5 WHEN 4 THEN 4 WHEN 0 THEN 9 ELSE s_suppkey % 5 - 1 END AS dst, 1 + abs(s_acctbal) / 1000000 AS rate, 'v' || (s_suppkey % 16) AS venue, s_suppkey AS observed_at FROM supplier),
e1 AS (SELECT src, dst, arg_min(rate, (venue, observed_at, rate)) AS rate FROM ed WHERE src <> dst GROUP BY src, dst),
ra AS (SELECT 'c0' AS ccy, 1.0::DOUBLE AS usd UNION ALL SELECT 'c1', (SELECT rate FROM e1 WHERE src = 'c1') UNION ALL SELECT 'c2', (SELECT rate FROM e1 WHERE src = 'c2') * (SELECT rate FROM e1 WHERE src = 'c1') UNION ALL SELECT 'c3', (SELECT rate FROM e1 WHERE src = 'c3') * (SELECT rate FROM e1 WHERE src = 'c2') * (SELECT rate FROM e1 WHERE src = 'c1'))"""


@query(f"WITH {V.OBS}, {_RATES} SELECT asset, obs.ccy, count(*) AS n, round(sum(volume * usd), 2) AS usd FROM obs LEFT JOIN ra ON ra.ccy = 'c' || obs.ccy GROUP BY ALL")
def quote_conversion(spark, sf_dir):
    """Volumes in USD by rates from the cheapest conversion paths; a currency without a path converts to nothing, and what leads away from USD alone is no path."""
    k = F.col("s_suppkey") % 5
    e = V.table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), k).alias("src"), F.concat(F.lit("c"), F.when(k == 4, k).when(k == 0, 9).otherwise(k - 1)).alias("dst"), (1 + F.abs("s_acctbal") / 1_000_000).alias("rate"), F.concat(F.lit("v"), F.col("s_suppkey") % 16).alias("venue"), F.col("s_suppkey").alias("observed_at"))
    rates = ingest.quote_rates(e, "c0")
    o = V.obs(spark, sf_dir).withColumn("code", F.concat(F.lit("c"), "ccy")).join(rates, F.col("code") == F.col("currency"), "left")
    return o.groupBy("asset", "ccy").agg(F.count("*").alias("n"), r(F.sum(F.col("volume") * F.col("usd")), 2).alias("usd"))


_MARKS = V.DERIVATIVES + """,
ma AS (SELECT asset || ':' || venue AS instrument, arg_max(p_retailprice * (1 + l_discount), (l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice)) AS mark FROM obs WHERE l_linenumber IN (2, 3) GROUP BY 1),
ii AS (SELECT p_partkey % 16 AS v, p_partkey AS a, CASE WHEN p_size % 2 = 0 THEN 8.0::DOUBLE END AS hours FROM part),
fm AS (SELECT d.*, coalesce(mark, price) AS marked, coalesce(funding_hours, hours) AS interval_hours FROM deriv AS d LEFT JOIN ma ON ma.instrument = d.asset || ':' || d.venue LEFT JOIN ii ON a = asset AND v = venue WHERE kind = 'perpetual' AND funding_raw IS NOT NULL),
fr AS (SELECT asset, CASE WHEN funding_semantics = 'undocumented' THEN NULL WHEN coalesce(interval_hours, 0) <= 0 THEN NULL ELSE (CASE WHEN funding_semantics = 'relative' THEN funding_raw WHEN inverse THEN funding_raw * marked ELSE funding_raw / marked END) * 8 / interval_hours END AS rate_8h FROM fm)"""


@query(f"WITH {_MARKS} SELECT asset, count(*) AS n, count(rate_8h) AS known, round(sum(rate_8h), 9) AS total FROM fr GROUP BY asset")
def funding_with_marks(spark, sf_dir):
    """Funding turned relative by the instrument's last mark; intervals come from the instrument where the observation has none."""
    key = F.concat_ws(":", "asset", "venue")
    at = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    marks = V.obs(spark, sf_dir).filter("l_linenumber in (2, 3)").select(key.alias("instrument"), F.lit(0).alias("ts_ms"), at.alias("id"), (F.col("p_retailprice") * (1 + F.col("l_discount"))).alias("mark"))
    known = V.table(spark, sf_dir, "part").select(F.concat_ws(":", "p_partkey", F.col("p_partkey") % 16).alias("instrument"), F.when(F.col("p_size") % 2 == 0, 8.0).alias("hours"))
    d = V.derivatives(spark, sf_dir).filter("kind = 'perpetual' and funding_raw is not null").withColumn("instrument", key)
    f = D.funding(D.with_intervals(D.with_marks(d, marks), known))
    return f.groupBy("asset").agg(F.count("*").alias("n"), F.count("rate_8h").alias("known"), r(F.sum("rate_8h"), 9).alias("total"))


# --- venue rows


_VENUE = V.PRICES + "," + V.VOLUMES + f""",
kk AS (SELECT DISTINCT asset, price, rw, weight FROM ca),
vr AS (SELECT asset, venue, unnest(arg_min(struct_pack(price := w2.price, source := source, kind := kind, weight := weight, reason := reason, ccy := ccy, age_s := age_s, base_volume := l_quantity, volume := volume),
  (CASE WHEN reason IS NULL THEN 0 ELSE 1 END, CASE WHEN kind = 'option' THEN 1 ELSE 0 END, CASE WHEN kind = 'spot' THEN 0 ELSE 1 END, CASE WHEN {V.FX_SQL} IS NULL THEN 1 ELSE 0 END, -coalesce(weight, 0), -coalesce(volume, 0), l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice))), count(*) AS instruments FROM w2 LEFT JOIN kk USING (asset, price, rw) GROUP BY asset, venue)"""


@query(f"WITH {_VENUE} SELECT asset, venue, round(vr.price, 6) AS price, source, kind, round(weight, 6) AS weight, reason, reason IS NULL AS included, ccy, age_s AS age, base_volume, volume, round((vr.price - reference_price) / reference_price * 10000, 4) AS deviation_bps, instruments, round(share, 6) AS volume_share FROM vr LEFT JOIN rp USING (asset) LEFT JOIN sh USING (asset, venue)")
def venue_states(spark, sf_dir):
    """A row for each asset and venue: the ticker that stands for it, its part in the price, and its share of volume."""
    p = pricing.provenance(V.obs(spark, sf_dir))
    last = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    best = pricing.representative(p, ["asset", "venue"], V.quote_usd(F.col("ccy")), last)
    counts = p.groupBy("asset", "venue").agg(F.count("*").alias("instruments"), F.sum(F.when(F.col("volume") > 0, F.col("volume"))).alias("v"))
    shares = counts.join(counts.groupBy("asset").agg(F.sum("v").alias("every")), "asset").select("asset", "venue", "instruments", C.ratio("v", "every").alias("share"))
    j = best.join(shares, ["asset", "venue"])
    return j.select("asset", "venue", r("price").alias("price"), "source", "kind", r("weight").alias("weight"), "reason", "included", "ccy", F.col("age_s").alias("age"), F.col("l_quantity").alias("base_volume"), "volume", r(C.bps(F.col("price"), F.col("reference_price")), 4).alias("deviation_bps"), "instruments", r("share").alias("volume_share"))


def _edges(spark, sf_dir):
    k = F.col("s_suppkey") % 5
    return V.table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), k).alias("src"), F.concat(F.lit("c"), F.when(k == 4, k).when(k == 0, 9).otherwise(k - 1)).alias("dst"), (1 + F.abs("s_acctbal") / 1_000_000).alias("rate"), F.concat(F.lit("v"), F.col("s_suppkey") % 16).alias("venue"), F.col("s_suppkey").alias("observed_at"))


def venue_rows(spark, sf_dir):
    """All venue rows of these tables, nested."""
    lines = V.kept_lines(spark, sf_dir)
    last = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    found = ingest.conversions(_edges(spark, sf_dir), "c0", ["c1", "c2"])
    return venue_parts.venue_rows(V.obs(spark, sf_dir, lines), V.derivatives(spark, sf_dir, lines), V.book(spark, sf_dir, lines), found, F.concat(F.lit("asset:named:part:P"), "asset"), F.concat(F.lit("c"), "ccy"), F.col("l_quantity"), AS_OF, last)


#: Added before rounding: sums of products of table values lie halfway between two decimals often.
_OFF = 1.23456e-5
_CONVERTED = _RATES.split("e1 AS")[0] + """e1 AS (SELECT src, dst, unnest(arg_min(struct_pack(rate := rate, venue := venue, seen := observed_at), (venue, observed_at, rate))) FROM ed WHERE src <> dst GROUP BY src, dst),
x AS (SELECT src, rate, venue, seen FROM e1 WHERE src IN ('c1', 'c2', 'c3')),
cv AS (SELECT 0 AS ccy, 'c0' AS cf, 1.0::DOUBLE AS rate, 'identity' AS method, NULL::BIGINT AS seen, NULL AS cs, '["c0"]' AS path, NULL::DOUBLE AS parity
UNION ALL SELECT 1, 'c1', rate, 'direct', seen, venue, '["c1","c0"]', (rate - 1) * 10000 FROM x WHERE src = 'c1'
UNION ALL SELECT 2, 'c2', b.rate * a.rate, 'chained', least(a.seen, b.seen), b.venue, '["c2","c1","c0"]', (b.rate * a.rate - 1) * 10000 FROM x a, x b WHERE a.src = 'c1' AND b.src = 'c2'
UNION ALL SELECT 3, 'c3', c.rate * b.rate * a.rate, 'chained', least(a.seen, b.seen, c.seen), c.venue, '["c3","c2","c1","c0"]', NULL FROM x a, x b, x c WHERE a.src = 'c1' AND b.src = 'c2' AND c.src = 'c3')"""
_FULL = V.PRICES + "," + V.VOLUMES + "," + V.DERIVATIVES.removeprefix(V.OBS).lstrip(", \n") + "," + V.BOOK.removeprefix(V.OBS).lstrip(", \n") + "," + _CONVERTED + f""",
kk AS (SELECT DISTINCT asset, price, rw, weight FROM ca),
vr AS (SELECT asset, venue, unnest(arg_min(struct_pack(price := w2.price, source := source, kind := kind, weight := weight, reason := reason, ccy := w2.ccy, age_s := age_s, base_volume := l_quantity, volume := volume),
  (CASE WHEN reason IS NULL THEN 0 ELSE 1 END, CASE WHEN kind = 'option' THEN 1 ELSE 0 END, CASE WHEN kind = 'spot' THEN 0 ELSE 1 END, CASE WHEN cv.rate IS NULL THEN 1 ELSE 0 END, -coalesce(weight, 0), -coalesce(volume, 0), l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice))), count(*) AS instruments FROM w2 LEFT JOIN kk USING (asset, price, rw) LEFT JOIN cv ON cv.ccy = w2.ccy GROUP BY asset, venue),
sx AS (SELECT asset, venue, max(price) FILTER (side = 'bid') AS bid, min(price) FILTER (side = 'ask') AS ask FROM book GROUP BY asset, venue),
dx AS (SELECT asset, venue, depth_50_bid + depth_50_ask AS d FROM (SELECT asset, venue, {_DEPTHS.replace(', 7) END', ', 9) END')} FROM book GROUP BY asset, venue)),
dz AS (SELECT asset, venue, d, CASE WHEN d > 0 THEN d / sum(CASE WHEN d > 0 THEN d END) OVER (PARTITION BY asset) END AS dshare FROM dx),
fx AS (SELECT asset, venue, unnest(arg_max(struct_pack(fraw := funding_raw, fhours := funding_hours, f8 := rate_8h, mark := price), (coalesce(oi_raw, -1), funding_raw, coalesce(funding_hours, -1), coalesce(rate_8h, -9), price))) FROM f8 WHERE kind = 'perpetual' AND funding_raw IS NOT NULL GROUP BY asset, venue),
ox AS (SELECT asset, venue, sum(oi_raw) AS oraw, sum(usd_equivalent) AS ousd FROM oi GROUP BY asset, venue)"""


@query(f"""WITH {_FULL} SELECT 'asset:named:part:P' || asset AS asset_id, venue::VARCHAR AS venue_slug, ({AS_OF} - age_s * 1000)::BIGINT AS observed_at, round(vr.price, 6) AS price_usd, source AS price_source, round((vr.price - reference_price) / reference_price * 10000, 4) AS deviation_bps, round(weight, 6) AS reference_weight,
round(CASE WHEN bid <= ask THEN (ask - bid) / ((ask + bid) / 2) * 10000 END, 6) AS spread_bps, base_volume AS reported_base_volume_24h, volume AS reported_quote_volume_24h, round(volume * cv.rate + {_OFF}, 3) AS reported_volume_24h_usd, round(share, 6) AS volume_share, round(dshare, 6) AS liquidity_share, round(d + {_OFF}, 2) AS depth_50bps_usd,
fraw AS funding_rate_raw, fhours AS funding_interval_hours, round(f8, 10) AS funding_rate_8h, round(mark, 6) AS mark_price_usd, NULL::DOUBLE AS index_price_usd, round(oraw, 4) AS open_interest_raw, round(ousd + {_OFF}, 2) AS open_interest_usd, instruments AS instrument_count, cf AS conversion__from_asset_id, CASE WHEN cf IS NOT NULL THEN 'c0' END AS conversion__to_asset_id, round(cv.rate, 8) AS conversion__rate, method AS conversion__method,
seen AS conversion__observed_at, cs AS conversion__source_venue_slug, path AS conversion__path, round(parity, 6) AS conversion__deviation_from_parity_bps, reason IS NULL AS included_in_reference_price, reason AS exclusion_reason
FROM vr LEFT JOIN (SELECT asset, reference_price FROM rp) USING (asset) LEFT JOIN sh USING (asset, venue) LEFT JOIN cv USING (ccy) LEFT JOIN sx USING (asset, venue) LEFT JOIN dz USING (asset, venue) LEFT JOIN fx USING (asset, venue) LEFT JOIN ox USING (asset, venue)""")
def venue_table(spark, sf_dir):
    """The whole row of each asset and venue, in all 32 columns as they are stored."""
    t = datasets.built_table("venue_asset_state", venue_rows(spark, sf_dir))
    digits = {"price_usd": 6, "deviation_bps": 4, "reference_weight": 6, "spread_bps": 6, "reported_volume_24h_usd": 3, "volume_share": 6, "liquidity_share": 6, "depth_50bps_usd": 2, "funding_rate_8h": 10, "mark_price_usd": 6, "open_interest_raw": 4, "open_interest_usd": 2, "conversion__rate": 8, "conversion__deviation_from_parity_bps": 6}
    return t.withColumns({c: r(F.col(c) + _OFF if c in ("reported_volume_24h_usd", "depth_50bps_usd", "open_interest_usd") else c, n) for c, n in digits.items()})


_SEEN = "1995-01-01"


@query(f"""WITH m AS (SELECT DISTINCT l_partkey || ':' || l_suppkey % 16 || ':' || l_returnflag AS instrument_id, l_suppkey % 16 AS v, l_shipdate < TIMESTAMP '{_SEEN}' AS early FROM lineitem),
g AS (SELECT instrument_id, v::VARCHAR AS venue_slug, bool_or(early) AS a, bool_or(NOT early) AS b FROM m GROUP BY ALL)
SELECT instrument_id, venue_slug, b AS active, CASE WHEN a THEN 1000 ELSE 2000 END::BIGINT AS first_seen_at, CASE WHEN b THEN 2000 ELSE 1000 END::BIGINT AS last_seen_at FROM g""")
def carried_instruments(spark, sf_dir):
    """Instruments over two generations, of shipments before and since a day: when each was first and last seen, and whether it is still there."""
    l = V.table(spark, sf_dir, "lineitem")  # noqa: E741
    key = F.concat_ws(":", "l_partkey", F.col("l_suppkey") % 16, "l_returnflag")
    of = lambda rows: rows.select(key.alias("instrument_id"), (F.col("l_suppkey") % 16).cast("string").alias("venue_slug"), F.lit(True).alias("active")).distinct()
    day = F.lit(_SEEN).cast("timestamp_ntz")
    first = datasets.built_table("instruments", datasets.carried(of(l.filter(F.col("l_shipdate") < day)), None, "instrument_id", 1000))
    second = datasets.built_table("instruments", datasets.carried(of(l.filter(F.col("l_shipdate") >= day)), first, "instrument_id", 2000, "active"))
    return second.select("instrument_id", "venue_slug", "active", "first_seen_at", "last_seen_at")


@query(f"""WITH {V.BOOK}, s AS (SELECT asset, venue, {_DEPTHS} FROM book GROUP BY asset, venue), t AS (SELECT asset, venue, depth_50_bid + depth_50_ask AS d FROM s), u AS (SELECT asset, venue, d, d / sum(d) OVER (PARTITION BY asset) AS share FROM t WHERE d > 0)
SELECT asset, count(*) AS venues, round(sum(d), 2) AS depth, round(max(share), 6) AS largest_share, round(sum(share * share), 6) AS hhi, arg_max(venue, (round(d, 4), -venue)) AS largest_venue FROM u GROUP BY asset""")
def liquidity_at_50bps(spark, sf_dir):
    """Depth within 50 bps over venues: in all, the largest venue and its share, and how concentrated it is."""
    d = liquidity.depth_bands(V.book(spark, sf_dir), ["asset", "venue"]).withColumn("d", F.col("depth_50_bid") + F.col("depth_50_ask")).filter("d > 0")
    return liquidity.depth_shares(d).select("asset", "venues", r("depth", 2).alias("depth"), r("largest_share").alias("largest_share"), r("hhi").alias("hhi"), "largest_venue")


for _n in liquidity.NOTIONALS[1:]:
    query(f"""WITH {V.BOOK}, t AS (SELECT *, greatest(0, least(usd, {int(_n)} - coalesce(sum(usd) OVER (PARTITION BY asset, side ORDER BY CASE side WHEN 'bid' THEN -price ELSE price END, size, venue ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take FROM book WHERE usd > 0),
    g AS (SELECT asset, side, sum(usd) AS there, (sum(price * take) / sum(take) - max(reference_price)) / max(reference_price) * 10000 AS off FROM t GROUP BY asset, side)
    SELECT asset, side, CASE WHEN there >= {int(_n)} THEN round(greatest(0, CASE side WHEN 'ask' THEN off ELSE -off END), 6) END AS impact_bps FROM g""", f"walk_impact_{int(_n)}")(lambda spark, sf_dir, n=_n: liquidity.walk(V.book(spark, sf_dir), ["asset"], n).select("asset", "side", r("impact_bps").alias("impact_bps")))

for _w in ("24h", "7d"):
    _h, _least = series.WINDOW_HOURS[_w], 3
    query(f"WITH {V.POINTS}, t AS ({_trail(_h)}), l AS (SELECT asset, price, CASE WHEN price > 0 AND lag(price) OVER o > 0 THEN ln(price / lag(price) OVER o) END AS x FROM t WINDOW o AS (PARTITION BY asset ORDER BY ts_ms, id)) SELECT asset, round(CASE WHEN count(*) >= {_least} AND 1 - count(*) / {_h * 4.0} <= 0.35 THEN stddev_samp(x) * sqrt(35040) END, 6) AS realised, count(*) AS points, round(stddev_samp(x), 6) AS deviation FROM l GROUP BY asset", f"volatility_{_w}")(
        lambda spark, sf_dir, h=_h: series.volatility(V.points(spark, sf_dir), h, 3).join(series.log_returns(series.trailing(V.points(spark, sf_dir), h)).groupBy("asset").agg(r(F.stddev_samp("log_return")).alias("deviation")), "asset").select("asset", r("realised").alias("realised"), "points", "deviation"))


@query(f"""WITH {V.OBS}, a AS (SELECT asset, l_linenumber, kind, CASE WHEN l_quantity % 9 > 0 THEN age_s END AS age, l_linestatus FROM obs)
SELECT asset, min(age) AS ticker_age_s, min(age) FILTER (kind = 'perpetual' AND l_linenumber <> 6) AS funding_age_s, min(age) FILTER (kind <> 'spot' AND l_linenumber <> 7) AS open_interest_age_s, min(age) FILTER (l_linestatus = 'O') AS order_book_age_s, min(age) AS freshest_age_s, max(age) AS oldest_age_s FROM a WHERE age IS NOT NULL GROUP BY asset""")
def freshness_by_family(spark, sf_dir):
    """Ages of tickers, funding, open interest and books; observations without a venue's time tell nothing."""
    o = V.obs(spark, sf_dir).withColumn("age_s", F.when(F.col("l_quantity") % 9 > 0, F.col("age_s")))
    return structure.family_ages({"ticker": o, "funding": o.filter("kind = 'perpetual' and l_linenumber <> 6"), "open_interest": o.filter("kind <> 'spot' and l_linenumber <> 7"), "order_book": o.filter("source = 'mid'")})


# --- ingest


@query(f"WITH {V.OBS}, {_TICK} SELECT count(*) AS considered, count(*) FILTER (reason IS NULL) AS accepted, count(reason) AS quarantined, true AS conserved FROM judged")
def conservation(spark, sf_dir):
    return ingest.conserved(_judged(spark, sf_dir), "reason")


_RAW = """raw AS (SELECT p_partkey AS id, ['spot', 'perpetual', 'future', 'option', 'swap'][1 + p_partkey % 5] AS instrument_type, CASE p_size % 4 WHEN 0 THEN 'linear' WHEN 1 THEN 'inverse' WHEN 2 THEN NULL ELSE 'odd' END AS contract_type, CASE p_partkey % 7 WHEN 0 THEN 'call' WHEN 1 THEN 'put' WHEN 2 THEN 'both' END AS option_type,
  CASE WHEN p_size % 3 <> 0 THEN 1700000000000 END AS expiry, CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS strike, ['contracts', 'usd', 'lots', 'base_asset'][1 + p_partkey % 4] AS unit, ['relative', 'absolute', 'guessed'][1 + p_partkey % 3] AS semantics, CASE WHEN p_partkey % 2 = 0 THEN 1.0::DOUBLE END AS multiplier, split_part(p_brand, '#', 1) AS base, split_part(p_brand, '#', 2) AS quote FROM part)"""


@query(f"""WITH {_RAW}, n AS (SELECT *, CASE WHEN instrument_type = 'swap' THEN 'unknown_instrument_type' WHEN contract_type = 'odd' THEN 'unknown_contract_type' WHEN option_type = 'both' THEN 'unknown_option_type'
  WHEN (instrument_type = 'perpetual' AND expiry IS NOT NULL) OR (instrument_type IN ('future', 'option') AND expiry IS NULL) OR (instrument_type = 'option' AND (strike IS NULL OR option_type IS NULL)) OR (instrument_type = 'spot' AND contract_type IS NOT NULL) THEN 'model_validation' END AS reason, CASE WHEN unit <> 'lots' THEN unit WHEN instrument_type <> 'spot' THEN 'unknown' END AS open_interest_unit FROM raw)
SELECT id, reason, upper(base) || '/' || upper(quote) AS symbol, open_interest_unit, CASE WHEN semantics = 'guessed' THEN 'undocumented' ELSE semantics END AS funding_semantics, CASE WHEN instrument_type = 'perpetual' THEN 'perpetual' WHEN instrument_type IN ('future', 'option') THEN 'dated' END AS settlement_period, coalesce(instrument_type <> 'spot' AND open_interest_unit = 'contracts' AND multiplier IS NULL, false) AS missing_multiplier FROM n""")
def instrument_normalisation(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (1 + at).cast("int"))
    raw = V.table(spark, sf_dir, "part").select(
        k.alias("id"), pick(["spot", "perpetual", "future", "option", "swap"], k % 5).alias("instrument_type"), F.when(size % 4 == 0, "linear").when(size % 4 == 1, "inverse").when(size % 4 == 3, "odd").alias("contract_type"), F.when(k % 7 == 0, "call").when(k % 7 == 1, "put").when(k % 7 == 2, "both").alias("option_type"),
        F.when(size % 3 != 0, F.lit(1_700_000_000_000)).alias("expiry"), F.when(size % 2 == 0, F.col("p_retailprice")).alias("strike"), pick(["contracts", "usd", "lots", "base_asset"], k % 4).alias("open_interest_unit"), pick(["relative", "absolute", "guessed"], k % 3).alias("funding_semantics"), F.when(k % 2 == 0, 1.0).alias("contract_multiplier"),
        F.split_part("p_brand", F.lit("#"), F.lit(1)).alias("base"), F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("quote"),
    )
    n = ingest.normalised_instruments(raw)
    return n.select("id", "reason", F.col("symbol_normalized").alias("symbol"), "open_interest_unit", "funding_semantics", "settlement_period", F.coalesce("missing_multiplier", F.lit(False)).alias("missing_multiplier"))


_CLOCK = V.AS_OF_MS
_TIMES = f"(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN epoch_us(ts) // 1000 END AS event, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 - 5 ELSE 0 END AS server, epoch_us(ts) // 1000 + 40 + CASE WHEN event_id % 50 = 0 THEN 100000000000 WHEN event_id % 50 = 1 THEN -1700000000000 ELSE 0 END AS receive FROM events)"


@query(f"SELECT event_id, t AS best_ms, CASE WHEN t >= 1262304000000 AND t <= {_CLOCK} + 93600000 THEN t END AS plausible_ms FROM (SELECT event_id, coalesce(nullif(event, 0), nullif(server, 0), receive) AS t FROM {_TIMES})")
def observation_times(spark, sf_dir):
    """The best clock of each observation, and whether its time is plausible."""
    e, k = V.table(spark, sf_dir, "events"), F.col("event_id")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    shifted = ms + 40 + F.when(k % 50 == 0, F.lit(100_000_000_000)).when(k % 50 == 1, F.lit(-1_700_000_000_000)).otherwise(F.lit(0))
    best = ingest.best_time(F.when(k % 3 == 0, F.lit(0).cast("long")).when(k % 3 == 1, ms), F.when(k % 2 == 0, ms - 5).otherwise(F.lit(0).cast("long")), shifted)
    return e.select("event_id", best.alias("best_ms")).withColumn("plausible_ms", C.plausible_ms(F.col("best_ms"), F.lit(_CLOCK)))


@query(f"WITH {V.BOOK}, t AS (SELECT asset, venue, CASE WHEN asset % 19 <> 0 THEN asset END AS instrument, max(price) FILTER (side = 'bid') AS bid, min(price) FILTER (side = 'ask') * CASE WHEN asset % 5 = 0 THEN 0.98 ELSE 1 END AS ask FROM book GROUP BY asset, venue) SELECT asset, venue, CASE WHEN instrument IS NULL THEN 'unresolved_instrument' WHEN bid IS NULL OR ask IS NULL THEN 'schema_failure' WHEN bid >= ask THEN 'crossed_book' END AS reason FROM t")
def book_validation(spark, sf_dir):
    side = lambda s, f: f(F.when(F.col("side") == s, F.col("price")))
    t = V.book(spark, sf_dir).groupBy("asset", "venue").agg(side("bid", F.max).alias("bid"), (side("ask", F.min)).alias("low_ask")).withColumn("ask", F.col("low_ask") * F.when(F.col("asset") % 5 == 0, 0.98).otherwise(1))
    return t.select("asset", "venue", ingest.book_reason(F.when(F.col("asset") % 19 != 0, F.col("asset")), F.col("bid"), F.col("ask")).alias("reason"))


# --- storage


@query(f"WITH {V.POINTS}, s AS (SELECT {_SLOT} AS slot, count(*) AS n FROM points GROUP BY 1) SELECT * FROM s WHERE slot < {AS_OF - 5 * 86_400_000} OR slot > {AS_OF}")
def unexpected_slots(spark, sf_dir):
    return storage.unexpected_slots(V.points(spark, sf_dir), "ts_ms", AS_OF - 5 * 86_400_000, AS_OF)


for _unit in ("day", "month"):
    query(f"SELECT date_trunc('{_unit}', ts)::TIMESTAMP AS since, count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, round(avg(value), 6) AS mean, round(arg_min(value, (ts, event_id)), 6) AS first, round(arg_max(value, (ts, event_id)), 6) AS last FROM events GROUP BY 1", f"rollup_{'daily' if _unit == 'day' else 'monthly'}")(
        lambda spark, sf_dir, unit=_unit: storage.rollup(V.table(spark, sf_dir, "events").select("ts", F.col("event_id").alias("id"), "value"), unit).select("since", "n", *[r(c).alias(c) for c in ("low", "high", "mean", "first", "last")]))


_INSTRUMENT = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(f"WITH {V.PRICES} SELECT asset, venue, l_orderkey, l_linenumber, reason, row_number() OVER (PARTITION BY asset ORDER BY CASE WHEN reason IS NULL THEN 0 ELSE 1 END, venue, {', '.join(_INSTRUMENT)})::INT AS place FROM w2")
def provenance_order(spark, sf_dir):
    """The order in which an asset's observations are told: those in the price first, then by venue and instrument."""
    return pricing.ordered(pricing.provenance(V.obs(spark, sf_dir)), _INSTRUMENT).select("asset", "venue", "l_orderkey", "l_linenumber", "reason", "place")


_RUNS = f"""gen AS (SELECT event_id AS id, epoch_us(ts) // 1000 AS ts_ms, event_id % 7 > 0 AS due, event_type <> 'error' AS valid FROM events WHERE epoch_us(ts) // 1000 IS NOT NULL),
slo AS (SELECT *, ts_ms // 900000 * 900000 AS slot, ts_ms // 86400000 * 86400000 AS day FROM gen),
tak AS (SELECT slot, count(*) FILTER (due) AS runs, count(*) FILTER (due AND valid) AS good, count(*) FILTER (NOT due) AS unexpected FROM slo GROUP BY slot),
rep AS (SELECT d.day, d.day + k * 900000 AS slot, coalesce(good, 0) > 0 AS successful, coalesce(runs, 0) = 0 AS missing, coalesce(runs, 0) > 1 AS duplicate, coalesce(runs, 0) > 0 AND coalesce(good, 0) = 0 AS invalid, coalesce(unexpected, 0) AS unexpected
  FROM (SELECT DISTINCT day FROM slo) AS d, range(96) AS r(k) LEFT JOIN tak ON tak.slot = d.day + k * 900000)"""


def _runs(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), (F.col("event_id") % 7 > 0).alias("due"), (F.col("event_type") != "error").alias("valid"))


@query(f"WITH {_RUNS} SELECT * FROM rep")
def slot_report(spark, sf_dir):
    """Of each slot whether it succeeded, is missing, was claimed twice or failed, and runs that nobody scheduled."""
    return storage.slot_report(_runs(spark, sf_dir))


@query(f"WITH {_RUNS} SELECT id, ts_ms FROM slo SEMI JOIN (SELECT slot FROM rep WHERE successful AND NOT duplicate) USING (slot) WHERE due")
def compactable_generations(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return storage.compactable(runs, storage.slot_report(runs)).select("id", "ts_ms")


_ORDERED = "gen AS (SELECT o_orderkey AS id, epoch_us(o_orderdate) // 1000 + (o_orderkey * 7919) % 86400000 AS ts_ms, true AS due, o_orderstatus <> 'P' AS valid FROM orders)"


@query(f"WITH {_RUNS.replace(_RUNS[:_RUNS.index('slo AS')], _ORDERED + ', ')}, c AS (SELECT DISTINCT epoch_us(l_shipdate) // 1000 AS day FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 7) SELECT day, count(*) FILTER (successful) AS slots FROM rep WHERE day + 86400000 <= {AS_OF} GROUP BY day HAVING count(*) FILTER (successful) > 0 AND NOT bool_or(duplicate) AND day NOT IN (SELECT day FROM c)")
def closed_days(spark, sf_dir):
    """Days whose runs may be put together, of orders as runs; days of some large shipments have been already."""
    runs = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + (F.col("o_orderkey") * 7919) % 86_400_000).alias("ts_ms"), F.lit(True).alias("due"), (F.col("o_orderstatus") != "P").alias("valid"))
    done = V.table(spark, sf_dir, "lineitem").filter("l_quantity = 50 and l_linenumber = 7").select(F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("day")).distinct()
    return storage.closed_days(storage.slot_report(runs), done, AS_OF)


_CANDIDATES = "(SELECT CASE o_orderkey % 9 WHEN 0 THEN 'code-' WHEN 1 THEN 'data-latest-' ELSE 'data-' END || o_orderkey AS tag, (o_orderkey * 31) % 4000 / 10.0 AS age_hours, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN true END AS has_replacement, o_totalprice < 300000 AS verified FROM orders)"


@query(f"WITH h AS (SELECT *, CASE WHEN NOT starts_with(tag, 'data-') THEN 'foreign_tag' WHEN starts_with(tag, 'data-latest') THEN 'protected_tag' WHEN age_hours < 48 THEN 'too_young' WHEN NOT coalesce(has_replacement, false) THEN 'no_replacement' WHEN NOT coalesce(verified, false) THEN 'not_verified' END AS held FROM {_CANDIDATES}), k AS (SELECT *, row_number() OVER (PARTITION BY held ORDER BY age_hours DESC, tag) AS n FROM h) SELECT tag, coalesce(held, CASE WHEN n > 200 THEN 'over_the_limit' ELSE 'delete' END) AS action FROM k")
def deletion_plan(spark, sf_dir):
    """What a clean-up deletes, at most 200 in one run, and why it leaves the rest."""
    o, k = V.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    c = o.select(F.concat(F.when(k % 9 == 0, "code-").when(k % 9 == 1, "data-latest-").otherwise("data-"), k).alias("tag"), ((k * 31) % 4000 / 10.0).alias("age_hours"), F.when(F.col("o_orderstatus").isin("F", "O"), True).alias("has_replacement"), (F.col("o_totalprice") < 300_000).alias("verified"))
    return storage.deletion_plan(c).select("tag", "action")


@query("SELECT p_partkey AS id, p_name AS name, p_size::BIGINT AS size, NULL::DOUBLE AS balance FROM part UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::BIGINT AS size FROM supplier")
def union_by_name(spark, sf_dir):
    """Tables of different generations as one: columns meet by name, and those that one lacks are null."""
    a = V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("size"))
    b = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True).select("id", "name", "size", "balance")


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def shared_keys(spark, sf_dir):
    return V.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).intersect(V.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


# --- live universe

_META = "me AS (SELECT 'a' || p_partkey AS asset_id, p_name AS symbol, CASE WHEN p_partkey % 3 = 0 THEN 'unresolved' ELSE ['resolved', 'probable', 'ambiguous', 'manual_override'][1 + p_size % 4] END AS resolution_state, p_partkey % 17 = 0 AS is_stablecoin FROM part)"
_LIVE = V.OBS + f", {_META}, st AS (SELECT 'a' || asset AS asset_id, min(price) AS price, round(sum(volume), 2) AS volume, count(DISTINCT venue) AS venue_count FROM obs GROUP BY asset), lu AS (SELECT asset_id, symbol, price, row_number() OVER (ORDER BY volume DESC NULLS LAST, asset_id) AS rank FROM st JOIN me USING (asset_id) WHERE resolution_state IN ('resolved', 'manual_override', 'probable') AND NOT is_stablecoin AND venue_count >= 2 QUALIFY rank <= 150)"


def _live(spark, sf_dir):
    k = F.col("p_partkey")
    meta = V.table(spark, sf_dir, "part").select(F.concat(F.lit("a"), k).alias("asset_id"), F.col("p_name").alias("symbol"), F.when(k % 3 == 0, "unresolved").otherwise(F.element_at(F.array(*map(F.lit, ("resolved", "probable", "ambiguous", "manual_override"))), 1 + F.col("p_size") % 4)).alias("resolution_state"), (k % 17 == 0).alias("is_stablecoin"))
    states = V.obs(spark, sf_dir).groupBy(F.concat(F.lit("a"), "asset").alias("asset_id")).agg(F.min("price").alias("price"), r(F.sum("volume"), 2).alias("volume"), F.count_distinct("venue").alias("venue_count"))
    return universes.live_universe(states, meta)


@query(f"WITH {_LIVE} SELECT rank, asset_id, symbol, round(price, 6) AS price FROM lu")
def live_universe(spark, sf_dir):
    return _live(spark, sf_dir).select(F.col("rank").cast("long").alias("rank"), "asset_id", "symbol", r("price").alias("price"))


@query(f"WITH {_LIVE}, i AS (SELECT DISTINCT asset, venue, kind, ccy FROM obs) SELECT 'a' || asset AS base_id, venue, kind, ccy FROM i SEMI JOIN lu ON asset_id = 'a' || asset WHERE kind <> 'future' AND ccy IN (0, 2, 3) AND (asset + venue) % 5 > 0")
def live_instruments(spark, sf_dir):
    """Active instruments of followed assets with a quote that has a rate."""
    i = V.obs(spark, sf_dir).select("asset", "venue", "kind", "ccy").distinct()
    i = i.select(F.concat(F.lit("a"), "asset").alias("base_id"), "venue", F.when(F.col("kind") == "spot", "spot").when(F.col("kind") == "perpetual", "perpetual_linear").otherwise("future_dated").alias("class"), F.col("ccy").alias("quote_id"), ((F.col("asset") + F.col("venue")) % 5 > 0).alias("active"), "kind", "ccy")
    rates = spark.createDataFrame([(0,), (2,), (3,)], "quote_id long")
    return universes.live_instruments(i, _live(spark, sf_dir), rates).select("base_id", "venue", "kind", "ccy")


# --- scalars


@query("SELECT event_id, CASE WHEN value = 0 THEN 0 ELSE round(value * pow(10, 4 - floor(log10(abs(value))))) / pow(10, 4 - floor(log10(abs(value)))) END AS five_digits FROM events")
def round_for_output(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select("event_id", C.round_for_output(F.col("value"), 5).alias("five_digits"))


@query("SELECT p_partkey, split_part(replace(p_brand, '#', '-'), '-', 1) AS base, split_part(replace(p_brand, '#', '-'), '-', 2) AS quote, substr(p_brand, 6) AS bare, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 4 ELSE NULL END::INT AS decimals, epoch_ms(TIMESTAMP '2024-01-01' + INTERVAL (p_size) HOUR) AS ms FROM part")
def text_scalars(spark, sf_dir):
    p, size = V.table(spark, sf_dir, "part"), F.col("p_size")
    pair = C.split_pair(F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")))
    step = F.when(size % 4 == 0, 1.0).when(size % 4 == 1, 0.5).when(size % 4 == 2, 0.0025).otherwise(-1.0)
    iso = F.date_format(F.timestamp_millis(F.lit(1_704_067_200_000) + size * 3_600_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return p.select("p_partkey", pair["base"].alias("base"), pair["quote"].alias("quote"), C.without_prefix(F.col("p_brand"), "Brand", "Brand#").alias("bare"), C.step_decimals(step).alias("decimals"), C.iso_ms(iso).alias("ms"))
