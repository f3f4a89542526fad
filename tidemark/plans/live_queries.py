"""Queries of the live path, by batch replay and as streams."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans import views as V
from tidemark.plans.catalogue import query, r
from tidemark.streaming import book, capture, frames, live

NOW = V.AS_OF_MS - 86_400_000
STALE = 5 * 86_400.0
#: Added before rounding: products of table values lie halfway between two decimals often, and engines round those differently.
OFF = 1.23456e-7
TICKS = """
ticks AS (SELECT user_id AS asset, event_id % 4 AS venue, epoch_us(ts) // 1000 AS ts_ms, event_id AS id, CASE WHEN event_type = 'view' AND value > 0 THEN value END AS bid, CASE WHEN event_type = 'click' AND value > 0 THEN value END AS ask,
  CASE WHEN event_type = 'purchase' AND value > 0 THEN value END AS last, CASE WHEN event_type = 'signup' AND value > 0 THEN value END AS volume, CASE WHEN event_type = 'error' AND value > 0 THEN value END AS mark FROM events),
quotes AS (SELECT asset, venue, """ + ", ".join(f"arg_max({f}, (ts_ms, id)) FILTER ({f} IS NOT NULL) AS {f}" for f in live.FIELDS) + """,
  max(ts_ms) FILTER (bid IS NOT NULL OR ask IS NOT NULL OR last IS NOT NULL) AS price_ms, max(ts_ms) AS seen_ms FROM ticks GROUP BY asset, venue)"""
_AGE = f"({NOW} - price_ms) / 1000.0"
JUDGED = TICKS + f""",
c0 AS (SELECT *, coalesce(bid <= ask AND (ask - bid) / ((bid + ask) / 2) * 10000 <= 100, false) AS use_mid, {_AGE} AS age_s FROM quotes),
c1 AS (SELECT *, CASE WHEN use_mid THEN (bid + ask) / 2 ELSE last END AS price FROM c0),
c2 AS (SELECT *, CASE WHEN price IS NULL THEN 'missing_price' WHEN age_s > {STALE} THEN 'stale' END AS early FROM c1),
c3 AS (SELECT *, CASE WHEN early IS NULL THEN greatest(CASE WHEN volume > 0 THEN sqrt(volume) ELSE 0 END, 0.001) * greatest(0.25::DOUBLE, 1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, greatest(age_s, 0) / {STALE})) * (CASE WHEN use_mid THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END) END AS weight FROM c2),
cm AS ({V.median_sql('c3', 'asset', 'price', 'weight', 'centre')}),
cn AS (SELECT asset, count(weight) AS n FROM c3 GROUP BY asset),
j AS (SELECT c3.*, coalesce(early, CASE WHEN n >= 3 AND abs((price - centre) / centre * 10000) > 300 THEN 'outlier' END) AS reason FROM c3 LEFT JOIN cm USING (asset) LEFT JOIN cn USING (asset))"""


def _quotes(spark, sf_dir):
    return live.merged(live.ticks_of(V.table(spark, sf_dir, "events")))


_MERGED = "SELECT asset, venue, round(bid, 6) AS bid, round(ask, 6) AS ask, round(last, 6) AS last, round(volume, 6) AS volume, round(mark, 6) AS mark, price_ms FROM quotes"


def _rounded(q):
    return q.select("asset", "venue", *[r(f).alias(f) for f in live.FIELDS], "price_ms")


@query(f"WITH {TICKS} {_MERGED}")
def live_merge_latest(spark, sf_dir):
    return _rounded(_quotes(spark, sf_dir))


@query(f"WITH {TICKS} {_MERGED}")
def stream_merge_latest(spark, sf_dir):
    """The same state from a stream over the files."""
    return _rounded(live.replayed(live.merged(live.ticks_of(live.event_stream(spark, sf_dir))), _place(spark), ["asset", "venue"]))


@query(f"WITH {JUDGED} SELECT asset, venue, reason FROM j")
def live_outlier_rejection(spark, sf_dir):
    return live.judged(_quotes(spark, sf_dir), F.lit(NOW), STALE).select("asset", "venue", "reason")


@query(f"WITH {JUDGED} SELECT coalesce(reason, 'included') AS reason, count(*) AS n FROM j GROUP BY 1")
def live_expiry(spark, sf_dir):
    return live.judged(_quotes(spark, sf_dir), F.lit(NOW), STALE).groupBy(F.coalesce("reason", F.lit("included")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {JUDGED}, l AS (SELECT asset, list(price ORDER BY price, weight) AS ps, list(weight ORDER BY price, weight) AS ws FROM j WHERE reason IS NULL GROUP BY asset), k AS (SELECT asset, unnest(ps) AS price, unnest({V.cap_sql('ws')}) AS weight FROM l), m AS ({V.median_sql('k', 'asset', 'price', 'weight', 'live_price')}) SELECT asset, round(live_price, 6) AS live_price, len(ps) AS venues FROM l JOIN m USING (asset)")
def live_price_replay(spark, sf_dir):
    return live.prices(_quotes(spark, sf_dir), F.lit(NOW), STALE).select("asset", r("live_price").alias("live_price"), "venues")


@query("WITH s AS (SELECT user_id AS asset, epoch_us(ts) // 1000 AS ts_ms, max(floor(value / 50)) AS price, count(*) AS venues FROM events GROUP BY 1, 2), b AS (SELECT *, lag(ts_ms) OVER o AS t, lag(price) OVER o AS p, lag(venues) OVER o AS v FROM s WINDOW o AS (PARTITION BY asset ORDER BY ts_ms)) SELECT asset, ts_ms, price, venues FROM b WHERE t IS NULL OR price IS DISTINCT FROM p OR venues <> v OR ts_ms - t >= 10000")
def live_emit_changes(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    s = e.groupBy(F.col("user_id").alias("asset"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")).agg(F.max(F.floor(F.col("value") / 50)).cast("double").alias("price"), F.count("*").alias("venues"))
    return live.announced(s)


@query(f"WITH {TICKS} SELECT asset, venue, max(id) AS id FROM ticks GROUP BY asset, venue")
def live_conflation(spark, sf_dir):
    return live.conflated(live.ticks_of(V.table(spark, sf_dir, "events")), ["asset", "venue"]).select("asset", "venue", "id")


def _place(spark) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/streams/{uuid.uuid4().hex}"


@query("SELECT time_bucket(INTERVAL '15 minutes', ts) AS slot, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling_15m(spark, sf_dir):
    """Counts per 15-minute window with a watermark, from a stream in update mode, late rows dropped by the watermark."""
    e = live.event_stream(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp")).withWatermark("t", "1 hour")
    w = e.groupBy(F.window("t", "15 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return live.replayed(w, _place(spark), ["w", "event_type"]).select(F.col("w.start").cast("timestamp_ntz").alias("slot"), "event_type", "n", r("total", 4).alias("total"))


# --- prices in USD over several markets of a venue

_BOOKS = f"""
tk AS (SELECT user_id AS asset, event_id % 4 AS venue, 'm' || (event_id % 3) AS symbol, ['USD', 'USDT', 'XYZ'][1 + event_id % 3] AS quote, epoch_us(ts) // 1000 AS ts_ms, event_id AS id, CASE WHEN event_type IN ('view', 'error') AND value > 0 THEN value END AS bid, CASE WHEN event_type IN ('click', 'error') AND value > 0 THEN value * 1.004 END AS ask, CASE WHEN event_type = 'purchase' AND value > 0 THEN value END AS last,
  CASE WHEN event_type = 'signup' AND event_id % 2 = 0 AND value > 0 THEN value * 9 END AS quote_volume, CASE WHEN event_type IN ('signup', 'purchase') AND event_id % 2 = 1 AND value > 0 THEN value END AS base_volume FROM events),
pr AS (SELECT quote, arg_max(rate, (ts_ms, id)) AS rate FROM (SELECT 'USDT' AS quote, epoch_us(ts) // 1000 AS ts_ms, event_id AS id, CASE WHEN event_id % 4 = 0 THEN 0.97 + (value % 7) / 100 ELSE 1 + (value % 5 - 2) / 10000 END AS rate FROM events WHERE event_type = 'view') WHERE abs(rate - 1) * 10000 <= 500 GROUP BY quote UNION ALL SELECT 'USD', 1.0),
fe AS (SELECT unnest([0, 1, 2]) AS venue, unnest([true, true, false]) AS connected, unnest([0, 0, {NOW} - 5000]) AS changed_ms),
qu AS (SELECT asset, venue, symbol, quote, {', '.join(f'arg_max({f}, (ts_ms, id)) FILTER ({f} IS NOT NULL) AS {f}' for f in ('bid', 'ask', 'last', 'quote_volume', 'base_volume'))}, max(ts_ms) FILTER (bid IS NOT NULL OR ask IS NOT NULL OR last IS NOT NULL) AS price_ms FROM tk GROUP BY ALL),
ca0 AS (SELECT *, coalesce(bid <= ask AND (ask - bid) / ((bid + ask) / 2) * 10000 <= 100, false) AS m FROM qu),
ca1 AS (SELECT c.*, CASE WHEN m THEN 'mid' WHEN last IS NOT NULL THEN 'last' END AS source, (CASE WHEN m THEN (bid + ask) / 2 ELSE last END) * rate AS price_usd, rate, connected, changed_ms FROM ca0 AS c LEFT JOIN pr USING (quote) LEFT JOIN fe USING (venue)),
ca2 AS (SELECT *, coalesce(quote_volume * rate, base_volume * price_usd) AS volume_usd, greatest(0, ({NOW} - price_ms) / 1000.0) AS age_s, CASE WHEN price_usd IS NULL OR price_ms IS NULL THEN 'unusable' WHEN NOT coalesce(connected OR {NOW} - changed_ms <= 20000, false) THEN 'feed_disconnected' WHEN greatest(0, ({NOW} - price_ms) / 1000.0) > {STALE} THEN 'stale' END AS early FROM ca1)"""


def _live_ticks(spark, sf_dir):
    e, k, kind, v = V.table(spark, sf_dir, "events"), F.col("event_id"), F.col("event_type"), F.col("value")
    sound = lambda test, value: F.when(test & (v > 0), value)
    return e.select(
        F.col("user_id").alias("asset"), (k % 4).alias("venue"), F.concat(F.lit("m"), k % 3).alias("symbol"), F.element_at(F.array(*map(F.lit, ("USD", "USDT", "XYZ"))), (1 + k % 3).cast("int")).alias("quote"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), k.alias("id"),
        sound(kind.isin("view", "error"), v).alias("bid"), sound(kind.isin("click", "error"), v * 1.004).alias("ask"), sound(kind == "purchase", v).alias("last"), sound((kind == "signup") & (k % 2 == 0), v * 9).alias("quote_volume"), sound(kind.isin("signup", "purchase") & (k % 2 == 1), v).alias("base_volume"),
    )


def _rates(spark, sf_dir):
    e, k, v = V.table(spark, sf_dir, "events").filter("event_type = 'view'"), F.col("event_id"), F.col("value")
    last = F.when(k % 4 == 0, 0.97 + (v % 7) / 100).otherwise(1 + (v % 5 - 2) / 10000)
    ticks = e.select(F.lit("USDT").alias("quote"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), k.alias("id"), F.lit(None).cast("double").alias("bid"), F.lit(None).cast("double").alias("ask"), last.alias("last"))
    return live.probed_rates(ticks).union(spark.createDataFrame([("USD", 1.0)], "quote string, rate double"))


def _feeds(spark):
    return spark.createDataFrame([(0, True, 0), (1, True, 0), (2, False, NOW - 5000)], "venue long, connected boolean, changed_ms long")


def _found(spark, sf_dir):
    quotes = live.merged(_live_ticks(spark, sf_dir), ("asset", "venue", "symbol", "quote"), ("bid", "ask", "last", "quote_volume", "base_volume"))
    return live.usd_candidates(quotes, _rates(spark, sf_dir), _feeds(spark), F.lit(NOW), STALE)


@query(f"WITH {_BOOKS} SELECT quote, round(rate, 8) AS rate FROM pr")
def live_stablecoin_rates(spark, sf_dir):
    return _rates(spark, sf_dir).select("quote", r("rate", 8).alias("rate"))


@query(f"WITH {_BOOKS} SELECT asset, venue, symbol, source, round(price_usd + {OFF}, 4) AS price_usd, round(volume_usd + {OFF}, 4) AS volume_usd, early FROM ca2")
def live_usd_candidates(spark, sf_dir):
    return _found(spark, sf_dir).select("asset", "venue", "symbol", "source", r(F.col("price_usd") + OFF, 4).alias("price_usd"), r(F.col("volume_usd") + OFF, 4).alias("volume_usd"), "early")


_BEST = _BOOKS + """,
be AS (SELECT * FROM ca2 WHERE early IS NULL QUALIFY coalesce(volume_usd, 0) = max(coalesce(volume_usd, 0)) OVER (PARTITION BY asset, venue))"""


@query(f"WITH {_BEST} SELECT asset, venue, count(*) = 1 AS alone, round(max(coalesce(volume_usd, 0)) + {OFF}, 4) AS volume FROM be GROUP BY asset, venue")
def live_one_per_venue(spark, sf_dir):
    """A venue's market with the largest volume; `alone` where no other has as much."""
    found = _found(spark, sf_dir)
    best = live.one_per_venue(found).select("asset", "venue", F.coalesce("volume_usd", F.lit(0.0)).alias("v"))
    same = found.filter("early is null").select("asset", "venue", F.coalesce("volume_usd", F.lit(0.0)).alias("w")).join(best, ["asset", "venue"]).filter("w = v").groupBy("asset", "venue").agg(F.count("*").alias("n"))
    return best.join(same, ["asset", "venue"]).select("asset", "venue", (F.col("n") == 1).alias("alone"), r(F.col("v") + OFF, 4).alias("volume"))


_STATES = _BOOKS + f""",
oz AS (SELECT asset, venue, unnest(arg_max(struct_pack(price_usd := price_usd, volume_usd := volume_usd, source := source, age_s := age_s), (coalesce(volume_usd, 0), symbol))) FROM (SELECT *, count(*) OVER (PARTITION BY asset, venue, coalesce(volume_usd, 0)) AS same FROM ca2 WHERE early IS NULL) GROUP BY asset, venue),
ow AS (SELECT *, greatest(CASE WHEN volume_usd > 0 THEN sqrt(volume_usd) ELSE 0 END, 0.001) * greatest(0.25::DOUBLE, 1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, age_s / {STALE})) * (CASE source WHEN 'mid' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END) AS w, count(*) OVER (PARTITION BY asset) AS n FROM oz),
oc AS ({V.median_sql('ow', 'asset', 'price_usd', 'w', 'centre')}),
ok AS (SELECT ow.* FROM ow JOIN oc USING (asset) WHERE NOT (n >= 3 AND abs((price_usd - centre) / centre * 10000) > 300)),
ol AS (SELECT asset, list(price_usd ORDER BY price_usd, w) AS ps, list(w ORDER BY price_usd, w) AS ws, sum(volume_usd) AS volume, max(n) AS n FROM ok GROUP BY asset),
oo AS (SELECT asset, unnest(ps) AS x, unnest({V.cap_sql('ws')}) AS w FROM ol), om AS ({V.median_sql('oo', 'asset', 'x', 'w', 'price')}),
od AS (SELECT asset, abs(x - price) AS d, w FROM oo JOIN om USING (asset)), oe AS ({V.median_sql('od', 'asset', 'd', 'w', 'mad')}),
og AS (SELECT asset, count(*) AS gone FROM ca2 WHERE early IN ('feed_disconnected', 'stale') GROUP BY asset),
li AS (SELECT asset, price, CASE WHEN len(ps) > 1 THEN 'robust_weighted_median' ELSE 'single_venue' END AS method, len(ps) AS used, n + coalesce(gone, 0) AS seen, CASE WHEN len(ps) >= 2 THEN mad / price * 10000 END AS dispersion, volume, (price - (40 + asset % 20)) / (40 + asset % 20) * 10000 AS vs FROM ol JOIN om USING (asset) LEFT JOIN oe USING (asset) LEFT JOIN og USING (asset))"""


def _states(spark, sf_dir):
    published = V.table(spark, sf_dir, "events").select(F.col("user_id").alias("asset")).distinct().withColumn("published", (40 + F.col("asset") % 20).cast("double"))
    return live.live_states(_found(spark, sf_dir), published, STALE)


@query(f"WITH {_STATES} SELECT asset, round(price + {OFF}, 4) AS price, method, used AS venues_used, seen AS venues_seen, round(dispersion, 4) AS dispersion_bps, round(volume + {OFF}, 4) AS volume, round(vs, 4) AS vs_generation_bps FROM li")
def live_states(spark, sf_dir):
    s = _states(spark, sf_dir)
    return s.select("asset", r(F.col("price") + OFF, 4).alias("price"), "method", "venues_used", "venues_seen", r("dispersion_bps", 4).alias("dispersion_bps"), r(F.col("volume_24h_usd") + OFF, 4).alias("volume"), r("vs_generation_bps", 4).alias("vs_generation_bps"))


#: Ids of a block in which assets are numbered.
_BLOCK = 100_000


@query(f"WITH {_STATES} SELECT rank, symbol, round(price + {OFF}, 4) AS price FROM (SELECT *, 's' || asset AS symbol, row_number() OVER (ORDER BY asset % 7, asset) AS rank FROM (SELECT DISTINCT user_id AS asset FROM events)) JOIN li USING (asset) WHERE asset IN (SELECT user_id FROM events WHERE event_type = 'signup') ORDER BY rank LIMIT 40")
def live_snapshot(spark, sf_dir):
    """The first assets by rank, of those whose symbols are asked for: here by all who signed up."""
    e = V.table(spark, sf_dir, "events")
    followed = e.select(F.col("user_id").alias("asset")).distinct().withColumns({"k": F.col("asset") % 7, "block": F.floor(F.col("asset") / _BLOCK)})
    # assets are numbered within blocks of them; one task adds up how many the blocks before have
    before = Window.orderBy("k", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = followed.groupBy("k", "block").agg(F.count("*").alias("n")).select("k", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = followed.withColumn("row", F.row_number().over(Window.partitionBy("k", "block").orderBy("asset")))
    universe = numbered.join(blocks, ["k", "block"]).select("asset", (F.col("before") + F.col("row")).alias("rank"), F.concat(F.lit("s"), "asset").alias("symbol"))
    asked = e.filter("event_type = 'signup'").select(F.concat(F.lit("S"), "user_id").alias("symbol")).distinct()
    return live.snapshot(_states(spark, sf_dir), universe, asked, 40).select(F.col("rank").cast("long").alias("rank"), "symbol", r(F.col("price") + OFF, 4).alias("price"))


# --- the book as a running stream

_T0, _T1, _T2 = 1_703_980_800_000, 1_704_931_200_000, 1_705_795_200_000  # listings of the universe; the events begin after the first
_STALE_MS = int(STALE * 1000)
_ODD = "(asset % 4 = 1 OR (venue = 1 AND symbol = 'm2'))"  # markets that the second listing lacks
_STREAMED = _BOOKS[: _BOOKS.index("fe AS (")] + f"""
sb AS (SELECT unnest([0, 1, 2]) AS step, unnest([{_T0}, {_T1}, {_T2}]) AS since, unnest([{_T1}, {_T2}, 9999999999999]) AS until),
sq AS (SELECT step, asset, venue, symbol, quote, {', '.join(f'arg_max({f}, (ts_ms, id)) FILTER ({f} IS NOT NULL) AS {f}' for f in ('bid', 'ask', 'last', 'quote_volume', 'base_volume'))}, max(ts_ms) FILTER (bid IS NOT NULL OR ask IS NOT NULL OR last IS NOT NULL) AS price_ms
  FROM tk JOIN sb ON ts_ms < until WHERE NOT {_ODD} OR step = 0 OR (step = 2 AND ts_ms >= {_T2}) GROUP BY ALL),
sl AS (SELECT step, asset, greatest(max(since), coalesce(max(ts_ms) FILTER (ts_ms >= since AND ts_ms < until), 0)) AS looked FROM tk, sb GROUP BY step, asset),
sm AS (SELECT q.*, rate, venue <> 3 AS connected, looked, coalesce(bid <= ask AND (ask - bid) / ((bid + ask) / 2) * 10000 <= 100, false) AS m FROM sq AS q JOIN sl USING (step, asset) LEFT JOIN pr USING (quote)),
sp AS (SELECT *, (CASE WHEN m THEN (bid + ask) / 2 ELSE last END) * rate AS price_usd, CASE WHEN m THEN 'mid' ELSE 'last' END AS source FROM sm),
ev AS (SELECT DISTINCT asset FROM sp WHERE price_usd IS NOT NULL AND price_ms IS NOT NULL AND connected AND looked - price_ms <= {_STALE_MS}),
te AS (SELECT asset, CASE WHEN min(price_ms + {_STALE_MS} + 1) FILTER (connected AND looked <= price_ms + {_STALE_MS}) <= (SELECT max(ts_ms) FROM tk) THEN (SELECT max(ts_ms) FROM tk) ELSE max(looked) END AS now FROM sp WHERE step = 2 GROUP BY asset),
ca2 AS (SELECT sp.*, coalesce(quote_volume * rate, base_volume * price_usd) AS volume_usd, greatest(0, (now - price_ms) / 1000.0) AS age_s, CASE WHEN price_usd IS NULL OR price_ms IS NULL THEN 'unusable' WHEN NOT connected THEN 'feed_disconnected' WHEN now - price_ms > {_STALE_MS} THEN 'stale' END AS early FROM sp JOIN te USING (asset) WHERE step = 2)""" + _STATES[len(_BOOKS):]  # fmt: skip


@query(f"WITH {_STREAMED} SELECT asset::VARCHAR AS asset, round(price + {OFF}, 4) AS price, coalesce(used, 0) AS venues_used FROM ev LEFT JOIN li USING (asset)")
def stream_live_book(spark, sf_dir):
    """What a running stream last told of each asset: quotes merge and expire by timers while two refreshes of the universe drop markets and take them up again, without what was known of them."""
    ticks, rates = _live_ticks(spark, sf_dir), _rates(spark, sf_dir).select(F.col("quote").alias("r_quote"), "rate")
    markets = ticks.select("asset", "venue", "symbol", "quote").distinct().join(rates, F.col("quote") == F.col("r_quote"), "left").withColumn("connected", F.col("venue") != 3).withColumns({"asset": F.col("asset").cast("string"), "venue_text": F.col("venue").cast("string")})
    listed = markets.select("asset", F.col("venue_text").alias("venue"), "symbol", "quote", "rate", "connected")
    fewer = listed.filter("not (cast(asset as long) % 4 = 1 or (venue = '1' and symbol = 'm2'))")
    changes = [book.listing_changes(None, listed, 1, _T0), book.listing_changes(listed, fewer, 2, _T1), book.listing_changes(fewer, listed, 3, _T2)]
    rows = book.tick_rows(ticks)
    parts = [rows.filter(F.col("ts_ms") < _T1), rows.filter((F.col("ts_ms") >= _T1) & (F.col("ts_ms") < _T2)), rows.filter(F.col("ts_ms") >= _T2)]
    told = book.told_in_steps([p.unionByName(c) for p, c in zip(parts, changes)], _place(spark), book.Pace(_STALE_MS, 0, None))
    return book.latest_told(told).select("asset", r(F.col("price") + OFF, 4).alias("price"), F.col("venues_used").cast("long").alias("venues_used"))


_PERPS = _STATES + f""",
pq AS (SELECT user_id AS asset, event_id % 4 AS venue, 'p' || (event_id % 2) AS symbol, ['USDT', 'XYZ'][1 + event_id % 2] AS quote, arg_max(value, (ts, event_id)) FILTER (event_type = 'view' AND value > 0) AS mark, arg_max(value, (ts, event_id)) FILTER (event_type = 'click' AND value > 0) AS last, arg_max(value / 1000000, (ts, event_id)) FILTER (event_type = 'purchase') AS rate_raw, arg_max(CASE WHEN event_id % 3 = 0 THEN 4.0 ELSE 8.0 END, (ts, event_id)) FILTER (event_type = 'signup') AS hours,
  arg_max(value * 100, (ts, event_id)) FILTER (event_type = 'error' AND value > 0) AS oi, max(epoch_us(ts) // 1000) AS price_ms FROM events GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {_PERPS} SELECT pq.asset, venue, symbol, round(mark, 6) AS mark, round(rate_raw * 8 / hours, 10) AS funding_8h, round(oi, 4) AS open_interest_usd, round((coalesce(mark, last) * coalesce(rate, 1) - price) / price * 10000, 4) AS basis_bps FROM pq JOIN li USING (asset) LEFT JOIN pr USING (quote) WHERE {NOW} - price_ms <= {STALE} * 1000")
def live_perps(spark, sf_dir):
    e, k, kind, v = V.table(spark, sf_dir, "events"), F.col("event_id"), F.col("event_type"), F.col("value")
    sound = lambda name, value: F.when((kind == name) & (v > 0), value)
    ticks = e.select(F.col("user_id").alias("asset"), (k % 4).alias("venue"), F.concat(F.lit("p"), k % 2).alias("symbol"), F.when(k % 2 == 0, "USDT").otherwise("XYZ").alias("quote"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), k.alias("id"), v.alias("bid"), F.lit(None).cast("double").alias("ask"),
        sound("view", v).alias("mark"), sound("click", v).alias("last"), F.when(kind == "purchase", v / 1_000_000).alias("funding_rate"), F.when(kind == "signup", F.when(k % 3 == 0, 4.0).otherwise(8.0)).alias("funding_interval_hours"), sound("error", v * 100).alias("open_interest_usd"))
    quotes = live.merged(ticks, ("asset", "venue", "symbol", "quote"), ("bid", "ask", "mark", "last", "funding_rate", "funding_interval_hours", "open_interest_usd"))
    p = live.perps(quotes.withColumn("price_ms", F.col("seen_ms")), _states(spark, sf_dir), _rates(spark, sf_dir), F.lit(NOW), STALE)
    return p.select("asset", "venue", "symbol", r("mark").alias("mark"), r("funding_8h", 10).alias("funding_8h"), r("open_interest_usd", 4).alias("open_interest_usd"), r("basis_bps", 4).alias("basis_bps"))


@query("WITH s AS (SELECT user_id AS asset, epoch_us(ts) // 1000 AS ts_ms, max(floor(value / 50)) AS price, count(*) AS venues FROM events GROUP BY 1, 2), k AS (SELECT asset, ts_ms // 60000000 AS step, unnest(arg_max(struct_pack(ts_ms := ts_ms, price := price, venues := venues), ts_ms)) FROM s GROUP BY 1, 2), b AS (SELECT *, lag(ts_ms) OVER o AS t, lag(price) OVER o AS p, lag(venues) OVER o AS v FROM k WINDOW o AS (PARTITION BY asset ORDER BY ts_ms)) SELECT asset, ts_ms, price, venues FROM b WHERE t IS NULL OR price IS DISTINCT FROM p OR venues <> v OR ts_ms - t >= 10000")
def live_emit_cadence(spark, sf_dir):
    """What is told when states are looked at once in a while, here every 60,000 s."""
    e = V.table(spark, sf_dir, "events")
    s = e.groupBy(F.col("user_id").alias("asset"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")).agg(F.max(F.floor(F.col("value") / 50)).cast("double").alias("price"), F.count("*").alias("venues"))
    return live.emitted(s, 60_000_000)


@query(f"WITH {TICKS} SELECT asset, venue, price_ms FROM quotes WHERE asset % 4 <> 1")
def live_universe_refresh(spark, sf_dir):
    """The state that is left when a quarter of the assets is no longer followed."""
    q = _quotes(spark, sf_dir)
    return live.kept_quotes(q, q.select("asset").distinct().filter("asset % 4 <> 1")).select("asset", "venue", "price_ms")


@query(f"WITH {TICKS}, t AS (SELECT venue, count(*) AS n, max(ts_ms) AS last_ms FROM ticks GROUP BY venue), f AS (SELECT unnest([0, 1, 2, 3, 9])::BIGINT AS venue, unnest([true, false, true, true, true]) AS connected), m AS (SELECT event_id % 4 AS venue, count(*) AS malformed FROM events WHERE event_type = 'error' GROUP BY 1) SELECT venue, connected, coalesce(n, 0) AS ticks, coalesce(malformed, 0) AS malformed, ({NOW} - last_ms) / 1000.0 AS age_s, CASE WHEN NOT connected THEN 'disconnected' WHEN last_ms IS NULL THEN 'silent' WHEN ({NOW} - last_ms) / 1000.0 > {STALE} THEN 'stale' ELSE 'ok' END AS health FROM f LEFT JOIN t USING (venue) LEFT JOIN m USING (venue)")
def live_feed_health(spark, sf_dir):
    feeds = spark.createDataFrame([(0, True), (1, False), (2, True), (3, True), (9, True)], "venue long, connected boolean")
    faults = V.table(spark, sf_dir, "events").filter("event_type = 'error'").groupBy((F.col("event_id") % 4).alias("venue")).agg(F.count("*").alias("malformed"))
    return live.feed_health(live.ticks_of(V.table(spark, sf_dir, "events")), feeds, faults, F.lit(NOW), STALE)


# --- frames


def _frame(feed, values: dict):
    """A frame with one row, as the venue would send it; values are columns by tick name."""
    row = {feed.symbol: values["symbol"]} | {key: values[name] for name, key in feed.fields.items()}
    if feed.event_in_row:
        row[feed.event] = F.date_format(F.timestamp_millis(values["event_ms"]), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") if feed.event_iso else values["event_ms"]
    for path, want in feed.tests.items():
        if path.count(".") == 1 and feed.rows == "$":
            row[path[2:]] = F.lit(want.replace("*", "X"))
    body = F.to_json(F.struct(*[c.alias(k) for k, c in row.items()]))
    parts = feed.rows.split(".")[1:]
    listed = feed.name in ("binance", "okx", "bitget", "cryptocom")
    out = F.concat(F.lit("["), body, F.lit("]")) if listed else body
    outer: dict = {}
    for path, want in feed.tests.items():
        at = outer
        *way, last = path.split(".")[1:]
        for step in way:
            at = at.setdefault(step, {})
        at[last] = want.replace("*", "X")
    if feed.event and not feed.event_in_row:
        outer[feed.event[2:]] = "TIME"
    if parts:
        at = outer
        for step in parts[:-1]:
            at = at.setdefault(step, {})
        at[parts[-1]] = "ROWS"
        text = json.dumps(outer).replace('"TIME"', "%2$s").replace('"ROWS"', "%1$s")
        out = F.format_string(text.replace("%1$s", "%%1$s").replace("%2$s", "%%2$s").replace("%%", "%"), out, values["event_ms"].cast("string"))
    return out


_FEED_SQL = "CASE event_id % 9 " + " ".join(f"WHEN {k} THEN '{f.name}'" for k, f in enumerate(frames.FEEDS)) + " END"


def _told(name: str, value: str) -> str:
    has = [f"'{f.name}'" for f in frames.FEEDS if name in f.fields]
    return f"CASE WHEN feed IN ({', '.join(has)}) THEN {value} END" if has else "NULL::DOUBLE"


_VALUES = {"last": "value", "bid": "value - 60", "ask": "value + 1", "mark": "value * 2", "index": "value * 3", "quote_volume_24h": "value * 10", "base_volume_24h": "value - 40", "open_interest_usd": "value * 100"}


def _frame_values():
    v = F.col("value")
    return {"symbol": F.concat(F.lit("S"), "user_id"), "event_ms": F.unix_millis(F.col("ts").cast("timestamp")), "last": v, "bid": v - 60, "ask": v + 1, "mark": v * 2, "index": v * 3, "quote_volume_24h": v * 10, "base_volume_24h": v - 40, "open_interest_usd": v * 100, "funding_rate": (v - 50) / 1000, "funding_interval_hours": F.lit(4.0)}


_FRAMES_SQL = f"""WITH f AS (SELECT *, {_FEED_SQL} AS feed FROM events WHERE event_type <> 'error')
SELECT event_id AS received_ms, feed, 'S' || user_id AS symbol, epoch_us(ts) // 1000 AS event_ms, {', '.join(f'round({_told(n, f"CASE WHEN {v} > 0 THEN {v} END")}, 6) AS {n}' for n, v in _VALUES.items())}, round({_told('funding_rate', '(value - 50) / 1000')}, 9) AS funding_rate, CASE WHEN feed = 'deribit' THEN 8.0::DOUBLE WHEN feed = 'bybit_linear' THEN 4.0::DOUBLE END AS funding_interval_hours FROM f"""


@query(_FRAMES_SQL)
def feed_frames(spark, sf_dir):
    """Frames of all nine feeds, with some of another kind among them, as ticks."""
    e, values = V.table(spark, sf_dir, "events"), _frame_values()
    out = None
    for k, feed in enumerate(frames.FEEDS):
        other = F.when(F.col("event_id") % 2 == 0, F.lit('{"method": "something else", "channel": "x", "topic": "y"}')).otherwise(F.lit("pong"))
        own = e.filter(F.col("event_id") % 9 == k).select(F.col("event_id").alias("received_ms"), F.when(F.col("event_type") == "error", other).otherwise(_frame(feed, values)).alias("frame"))
        t = frames.ticks(own, feed).withColumn("feed", F.lit(feed.name))
        out = t if out is None else out.unionByName(t)
    return out.select("received_ms", "feed", "symbol", "event_ms", *[r(n).alias(n) for n in _VALUES], r("funding_rate", 9).alias("funding_rate"), "funding_interval_hours")


@query(f"SELECT {_FEED_SQL} AS feed, count(*) FILTER (event_id % 2 = 1 AND NOT ({_FEED_SQL} IN ('okx', 'bitget') AND event_id % 4 = 1)) AS malformed FROM events GROUP BY 1")
def feed_malformed_frames(spark, sf_dir):
    """How many frames of each feed are no JSON; keep-alive texts are no fault where the venue sends them."""
    e = V.table(spark, sf_dir, "events")
    out = None
    for k, feed in enumerate(frames.FEEDS):
        own = e.filter(F.col("event_id") % 9 == k).select(F.when(F.col("event_id") % 2 == 0, F.lit("{}")).when(F.col("event_id") % 4 == 1, F.lit("pong")).otherwise(F.lit("{broken")).alias("frame"))
        n = own.select(F.lit(feed.name).alias("feed")).distinct().join(frames.malformed(own, feed).agg(F.count("*").alias("malformed")))
        out = n if out is None else out.unionByName(n)
    return out


# --- captured frames


def _capture(spark, sf_dir) -> str:
    """Capture files as collectors leave them: frames of all nine feeds, and for events of errors what venues send besides: other channels, keep-alives, odd shapes, cut frames."""
    e, k, folder = V.table(spark, sf_dir, "events"), F.col("event_id"), f"{_place(spark)}/capture"
    odd = F.when(k % 4 == 0, F.lit('{"method": "something else", "channel": "x", "topic": "y"}')).when(k % 4 == 1, "pong").when(k % 4 == 2, "[1, 2]").otherwise("{broken")
    feed, frame = F.lit(None), F.lit(None)
    for n, f in enumerate(frames.FEEDS):
        feed, frame = F.when(k % 9 == n, f.name).otherwise(feed), F.when(k % 9 == n, _frame(f, _frame_values())).otherwise(frame)
    line = F.struct(feed.alias("feed"), k.alias("received_ms"), F.when(F.col("event_type") == "error", odd).otherwise(frame).alias("frame"))
    e.select(F.to_json(line).alias("value")).write.text(folder)
    return folder


@query(_FRAMES_SQL)
def stream_captured_frames(spark, sf_dir):
    """Ticks from a stream over capture files."""
    place, found = _place(spark), capture.ticks(capture.captured(spark, _capture(spark, sf_dir), stream=True))
    run = found.writeStream.format("parquet").option("path", f"{place}/ticks").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    t = spark.read.schema(found.schema).parquet(f"{place}/ticks")
    return t.select("received_ms", "feed", "symbol", "event_ms", *[r(n).alias(n) for n in _VALUES], r("funding_rate", 9).alias("funding_rate"), "funding_interval_hours")


@query(f"""WITH f AS (SELECT {_FEED_SQL} AS feed, event_id % 4 AS k FROM events WHERE event_type = 'error'), j AS (SELECT feed, CASE WHEN k = 3 OR (k = 1 AND feed NOT IN ('okx', 'bitget')) THEN 'not_json' WHEN k = 2 THEN CASE WHEN feed = 'binance' THEN 'row_not_an_object' ELSE 'not_an_object' END END AS fault FROM f)
SELECT feed, fault, count(*) AS n FROM j WHERE fault IS NOT NULL GROUP BY 1, 2""")
def captured_faults(spark, sf_dir):
    """Captured frames that no parser takes, by feed and reason."""
    return capture.faults(capture.captured(spark, _capture(spark, sf_dir))).groupBy("feed", "fault").agg(F.count("*").alias("n"))
