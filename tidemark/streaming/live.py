"""A live price per asset from partial updates: merge, candidates, expiry, outliers, price, what is announced.

Ticks: asset, venue, ts_ms, id (last tie-break), and any of bid, ask, last, volume,
mark; null means unchanged. The same expressions serve a batch replay and a
streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import bps, let
from tidemark.operators.pricing import FRESHNESS_FLOOR, SOURCE_QUALITY
from tidemark.operators.robust import cap_weights, median_of

FIELDS = ("bid", "ask", "last", "volume", "mark")
STALE_S, GRACE_S, MOST_SPREAD_BPS, MOST_OFF_BPS, MAJORITY, MOST_SHARE = 300.0, 20.0, 100.0, 300.0, 3, 0.35
HEARTBEAT_MS, PARITY_BPS, EMIT_MS = 10_000, 500.0, 500


def positive(c: Column) -> Column:
    return F.when((c > 0) & (c != float("inf")), c)


def freshness(age_s: Column, stale_s: float) -> Column:
    """1 for new quotes, falling in proportion to age down to a floor at the age of staleness."""
    return F.greatest(F.lit(FRESHNESS_FLOOR), 1.0 - (1.0 - FRESHNESS_FLOOR) * F.least(F.lit(1.0), F.greatest(age_s, F.lit(0.0)) / stale_s))


def merged(ticks: DataFrame, keys: tuple[str, ...] = ("asset", "venue"), fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The last known value of each field per key, and when a price last came. Works on streams: all aggregates keep bounded state per key, and a key per followed instrument."""
    at = F.struct("ts_ms", "id")
    latest = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields]
    priced = F.col("bid").isNotNull() | F.col("ask").isNotNull() | F.col("last").isNotNull()
    return ticks.groupBy(*keys).agg(*latest, F.max(F.when(priced, F.col("ts_ms"))).alias("price_ms"), F.max("ts_ms").alias("seen_ms"))


def candidates(quotes: DataFrame) -> DataFrame:
    """price and source of each venue: the middle of a narrow, uncrossed book, else the last trade."""
    mid = (F.col("bid") + F.col("ask")) / 2
    narrow = (F.col("bid") <= F.col("ask")) & ((F.col("ask") - F.col("bid")) / mid * 10_000.0 <= MOST_SPREAD_BPS)
    use_mid = F.coalesce(narrow, F.lit(False))
    return quotes.withColumns({"price": F.when(use_mid, mid).otherwise(F.col("last")), "source": F.when(use_mid, "mid").when(F.col("last").isNotNull(), "last")})


def judged(quotes: DataFrame, now_ms: Column, stale_s: float = STALE_S, down: Column | None = None) -> DataFrame:
    """candidates() with age_s and the reason why a venue is left out: no price, stale, feed gone, or far from a majority's middle."""
    aged = candidates(quotes).withColumn("age_s", (now_ms - F.col("price_ms")) / 1000.0)
    early = F.when(F.col("price").isNull(), "missing_price").when(F.col("age_s") > stale_s, "stale")
    if down is not None:
        early = early.when(down > GRACE_S, "feed_disconnected")
    weight = F.greatest(F.when(F.col("volume") > 0, F.sqrt("volume")).otherwise(F.lit(0.0)), F.lit(1e-3)) * freshness(F.col("age_s"), stale_s)
    weighed = aged.withColumn("early", early).withColumn("weight", F.when(F.col("early").isNull(), weight * F.when(F.col("source") == "mid", SOURCE_QUALITY["mid"]).otherwise(SOURCE_QUALITY["last"])))
    asset = Window.partitionBy("asset")
    listed = F.array_sort(F.collect_list(F.when(F.col("weight").isNotNull(), F.struct(F.col("price").alias("x"), F.col("weight").alias("w")))).over(asset))
    centred = weighed.withColumn("listed", listed).withColumn("centre", median_of(F.col("listed")))
    far = (F.size("listed") >= MAJORITY) & (F.abs(bps(F.col("price"), F.col("centre"))) > MOST_OFF_BPS)
    return centred.withColumn("reason", F.coalesce("early", F.when(far, F.lit("outlier")))).drop("listed", "early")


def prices(quotes: DataFrame, now_ms: Column, stale_s: float = STALE_S) -> DataFrame:
    """asset, live_price, venues: the capped weighted median of the venues that count."""
    kept = judged(quotes, now_ms, stale_s).filter("reason is null")
    pairs = kept.groupBy("asset").agg(F.array_sort(F.collect_list(F.struct(F.col("price").alias("x"), F.col("weight").alias("w")))).alias("pairs"))
    capped = let(F.col("pairs"), lambda ps: F.zip_with(ps, cap_weights(F.transform(ps, lambda p: p["w"]), MOST_SHARE), lambda p, s: F.struct(p["x"].alias("x"), s.alias("w"))))
    return pairs.select("asset", median_of(capped).alias("live_price"), F.size("pairs").cast("long").alias("venues"))


def announced(states: DataFrame) -> DataFrame:
    """Of states in time (asset, ts_ms, price, venues) those worth telling: the first, changed prices or venue counts, and a heartbeat."""
    order = Window.partitionBy("asset").orderBy("ts_ms")
    before = lambda c: F.lag(c).over(order)
    changed = before("ts_ms").isNull() | ~F.col("price").eqNullSafe(before("price")) | (F.col("venues") != before("venues")) | (F.col("ts_ms") - before("ts_ms") >= HEARTBEAT_MS)
    return states.withColumn("changed", changed).filter("changed").drop("changed")


def probed_rates(ticks: DataFrame, parity_bps: float = PARITY_BPS) -> DataFrame:
    """(quote, rate): what a stablecoin is worth in USD by its own market, its last tick within bounds of parity. ticks: quote, ts_ms, id, bid, ask, last."""
    price = F.when(F.col("bid") <= F.col("ask"), (F.col("bid") + F.col("ask")) / 2).otherwise(F.col("last"))
    sane = ticks.withColumn("rate", price).filter(F.abs(F.col("rate") - 1) * 10_000 <= parity_bps)
    return sane.groupBy("quote").agg(F.max_by("rate", F.struct("ts_ms", "id")).alias("rate"))


def usd_candidates(quotes: DataFrame, rates: DataFrame, feeds: DataFrame, now_ms: Column, stale_s: float = STALE_S) -> DataFrame:
    """Spot quotes as prices in USD, each with its age and the reason why it cannot count: no price, a quote without a rate, a feed that is gone or never was, or age.

    quotes: asset, venue, symbol, quote, bid, ask, last, quote_volume, base_volume,
    price_ms. rates: quote, rate. feeds: venue, connected, changed_ms.
    """
    named = rates.select(F.col("quote").alias("r_quote"), "rate")
    known = feeds.select(F.col("venue").alias("f_venue"), "connected", "changed_ms")
    j = candidates(quotes).join(named, F.col("quote") == F.col("r_quote"), "left").join(known, F.col("venue") == F.col("f_venue"), "left").drop("r_quote", "f_venue")
    j = j.withColumn("price_usd", F.col("price") * F.col("rate")).withColumn("volume_usd", F.coalesce(F.col("quote_volume") * F.col("rate"), F.col("base_volume") * F.col("price_usd")))
    up = F.coalesce(F.col("connected") | (now_ms - F.col("changed_ms") <= GRACE_S * 1000), F.lit(False))
    age = F.greatest(F.lit(0.0), (now_ms - F.col("price_ms")) / 1000.0)
    reason = F.when(F.col("price_usd").isNull() | F.col("price_ms").isNull(), "unusable").when(~up, "feed_disconnected").when(age > stale_s, "stale")
    return j.withColumns({"age_s": age, "early": reason})


def one_per_venue(found: DataFrame) -> DataFrame:
    """Of a venue's usable quotes of an asset the one with the largest volume (of equal ones the last symbol), so that a venue counts once."""
    return found.filter("early is null").groupBy("asset", "venue").agg(F.max_by(F.struct("symbol", "price_usd", "volume_usd", "source", "age_s"), F.struct(F.coalesce("volume_usd", F.lit(0.0)), "symbol")).alias("b")).select("asset", "venue", "b.*")


def live_states(found: DataFrame, generation: DataFrame, stale_s: float = STALE_S) -> DataFrame:
    """A row per asset: price, method, venues used and seen, dispersion, volume, and how far it is from the published price. found: usd_candidates(); generation: asset, published."""
    best = one_per_venue(found)
    weight = F.greatest(F.when(F.col("volume_usd") > 0, F.sqrt("volume_usd")).otherwise(F.lit(0.0)), F.lit(1e-3)) * freshness(F.col("age_s"), stale_s) * F.when(F.col("source") == "mid", SOURCE_QUALITY["mid"]).otherwise(SOURCE_QUALITY["last"])
    asset = Window.partitionBy("asset")
    pair = F.struct(F.col("price_usd").alias("x"), F.col("w").alias("w"))
    weighed = best.withColumn("w", weight).withColumns({"listed": F.array_sort(F.collect_list(pair).over(asset)), "n": F.count("*").over(asset)})
    centred = weighed.withColumn("centre", median_of(F.col("listed"))).drop("listed")
    far = (F.col("n") >= MAJORITY) & (F.abs(bps(F.col("price_usd"), F.col("centre"))) > MOST_OFF_BPS)
    kept = centred.filter(~F.coalesce(far, F.lit(False))).groupBy("asset").agg(F.array_sort(F.collect_list(pair)).alias("pairs"), F.sum("volume_usd").alias("volume_24h_usd"), F.max("n").alias("n"))
    capped = let(F.col("pairs"), lambda ps: F.zip_with(ps, cap_weights(F.transform(ps, lambda p: p["w"]), MOST_SHARE), lambda p, s: F.struct(p["x"].alias("x"), s.alias("w"))))
    priced = kept.withColumn("capped", capped).withColumn("price", median_of(F.col("capped"))).withColumn("used", F.size("pairs"))
    off = F.array_sort(F.transform("capped", lambda p: F.struct(F.abs(p["x"] - F.col("price")).alias("x"), p["w"].alias("w"))))
    rejected = found.filter(F.col("early").isin("feed_disconnected", "stale")).groupBy(F.col("asset").alias("r_asset")).agg(F.count("*").alias("gone"))
    j = priced.join(rejected, F.col("asset") == F.col("r_asset"), "left").join(generation.select(F.col("asset").alias("g_asset"), "published"), F.col("asset") == F.col("g_asset"), "left")
    return j.select("asset", "price", F.when(F.col("used") > 1, "robust_weighted_median").otherwise("single_venue").alias("method"), F.col("used").cast("long").alias("venues_used"), (F.col("n") + F.coalesce("gone", F.lit(0))).alias("venues_seen"), F.when(F.col("used") >= 2, median_of(off) / F.col("price") * 10_000).alias("dispersion_bps"), "volume_24h_usd", bps(F.col("price"), F.col("published")).alias("vs_generation_bps"))


def perps(quotes: DataFrame, states: DataFrame, rates: DataFrame, now_ms: Column, stale_s: float = STALE_S) -> DataFrame:
    """What perpetuals add: 8-hour funding, open interest, and basis of the mark (else the last price) to the live price. Quotes without a known rate are taken as USD; stale ones are left out."""
    named = rates.select(F.col("quote").alias("r_quote"), "rate")
    fresh = quotes.filter(F.col("price_ms").isNotNull() & (now_ms - F.col("price_ms") <= stale_s * 1000)).join(named, F.col("quote") == F.col("r_quote"), "left").join(states.select(F.col("asset").alias("s_asset"), F.col("price").alias("reference")), F.col("asset") == F.col("s_asset"))
    funding = F.when(F.col("funding_interval_hours") > 0, F.col("funding_rate") * 8.0 / F.col("funding_interval_hours"))
    return fresh.select("asset", "venue", "symbol", "mark", funding.alias("funding_8h"), "open_interest_usd", bps(F.coalesce("mark", "last") * F.coalesce("rate", F.lit(1.0)), F.col("reference")).alias("basis_bps"))


def emitted(states: DataFrame, every_ms: int = EMIT_MS) -> DataFrame:
    """announced(), looked at once in every_ms: of an asset's states in one step only the last is told."""
    step = F.floor(F.col("ts_ms") / every_ms)
    return announced(states.groupBy("asset", step.alias("step")).agg(F.max_by(F.struct(*[c for c in states.columns if c != "asset"]), "ts_ms").alias("s")).select("asset", "s.*"))


def kept_quotes(quotes: DataFrame, universe: DataFrame) -> DataFrame:
    """State after the universe has changed: instruments that are still in it keep theirs."""
    return quotes.join(universe.select("asset"), "asset", "left_semi")


def snapshot(states: DataFrame, universe: DataFrame, asked: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Live states by rank, of some symbols if wanted. universe: asset, symbol, rank. asked: symbol, in any case."""
    ranked = states.join(universe, "asset")
    if asked is not None:
        wanted = asked.select(F.upper("symbol").alias("a_symbol"))
        ranked = ranked.join(wanted, F.upper("symbol") == F.col("a_symbol"), "left_semi")
    ranked = ranked.orderBy("rank")
    return ranked.limit(limit) if limit else ranked


def feed_health(ticks: DataFrame, feeds: DataFrame, faults: DataFrame, now_ms: Column, stale_s: float = STALE_S) -> DataFrame:
    """By venue: whether it is connected, how many ticks and malformed frames came, how old the last tick is, and a word for it. faults: venue, malformed."""
    seen = ticks.groupBy(F.col("venue").alias("t_venue")).agg(F.count("*").alias("ticks"), F.max("ts_ms").alias("last_ms"))
    bad = faults.select(F.col("venue").alias("b_venue"), "malformed")
    j = feeds.join(seen, F.col("venue") == F.col("t_venue"), "left").join(bad, F.col("venue") == F.col("b_venue"), "left")
    age = (now_ms - F.col("last_ms")) / 1000.0
    word = F.when(~F.col("connected"), "disconnected").when(F.col("last_ms").isNull(), "silent").when(age > stale_s, "stale").otherwise("ok")
    return j.select("venue", "connected", F.coalesce("ticks", F.lit(0)).alias("ticks"), F.coalesce("malformed", F.lit(0)).alias("malformed"), age.alias("age_s"), word.alias("health"))


def conflated(updates: DataFrame, keys: list[str]) -> DataFrame:
    """At most one update per key, the latest."""
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*updates.columns), F.struct("ts_ms", "id")).alias("u")).select("u.*")


def ticks_of(events: DataFrame) -> DataFrame:
    """Ticks from the events table: each type of event brings another field."""
    of = lambda kind: positive(F.when(F.col("event_type") == kind, F.col("value")))
    return events.select(
        F.col("user_id").alias("asset"), (F.col("event_id") % 4).alias("venue"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.col("event_id").alias("id"),
        of("view").alias("bid"), of("click").alias("ask"), of("purchase").alias("last"), of("signup").alias("volume"), of("error").alias("mark"),
    )


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 8) -> DataFrame:
    """The events table as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")


def replayed(stream: DataFrame, where: str, keys: list[str]) -> DataFrame:
    """Runs a stream over what there is and gives the last row of each key.

    In update mode a micro-batch brings the keys that it changed and no others;
    they are appended with the batch's number, and the newest of a key counts. A
    batch that runs again after a failure writes the same folder again.
    """
    spark = stream.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{where}/out/part={number}")

    run = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{where}/out")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "_batch").alias("_row")).select(*keys, "_row.*")
