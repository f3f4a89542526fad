"""From raw observations to accepted ones: validation, matching, conversion, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STALE_S, PARITY_BPS, DETAIL_ROWS = 1800.0, 500.0, 200


def ticker_reason(t: dict[str, Column]) -> Column:
    """The first test that an observation fails, or null. t: instrument, active, bid, ask, candidate, high, low, age_s."""
    return (
        F.when(t["instrument"].isNull(), "unresolved_instrument").when(~t["active"], "inactive_instrument")
        .when(t["bid"].isNotNull() & t["ask"].isNotNull() & t["candidate"].isNull(), "crossed_book").when(t["candidate"].isNull(), "missing_price")
        .when(t["candidate"] <= 0, "non_positive_price").when(t["high"] < t["low"], "schema_failure")
        .when(t["age_s"] > STALE_S, "stale").when(t["age_s"] < -STALE_S, "missing_timestamp")
    )


def book_reason(instrument: Column, best_bid: Column, best_ask: Column) -> Column:
    return F.when(instrument.isNull(), "unresolved_instrument").when(best_bid.isNull() | best_ask.isNull(), "schema_failure").when(best_bid >= best_ask, "crossed_book")


def best_time(event: Column, server: Column, receive: Column) -> Column:
    """The venue's time, else its server's, else ours; 0 is no time."""
    none = F.lit(0).cast("long")
    return F.coalesce(F.nullif(event, none), F.nullif(server, none), receive)


def quarantined(rows: DataFrame, reason: str, order: list[str], detail: int = DETAIL_ROWS) -> DataFrame:
    """Rows with a reason, `detail` for each; counts are exact elsewhere.

    The rows that can be among them are cut to `detail` by task and reason first, so a reason that most rows have does not meet in one task.
    """
    tasks = Window.partitionBy(reason, "_salt").orderBy(*order)
    salted = rows.filter(F.col(reason).isNotNull()).withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(64)))
    few = salted.withColumn("_r", F.row_number().over(tasks)).filter(F.col("_r") <= detail)
    return few.withColumn("_r", F.row_number().over(Window.partitionBy(reason).orderBy(*order))).filter(F.col("_r") <= detail).drop("_r", "_salt")


def conserved(rows: DataFrame, reason: str) -> DataFrame:
    """considered, accepted, quarantined, and whether the last two make the first."""
    out = rows.agg(F.count("*").alias("considered"), F.count_if(F.col(reason).isNull()).alias("accepted"), F.count(reason).alias("quarantined"))
    return out.withColumn("conserved", F.col("accepted") + F.col("quarantined") == F.col("considered"))


# What instruments can be.
TYPES, CONTRACTS, OPTIONS = ("spot", "perpetual", "future", "option"), ("linear", "inverse", "quanto"), ("call", "put")
OI_UNITS, SEMANTICS = ("base_asset", "quote_currency", "contracts", "usd", "unknown"), ("relative", "absolute", "undocumented")


def normalised_instruments(raw: DataFrame) -> DataFrame:
    """Raw instruments with what follows from their own fields, and the reason why one is refused.

    Unknown kinds of instrument, contract or option are refused, and so are fields
    that contradict each other: a perpetual with an expiry, a dated one without,
    an option without strike or direction, a spot market with a contract. A
    derivative without a known unit of open interest keeps `unknown`; funding
    semantics that nobody documents become `undocumented`.
    """
    kind, dated = F.col("instrument_type"), F.col("instrument_type").isin("future", "option")
    unknown = lambda c, values: F.col(c).isNotNull() & ~F.col(c).isin(*values)
    contradicts = ((kind == "perpetual") & F.col("expiry").isNotNull()) | (dated & F.col("expiry").isNull()) | ((kind == "option") & (F.col("strike").isNull() | F.col("option_type").isNull())) | ((kind == "spot") & F.col("contract_type").isNotNull())
    reason = F.when(kind.isNull() | ~kind.isin(*TYPES), "unknown_instrument_type").when(unknown("contract_type", CONTRACTS), "unknown_contract_type").when(unknown("option_type", OPTIONS), "unknown_option_type").when(contradicts, "model_validation")
    unit = F.when(F.col("open_interest_unit").isin(*OI_UNITS), F.col("open_interest_unit")).when(kind != "spot", "unknown")
    semantics = F.when(unknown("funding_semantics", SEMANTICS), "undocumented").otherwise(F.col("funding_semantics"))
    return raw.withColumns({
        "reason": reason, "symbol_normalized": F.concat_ws("/", F.upper("base"), F.upper("quote")), "open_interest_unit": unit, "funding_semantics": semantics,
        "settlement_period": F.when(kind == "perpetual", "perpetual").when(dated, "dated"), "missing_multiplier": (kind != "spot") & (unit == "contracts") & F.col("contract_multiplier").isNull(),
    })


def deduped_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in order; null keys count as equal."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")


def deduped_last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")


def tiered_match(obs: DataFrame, instruments: DataFrame) -> DataFrame:
    """Observations with instrument_id: of instruments with the same venue and symbol, those of the hint's exact class, else of its type, else (hint `derivative`) all but spot, else without a hint the only one there is. Below the first tier a match must be the only one.

    Instruments meet observations as one row for each venue and symbol, with how
    many there are of each class and type, so no pairs of both are made.

    obs: id, venue, symbol, hint; instruments: venue, symbol, class, type, instrument_id.
    """
    i = instruments.groupBy(F.col("venue").alias("i_venue"), F.col("symbol").alias("i_symbol"), "class", "type").agg(F.count("*").alias("n"), F.min("instrument_id").alias("m"))
    listed = i.groupBy("i_venue", "i_symbol").agg(F.collect_list(F.struct("class", "type", "n", "m")).alias("listed"))
    joined = obs.distinct().join(listed, (F.col("venue") == F.col("i_venue")) & (F.col("symbol") == F.col("i_symbol")), "left")
    hint = F.col("hint")

    def among(test):
        """How many instruments pass, and the least of them."""
        good = F.filter("listed", test)
        return F.coalesce(F.aggregate(good, F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0)), F.array_min(F.transform(good, lambda x: x["m"]))

    tests = [lambda x: x["class"] == hint, lambda x: x["type"] == hint, lambda x: (hint == "derivative") & (x["type"] != "spot"), lambda x: hint.isNull()]
    (n1, m1), *rest = [among(test) for test in tests]
    found = F.when(n1 > 0, m1)
    for n, m in rest:
        found = found.when(n > 0, F.when(n == 1, m))
    return joined.select(*obs.columns, found.alias("instrument_id"))


def best_paths(edges: DataFrame, target: str, hops: int = 3) -> DataFrame:
    """Cheapest conversion from each currency to the target: (currency, rate, hops, source, observed_at, trail: cost, venue and currency of each hop).

    edges: src, dst, rate, venue, observed_at. A stated rate costs 1000, its inverse 1050, so fewer hops always win. Of parallel edges the cheapest stays, then the first venue's.
    """
    stated = edges.filter("rate > 0").select("src", "dst", "rate", "venue", "observed_at", F.lit(1000).alias("cost"))
    inverse = edges.filter("rate > 0").select(F.col("dst").alias("src"), F.col("src").alias("dst"), (1 / F.col("rate")).alias("rate"), "venue", "observed_at", F.lit(1050).alias("cost"))
    both = deduped_first(stated.unionByName(inverse).filter("src <> dst"), ["src", "dst"], ["cost", "venue", "observed_at", "rate"])
    step = both.select(F.col("src").alias("s"), F.col("dst").alias("d"), F.col("rate").alias("r"), F.col("venue").alias("v"), F.col("observed_at").alias("o"), F.col("cost").alias("c"))
    # paths grow backwards from the target, so a hop is a join on its far end
    paths = both.filter(F.col("dst") == target).select(F.col("src").alias("currency"), "rate", F.lit(1).alias("hops"), F.col("cost").alias("total"), F.array(F.struct(F.col("cost").alias("c"), F.col("venue").alias("v"), F.col("src").alias("n"))).alias("trail"), F.col("venue").alias("source"), "observed_at")
    every = paths
    for k in range(2, hops + 1):
        grown = paths.join(step, F.col("d") == F.col("currency")).filter((F.col("s") != target) & ~F.exists("trail", lambda t: t["n"] == F.col("s")))
        paths = grown.select(F.col("s").alias("currency"), (F.col("rate") * F.col("r")).alias("rate"), F.lit(k).alias("hops"), (F.col("total") + F.col("c")).alias("total"), F.concat(F.array(F.struct("c", "v", F.col("s").alias("n"))), F.col("trail")).alias("trail"), F.col("v").alias("source"), F.least("observed_at", "o").alias("observed_at"))
        every = every.unionByName(paths)
    return every.groupBy("currency").agg(F.min_by(F.struct("rate", "hops", "source", "observed_at", "trail"), F.struct("total", "trail")).alias("b")).select("currency", "b.*")


def quote_rates(edges: DataFrame, target: str) -> DataFrame:
    """(currency, usd): what one unit of each currency is worth in the target, which is worth one."""
    spark = edges.sparkSession
    return best_paths(edges, target).select("currency", F.col("rate").alias("usd")).union(spark.createDataFrame([(target, 1.0)], "currency string, usd double"))


def conversions(edges: DataFrame, target: str, pegged: list[str]) -> DataFrame:
    """(currency, conversion): how each currency is turned into the target, as a nested value that travels along a row: rate, method, clock, first venue, path, and for pegged currencies how far they are from parity."""
    own = edges.sparkSession.range(1)
    stated = F.forall("trail", lambda t: t["c"] == 1000)
    method = F.when(F.col("hops") > 1, "chained").when(stated, "direct").otherwise("inverse")
    nested = lambda currency, rate, how, at, venue, path: F.struct(
        currency.alias("from_asset_id"), F.lit(target).alias("to_asset_id"), rate.alias("rate"), how.alias("method"), at.cast("long").alias("observed_at"), venue.cast("string").alias("source_venue_slug"), path.alias("path"),
        F.when(currency.isin(pegged), (rate - 1) * 10_000.0).alias("deviation_from_parity_bps"),
    )
    found = best_paths(edges, target).select("currency", nested(F.col("currency"), F.col("rate"), method, F.col("observed_at"), F.col("source"), F.concat(F.transform("trail", lambda t: t["n"]), F.array(F.lit(target)))).alias("conversion"))
    itself = own.select(F.lit(target).alias("currency"), nested(F.lit(target), F.lit(1.0), F.lit("identity"), F.lit(None), F.lit(None), F.array(F.lit(target))).alias("conversion"))
    return found.union(itself)


def agreed_names(symbols: DataFrame, least: int = 2) -> DataFrame:
    """(ticker, name) that so many venues agree on."""
    return symbols.groupBy("ticker", "name").agg(F.count_distinct("venue").alias("venues")).filter(F.col("venues") >= least)


def identities(symbols: DataFrame, overrides: DataFrame, fiat: list[str], native: dict[str, str], never_merge: list[str]) -> DataFrame:
    """asset_id and resolution_state of each symbol, by the first rule that applies.

    symbols: venue, ticker, name, address, chain, traded_only. overrides: o_venue (null: any), o_ticker, o_asset. Order: override, address, fiat (not if only ever traded), never merged, native ticker, name that two venues agree on, else a name of the venue's own.
    """
    agreed = agreed_names(symbols.filter("name is not null and name <> ''")).select(F.col("ticker").alias("a_ticker"), F.col("name").alias("a_name"))
    chains = F.create_map(*[F.lit(x) for pair in native.items() for x in pair]) if native else F.create_map().cast("map<string,string>")
    j = symbols.join(overrides, (F.col("ticker") == F.col("o_ticker")) & F.coalesce(F.col("o_venue") == F.col("venue"), F.lit(True)), "left").join(agreed, (F.col("ticker") == F.col("a_ticker")) & (F.col("name") == F.col("a_name")), "left")
    evm, solana = F.col("address").rlike("^0x[0-9a-fA-F]{40}$"), F.col("address").rlike("^[1-9A-HJ-NP-Za-km-z]{32,44}$")
    own = F.concat_ws(":", F.lit("asset:unresolved"), F.col("venue").cast("string"), "ticker")
    rules = [
        (F.col("o_asset").isNotNull(), F.col("o_asset"), "manual_override"), (evm, F.concat_ws(":", F.lit("asset:evm"), F.coalesce("chain", F.lit("1")), F.lower("address")), "resolved"),
        (solana, F.concat_ws(":", F.lit("asset:solana"), F.col("address")), "resolved"), (F.col("ticker").isin(fiat) & ~F.col("traded_only"), F.concat_ws(":", F.lit("asset:fiat"), F.lower("ticker")), "resolved"),
        (F.col("ticker").isin(never_merge), own, "ambiguous"), (F.element_at(chains, F.col("ticker")).isNotNull(), F.concat_ws(":", F.lit("asset:native"), F.element_at(chains, F.col("ticker")), "ticker"), "resolved"),
        (F.col("a_name").isNotNull(), F.concat_ws(":", F.lit("asset:named"), F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "ticker"), "probable"),
    ]
    asset, state = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for test, value, name in rules:
        asset, state = asset.when(test, value), state.when(test, F.lit(name))
    return j.select(*symbols.columns, asset.otherwise(own).alias("asset_id"), state.otherwise("unresolved").alias("resolution_state"))
