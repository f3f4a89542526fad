"""Venue payloads (public REST JSON) as raw tickers and derivatives: one declarative mapping per venue and product.

A payload's rows are found at a path and are objects, a map of objects, or
positional arrays. Fields are keys or positions; what a venue does not publish
stays null. Prices must be positive, volumes not negative; anything else that is
no number is null. A payload of another shape fails.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_non_negative, parse_number, parse_positive, parse_whole

POSITIVE = ("last_price", "bid_price", "ask_price", "open_24h", "high_24h", "low_24h", "mark_price", "index_price", "underlying_price")
NON_NEGATIVE = ("bid_size", "ask_size", "base_volume_24h", "quote_volume_24h", "contract_volume_24h", "open_interest_raw", "open_interest_base", "open_interest_usd")
ANY_NUMBER = ("funding_rate_raw", "funding_interval_hours", "mark_iv", "bid_iv", "ask_iv")
WHOLE = ("event_ms", "server_ms", "trade_count_24h", "next_funding_time", "previous_funding_time")


@dataclass(frozen=True)
class Feed:
    venue: str
    product: str
    path: str  # JSON path of the rows
    shape: str  # objects, map, arrays, parallel
    symbol: str | int | None  # key or position of the symbol; None for a map's own keys
    fields: dict[str, str | int | tuple] = field(default_factory=dict)  # name -> key, position, or (key, position in that key's array)
    parent: dict[str, str] = field(default_factory=dict)  # name -> path outside of the rows
    scale: dict[str, float] = field(default_factory=dict)
    constants: dict[str, object] = field(default_factory=dict)
    keep: str | None = None  # a condition on `row`


def _px(last, bid=None, ask=None, high=None, low=None, open_=None, base=None, quote=None, bid_size=None, ask_size=None, **more):
    named = {"last_price": last, "bid_price": bid, "ask_price": ask, "high_24h": high, "low_24h": low, "open_24h": open_, "base_volume_24h": base, "quote_volume_24h": quote, "bid_size": bid_size, "ask_size": ask_size}
    return {k: v for k, v in (named | more).items() if v is not None}


# Public field names of each venue's API.
FEEDS = [
    Feed("okx", "spot", "$.data", "objects", "instId", _px("last", "bidPx", "askPx", "high24h", "low24h", "open24h", "vol24h", "volCcy24h", "bidSz", "askSz", event_ms="ts")),
    Feed("okx", "swap", "$.data", "objects", "instId", _px("last", "bidPx", "askPx", "high24h", "low24h", "open24h", "volCcy24h", None, "bidSz", "askSz", contract_volume_24h="vol24h", event_ms="ts")),
    Feed("okx", "funding", "$.data", "objects", "instId", {"funding_rate_raw": "fundingRate", "previous_funding_time": "fundingTime", "next_funding_time": "nextFundingTime"}, constants={"funding_semantics": "relative"}),
    Feed("okx", "open_interest", "$.data", "objects", "instId", {"open_interest_raw": "oi", "open_interest_base": "oiCcy", "open_interest_usd": "oiUsd", "event_ms": "ts"}, constants={"open_interest_unit": "contracts"}),
    Feed("okx", "marks", "$.data", "objects", "instId", {"mark_price": "markPx", "event_ms": "ts"}),
    Feed("binance", "spot", "$", "objects", "symbol", _px("lastPrice", "bidPrice", "askPrice", "highPrice", "lowPrice", "openPrice", "volume", "quoteVolume", "bidQty", "askQty", trade_count_24h="count", event_ms="closeTime")),
    Feed("binance_derivatives", "usdm", "$", "objects", "symbol", _px("lastPrice", None, None, "highPrice", "lowPrice", "openPrice", "volume", "quoteVolume", trade_count_24h="count", event_ms="closeTime")),
    Feed("binance_derivatives", "usdm_premium", "$", "objects", "symbol", {"mark_price": "markPrice", "index_price": "indexPrice", "funding_rate_raw": "lastFundingRate", "next_funding_time": "nextFundingTime", "event_ms": "time"}, constants={"funding_interval_hours": 8.0}),
    Feed("binance_derivatives", "coinm", "$", "objects", "symbol", _px("lastPrice", None, None, "highPrice", "lowPrice", "openPrice", "baseVolume", None, contract_volume_24h="volume", trade_count_24h="count", event_ms="closeTime")),
    Feed("binance_derivatives", "open_interest", "$", "objects", "symbol", {"open_interest_raw": "openInterest", "event_ms": "time"}),
    Feed("binance_derivatives", "funding_info", "$", "objects", "symbol", {"funding_interval_hours": "fundingIntervalHours"}),
    Feed("bybit", "spot", "$.result.list", "objects", "symbol", _px("lastPrice", "bid1Price", "ask1Price", "highPrice24h", "lowPrice24h", "prevPrice24h", "volume24h", "turnover24h", "bid1Size", "ask1Size"), {"server_ms": "$.time"}),
    Feed("bybit", "linear", "$.result.list", "objects", "symbol", _px("lastPrice", "bid1Price", "ask1Price", "highPrice24h", "lowPrice24h", "prevPrice24h", "volume24h", "turnover24h", mark_price="markPrice", index_price="indexPrice", funding_rate_raw="fundingRate", next_funding_time="nextFundingTime", open_interest_raw="openInterest", open_interest_usd="openInterestValue"), {"server_ms": "$.time"}, constants={"open_interest_unit": "base_asset"}),
    Feed("bybit", "inverse", "$.result.list", "objects", "symbol", _px("lastPrice", "bid1Price", "ask1Price", "highPrice24h", "lowPrice24h", "prevPrice24h", "turnover24h", None, contract_volume_24h="volume24h", mark_price="markPrice", index_price="indexPrice", funding_rate_raw="fundingRate", open_interest_raw="openInterest", open_interest_base="openInterestValue"), {"server_ms": "$.time"}, constants={"open_interest_unit": "contracts"}),
    Feed("coinbase", "spot", "$", "map", None, _px(("stats_24hour", "last"), None, None, ("stats_24hour", "high"), ("stats_24hour", "low"), ("stats_24hour", "open"), ("stats_24hour", "volume"))),
    Feed("kraken", "spot", "$.result", "map", None, _px(("c", 0), ("b", 0), ("a", 0), ("h", 1), ("l", 1), "o", ("v", 1), trade_count_24h=("t", 1))),
    Feed("krakenfutures", "perpetual", "$.tickers", "objects", "symbol", _px("last", "bid", "ask", "high24h", "low24h", "open24h", None, "volumeQuote", mark_price="markPrice", index_price="indexPrice", funding_rate_raw="fundingRate", open_interest_raw="openInterest"), constants={"funding_interval_hours": 1.0, "funding_semantics": "absolute"}),
    Feed("bitget", "spot", "$.data", "objects", "symbol", _px("lastPr", "bidPr", "askPr", "high24h", "low24h", "open", "baseVolume", "quoteVolume", "bidSz", "askSz", event_ms="ts")),
    Feed("bitget", "mix", "$.data", "objects", "symbol", _px("lastPr", "bidPr", "askPr", "high24h", "low24h", "open24h", "baseVolume", "quoteVolume", mark_price="markPrice", index_price="indexPrice", funding_rate_raw="fundingRate", open_interest_raw="holdingAmount", event_ms="ts"), constants={"open_interest_unit": "base_asset"}),
    Feed("gateio", "spot", "$", "objects", "currency_pair", _px("last", "highest_bid", "lowest_ask", "high_24h", "low_24h", None, "base_volume", "quote_volume", "highest_size", "lowest_size")),
    Feed("gateio", "futures", "$", "objects", "contract", _px("last", "highest_bid", "lowest_ask", "high_24h", "low_24h", None, "volume_24h_base", "volume_24h_quote", mark_price="mark_price", index_price="index_price", funding_rate_raw="funding_rate", open_interest_raw="total_size"), constants={"open_interest_unit": "contracts"}),
    Feed("gateio", "contracts", "$", "objects", "name", {"mark_price": "mark_price", "index_price": "index_price", "funding_rate_raw": "funding_rate", "funding_interval_hours": "funding_interval"}, scale={"funding_interval_hours": 1 / 3600}),
    Feed("kucoin", "spot", "$.data.ticker", "objects", "symbol", _px("last", "buy", "sell", "high", "low", "open", "vol", "volValue", "bestBidSize", "bestAskSize"), {"server_ms": "$.data.time"}),
    Feed("mexc", "spot", "$", "objects", "symbol", _px("lastPrice", "bidPrice", "askPrice", "highPrice", "lowPrice", "openPrice", "volume", "quoteVolume", "bidQty", "askQty", event_ms="closeTime")),
    Feed("htx", "spot", "$.data", "objects", "symbol", _px("close", "bid", "ask", "high", "low", "open", "amount", "vol", "bidSize", "askSize", trade_count_24h="count"), {"server_ms": "$.ts"}),
    Feed("cryptocom", "spot", "$.result.data", "objects", "i", _px("a", "b", "k", "h", "l", None, "v", event_ms="t")),
    Feed("cryptocom", "derivatives", "$.result.data", "objects", "i", _px("a", "b", "k", "h", "l", None, "v", open_interest_raw="oi", event_ms="t")),
    Feed("deribit", "derivatives", "$.result", "objects", "instrument_name", _px("last", "bid_price", "ask_price", "high", "low", None, "volume", None, mark_price="mark_price", funding_rate_raw="funding_8h", open_interest_raw="open_interest", underlying_price="underlying_price", mark_iv="mark_iv", event_ms="creation_timestamp"), constants={"funding_interval_hours": 8.0}, keep="not rlike(symbol, '_') or rlike(symbol, '^[A-Z]+_[A-Z]+(-|$)')"),
    Feed("hyperliquid", "perpetual", "$", "parallel", "name", {"mark_price": "markPx", "index_price": "oraclePx", "funding_rate_raw": "funding", "open_interest_raw": "openInterest", "last_price": "midPx", "quote_volume_24h": "dayNtlVlm"}, constants={"funding_interval_hours": 1.0, "open_interest_unit": "base_asset"}),
    Feed("dydx", "perpetual", "$.markets", "map", None, {"index_price": "oraclePrice", "funding_rate_raw": "nextFundingRate", "open_interest_raw": "openInterest", "quote_volume_24h": "volume24H", "trade_count_24h": "trades24H"}, constants={"funding_interval_hours": 1.0, "open_interest_unit": "base_asset"}),
    Feed("bitstamp", "spot", "$", "objects", "pair", _px("last", "bid", "ask", "high", "low", "open", "volume", event_ms="timestamp"), scale={"event_ms": 1000}),
    Feed("bitfinex", "spot", "$", "arrays", 0, _px(7, 1, 3, 9, 10, None, 8, None, 2, 4)),
]
#: Closed to us, with the reason that its health row gives.
DISABLED = {"bitmex": "market data is not open to this collector"}
BY_NAME = {(f.venue, f.product): f for f in FEEDS}


def _field(row: Column, at: str | int | tuple, positional: bool) -> Column:
    if isinstance(at, tuple):
        key, inner = at
        return F.get_json_object(F.element_at(row, key), f"$[{inner}]" if isinstance(inner, int) else f"$.{inner}")
    return F.get(row, F.lit(at)) if positional else F.element_at(row, at)


def rows_of(payloads: DataFrame, feed: Feed) -> DataFrame:
    """Payload rows as (symbol, row, parent values). payloads: payload, a JSON text each."""
    text = F.col("payload") if feed.path == "$" else F.get_json_object("payload", feed.path)
    parents = [F.get_json_object("payload", path).alias(name) for name, path in feed.parent.items()]
    match feed.shape:
        case "objects":
            parsed, out = F.from_json(text, "array<map<string,string>>"), lambda d: d.select("*", F.explode("parsed").alias("row")).withColumn("symbol", F.element_at("row", feed.symbol))
        case "map":
            parsed, out = F.from_json(text, "map<string,map<string,string>>"), lambda d: d.select("*", F.explode("parsed").alias("symbol", "row"))
        case "arrays":
            parsed, out = F.from_json(text, "array<array<string>>"), lambda d: d.select("*", F.explode("parsed").alias("row")).withColumn("symbol", F.get("row", F.lit(feed.symbol)))
        case "parallel":  # [{universe: [...]}, [...]]: equal lengths or nothing
            names = F.from_json(F.get_json_object(text, "$[0].universe"), "array<map<string,string>>")
            contexts = F.from_json(F.get_json_object(text, "$[1]"), "array<map<string,string>>")
            paired = F.when(F.size(names) == F.size(contexts), F.zip_with(names, contexts, lambda n, c: F.map_concat(n, F.map_filter(c, lambda k, _: ~F.array_contains(F.map_keys(n), k)))))
            parsed, out = paired, lambda d: d.select("*", F.explode("parsed").alias("row")).withColumn("symbol", F.element_at("row", feed.symbol))
        case _:
            raise ValueError(f"no shape {feed.shape!r}")
    sound = F.when(parsed.isNull(), F.raise_error(F.lit(f"{feed.venue} {feed.product}: payload has another shape"))).otherwise(parsed)
    found = out(payloads.select(*parents, sound.alias("parsed"))).filter("symbol is not null")
    return found.filter(feed.keep) if feed.keep else found


def raw(payloads: DataFrame, venue: str, product: str) -> DataFrame:
    """Typed raw records of one feed: venue, product, symbol and all numeric fields, null where not published."""
    if venue in DISABLED:
        raise ValueError(f"{venue} is disabled: {DISABLED[venue]}")
    feed = BY_NAME[venue, product]
    rows = rows_of(payloads, feed)
    readers = dict.fromkeys(POSITIVE, parse_positive) | dict.fromkeys(NON_NEGATIVE, parse_non_negative) | dict.fromkeys(ANY_NUMBER, parse_number) | dict.fromkeys(WHOLE, parse_whole)
    kinds = dict.fromkeys((*POSITIVE, *NON_NEGATIVE, *ANY_NUMBER), "double") | dict.fromkeys(WHOLE, "long")
    out = []
    for name, read in readers.items():
        if name in feed.constants:
            value = F.lit(feed.constants[name])
        elif name in feed.fields:
            value = read(_field(F.col("row"), feed.fields[name], feed.shape == "arrays"))
            value = value * feed.scale[name] if name in feed.scale else value
        elif name in feed.parent:
            value = read(F.col(name))
        else:
            value = F.lit(None)
        out.append(value.cast(kinds[name]).alias(name))
    texts = [F.lit(feed.constants.get(c)).cast("string").alias(c) for c in ("open_interest_unit", "funding_semantics")]
    return rows.select(F.lit(venue).alias("venue"), F.lit(product).alias("product"), "symbol", *out, *texts)


def disabled_health(spark) -> DataFrame:
    """A row for each venue that is closed to us, with its reason; its feeds refuse to be read."""
    return spark.createDataFrame([(venue, "disabled", why, 0) for venue, why in sorted(DISABLED.items())], "venue string, status string, reason string, rows long")


def health(rows: Column, priced: Column, requests: Column, failed: Column) -> Column:
    """A venue's run in one word."""
    return F.when(failed & (rows == 0), "failed").when(failed, "degraded").when(rows == 0, "unavailable").when(F.try_divide(priced.cast("double"), rows) < 0.25, "degraded").when(requests > 40, "degraded").otherwise("success")
