"""Frames of venues' public streams as ticks: one declarative mapping for each feed, the same on a batch and on a stream."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import iso_ms, parse_number, parse_positive, parse_whole

PRICES = ("last", "bid", "ask", "mark", "index", "quote_volume_24h", "base_volume_24h", "funding_interval_hours", "open_interest_usd")
TICK = (*PRICES, "funding_rate")


@dataclass(frozen=True)
class FrameFeed:
    name: str
    venue: str
    kind: str
    rows: str  # JSON path of the rows, an array or one object
    symbol: str
    fields: dict[str, str]
    event: str | None = None  # path of the event time in the frame, or key in the row
    event_in_row: bool = False
    event_iso: bool = False
    tests: dict[str, str] = field(default_factory=dict)  # path in the frame -> what it must be, or begin with if it ends in *
    constants: dict[str, float] = field(default_factory=dict)
    silent: tuple[str, ...] = ()  # texts that are no JSON and no fault
    per_request: int = 100
    subscribe: dict | None = None  # a request, with SYMBOLS where the list of topics goes
    topic: str | dict = "{}"
    listed: bool = False  # rows are an array
    holder: str | None = None  # path of what holds the rows, where frames without it are no fault
    iterated: bool = False  # a feed whose rows are gone through without a look at what they are


_BYBIT = {"last": "lastPrice", "bid": "bid1Price", "ask": "ask1Price", "quote_volume_24h": "turnover24h", "base_volume_24h": "volume24h"}
# Public channels and field names of each stream.
FEEDS = [
    FrameFeed("binance", "binance", "spot", "$", "s", {"last": "c", "quote_volume_24h": "q", "base_volume_24h": "v"}, "E", True, listed=True),
    FrameFeed("bybit_spot", "bybit", "spot", "$.data", "symbol", _BYBIT, "$.ts", tests={"$.topic": "tickers.*"}, per_request=10, subscribe={"op": "subscribe", "args": "SYMBOLS"}, topic="tickers.{}"),
    FrameFeed("bybit_linear", "bybit", "linear-perp", "$.data", "symbol", _BYBIT | {"mark": "markPrice", "index": "indexPrice", "funding_rate": "fundingRate", "funding_interval_hours": "fundingIntervalHour", "open_interest_usd": "openInterestValue"}, "$.ts", tests={"$.topic": "tickers.*"}, per_request=10, subscribe={"op": "subscribe", "args": "SYMBOLS"}, topic="tickers.{}"),
    FrameFeed("okx", "okx", "spot", "$.data", "instId", {"last": "last", "bid": "bidPx", "ask": "askPx", "quote_volume_24h": "volCcy24h", "base_volume_24h": "vol24h"}, "ts", True, tests={"$.arg.channel": "tickers"}, silent=("pong",), per_request=50, subscribe={"op": "subscribe", "args": "SYMBOLS"}, topic={"channel": "tickers", "instId": "{}"}, listed=True),
    FrameFeed("coinbase", "coinbase", "spot", "$", "product_id", {"last": "price", "bid": "best_bid", "ask": "best_ask", "base_volume_24h": "volume_24h"}, "time", True, True, {"$.type": "ticker"}, subscribe={"type": "subscribe", "product_ids": "SYMBOLS", "channels": ["ticker"]}),
    FrameFeed("gateio", "gateio", "spot", "$.result", "currency_pair", {"last": "last", "bid": "highest_bid", "ask": "lowest_ask", "quote_volume_24h": "quote_volume", "base_volume_24h": "base_volume"}, "$.time_ms", tests={"$.channel": "spot.tickers", "$.event": "update"}, subscribe={"channel": "spot.tickers", "event": "subscribe", "payload": "SYMBOLS"}),
    FrameFeed("bitget", "bitget", "spot", "$.data", "instId", {"last": "lastPr", "bid": "bidPr", "ask": "askPr", "quote_volume_24h": "quoteVolume", "base_volume_24h": "baseVolume"}, "ts", True, tests={"$.arg.channel": "ticker"}, silent=("pong",), per_request=50, subscribe={"op": "subscribe", "args": "SYMBOLS"}, topic={"instType": "SPOT", "channel": "ticker", "instId": "{}"}, listed=True),
    FrameFeed("cryptocom", "cryptocom", "spot", "$.result.data", "i", {"last": "a", "bid": "b", "ask": "k", "base_volume_24h": "v"}, "t", True, tests={"$.result.channel": "ticker"}, subscribe={"method": "subscribe", "params": {"channels": "SYMBOLS"}}, topic="ticker.{}", listed=True, iterated=True),
    FrameFeed("deribit", "deribit", "inverse-perp", "$.params.data", "instrument_name", {"last": "last_price", "bid": "best_bid_price", "ask": "best_ask_price", "mark": "mark_price", "index": "index_price", "funding_rate": "funding_8h", "open_interest_usd": "open_interest"}, "timestamp", True, tests={"$.method": "subscription"}, constants={"funding_interval_hours": 8.0}, per_request=20, subscribe={"jsonrpc": "2.0", "method": "public/subscribe", "params": {"channels": "SYMBOLS"}}, topic="ticker.{}.100ms", holder="$.params"),
]
BY_NAME = {f.name: f for f in FEEDS}


def subscribe_frames(feed: FrameFeed, symbols: list[str]) -> list[str]:
    """Requests that subscribe to symbols, as many topics in each as the venue takes; none where one stream carries every market."""
    if feed.subscribe is None:
        return []

    def filled(x, topics):
        return topics if x == "SYMBOLS" else {k: filled(v, topics) for k, v in x.items()} if isinstance(x, dict) else x

    topic = lambda s: feed.topic.format(s) if isinstance(feed.topic, str) else {k: v.format(s) if v == "{}" else v for k, v in feed.topic.items()}
    return [json.dumps(filled(feed.subscribe, [topic(s) for s in symbols[k : k + feed.per_request]])) for k in range(0, len(symbols), feed.per_request)]


def value_of(feed: FrameFeed, name: str, row):
    """A value of a feed's row (a map of texts), null where the feed does not tell it or it is no measurement."""
    if name in feed.constants:
        return F.lit(feed.constants[name])
    if name in feed.fields:
        return (parse_positive if name in PRICES else parse_number)(F.element_at(row, feed.fields[name]))
    return F.lit(None).cast("double")


def malformed(frames: DataFrame, feed: FrameFeed) -> DataFrame:
    """Frames that are no JSON at all; a feed's keep-alive texts are none of them."""
    known = F.col("frame").isin(*feed.silent) if feed.silent else F.lit(False)
    return frames.filter(F.get_json_object("frame", "$").isNull() & ~known)


def ticks(frames: DataFrame, feed: FrameFeed) -> DataFrame:
    """Ticks of a feed's frames (frame, received_ms): venue, kind, symbol, received_ms, event_ms and all values, null where a frame does not tell. Frames of another kind give none."""
    ok = F.get_json_object("frame", "$").isNotNull()
    for path, want in feed.tests.items():
        found = F.get_json_object("frame", path)
        ok = ok & (found.startswith(want[:-1]) if want.endswith("*") else found == want)
    text = F.get_json_object("frame", feed.rows)
    listed = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), "array<map<string,string>>")
    event = None if feed.event is None or feed.event_in_row else F.get_json_object("frame", feed.event).alias("_event")
    rows = frames.filter(F.coalesce(ok, F.lit(False))).select("received_ms", *([event] if event is not None else []), F.explode(listed).alias("row"))
    at = F.col("_event") if event is not None else F.element_at("row", feed.event)
    out = [F.lit(feed.venue).alias("venue"), F.lit(feed.kind).alias("kind"), F.element_at("row", feed.symbol).alias("symbol"), "received_ms", (iso_ms(at) if feed.event_iso else parse_whole(at)).alias("event_ms")]
    out += [value_of(feed, name, F.col("row")).alias(name) for name in TICK]
    return rows.select(*out).filter("symbol is not null")
