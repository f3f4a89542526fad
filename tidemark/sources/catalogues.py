"""Venue catalogues, order books and currency rates: what instruments there are, and their levels, one declarative mapping each.

Rows of catalogues are read as those of tickers are. What a venue states in words
(kinds, states, directions) is translated by a table of its own; a word that is
not in it stays as it is and is refused later, by name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_number, parse_positive, parse_whole, split_pair
from tidemark.operators.liquidity import build_levels
from tidemark.sources.venues import _field, rows_of

NUMBERS = ("tick_size", "quantity_step", "minimum_quantity", "minimum_notional", "contract_multiplier", "strike", "funding_interval_hours")
TIMES = ("expiry", "listing_time")
TEXTS = ("base", "quote", "settlement", "base_name", "base_contract_address", "contract_value_symbol")
WORDS = ("instrument_type", "contract_type", "option_type")
NO_TIMES = (0, 4133404800000)  # 2100-01-01: a perpetual that never ends


@dataclass(frozen=True)
class Catalogue:
    venue: str
    product: str
    path: str
    shape: str
    symbol: str | int | None
    fields: dict[str, str | int | tuple] = field(default_factory=dict)
    words: dict[str, dict[str, str]] = field(default_factory=dict)  # for instrument_type, contract_type, option_type: the venue's words
    constants: dict[str, object] = field(default_factory=dict)
    active: tuple[str, tuple[str, ...]] | None = None  # key, values that mean active
    pair: str | None = None  # a key whose text is base and quote with a separator; `symbol` for the symbol itself
    scale: dict[str, float] = field(default_factory=dict)
    parent: dict[str, str] = field(default_factory=dict)
    keep: str | None = None


_PERP, _OI = {"instrument_type": "perpetual"}, "open_interest_unit"
_SPOT = {"instrument_type": "spot"}
_DERIBIT = {"future": "future", "option": "option", "spot": "spot"}
# Public field names and words of each venue's API.
CATALOGUES = [
    Catalogue("okx", "spot", "$.data", "objects", "instId", {"base": "baseCcy", "quote": "quoteCcy", "tick_size": "tickSz", "quantity_step": "lotSz", "minimum_quantity": "minSz", "listing_time": "listTime"}, constants=_SPOT, active=("state", ("live",))),
    Catalogue("okx", "derivatives", "$.data", "objects", "instId", {"settlement": "settleCcy", "contract_multiplier": "ctVal", "contract_value_symbol": "ctValCcy", "tick_size": "tickSz", "quantity_step": "lotSz", "minimum_quantity": "minSz", "expiry": "expTime", "listing_time": "listTime", "strike": "stk", "instrument_type": "instType", "contract_type": "ctType", "option_type": "optType"}, {"instrument_type": {"SWAP": "perpetual", "FUTURES": "future", "OPTION": "option"}, "option_type": {"C": "call", "P": "put"}}, {_OI: "contracts", "funding_semantics": "relative"}, ("state", ("live",)), "uly"),
    Catalogue("binance", "spot", "$.symbols", "objects", "symbol", {"base": "baseAsset", "quote": "quoteAsset"}, constants=_SPOT, active=("status", ("TRADING",))),
    Catalogue("binance_derivatives", "usdm", "$.symbols", "objects", "symbol", {"base": "baseAsset", "quote": "quoteAsset", "settlement": "marginAsset", "expiry": "deliveryDate", "listing_time": "onboardDate", "instrument_type": "contractType"}, {"instrument_type": {"PERPETUAL": "perpetual", "CURRENT_QUARTER": "future", "NEXT_QUARTER": "future"}}, {"contract_type": "linear", _OI: "base_asset", "funding_semantics": "relative", "funding_interval_hours": 8.0}, ("status", ("TRADING",)), keep="coalesce(element_at(row, 'underlyingType'), 'COIN') = 'COIN'"),
    Catalogue("binance_derivatives", "coinm", "$.symbols", "objects", "symbol", {"base": "baseAsset", "quote": "quoteAsset", "settlement": "marginAsset", "contract_multiplier": "contractSize", "expiry": "deliveryDate", "listing_time": "onboardDate", "instrument_type": "contractType"}, {"instrument_type": {"PERPETUAL": "perpetual", "CURRENT_QUARTER": "future", "NEXT_QUARTER": "future"}}, {"contract_type": "inverse", "contract_value_symbol": "USD", _OI: "contracts", "funding_semantics": "relative", "funding_interval_hours": 8.0}, ("contractStatus", ("TRADING",))),
    Catalogue("bybit", "spot", "$.result.list", "objects", "symbol", {"base": "baseCoin", "quote": "quoteCoin", "tick_size": ("priceFilter", "tickSize"), "quantity_step": ("lotSizeFilter", "basePrecision"), "minimum_quantity": ("lotSizeFilter", "minOrderQty")}, constants=_SPOT, active=("status", ("Trading",)), keep="coalesce(element_at(row, 'symbolType'), '') not in ('stock', 'ETF', 'forex', 'xstocks')"),
    Catalogue("bybit", "derivatives", "$.result.list", "objects", "symbol", {"base": "baseCoin", "quote": "quoteCoin", "settlement": "settleCoin", "tick_size": ("priceFilter", "tickSize"), "quantity_step": ("lotSizeFilter", "qtyStep"), "minimum_quantity": ("lotSizeFilter", "minOrderQty"), "expiry": "deliveryTime", "listing_time": "launchTime", "funding_interval_hours": "fundingInterval", "instrument_type": "contractType", "contract_type": "contractType"}, {"instrument_type": {"LinearPerpetual": "perpetual", "InversePerpetual": "perpetual", "LinearFutures": "future", "InverseFutures": "future"}, "contract_type": {"LinearPerpetual": "linear", "LinearFutures": "linear", "InversePerpetual": "inverse", "InverseFutures": "inverse"}}, {"funding_semantics": "relative"}, ("status", ("Trading",)), scale={"funding_interval_hours": 1 / 60}, keep="coalesce(element_at(row, 'symbolType'), '') not in ('stock', 'ETF', 'forex', 'xstocks')"),
    Catalogue("coinbase", "spot", "$", "objects", "id", {"base": "base_currency", "quote": "quote_currency", "tick_size": "quote_increment", "quantity_step": "base_increment", "minimum_notional": "min_market_funds"}, constants=_SPOT, active=("status", ("online",))),
    Catalogue("kraken", "spot", "$.result", "map", None, {"base": "base", "quote": "quote", "tick_size": "tick_size", "minimum_quantity": "ordermin", "minimum_notional": "costmin"}, constants=_SPOT, active=("status", ("online",)), pair="wsname"),
    Catalogue("krakenfutures", "derivatives", "$.instruments", "objects", "symbol", {"base": "base", "quote": "quote", "tick_size": "tickSize", "contract_multiplier": "contractSize", "expiry": "lastTradingTime", "listing_time": "openingDate", "contract_type": "type"}, {"contract_type": {"futures_inverse": "inverse", "flexible_futures": "linear", "futures_vanilla": "linear"}}, {"funding_semantics": "absolute", "funding_interval_hours": 1.0}, ("tradeable", ("true",))),
    Catalogue("bitget", "spot", "$.data", "objects", "symbol", {"base": "baseCoin", "quote": "quoteCoin", "minimum_quantity": "minTradeAmount", "minimum_notional": "minTradeUSDT"}, constants=_SPOT, active=("status", ("online",))),
    Catalogue("bitget", "mix", "$.data", "objects", "symbol", {"base": "baseCoin", "quote": "quoteCoin", "quantity_step": "sizeMultiplier", "minimum_quantity": "minTradeNum", "expiry": "deliveryTime", "listing_time": "launchTime", "funding_interval_hours": "fundInterval", "instrument_type": "symbolType"}, {"instrument_type": {"perpetual": "perpetual", "delivery": "future"}}, {_OI: "base_asset", "funding_semantics": "relative"}, ("symbolStatus", ("normal",))),
    Catalogue("gateio", "spot", "$", "objects", "id", {"base": "base", "quote": "quote", "minimum_quantity": "min_base_amount", "minimum_notional": "min_quote_amount", "base_name": "base_name"}, constants=_SPOT, active=("trade_status", ("tradable",))),
    Catalogue("gateio", "futures", "$", "objects", "name", {"tick_size": "order_price_round", "minimum_quantity": "order_size_min", "contract_multiplier": "quanto_multiplier", "funding_interval_hours": "funding_interval", "contract_type": "type"}, {"contract_type": {"direct": "linear"}}, _PERP | {_OI: "contracts", "funding_semantics": "relative"}, ("in_delisting", ("false",)), "symbol", {"funding_interval_hours": 1 / 3600}),
    Catalogue("kucoin", "spot", "$.data", "objects", "symbol", {"base": "baseCurrency", "quote": "quoteCurrency", "tick_size": "priceIncrement", "quantity_step": "baseIncrement", "minimum_quantity": "baseMinSize"}, constants=_SPOT, active=("enableTrading", ("true",))),
    Catalogue("mexc", "spot", "$.symbols", "objects", "symbol", {"base": "baseAsset", "quote": "quoteAsset", "base_name": "fullName", "base_contract_address": "contractAddress", "quantity_step": "baseSizePrecision"}, constants=_SPOT, active=("status", ("1", "ENABLED"))),
    Catalogue("htx", "spot", "$.data", "objects", "symbol", {"base": "bc", "quote": "qc", "minimum_quantity": "minoa", "minimum_notional": "minov"}, constants=_SPOT, active=("state", ("online",))),
    Catalogue("cryptocom", "all", "$.result.data", "objects", "symbol", {"base": "base_ccy", "quote": "quote_ccy", "tick_size": "price_tick_size", "quantity_step": "qty_tick_size", "contract_multiplier": "contract_size", "expiry": "expiry_timestamp_ms", "instrument_type": "inst_type"}, {"instrument_type": {"CCY_PAIR": "spot", "PERPETUAL_SWAP": "perpetual", "FUTURE": "future"}}, active=("tradable", ("true",))),
    Catalogue("deribit", "all", "$.result", "objects", "instrument_name", {"base": "base_currency", "quote": "quote_currency", "settlement": "settlement_currency", "tick_size": "tick_size", "minimum_quantity": "min_trade_amount", "contract_multiplier": "contract_size", "expiry": "expiration_timestamp", "listing_time": "creation_timestamp", "strike": "strike", "instrument_type": "kind", "contract_type": "instrument_type", "option_type": "option_type"}, {"instrument_type": _DERIBIT, "contract_type": {"reversed": "inverse"}}, {_OI: "usd", "funding_semantics": "relative"}, ("is_active", ("true",)), keep="element_at(row, 'kind') not like '%combo'"),
    Catalogue("hyperliquid", "perpetual", "$[0].universe", "objects", "name", {"base": "name"}, constants=_PERP | {"quote": "USD", "settlement": "USDC", "contract_type": "linear", _OI: "base_asset", "funding_semantics": "relative", "funding_interval_hours": 1.0}, active=("isDelisted", ("false",))),
    Catalogue("dydx", "perpetual", "$.markets", "map", None, {"tick_size": "tickSize", "quantity_step": "stepSize"}, constants=_PERP | {"settlement": "USDC", "contract_type": "linear", _OI: "base_asset", "funding_semantics": "relative", "funding_interval_hours": 1.0}, active=("status", ("ACTIVE",)), pair="symbol"),
    Catalogue("bitstamp", "spot", "$", "objects", "url_symbol", {"base_name": "description"}, constants=_SPOT, active=("trading", ("Enabled",)), pair="name"),
]
BY_NAME = {(c.venue, c.product): c for c in CATALOGUES}
SCHEMA = ("venue", "product", "symbol", "instrument_type", "contract_type", "option_type", *TEXTS, *NUMBERS, *TIMES, "funding_semantics", "open_interest_unit", "active")


def _timed(value: Column) -> Column:
    """Milliseconds from a whole number or an ISO time; times that mean none are null."""
    ms = F.coalesce(parse_whole(value), F.unix_millis(F.try_to_timestamp(value)))
    return F.when(~ms.isin(*NO_TIMES), ms)


def catalogue(payloads: DataFrame, venue: str, product: str) -> DataFrame:
    """Raw instruments of one payload kind, under the names of SCHEMA."""
    c = BY_NAME[venue, product]
    row, positional = F.col("row"), c.shape == "arrays"
    read = lambda name: _field(row, c.fields[name], positional)
    pair = None if c.pair is None else split_pair(F.col("symbol") if c.pair == "symbol" else F.element_at(row, c.pair))
    out = {"venue": F.lit(venue), "product": F.lit(product), "symbol": F.col("symbol")}
    for name in (*WORDS, *TEXTS, *NUMBERS, *TIMES, "funding_semantics", "open_interest_unit"):
        value = F.lit(None)
        if name in c.constants:
            value = F.lit(c.constants[name])
        elif name in c.fields:
            value = read(name)
            if name in c.words:
                known = F.create_map(*[F.lit(x) for both in c.words[name].items() for x in both])
                value = F.coalesce(F.try_element_at(known, value), value)
            if name in NUMBERS:
                value = (parse_positive if name != "strike" else parse_number)(value)
                value = value * c.scale[name] if name in c.scale else value
            elif name in TIMES:
                value = _timed(value)
            else:
                value = F.nullif(value, F.lit(""))
        if name in ("base", "quote") and pair is not None:
            value = F.coalesce(pair[name], value)
        out[name] = value.cast("double" if name in NUMBERS else "long" if name in TIMES else "string")
    if (venue, product) == ("krakenfutures", "derivatives"):  # whether a contract ends tells what it is
        out["instrument_type"] = F.when(out["expiry"].isNull(), "perpetual").otherwise("future")
    if venue == "kraken":  # codes of four letters that begin with X or Z, where the venue names no pair
        for name in ("base", "quote"):
            code = out[name]
            out[name] = F.when(code.rlike("^[XZ][A-Z]{3}$"), F.substring(code, 2, 3)).otherwise(code)
    state = None if c.active is None else F.coalesce(F.element_at(row, c.active[0]).isin(*c.active[1]), F.lit("false" in c.active[1]))
    out["active"] = F.lit(True) if state is None else state
    return rows_of(payloads, c).select(*[v.alias(k) for k, v in out.items()])


def listed_pairs(pairs: DataFrame, codes: DataFrame, names: DataFrame) -> DataFrame:
    """Instruments of a venue that lists pairs as texts and renames codes in tables of its own. pairs: pair (XXXYYY or XXX:YYY); codes: code, symbol; names: code, name."""
    split = F.when(F.contains("pair", F.lit(":")), F.split("pair", ":")).when(F.length("pair") == 6, F.array(F.substring("pair", 1, 3), F.substring("pair", 4, 3)))
    parts = pairs.withColumn("p", split).filter("p is not null").select("pair", F.get("p", F.lit(0)).alias("b"), F.get("p", F.lit(1)).alias("q"))
    code = lambda side: codes.select(F.col("code").alias(f"{side}_code"), F.col("symbol").alias(f"{side}_symbol"))
    j = parts.join(code("b"), F.col("b") == F.col("b_code"), "left").join(code("q"), F.col("q") == F.col("q_code"), "left").join(names.select(F.col("code").alias("n_code"), "name"), F.col("b") == F.col("n_code"), "left")
    return j.select(F.concat(F.lit("t"), "pair").alias("symbol"), F.upper(F.coalesce("b_symbol", "b")).alias("base"), F.upper(F.coalesce("q_symbol", "q")).alias("quote"), F.col("name").alias("base_name"), F.lit("spot").alias("instrument_type"))


@dataclass(frozen=True)
class BookFeed:
    venue: str
    bids: str  # JSON paths of the levels
    asks: str
    price: str | int = 0  # in a level: position or key
    size: str | int = 1
    time: str | None = None
    time_ms: int = 1  # milliseconds in one of the clock's units


# Where each venue's books have their levels.
BOOKS = [
    BookFeed("okx", "$.data[0].bids", "$.data[0].asks", time="$.data[0].ts"), BookFeed("binance", "$.bids", "$.asks"), BookFeed("binance_derivatives", "$.bids", "$.asks", time="$.T"), BookFeed("bybit", "$.result.b", "$.result.a", time="$.result.ts"),
    BookFeed("coinbase", "$.bids", "$.asks"), BookFeed("kraken", "$.result.*.bids", "$.result.*.asks"), BookFeed("krakenfutures", "$.orderBook.bids", "$.orderBook.asks"), BookFeed("bitget", "$.data.bids", "$.data.asks", time="$.data.ts"),
    BookFeed("gateio", "$.bids", "$.asks", time="$.current"), BookFeed("kucoin", "$.data.bids", "$.data.asks", time="$.data.time"), BookFeed("mexc", "$.bids", "$.asks", time="$.timestamp"), BookFeed("htx", "$.tick.bids", "$.tick.asks", time="$.tick.ts"),
    BookFeed("cryptocom", "$.result.data[0].bids", "$.result.data[0].asks", time="$.result.data[0].t"), BookFeed("deribit", "$.result.bids", "$.result.asks", time="$.result.timestamp"), BookFeed("hyperliquid", "$.levels[0]", "$.levels[1]", "px", "sz", "$.time"),
    BookFeed("dydx", "$.bids", "$.asks", "price", "size"), BookFeed("bitstamp", "$.bids", "$.asks", time="$.timestamp", time_ms=1000),
]
BOOK_BY_VENUE = {b.venue: b for b in BOOKS}


def book(payloads: DataFrame, venue: str, depth: int = 50) -> DataFrame:
    """bids and asks (best first, cut at depth, only levels with a positive price and size), whether they were cut, and the venue's time. payloads: symbol, payload."""
    feed = BOOK_BY_VENUE[venue]

    def side(path: str, descending: bool) -> Column:
        above, any_key, below = path.partition(".*.")
        text = F.get_json_object(F.get(F.map_values(F.from_json(F.get_json_object("payload", above), "map<string,string>")), F.lit(0)), f"$.{below}") if any_key else F.get_json_object("payload", path)
        if isinstance(feed.price, int):
            rows = F.from_json(text, "array<array<string>>")
            pairs = F.transform(rows, lambda x: F.array(F.get(x, F.lit(feed.price)), F.get(x, F.lit(feed.size))))
        else:
            pairs = F.transform(F.from_json(text, "array<map<string,string>>"), lambda x: F.array(F.element_at(x, feed.price), F.element_at(x, feed.size)))
        return build_levels(F.coalesce(pairs, F.array().cast("array<array<string>>")), depth, descending)

    ms = F.lit(None).cast("long") if feed.time is None else parse_whole(F.get_json_object("payload", feed.time)) * feed.time_ms
    both = payloads.select("symbol", side(feed.bids, True).alias("b"), side(feed.asks, False).alias("a"), ms.alias("event_ms"))
    return both.select(F.lit(venue).alias("venue"), "symbol", F.col("b.levels").alias("bids"), F.col("a.levels").alias("asks"), (F.col("b.truncated") | F.col("a.truncated")).alias("truncated"), "event_ms")


def fx_records(tickers: DataFrame, instruments: DataFrame, currencies: list[str]) -> DataFrame:
    """Rates between currencies from a venue's own spot markets: from, to, rate, and whether it is the middle of a book or a last price."""
    pairs = instruments.filter((F.col("instrument_type") == "spot") & F.col("base").isin(currencies) & F.col("quote").isin(currencies)).select(F.col("symbol").alias("i_symbol"), "base", "quote")
    j = tickers.join(pairs, F.col("symbol") == F.col("i_symbol"))
    mid = F.when(F.col("bid_price") <= F.col("ask_price"), (F.col("bid_price") + F.col("ask_price")) / 2)
    return j.select("venue", "symbol", F.col("base").alias("from_symbol"), F.col("quote").alias("to_symbol"), F.coalesce(mid, "last_price").alias("rate"), F.when(mid.isNotNull(), "mid").when(F.col("last_price").isNotNull(), "last").alias("source"), "event_ms").filter("rate is not null")


def interval_hours(funding_ms: Column, next_ms: Column) -> Column:
    """Hours between a funding time and the next."""
    return F.when(next_ms > funding_ms, (next_ms - funding_ms) / 3_600_000.0)
