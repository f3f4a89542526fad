"""Payloads written by hand after the venues' public documentation: each value is told once, so that a wrong key, scale or sign shows."""

import json

import pytest

from tidemark.sources import catalogues as K
from tidemark.sources import venues as V

T = 1_700_000_000_000
TICKERS = [
    ("okx", "spot", {"code": "0", "msg": "", "data": [{"instType": "SPOT", "instId": "AA-USDT", "last": "11", "lastSz": "99", "askPx": "12", "askSz": "13", "bidPx": "10", "bidSz": "14", "open24h": "15", "high24h": "16", "low24h": "9", "volCcy24h": "170", "vol24h": "18", "ts": str(T + 1), "sodUtc0": "77"}]}, "AA-USDT",
     {"last_price": 11, "ask_price": 12, "ask_size": 13, "bid_price": 10, "bid_size": 14, "open_24h": 15, "high_24h": 16, "low_24h": 9, "quote_volume_24h": 170, "base_volume_24h": 18, "event_ms": T + 1}),
    ("okx", "swap", {"data": [{"instType": "SWAP", "instId": "AA-USDT-SWAP", "last": "11", "askPx": "12", "bidPx": "10", "open24h": "15", "high24h": "16", "low24h": "9", "volCcy24h": "1.7", "vol24h": "1800", "ts": str(T)}]}, "AA-USDT-SWAP",
     {"last_price": 11, "ask_price": 12, "bid_price": 10, "open_24h": 15, "high_24h": 16, "low_24h": 9, "base_volume_24h": 1.7, "contract_volume_24h": 1800, "event_ms": T}),
    ("okx", "funding", {"data": [{"instId": "AA-USDT-SWAP", "fundingRate": "-0.0001", "fundingTime": str(T + 2), "nextFundingTime": str(T + 3), "nextFundingRate": "", "method": "current_period"}]}, "AA-USDT-SWAP", {"funding_rate_raw": -0.0001, "previous_funding_time": T + 2, "next_funding_time": T + 3, "funding_semantics": "relative"}),
    ("okx", "open_interest", {"data": [{"instId": "AA-USDT-SWAP", "oi": "2000", "oiCcy": "20.5", "oiUsd": "830000", "ts": str(T)}]}, "AA-USDT-SWAP", {"open_interest_raw": 2000, "open_interest_base": 20.5, "open_interest_usd": 830000, "event_ms": T, "open_interest_unit": "contracts"}),
    ("okx", "marks", {"data": [{"instId": "AA-USDT-SWAP", "markPx": "11.5", "ts": str(T)}]}, "AA-USDT-SWAP", {"mark_price": 11.5, "event_ms": T}),
    ("binance", "spot", [{"symbol": "AAUSDT", "priceChange": "-9", "weightedAvgPrice": "8", "lastPrice": "11", "bidPrice": "10", "bidQty": "14", "askPrice": "12", "askQty": "13", "openPrice": "15", "highPrice": "16", "lowPrice": "9.5", "volume": "18", "quoteVolume": "170", "openTime": T - 9, "closeTime": T, "count": 42}, {"symbol": "DEADUSDT", "lastPrice": "0.00", "bidPrice": "0", "volume": "0"}], "AAUSDT",
     {"last_price": 11, "bid_price": 10, "bid_size": 14, "ask_price": 12, "ask_size": 13, "open_24h": 15, "high_24h": 16, "low_24h": 9.5, "base_volume_24h": 18, "quote_volume_24h": 170, "trade_count_24h": 42, "event_ms": T}),
    ("bybit", "spot", {"retCode": 0, "result": {"category": "spot", "list": [{"symbol": "AAUSDT", "bid1Price": "10", "bid1Size": "14", "ask1Price": "12", "ask1Size": "13", "lastPrice": "11", "prevPrice24h": "15", "price24hPcnt": "0.9", "highPrice24h": "16", "lowPrice24h": "9", "turnover24h": "170", "volume24h": "18"}]}, "time": T}, "AAUSDT",
     {"bid_price": 10, "bid_size": 14, "ask_price": 12, "ask_size": 13, "last_price": 11, "open_24h": 15, "high_24h": 16, "low_24h": 9, "quote_volume_24h": 170, "base_volume_24h": 18, "server_ms": T}),
    ("bybit", "linear", {"result": {"category": "linear", "list": [{"symbol": "AAUSDT", "lastPrice": "11", "indexPrice": "11.1", "markPrice": "11.2", "openInterest": "500", "openInterestValue": "5600", "turnover24h": "170", "volume24h": "18", "fundingRate": "0.0002", "nextFundingTime": str(T + 5)}]}, "time": T}, "AAUSDT",
     {"last_price": 11, "index_price": 11.1, "mark_price": 11.2, "open_interest_raw": 500, "open_interest_usd": 5600, "quote_volume_24h": 170, "base_volume_24h": 18, "funding_rate_raw": 0.0002, "next_funding_time": T + 5, "server_ms": T, "open_interest_unit": "base_asset"}),
    ("bybit", "inverse", {"result": {"category": "inverse", "list": [{"symbol": "AAUSD", "lastPrice": "11", "openInterest": "7000", "openInterestValue": "636", "turnover24h": "1.7", "volume24h": "1800", "fundingRate": "-0.0003"}]}, "time": T}, "AAUSD",
     {"last_price": 11, "open_interest_raw": 7000, "open_interest_base": 636, "base_volume_24h": 1.7, "contract_volume_24h": 1800, "funding_rate_raw": -0.0003, "server_ms": T, "open_interest_unit": "contracts"}),
    ("bitget", "spot", {"code": "00000", "requestTime": T, "data": [{"symbol": "AAUSDT", "open": "15", "high24h": "16", "low24h": "9", "lastPr": "11", "quoteVolume": "170", "baseVolume": "18", "usdtVolume": "171", "bidPr": "10", "askPr": "12", "bidSz": "14", "askSz": "13", "ts": str(T + 7), "change24h": "0.1"}]}, "AAUSDT",
     {"open_24h": 15, "high_24h": 16, "low_24h": 9, "last_price": 11, "quote_volume_24h": 170, "base_volume_24h": 18, "bid_price": 10, "ask_price": 12, "bid_size": 14, "ask_size": 13, "event_ms": T + 7}),
    ("bitget", "mix", {"data": [{"symbol": "AAUSDT", "lastPr": "11", "markPrice": "11.2", "indexPrice": "11.1", "fundingRate": "0.0004", "holdingAmount": "321", "open24h": "15", "openUtc": "88", "ts": str(T)}]}, "AAUSDT", {"last_price": 11, "mark_price": 11.2, "index_price": 11.1, "funding_rate_raw": 0.0004, "open_interest_raw": 321, "open_24h": 15, "event_ms": T, "open_interest_unit": "base_asset"}),
    ("mexc", "spot", [{"symbol": "AAUSDT", "priceChange": "1", "prevClosePrice": "77", "lastPrice": "11", "bidPrice": "10", "bidQty": "14", "askPrice": "12", "askQty": "13", "openPrice": "15", "highPrice": "16", "lowPrice": "9", "volume": "18", "quoteVolume": "170", "openTime": 1, "closeTime": T, "count": None}], "AAUSDT",
     {"last_price": 11, "bid_price": 10, "bid_size": 14, "ask_price": 12, "ask_size": 13, "open_24h": 15, "high_24h": 16, "low_24h": 9, "base_volume_24h": 18, "quote_volume_24h": 170, "event_ms": T}),
    ("cryptocom", "derivatives", {"code": 0, "result": {"data": [{"i": "AAUSD-PERP", "h": "16", "l": "9", "a": "11", "b": "10", "k": "12", "v": "18", "vv": "999", "c": "0.1", "oi": "600", "t": T}]}}, "AAUSD-PERP", {"high_24h": 16, "low_24h": 9, "last_price": 11, "bid_price": 10, "ask_price": 12, "base_volume_24h": 18, "open_interest_raw": 600, "event_ms": T}),
    ("dydx", "perpetual", {"markets": {"AA-USD": {"ticker": "AA-USD", "status": "ACTIVE", "oraclePrice": "11.1", "priceChange24H": "5", "volume24H": "170", "trades24H": 42, "nextFundingRate": "-0.00001", "openInterest": "600.5", "stepSize": "0.1"}}}, "AA-USD",
     {"index_price": 11.1, "quote_volume_24h": 170, "trade_count_24h": 42, "funding_rate_raw": -0.00001, "open_interest_raw": 600.5, "funding_interval_hours": 1, "open_interest_unit": "base_asset"}),
    ("bitstamp", "spot", [{"pair": "AA/USD", "last": "11", "bid": "10", "ask": "12", "high": "16", "low": "9", "open": "15", "open_24": "77", "volume": "18", "vwap": "76", "timestamp": "1700000001", "percent_change_24": "1"}], "AA/USD", {"last_price": 11, "bid_price": 10, "ask_price": 12, "high_24h": 16, "low_24h": 9, "open_24h": 15, "base_volume_24h": 18, "event_ms": 1_700_000_001_000}),
]
TEXTS = ("venue", "product", "symbol")


@pytest.mark.parametrize("venue, product, payload, symbol, want", TICKERS, ids=[f"{v}-{p}" for v, p, *_ in TICKERS])
def test_payload(spark, venue, product, payload, symbol, want):
    rows = V.raw(spark.createDataFrame([(json.dumps(payload),)], "payload string"), venue, product).collect()
    row = next(r.asDict() for r in rows if r.symbol == symbol)
    assert {k: v for k, v in row.items() if v is not None and k not in TEXTS} == pytest.approx(want)
    for other in rows:
        if other.symbol.startswith("DEAD"):  # zero prices are unknown, a zero volume is one
            assert (other.last_price, other.bid_price, other.base_volume_24h) == (None, None, 0)


BIDS, ASKS = [["10", "1"], ["9.5", "2"], ["0", "5"]], [["11", "3"], ["12", "0"], ["11.5", "4"]]
BOOKS = {
    "okx": {"code": "0", "data": [{"bids": [[p, s, "0", "1"] for p, s in BIDS], "asks": [[p, s, "0", "2"] for p, s in ASKS], "ts": str(T)}]}, "binance": {"lastUpdateId": 5, "bids": BIDS, "asks": ASKS}, "binance_derivatives": {"E": T, "T": T - 1, "bids": BIDS, "asks": ASKS},
    "bybit": {"result": {"s": "A", "b": BIDS, "a": ASKS, "ts": T, "u": 1}, "time": T + 9}, "coinbase": {"bids": [[p, s, 1] for p, s in BIDS], "asks": [[p, s, 1] for p, s in ASKS], "sequence": 3}, "bitget": {"data": {"bids": BIDS, "asks": ASKS, "ts": str(T)}}, "gateio": {"bids": BIDS, "asks": ASKS, "current": T, "update": T - 1},
    "kucoin": {"data": {"time": T, "bids": BIDS, "asks": ASKS}}, "mexc": {"lastUpdateId": 1, "bids": BIDS, "asks": ASKS}, "kraken": {"result": {"XAA": {"bids": [[p, s, 1] for p, s in BIDS], "asks": [[p, s, 1] for p, s in ASKS]}}},
    "krakenfutures": {"result": "success", "orderBook": {"bids": [[float(p), float(s)] for p, s in BIDS], "asks": [[float(p), float(s)] for p, s in ASKS]}}, "htx": {"ch": "x", "ts": T + 50, "tick": {"ts": T, "bids": [[float(p), float(s)] for p, s in BIDS], "asks": [[float(p), float(s)] for p, s in ASKS]}},
    "cryptocom": {"result": {"depth": 2, "data": [{"bids": [[p, s, "1"] for p, s in BIDS], "asks": [[p, s, "1"] for p, s in ASKS], "t": T}]}}, "deribit": {"result": {"timestamp": T, "bids": [[float(p), float(s)] for p, s in BIDS], "asks": [[float(p), float(s)] for p, s in ASKS]}},
    "hyperliquid": {"coin": "A", "time": T, "levels": [[{"px": p, "sz": s, "n": 1} for p, s in BIDS], [{"px": p, "sz": s, "n": 1} for p, s in ASKS]]}, "dydx": {"bids": [{"price": p, "size": s} for p, s in BIDS], "asks": [{"price": p, "size": s} for p, s in ASKS]},
    "bitstamp": {"timestamp": str(T // 1000), "microtimestamp": str(T * 1000 + 5), "bids": BIDS, "asks": ASKS},
}
#: Venues whose books tell no time.
TIMELESS = {"binance", "coinbase", "kraken", "krakenfutures", "mexc", "dydx"}


def test_every_book_has_a_payload():
    assert set(BOOKS) == set(K.BOOK_BY_VENUE)


@pytest.mark.parametrize("venue", sorted(BOOKS))
def test_book(spark, venue):
    got = K.book(spark.createDataFrame([("A", json.dumps(BOOKS[venue]))], "symbol string, payload string"), venue, 20).first()
    assert [(x.price, x.size) for x in got.bids] == [(10, 1), (9.5, 2)] and [(x.price, x.size) for x in got.asks] == [(11, 3), (11.5, 4)] and not got.truncated
    assert got.event_ms == (None if venue in TIMELESS else T - 1 if venue == "binance_derivatives" else T)
