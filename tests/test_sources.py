import json

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.mql.engine import market_schema
from tidemark.sources import datasets as D
from tidemark.sources import venues as V


def read(spark, venue, product, payload):
    rows = V.raw(spark.createDataFrame([(json.dumps(payload),)], "payload string"), venue, product).collect()
    return {r.symbol: r for r in rows}


def test_shapes(spark):
    k = read(spark, "kraken", "spot", {"error": [], "result": {"XXBTZUSD": {"a": ["101", "1", "1"], "b": ["99", "1"], "c": ["100", "0.1"], "v": ["1", "20"], "h": ["1", "110"], "l": ["1", "90"], "o": "95", "t": [1, 7]}}})["XXBTZUSD"]
    assert (k.last_price, k.bid_price, k.ask_price, k.base_volume_24h, k.trade_count_24h, k.quote_volume_24h) == (100, 99, 101, 20, 7, None)
    b = read(spark, "bitfinex", "spot", [["tBTCUSD", 99, 1, 101, 2, 0, 0, 100, 30, 110, 90], [None]])["tBTCUSD"]
    assert (b.last_price, b.bid_size, b.base_volume_24h) == (100, 1, 30)
    c = read(spark, "coinbase", "spot", {"BTC-USD": {"stats_24hour": {"last": "5", "volume": "0", "high": "-1"}}})["BTC-USD"]
    assert (c.last_price, c.base_volume_24h, c.high_24h, c.bid_price) == (5, 0, None, None)
    u = read(spark, "kucoin", "spot", {"data": {"time": 1700000000000, "ticker": [{"symbol": "A-B", "last": "2", "buy": "", "sell": "n/a", "vol": "3"}]}})["A-B"]
    assert (u.server_ms, u.last_price, u.bid_price, u.ask_price) == (1700000000000, 2, None, None)
    h = read(spark, "hyperliquid", "perpetual", [{"universe": [{"name": "BTC"}, {"name": "ETH"}]}, [{"markPx": "1", "funding": "0.1"}, {"markPx": "2"}]])
    assert (h["BTC"].mark_price, h["BTC"].funding_interval_hours, h["ETH"].mark_price) == (1, 1, 2)
    g = read(spark, "gateio", "contracts", [{"name": "X_Y", "funding_interval": 28800}])["X_Y"]
    assert g.funding_interval_hours == pytest.approx(8)
    t = read(spark, "htx", "spot", {"ts": 5, "data": [{"symbol": "xy", "close": 1, "amount": 2, "vol": 3}]})["xy"]
    assert (t.base_volume_24h, t.quote_volume_24h) == (2, 3)


@pytest.mark.parametrize("payload", [[{"universe": [{"name": "BTC"}]}, []], {"other": 1}])
def test_another_shape_fails(spark, payload):
    with pytest.raises(Exception, match="another shape"):
        read(spark, "hyperliquid", "perpetual", payload)


def test_catalogue_traps(spark):
    from tidemark.sources import catalogues as K

    cat = lambda venue, product, payload: {r.symbol: r for r in K.catalogue(spark.createDataFrame([(json.dumps(payload),)], "payload string"), venue, product).collect()}
    k = cat("kraken", "spot", {"result": {"XXBTZUSD": {"base": "XXBT", "quote": "ZUSD", "status": "online"}, "ADAEUR": {"base": "ADA", "quote": "ZEUR", "wsname": "ADA/EUR", "status": "cancel_only"}}})
    assert (k["XXBTZUSD"].base, k["XXBTZUSD"].quote, k["XXBTZUSD"].active) == ("XBT", "USD", True) and (k["ADAEUR"].base, k["ADAEUR"].quote, k["ADAEUR"].active) == ("ADA", "EUR", False)
    f = cat("krakenfutures", "derivatives", {"instruments": [{"symbol": "PF_XBTUSD", "type": "flexible_futures", "tradeable": True}, {"symbol": "FI_XBTUSD", "type": "futures_inverse", "lastTradingTime": "2024-03-29T16:00:00.000Z", "tradeable": True}]})
    assert (f["PF_XBTUSD"].instrument_type, f["PF_XBTUSD"].contract_type) == ("perpetual", "linear") and (f["FI_XBTUSD"].instrument_type, f["FI_XBTUSD"].contract_type) == ("future", "inverse") and f["FI_XBTUSD"].expiry == 1711728000000
    d = cat("deribit", "all", {"result": [{"instrument_name": "BTC-PERPETUAL", "kind": "future", "expiration_timestamp": 32503708800000}, {"instrument_name": "BTC-FS-1", "kind": "future_combo"}]})
    assert set(d) == {"BTC-PERPETUAL"}
    g = cat("gateio", "futures", [{"name": "BTC_USDT", "quanto_multiplier": "0.0001", "funding_interval": 28800, "in_delisting": False, "type": "direct"}])["BTC_USDT"]
    assert (g.base, g.quote, g.contract_multiplier, g.contract_type, g.active) == ("BTC", "USDT", 0.0001, "linear", True) and g.funding_interval_hours == pytest.approx(8)
    b = cat("binance_derivatives", "usdm", {"symbols": [{"symbol": "BTCUSDT", "contractType": "PERPETUAL", "deliveryDate": 4133404800000, "status": "TRADING", "underlyingType": "COIN"}, {"symbol": "TSLAUSDT", "contractType": "PERPETUAL", "underlyingType": "EQUITY"}]})
    assert set(b) == {"BTCUSDT"} and b["BTCUSDT"].expiry is None and b["BTCUSDT"].instrument_type == "perpetual"
    with pytest.raises(ValueError, match="disabled"):
        V.raw(spark.createDataFrame([("[]",)], "payload string"), "bitmex", "spot")


def test_every_feed_takes_an_empty_payload_of_its_shape(spark):
    empty = {"objects": [], "map": {}, "arrays": [], "parallel": [{"universe": []}, []]}
    for f in V.FEEDS:
        body = empty[f.shape]
        for key in reversed(f.path.split(".")[1:]):
            body = {key: body}
        assert read(spark, f.venue, f.product, body) == {}


def test_generation_round_trip(spark, tmp_path, capsys):
    names = [f.name for f in market_schema().fields]
    row = lambda **kw: tuple(kw.get(n) for n in names)
    states = spark.createDataFrame([row(asset_id=f"asset:x:{k}", symbol=f"S{k % 4}", venue_count=k, reported_volume_24h_usd=float(k) if k else None, name="Alpha" if k == 1 else None) for k in range(5)], market_schema())
    nested = spark.range(1).select(F.lit(1).alias("a"), F.struct(F.lit(2).alias("c"), F.struct(F.lit("x").alias("e"), F.array(F.lit(1), F.lit(2)).alias("f")).alias("d")).alias("b"))
    D.write_generation(spark, str(tmp_path), "g1", states, {"nested": nested}, shards=4)
    c = D.MarketClient.latest(spark, str(tmp_path))
    assert c.verify() >= 2 and c.asset_count() == 5 and c.qualified_asset_count(3) == 2
    assert spark.read.parquet(f"{tmp_path}/generations/g1/nested").first().asDict() == {"a": 1, "b__c": 2, "b__d__e": "x", "b__d__f": "[1,2]"}
    assert c.asset("S3").asset_id == "asset:x:3" and c.asset("asset:x:0").symbol == "S0"
    with pytest.raises(D.AmbiguousAsset):
        c.asset("S0")
    with pytest.raises(D.AssetNotFound):
        c.asset("nothing")
    assert [r.asset_id for r in c.search("ALPH").collect()] == ["asset:x:1"]
    assert [r.asset_id for r in c.top_by_volume(2).collect()] == ["asset:x:4", "asset:x:3"]
    assert [r.asset for r in c.query("SELECT asset FROM market WHERE venue_count = 2").collect()] == ["S2"]
    assert D.overview(c.market())["totals"].first().assets == 5
    assert D.unflattened(c.asset("S3"))["reference_price"]["value"] is None
    assert cli.main([str(tmp_path), "status"]) == 0 and cli.main([str(tmp_path), "asset", "no"]) == 1 and cli.main([str(tmp_path), "query", "SELECT asset FROM market"]) == 0
    assert c.view("S3").asset_id == "asset:x:3" and D.MarketClient.of(spark, str(tmp_path), "g1").asset_count() == 5
    with pytest.raises(AttributeError):
        c.view("S3").nothing
    assert len(D.export_web(c, str(tmp_path / "web"), 2)) == 3 and cli.main([str(tmp_path), "export-web", str(tmp_path / "web2")]) == 0
    assert cli.main([str(tmp_path), "methodology"]) == 0 and cli.main([str(tmp_path), "housekeeping"]) == 0 and cli.main([str(tmp_path), "compact-day", str(tmp_path / "day")]) == 0
    assert spark.read.parquet(str(tmp_path / "day")).count() == 5 and D.expired(spark, str(tmp_path)) == []
    with pytest.raises(D.NotPublishable):
        D.write_generation(spark, str(tmp_path), "g2", states.union(states), {}, shards=4)
    assert D.MarketClient.latest(spark, str(tmp_path)).manifest["generation"] == "g1"
    victim = next((tmp_path / "generations/g1").rglob("*.parquet"))
    victim.write_bytes(victim.read_bytes() + b"x")
    victim.with_name(f".{victim.name}.crc").unlink()  # else the file system itself refuses the file
    with pytest.raises(D.ChecksumMismatch):
        c.verify()
