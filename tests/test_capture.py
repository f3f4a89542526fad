"""Captured frames: frames written by hand for each feed, faults, ranges of files, and a stream over files that grow."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import capture, frames

NOW = 1_790_000_000_000
#: For each feed a frame as its venue documents it, and the ticks that it means: symbol, event time and what is told.
FRAMES = {
    "binance": ([{"e": "24hrMiniTicker", "E": NOW + 1, "s": "AAAUSDT", "c": "12.50", "o": "12", "h": "13", "l": "11", "v": "1000", "q": "12345.5"}, {"E": NOW + 2, "s": "BBBUSDT", "c": "0", "q": ""}, {"E": 5, "c": "1"}],
                [("AAAUSDT", NOW + 1, {"last": 12.5, "quote_volume_24h": 12345.5, "base_volume_24h": 1000.0}), ("BBBUSDT", NOW + 2, {})]),
    "bybit_spot": ({"topic": "tickers.AAAUSDT", "ts": NOW + 3, "type": "snapshot", "data": {"symbol": "AAAUSDT", "lastPrice": "7.25", "turnover24h": "88.5", "volume24h": "12"}}, [("AAAUSDT", NOW + 3, {"last": 7.25, "quote_volume_24h": 88.5, "base_volume_24h": 12.0})]),
    "bybit_linear": ({"topic": "tickers.AAAUSDT", "type": "delta", "ts": NOW + 4, "data": {"symbol": "AAAUSDT", "markPrice": "7.26", "indexPrice": "7.24", "bid1Price": "7.2", "ask1Price": "7.3", "fundingRate": "-0.0001", "fundingIntervalHour": "4", "openInterest": "9", "openInterestValue": "65.5"}},
                     [("AAAUSDT", NOW + 4, {"mark": 7.26, "index": 7.24, "bid": 7.2, "ask": 7.3, "funding_rate": -0.0001, "funding_interval_hours": 4.0, "open_interest_usd": 65.5})]),
    "okx": ({"arg": {"channel": "tickers", "instId": "AAA-USDT"}, "data": [{"instType": "SPOT", "instId": "AAA-USDT", "last": "3", "bidPx": "2.9", "askPx": "3.1", "volCcy24h": "300", "vol24h": "100", "ts": str(NOW + 5)}]},
            [("AAA-USDT", NOW + 5, {"last": 3.0, "bid": 2.9, "ask": 3.1, "quote_volume_24h": 300.0, "base_volume_24h": 100.0})]),
    "coinbase": ({"type": "ticker", "product_id": "AAA-USD", "price": "5.5", "best_bid": "5.4", "best_ask": "5.6", "volume_24h": "77", "volume_30d": "9", "time": "2026-09-21T13:46:40.006123Z"}, [("AAA-USD", 1_789_998_400_006, {"last": 5.5, "bid": 5.4, "ask": 5.6, "base_volume_24h": 77.0})]),
    "gateio": ({"time": 1, "time_ms": NOW + 7, "channel": "spot.tickers", "event": "update", "result": {"currency_pair": "AAA_USDT", "last": "4", "lowest_ask": "4.1", "highest_bid": "3.9", "base_volume": "10", "quote_volume": "40"}},
               [("AAA_USDT", NOW + 7, {"last": 4.0, "bid": 3.9, "ask": 4.1, "base_volume_24h": 10.0, "quote_volume_24h": 40.0})]),
    "bitget": ({"action": "snapshot", "arg": {"instType": "SPOT", "channel": "ticker", "instId": "AAAUSDT"}, "data": [{"instId": "AAAUSDT", "lastPr": "6", "bidPr": "5.9", "askPr": "6.1", "baseVolume": "20", "quoteVolume": "120", "ts": str(NOW + 8)}]},
               [("AAAUSDT", NOW + 8, {"last": 6.0, "bid": 5.9, "ask": 6.1, "base_volume_24h": 20.0, "quote_volume_24h": 120.0})]),
    "cryptocom": ({"id": -1, "method": "subscribe", "result": {"channel": "ticker", "data": [{"i": "AAA_USDT", "a": "8", "b": "7.9", "k": "8.1", "v": "30", "vv": "240", "t": NOW + 9}]}}, [("AAA_USDT", NOW + 9, {"last": 8.0, "bid": 7.9, "ask": 8.1, "base_volume_24h": 30.0})]),
    "deribit": ({"jsonrpc": "2.0", "method": "subscription", "params": {"channel": "ticker.AAA-PERPETUAL.100ms", "data": {"instrument_name": "AAA-PERPETUAL", "last_price": 9.5, "best_bid_price": 9.4, "best_ask_price": 9.6, "mark_price": 9.51, "index_price": 9.49, "funding_8h": 0.00002, "open_interest": 1000, "timestamp": NOW + 10}}},
                [("AAA-PERPETUAL", NOW + 10, {"last": 9.5, "bid": 9.4, "ask": 9.6, "mark": 9.51, "index": 9.49, "funding_rate": 0.00002, "funding_interval_hours": 8.0, "open_interest_usd": 1000.0})]),
}
#: Frames that mean nothing and are no faults.
SILENT = {
    "binance": ['{"result":null,"id":1}', "[]"], "bybit_spot": ['{"success":true,"op":"ping"}'], "bybit_linear": ['{"topic":"tickers.A","data":[1]}', '{"topic":"tickers.A","data":{"lastPrice":"1"}}'], "okx": ["pong", '{"event":"subscribe","arg":{"channel":"tickers"}}', '{"arg":5,"data":[1]}'],
    "coinbase": ['{"type":"subscriptions"}', '{"type":"ticker"}'], "gateio": ['{"channel":"spot.tickers","event":"subscribe","result":{"status":"success"}}', '{"channel":"spot.tickers","event":"update","result":[]}'], "bitget": ["pong"],
    "cryptocom": ['{"id": 7, "method": "public/heartbeat"}', '{"result":{"channel":"ticker","data":null}}'], "deribit": ['{"method":"subscription","params":null}', '{"id":1,"result":["x"]}'],
}
#: Frames that a parser cannot take, and why.
FAULTY = {
    "binance": [("[1]", "row_not_an_object"), ("pong", "not_json")], "bybit_spot": [("[]", "not_an_object"), ("{", "not_json")], "bybit_linear": [("3", "not_an_object")], "okx": [('{"arg":{"channel":"tickers"},"data":[{"instId":"A"},4]}', "row_not_an_object"), ("ping", "not_json")],
    "coinbase": [("null", "not_an_object")], "gateio": [('"x"', "not_an_object")], "bitget": [("[[]]", "not_an_object")], "cryptocom": [('{"result":{"channel":"ticker","data":{"i":"A"}}}', "rows_not_a_list"), ('{"result":{"channel":"ticker","data":[5]}}', "row_not_an_object")],
    "deribit": [('{"method":"subscription","params":[1]}', "holder_not_an_object"), ("", "not_json")],
}


def lines():
    out = []
    for feed in FRAMES:
        for frame in [json.dumps(FRAMES[feed][0]), *SILENT[feed], *(f for f, _ in FAULTY[feed])]:
            out.append(json.dumps({"feed": feed, "received_ms": NOW, "frame": frame}))
    return out + ["no line of a capture", json.dumps({"feed": "other", "received_ms": 1, "frame": "{}"}), json.dumps({"feed": "okx", "frame": "{}"})]


def told(rows):
    return {(r.feed, r.symbol, r.event_ms, tuple((n, r[n]) for n in frames.TICK if r[n] is not None)) for r in rows}


def wanted():
    return {(feed, symbol, at, tuple((n, values[n]) for n in frames.TICK if n in values)) for feed, (_, ticks) in FRAMES.items() for symbol, at, values in ticks}


@pytest.mark.parametrize("split", [64 << 20, 700])
def test_frames_of_all_feeds(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(capture, "SPLIT", split)  # ranges of bytes cut lines anywhere
    said = lines()
    (tmp_path / "a.jsonl").write_text("\n".join(said[:20]) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join(said[20:]))
    (tmp_path / "_other").write_text("not read")
    got = capture.captured(spark, str(tmp_path))
    assert got.count() == len(said)
    assert told(capture.ticks(got).collect()) == wanted()
    faults = sorted((r.feed or "", r.fault) for r in capture.faults(got).collect())
    assert faults == sorted([(feed, why) for feed, fs in FAULTY.items() for _, why in fs] + [("", "no_capture_line"), ("", "no_capture_line"), ("other", "unknown_feed")])
    assert [json.loads(r.reply) for r in capture.replies(got).collect()] == [{"id": 7, "method": "public/respond-heartbeat"}]


def test_mappings_miss_what_is_renamed(spark):
    """Each value of the frames by hand is read under its own key: with the key gone, so is the value."""
    cases = [(feed, name, key) for feed, (_, ticks) in FRAMES.items() for name, key in frames.BY_NAME[feed].fields.items() if name in ticks[0][2]]
    texts = [json.dumps(FRAMES[feed][0]).replace(f'"{key}":', f'"{key}_":') for feed, _, key in cases]
    made = spark.createDataFrame([(feed, k, text, "array" if text.startswith("[") else "object") for k, ((feed, *_), text) in enumerate(zip(cases, texts))], "feed string, received_ms long, frame string, shape string")
    got = {r.received_ms: r for r in capture.ticks(made).collect() if r.symbol == FRAMES[r.feed][1][0][0]}
    for k, (feed, name, _) in enumerate(cases):
        assert got[k][name] is None, (feed, name)
        assert all(got[k][n] == v for n, v in FRAMES[feed][1][0][2].items() if n != name)
    assert len(cases) > 35


def test_stream_over_growing_files(spark, tmp_path):
    """What is appended comes with the next batch; a line that is half written waits; a restart goes on where it stopped."""
    folder, said = tmp_path / "capture", lines()
    folder.mkdir()
    first = folder / "a.jsonl"
    first.write_text("\n".join(said[:5]) + "\n" + said[5][:10])

    def run():
        query = capture.captured(spark, str(folder), stream=True).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").start()
        query.processAllAvailable()
        return query

    query = run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    with first.open("a") as f:
        f.write(said[5][10:] + "\n")
    (folder / "b.jsonl").write_text("\n".join(said[6:20]) + "\n")
    query.processAllAvailable()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 20
    query.stop()
    with first.open("a") as f:
        f.write("\n".join(said[20:]) + "\n")
    run().stop()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == len(said) == got.select("file", "at").distinct().count()
    assert told(capture.ticks(got).collect()) == wanted()


def test_rows_are_parsed_once(spark):
    """A row of a frame is parsed once, not for each of its values."""
    frames = spark.createDataFrame([], capture.SCHEMA)
    plan = capture.ticks(frames)._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapType") == len(capture.FEEDS)
