import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import ingest, series, storage, universes
from tidemark.operators.liquidity import build_levels, depth_bands, walk
from tidemark.streaming import live


@pytest.mark.parametrize("text,want", [("1.5", 1.5), (" 2 ", 2.0), ("", None), ("-", None), ("n/a", None), ("NaN", None), ("inf", None), ("true", None), ("1e3", 1000.0), ("x", None), (None, None), ("-0.5", -0.5)])
def test_numbers(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(C.parse_number(F.col("t"))).first()[0] == want


def test_depth_three_cases(spark):
    schema = "asset int, venue int, side string, price double, size double, reference_price double, quote_usd double, kind string, inverse boolean, multiplier double"
    rows = [(1, 1, "bid", 99.99, 2.0, 100.0, 1.0, "spot", False, None), (2, 1, "bid", 50.0, 2.0, 100.0, 1.0, "spot", False, None), (3, 1, "bid", 99.99, 2.0, 100.0, 1.0, "perpetual", False, None)]
    got = {r.asset: (r.depth_5_bid, r.depth_5_ask) for r in depth_bands(spark.createDataFrame(rows, schema), ["asset"]).collect()}
    assert got[1] == (pytest.approx(199.98), None) and got[2] == (0.0, None) and got[3] == (None, None)
    w = {r.asset: r.impact_bps for r in walk(spark.createDataFrame(rows, schema), ["asset"], 150.0).collect()}
    assert w[1] == pytest.approx(1.0) and w[2] is None


def test_levels(spark):
    df = spark.createDataFrame([([["3", "1"], ["x", "1"], ["5", "0"], ["4", "2"], ["2", "9"]],)], "r array<array<string>>")
    b = df.select(build_levels(F.col("r"), 2, True).alias("b")).first().b
    assert [(x.price, x.size) for x in b.levels] == [(4.0, 2.0), (3.0, 1.0)] and b.truncated


def test_book_plan_against_a_plain_fold(spark):
    import random
    from collections import Counter

    from tidemark.operators import universes

    r = random.Random(8)
    for total, per_venue, per_asset, assets, venues in ((20, 5, 2, 6, 3), (20, 5, 2, 60, 9), (12, 12, 1, 30, 2), (30, 3, 3, 4, 40)):
        rows = [(r.randrange(assets), r.randrange(venues), f"i{k:04d}", r.randrange(40)) for k in range(500)]
        by_asset, by_venue, want = Counter(), Counter(), []
        for a, v, i, rank in sorted(rows, key=lambda x: (x[3], x[2])):
            if len(want) < total and by_asset[a] < per_asset and by_venue[v] < per_venue:
                by_asset[a] += 1
                by_venue[v] += 1
                want.append((a, v, i, rank, len(want) + 1))
        got = universes.book_plan(spark.createDataFrame(rows, "asset long, venue long, instrument string, rank long"), total, per_venue, per_asset).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_book_plan_skips_without_spending(spark):
    rows = [(1, 1, f"a{k}", k) for k in range(3)] + [(2, 1, "b", 3), (3, 2, "c", 4)]
    got = universes.book_plan(spark.createDataFrame(rows, "asset long, venue long, instrument string, rank long"), total=4, per_venue=3, per_asset=2)
    assert [r.instrument for r in got.orderBy("rank").collect()] == ["a0", "a1", "b", "c"]


def test_universes_and_unknown(spark):
    df = spark.createDataFrame([("a", "resolved", 3, 2e6, 1, 0, 5.0), ("b", "probable", 9, 9e9, 1, 1, 9.0)], "asset_id string, resolution_state string, venue_count int, volume double, spot_venues int, perp_venues int, depth_50 double")
    assert [universes.universe(df, n).count() for n in ("all_resolved", "multi_venue", "liquid", "spot_only", "derivative_active", "top_100")] == [1, 1, 1, 1, 0, 1]
    with pytest.raises(ValueError):
        universes.universe(df, "nothing")


def test_best_path_prefers_fewer_hops_and_stated_rates(spark):
    e = spark.createDataFrame([("a", "usd", 2.0, "v2", 5), ("a", "usd", 2.1, "v1", 4), ("usd", "a", 0.25, "v0", 1), ("b", "a", 3.0, "v1", 2), ("x", "y", 1.0, "v1", 1)], "src string, dst string, rate double, venue string, observed_at long")
    got = {r.currency: (r.rate, r.hops, r.source, r.observed_at) for r in ingest.best_paths(e, "usd").collect()}
    assert got == {"a": (2.1, 1, "v1", 4), "b": (pytest.approx(6.3), 2, "v1", 2)}


def test_rsi_needs_history_and_knows_flat(spark):
    df = spark.createDataFrame([(1, [1.0] * 20), (2, [1.0] * 5), (3, [float(k) for k in range(20)])], "k int, p array<double>")
    assert [r[0] for r in df.orderBy("k").select(series.rsi(F.col("p"))).collect()] == [50.0, None, 100.0]


def test_measures_in_one_pass_say_the_same(spark):
    import random

    r = random.Random(3)
    rows = [(a, 900_000 * k + r.randint(0, 800_000), k, r.choice((0.0, 1.0, 2.5, r.random() * 9))) for a in range(4) for k in range(r.randint(1, 60)) if r.random() < 0.9]
    p = spark.createDataFrame(rows, "asset int, ts_ms long, id long, price double")
    m = {x.asset: x for x in series.measures(p, {"1h": 1, "4h": 4}, {"1h": (1, 2), "4h": (4, 3)}).collect()}
    same = lambda a, b: a == b or (a is not None and b is not None and abs(a - b) < 1e-9)
    for w, hours, least in (("1h", 1, 2), ("4h", 4, 3)):
        assert all(same(x.change, m[x.asset][f"change_{w}"]) for x in series.window_returns(p, hours).collect())
        assert all(same(x.realised, m[x.asset][f"realised_{w}"]) for x in series.volatility(p, hours, least).collect())
    assert all(same(x.atr_bps, m[x.asset].atr_bps) for x in series.true_range(p).collect())
    assert all(x.prices == m[x.asset].prices for x in series.paths(p).collect())


def test_missing_slots_are_not_filled(spark):
    day = 1_704_067_200_000
    df = spark.createDataFrame([(day + k * C.SLOT_MS,) for k in range(96) if k not in (3, 95)], "ms long")
    assert sorted((r.slot - day) // C.SLOT_MS for r in storage.missing_slots(df, "ms").collect()) == [3, 95]


def test_live_expiry_and_majority(spark):
    rows = [(1, v, 100.0 + off, 0.0) for v, off in enumerate((0.0, 0.1, 0.2, 50.0))] + [(1, 9, 100.0, 9e6)]
    q = spark.createDataFrame([(a, v, None, None, p, 1.0, None, int(10_000_000 - age), 0) for a, v, p, age in rows], "asset int, venue int, bid double, ask double, last double, volume double, mark double, price_ms long, seen_ms long")
    got = {r.venue: r.reason for r in live.judged(q, F.lit(10_000_000)).collect()}
    assert got == {0: None, 1: None, 2: None, 3: "outlier", 9: "stale"}


def test_subscriptions():
    from tidemark.streaming import frames

    of = lambda name, symbols: [json.loads(x) for x in frames.subscribe_frames(frames.BY_NAME[name], symbols)]
    assert of("binance", ["A"]) == []
    assert of("bybit_spot", [f"S{k}" for k in range(12)]) == [{"op": "subscribe", "args": [f"tickers.S{k}" for k in range(10)]}, {"op": "subscribe", "args": ["tickers.S10", "tickers.S11"]}]
    assert of("okx", ["A-B"]) == [{"op": "subscribe", "args": [{"channel": "tickers", "instId": "A-B"}]}]
    assert of("bitget", ["AB"])[0]["args"] == [{"instType": "SPOT", "channel": "ticker", "instId": "AB"}]
    assert of("deribit", ["X"])[0]["params"] == {"channels": ["ticker.X.100ms"]} and of("coinbase", ["A-B"])[0]["product_ids"] == ["A-B"]


def test_one_candidate_per_venue_and_lost_feeds(spark):
    now = 1_000_000
    quotes = spark.createDataFrame([(1, 1, "a", "USD", None, None, 10.0, 5.0, None, now), (1, 1, "b", "USDT", None, None, 10.1, 9.0, None, now), (1, 2, "a", "USD", None, None, 10.2, 1.0, None, now), (1, 3, "a", "USD", 9.9, 10.1, 10.2, None, 3.0, now - 400_000), (1, 4, "a", "XYZ", None, None, 9.0, 1.0, None, now), (1, 5, "a", "USD", None, None, 9.0, 1.0, None, now)], "asset int, venue int, symbol string, quote string, bid double, ask double, last double, quote_volume double, base_volume double, price_ms long")
    rates = spark.createDataFrame([("USD", 1.0), ("USDT", 0.999)], "quote string, rate double")
    feeds = spark.createDataFrame([(1, True, 0), (2, False, now - 19_000), (3, True, 0), (4, True, 0), (5, False, now - 21_000)], "venue int, connected boolean, changed_ms long")
    found = live.usd_candidates(quotes, rates, feeds, F.lit(now))
    assert {(r.venue, r.symbol): r.early for r in found.collect()} == {(1, "a"): None, (1, "b"): None, (2, "a"): None, (3, "a"): "stale", (4, "a"): "unusable", (5, "a"): "feed_disconnected"}
    assert sorted((r.venue, r.symbol) for r in live.one_per_venue(found).collect()) == [(1, "b"), (2, "a")]
    state = live.live_states(found, spark.createDataFrame([(1, 10.0)], "asset int, published double")).first()
    assert (state.venues_used, state.venues_seen, state.method) == (2, 4, "robust_weighted_median")


def test_stablecoin_off_parity_is_ignored(spark):
    ticks = spark.createDataFrame([("U", 1, 1, 0.999, 1.001, None), ("U", 2, 2, None, None, 0.9), ("V", 1, 1, 1.2, 1.1, 1.01)], "quote string, ts_ms long, id long, bid double, ask double, last double")
    assert {r.quote: round(r.rate, 6) for r in live.probed_rates(ticks).collect()} == {"U": 1.0, "V": 1.01}


def test_rest_works_without_the_corpus_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for name in ("__spark_entry__.py",):
        (tmp_path / name).write_text((root / name).read_text())
    (tmp_path / "tidemark").mkdir()
    for p in (root / "tidemark").iterdir():
        if p.name != "llm":
            (tmp_path / "tidemark" / p.name).symlink_to(p)
    (tmp_path / "tests").mkdir()
    for name in ("__init__.py", "conftest.py", "test_mql.py"):
        if (root / "tests" / name).exists():
            (tmp_path / "tests" / name).write_text((root / "tests" / name).read_text())
    code = "import json, __spark_entry__ as e; q = e.queries(); print(json.dumps([len(q), 'pipeline' in q, sorted(k for k in e.oracle_sql() if k not in q)]))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    found = json.loads(out.stdout.splitlines()[-1])
    assert found[0] > 150 and found[1:] == [False, []], out.stderr
    run = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_mql.py", "-k", "not series"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path), "PYSPARK_PYTHON": sys.executable}, capture_output=True, text=True)
    assert run.returncode == 0, run.stdout[-2000:]


def test_a_missing_dependency_is_an_error(tmp_path):
    """Corpus operators that are there but cannot be imported do not vanish in silence."""
    root = Path(__file__).resolve().parent.parent
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_nobody_has")
    (tmp_path / "tidemark").mkdir()
    for p in (root / "tidemark").iterdir():
        if p.name != "llm":
            (tmp_path / "tidemark" / p.name).symlink_to(p)
    (tmp_path / "tidemark" / "llm").mkdir()
    (tmp_path / "tidemark" / "llm" / "__init__.py").write_text("")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert out.returncode and "a_module_that_nobody_has" in out.stderr
