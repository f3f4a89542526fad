"""The live book as a stream: against the batch expressions, against a plain replay, and with timers alone."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import book, live

START = 1_700_000_000_000
MARKETS = [(v, s, q, rate, v != "v3") for v in ("v0", "v1", "v2", "v3", "v4") for s, q, rate in (("m0", "USD", 1.0), ("m1", "USDT", 0.9997), ("m2", "XYZ", None))]


def ticks(seed, n, assets="AB", start=START, span=60_000):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        v, s, *_ = r.choice(MARKETS)
        price = 100 * (1 + r.choice([0.0001, 0.0002, 0.001, 0.2]) * r.random())
        values = [r.choice([None, price * 0.9999, price * 1.2]), r.choice([None, price * 1.0001]), r.choice([None, price]), r.choice([None, 10.0**r.randrange(2, 7)]), r.choice([None, 50.0])]
        rows.append((r.choice(assets), start + r.randrange(1, span), k, v, s, *values, None, None))
    return rows


def listing(asset, version, ts, markets):
    return (asset, ts, -1, None, None, *[None] * 5, version, markets)


class Replay:
    """The book by the letter: every tick in order, every look in full."""

    def __init__(self, pace):
        self.pace, self.known, self.listed, self.told, self.out = pace, {}, {}, {}, []

    def batch(self, rows, watermark):
        for row in rows:
            if row[-1] is not None:
                markets = {(m[0], m[1]): m for m in row[-1]}
                self.known = {k: q for k, q in self.known.items() if k[0] != row[0] or k[1:] in markets}
                self.listed[row[0]] = markets
        for row in sorted((x for x in rows if x[-1] is None), key=lambda x: (x[1], x[2])):
            if row[3:5] in self.listed.get(row[0], {}):
                q = self.known.setdefault((row[0], *row[3:5]), dict.fromkeys((*book.FIELDS, "price_ms")))
                for f, v in zip(book.FIELDS, row[5:10]):
                    if v is not None:
                        q[f] = v
                        q["price_ms"] = row[1] if f in book.PRICES else q["price_ms"]
        for asset in {x[0] for x in rows}:
            self.look(asset, max([x[1] for x in rows if x[0] == asset] + [watermark]))

    def look(self, asset, now):
        n, price, venues = self.told.get(asset, (0, None, 0))
        markets = [(*k[1:], q, *self.listed[asset][k[1:]][3:]) for k, q in self.known.items() if k[0] == asset]
        state = book.valued(markets, now, self.pace.stale_ms)
        if state is None and price is not None or state is not None and (price != state["price"] or venues != state["venues_used"]):
            self.told[asset] = (n + 1, state and state["price"], state["venues_used"] if state else 0)
            self.out.append((asset, n + 1, now, state and state["price"], state["venues_used"] if state else 0))
        due = [q["price_ms"] + self.pace.stale_ms + 1 for *_, q, _, connected in markets if connected and q["price_ms"] is not None and now <= q["price_ms"] + self.pace.stale_ms]
        self.due = getattr(self, "due", {}) | {asset: min(due, default=None)}

    def fire(self, watermark):
        for asset, at in list(self.due.items()):
            if at is not None and at <= watermark:
                self.look(asset, max(at, watermark))


def test_values_against_batch_expressions(spark):
    """The few lines of arithmetic in the state say what live_states says."""
    now = START + 70_000
    rows = [t[:10] for t in ticks(1, 600, [f"a{k}" for k in range(40)])]
    df = spark.createDataFrame(rows, "asset string, ts_ms long, id long, venue string, symbol string, " + ", ".join(f"{f} double" for f in book.FIELDS))
    listed = spark.createDataFrame(MARKETS, "venue string, symbol string, quote string, rate double, connected boolean")
    quotes = live.merged(df, ("asset", "venue", "symbol"), book.FIELDS).join(listed.select("venue", "symbol", "quote"), ["venue", "symbol"])
    feeds = listed.select("venue", "connected").distinct().withColumn("changed_ms", F.lit(0))
    rates = listed.filter("rate is not null").select("quote", "rate").distinct()
    found = live.usd_candidates(quotes, rates, feeds, F.lit(now), 50.0)
    want = {r.asset: r for r in live.live_states(found, df.select("asset").distinct().withColumn("published", F.lit(100.0)), 50.0).collect()}
    by_asset = {}
    for r in quotes.collect():
        by_asset.setdefault(r.asset, []).append((r.venue, r.symbol, r.asDict(), {"USD": 1.0, "USDT": 0.9997}.get(r.quote), r.venue != "v3"))
    got = {a: book.valued(m, now, 50_000) for a, m in by_asset.items()}
    assert {a for a, s in got.items() if s} == set(want) and len(want) > 20
    for a, w in want.items():
        g = got[a]
        assert (g["method"], g["venues_used"], g["venues_seen"]) == (w.method, w.venues_used, w.venues_seen)
        for name in ("price", "dispersion_bps", "volume_24h_usd"):
            assert (g[name] is None and w[name] is None) or g[name] == pytest.approx(w[name], rel=1e-9), (a, name, g, w, by_asset[a])


def test_stream_equals_replay(spark, tmp_path):
    """After each batch, timers included, the stream has told what a plain replay tells."""
    pace = book.Pace(stale_ms=30_000, look_ms=0, heartbeat_ms=None)
    every, some = list(MARKETS), [m for m in MARKETS if m[1] == "m0"]
    steps = [
        [listing("A", 1, START, every), listing("B", 1, START, every), *ticks(2, 60)],
        ticks(3, 8, "A", START + 61_000, 500),  # quotes of B begin to expire by the time that A's ticks bring
        [listing("A", 2, START + 62_000, some), listing("B", 2, START + 62_000, []), *ticks(4, 30, "AB", START + 62_000, 20_000)],
        [listing("A", 3, START + 90_000, every), listing("B", 3, START + 90_000, every), *ticks(5, 20, "A", START + 90_000, 5_000)],
        ticks(6, 5, "C", START + 300_000, 5_000),  # an asset that nobody follows moves the clock; all else expires
    ]
    replay, watermark = Replay(pace), 0
    for rows in steps:
        replay.batch([x for x in rows], watermark)
        watermark = max(x[1] for x in rows)
        replay.fire(watermark)
    frames = [spark.createDataFrame(rows, book.INPUT) for rows in steps]
    got = book.told_in_steps(frames, str(tmp_path), pace).collect()
    assert sorted((r.asset, r.n, r.at_ms, r.price, r.venues_used) for r in got) == sorted(replay.out)
    assert {a for a, *_ in replay.out} == {"A", "B"} and any(p is None for _, _, _, p, _ in replay.out)
    last = {r.asset: r.price for r in book.latest_told(spark.read.schema(book.TOLD).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out")).collect()}
    assert last == {"A": None, "B": None}


def test_timers_without_ticks(spark, tmp_path):
    """With the machine's clock a quote is told, told again by the heartbeat, waits for the next look, and expires, while no tick comes."""
    now = int(time.time() * 1000)
    row = lambda ts, k, last: ("A", ts, k, "v0", "m0", None, None, last, None, None, None, None)
    spark.createDataFrame([listing("A", 1, now, MARKETS), row(now, 1, 100.0)], book.INPUT).write.parquet(f"{tmp_path}/in")
    stream, out = spark.readStream.schema(book.INPUT).parquet(f"{tmp_path}/in"), []
    run = book.live_book(stream, book.Pace(stale_ms=12_000, look_ms=4_000, heartbeat_ms=6_000), "processing").writeStream.outputMode("update").foreachBatch(lambda b, k: out.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="500 milliseconds").start()
    try:
        deadline = time.time() + 90
        while not out and time.time() < deadline:
            time.sleep(0.2)
        spark.createDataFrame([row(now, 2, 101.0)], book.INPUT).write.mode("append").parquet(f"{tmp_path}/in")  # too soon after the first to be looked at
        while (not out or out[-1].price is not None) and time.time() < deadline:
            time.sleep(0.5)
    finally:
        run.stop()
    assert [r.n for r in out] == list(range(1, len(out) + 1)) and out[0].price == 100.0
    assert out[-1].price is None and out[-1].at_ms >= now + 12_000
    told = [r for r in out if r.price == 101.0]
    assert told and told[0].at_ms >= out[0].at_ms + 4_000


def test_listing_changes(spark):
    schema = "asset string, venue string, symbol string, quote string, rate double, connected boolean"
    before = spark.createDataFrame([("A", "v", "s", "USD", 1.0, True), ("B", "v", "s", "USD", 1.0, True)], schema)
    after = spark.createDataFrame([("A", "v", "t", "USD", 1.0, True), ("C", "v", "s", "USD", 1.0, True)], schema)
    got = {r.asset: [m.symbol for m in r.markets] for r in book.listing_changes(before, after, 2, 5).collect()}
    assert got == {"A": ["t"], "B": [], "C": ["s"]}
    assert book.listing_changes(None, after, 1, 5).count() == 2


def test_calls_to_the_state_do_not_grow_with_markets():
    """What a batch tells of an asset is read and written with as many calls, however many markets it has."""

    class Handle:
        def __init__(self):
            self.calls, self.kept = 0, {}

        def getValueState(self, name, *_):
            return self.Value(self, name)

        getMapState = getValueState

        def registerTimer(self, at):
            self.calls += 1

        deleteTimer = registerTimer

        class Value:
            def __init__(self, handle, name):
                self.handle, self.name = handle, name

            def get(self):
                self.handle.calls += 1
                return self.handle.kept.get(self.name)

            def update(self, value):
                self.handle.calls += 1
                self.handle.kept[self.name] = value

    class Timers:
        getCurrentProcessingTimeInMs = getCurrentWatermarkInMs = lambda self: START

    def calls(markets):
        handle, own = Handle(), book.LiveBook(book.Pace(heartbeat_ms=None))
        own.init(handle)
        names = [f"m{k}" for k in range(markets)]
        said = [{"ts_ms": START, "id": -1, "version": 1, "markets": [{"venue": "v", "symbol": m, "quote": "USD", "rate": 1.0, "connected": True} for m in names]}, *({"ts_ms": START, "id": k, "venue": "v", "symbol": m, "last": 100.0} for k, m in enumerate(names))]
        told = list(own.handleInputRows(("A",), iter([{"said": json.dumps(x)} for x in said]), Timers()))
        assert [t.price for t in told] == [100.0]
        return handle.calls

    assert calls(2) == calls(40) <= 3


def test_stream_rests_while_a_step_is_written(spark, tmp_path):
    """Files of a step come one by one; a stream that runs then would take the first and drop the others as late."""

    class Step:
        sparkSession = spark
        running = []

        def __init__(self, rows):
            self.frame = spark.createDataFrame(rows, book.INPUT)

        @property
        def write(self):
            self.running.append(len(spark.streams.active))
            return self.frame.write

    tick = lambda k, price: ("A", START + k, k, "v0", "m0", None, None, price, None, None, None, None)
    steps = [Step([listing("A", 1, START, MARKETS), tick(1, 100.0)]), Step([tick(2, 101.0)])]
    told = book.told_in_steps(steps, str(tmp_path), book.Pace(look_ms=0, heartbeat_ms=None))
    assert sorted((t.n, t.price) for t in told.collect()) == [(1, 100.0), (2, 101.0)] and Step.running == [0, 0]
