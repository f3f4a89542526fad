"""The live book as a stateful stream: quotes merge, age and expire, and states are told while the stream runs.

Rows come by asset: ticks (partial updates of one market) and listings (the
markets of the asset in a generation of the universe; none if it is no longer
followed). State is a row for each followed market and what was last told, so it
grows with the universe and not with time. A listing holds from the micro-batch
that it comes in: markets that stay keep their state, others lose it.

Timers tell what happens without ticks: a quote that expires, a state that had to
wait for the next look, and a heartbeat. The clock is the watermark and the
newest tick of the asset (`event`, for replays) or that of the machine
(`processing`); in the latter, a quote that no tick has renewed also has a time to
live, after which it counts as never heard of.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.pricing import FRESHNESS_FLOOR, SOURCE_QUALITY
from tidemark.streaming import live

PRICES = ("bid", "ask", "last")
FIELDS = (*PRICES, "quote_volume", "base_volume")
MARKET = "venue string, symbol string"
#: What is known of a market: each field with the (ts_ms, id) that it is from, and when a price last came.
QUOTE = ", ".join(f"{f} double, {f}_ms long, {f}_id long" for f in FIELDS) + ", price_ms long"
INPUT = f"asset string, ts_ms long, id long, {MARKET}, {', '.join(f'{f} double' for f in FIELDS)}, version int, markets array<struct<venue:string,symbol:string,quote:string,rate:double,connected:boolean>>"
TOLD = "asset string, n long, at_ms long, price double, method string, venues_used int, venues_seen int, dispersion_bps double, volume_24h_usd double"


@dataclass(frozen=True)
class Pace:
    """How long quotes count, how often an asset is looked at, and when a state is told again though nothing changed (None: never)."""

    stale_ms: int = int(live.STALE_S * 1000)
    look_ms: int = live.EMIT_MS
    heartbeat_ms: int | None = live.HEARTBEAT_MS
    least_move_bps: float = 0.0


def _median(pairs: list[tuple[float, float]]) -> float | None:
    """Weighted median of sorted (value, weight); the mean of two values where the first has exactly half."""
    pairs = [p for p in pairs if p[1] > 0]
    half, run = sum(w for _, w in pairs) / 2, 0.0
    for k, (x, w) in enumerate(pairs):
        run += w
        if run >= half:
            return (x + pairs[k + 1][0]) / 2 if run == half and k + 1 < len(pairs) else x
    return None


def _capped(weights: list[float]) -> list[float]:
    """robust.cap_weights for the few venues of one asset."""
    most = live.MOST_SHARE
    if most * len(weights) <= 1.0:
        return [1.0 / len(weights)] * len(weights)
    shares = [w / sum(weights) for w in weights]
    over, room = sum(max(0.0, s - most) for s in shares), sum(max(0.0, most - s) for s in shares)
    if over > 1e-12 and room > 1e-12:
        shares = [most if s >= most else s + over * (most - s) / room for s in shares]
    return [s / sum(shares) for s in shares]


def valued(markets: Iterable[tuple[str, str, dict, float | None, bool]], now_ms: int, stale_ms: int) -> dict | None:
    """An asset's live state from its markets (venue, symbol, quote, rate, connected): what live.live_states says of one asset, or None without a usable market."""
    best: dict[str, tuple] = {}
    gone = 0
    for venue, symbol, q, rate, connected in markets:
        bid, ask = q["bid"], q["ask"]
        mid = bid is not None and ask is not None and bid <= ask and (ask - bid) / ((bid + ask) / 2) * 10_000 <= live.MOST_SPREAD_BPS
        price = (bid + ask) / 2 if mid else q["last"]
        if price is None or rate is None or q["price_ms"] is None:
            continue
        age = max(0, now_ms - q["price_ms"])
        if not connected or age > stale_ms:
            gone += 1
            continue
        usd = price * rate
        volume = q["quote_volume"] * rate if q["quote_volume"] is not None else q["base_volume"] * usd if q["base_volume"] is not None else None
        found = ((volume or 0.0, symbol), usd, volume, SOURCE_QUALITY["mid" if mid else "last"], age)
        if venue not in best or found[0] > best[venue][0]:
            best[venue] = found
    if not best:
        return None
    pairs = []
    for _, usd, volume, quality, age in best.values():
        fresh = max(FRESHNESS_FLOOR, 1.0 - (1.0 - FRESHNESS_FLOOR) * min(1.0, age / stale_ms))
        pairs.append((usd, max(volume**0.5 if volume and volume > 0 else 0.0, 1e-3) * fresh * quality, volume))
    pairs.sort(key=lambda p: p[:2])
    centre = _median([p[:2] for p in pairs])
    kept = [p for p in pairs if len(pairs) < live.MAJORITY or abs((p[0] - centre) / centre * 10_000) <= live.MOST_OFF_BPS]
    if not kept:
        return None
    weights = _capped([w for _, w, _ in kept])
    price = _median([(x, w) for (x, _, _), w in zip(kept, weights)])
    off = _median(sorted((abs(x - price), w) for (x, _, _), w in zip(kept, weights))) if len(kept) > 1 else None
    volumes = [v for _, _, v in kept if v is not None]
    return {
        "price": price, "method": "robust_weighted_median" if len(kept) > 1 else "single_venue", "venues_used": len(kept), "venues_seen": len(pairs) + gone,
        "dispersion_bps": None if off is None else off / price * 10_000, "volume_24h_usd": sum(volumes) if volumes else None,
    }


def _newer(quote: dict, row: dict) -> None:
    """Takes over what row tells; of each field the newest value counts, whatever order ticks come in."""
    for f in FIELDS:
        value = row.get(f)
        if isinstance(value, str):  # how JSON has what is not finite
            value = float(value)
        if value is not None and (quote[f] is None or (row["ts_ms"], row["id"]) > (quote[f"{f}_ms"], quote[f"{f}_id"])):
            quote[f], quote[f"{f}_ms"], quote[f"{f}_id"] = value, row["ts_ms"], row["id"]
        if value is not None and f in PRICES:
            quote["price_ms"] = max(quote["price_ms"] or row["ts_ms"], row["ts_ms"])


_NAMES = [x.split()[0] for x in QUOTE.split(", ")]
_SAID = [x.split()[0] for x in INPUT.split(", ") if not x.startswith("asset ")]


class LiveBook(StatefulProcessor):
    """All that is known of an asset is one value, as every look needs all of it and each call to the state goes from the worker to the JVM and back; calls do not grow with markets. Listing and quotes in it are JSON texts, as are rows (`said`): a worker takes a row apart cell by cell."""

    def __init__(self, pace: Pace = Pace(), clock: str = "event"):
        self.pace, self.clock = pace, clock
        self.keep_ms = 2 * pace.stale_ms if clock == "processing" else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", "version int, listed string, quotes string, n long, at_ms long, price double, venues int, wake_ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen: dict[tuple, dict] = {}  # what this batch tells, a row for each market, however many ticks there are
        listing, newest = None, 0
        for said in rows:
            row = json.loads(said["said"])
            newest = max(newest, row["ts_ms"])
            if "markets" in row:
                if listing is None or row["version"] > listing["version"]:
                    listing = row
                continue
            _newer(seen.setdefault((row.get("venue"), row.get("symbol")), dict.fromkeys(_NAMES)), row)
        known = self._known(timerValues)
        version, listed, quotes = known["version"], known["listed"], known["quotes"]
        if listing is not None and (version is None or listing["version"] > version):
            listed = {(m.get("venue"), m.get("symbol")): (None if m.get("rate") is None else float(m["rate"]), m.get("connected")) for m in listing["markets"]}
            quotes = {market: q for market, q in quotes.items() if market in listed}
            known |= {"version": listing["version"], "listed": listed, "quotes": quotes}
        touched = timerValues.getCurrentProcessingTimeInMs() if self.keep_ms else None
        for market, ticks in seen.items():
            if market in listed:
                quote = quotes.setdefault(market, dict.fromkeys(_NAMES))
                for f in FIELDS:
                    if ticks[f] is not None and (quote[f] is None or (ticks[f"{f}_ms"], ticks[f"{f}_id"]) > (quote[f"{f}_ms"], quote[f"{f}_id"])):
                        quote |= {n: ticks[n] for n in (f, f"{f}_ms", f"{f}_id")}
                if ticks["price_ms"] is not None:
                    quote["price_ms"] = max(quote["price_ms"] or 0, ticks["price_ms"])
                quote["touched_ms"] = touched
        yield from self._look(key, timerValues, newest, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        known = self._known(timerValues)
        if known["wake_ms"] == at:  # Spark lets it go
            known["wake_ms"] = None
        yield from self._look(key, timerValues, at, known)

    def _known(self, timers) -> dict:
        """The asset's state, listing and quotes by market. Quotes that no tick has renewed in time are gone."""
        found = self.book.get()
        if found is None:
            return dict.fromkeys(("version", "at_ms", "price", "wake_ms")) | {"listed": {}, "quotes": {}, "n": 0, "venues": 0}
        version, listed, quotes, n, at, price, venues, wake = found
        by_market = {(venue, symbol): dict(zip((*_NAMES, "touched_ms"), m)) for venue, symbol, *m in json.loads(quotes)}
        if self.keep_ms:
            now = timers.getCurrentProcessingTimeInMs()
            by_market = {market: q for market, q in by_market.items() if now < q["touched_ms"] + self.keep_ms}
        return {"version": version, "listed": {(venue, symbol): tuple(m) for venue, symbol, *m in json.loads(listed)}, "quotes": by_market, "n": n, "at_ms": at, "price": price, "venues": venues, "wake_ms": wake}

    def _keep(self, known: dict, n: int, at: int | None, price: float | None, venues: int, wake: int | None) -> None:
        """Writes the asset's state, and sets its one timer: the next moment at which something can change."""
        if known["version"] is None:  # nobody follows it
            return
        listed = json.dumps([(*market, *m) for market, m in known["listed"].items()])
        quotes = json.dumps([(*market, *(q[f] for f in _NAMES), q["touched_ms"]) for market, q in known["quotes"].items()])
        if wake != known["wake_ms"]:
            if known["wake_ms"] is not None:
                self.handle.deleteTimer(known["wake_ms"])
            if wake is not None:
                self.handle.registerTimer(wake)
        self.book.update((known["version"], listed, quotes, n, at, price, venues, wake))

    def _look(self, key, timers, newest: int, known: dict) -> Iterator[Row]:
        now = timers.getCurrentProcessingTimeInMs() if self.clock == "processing" else max(newest, timers.getCurrentWatermarkInMs())
        n, at, price, venues, listed, quotes = (known[x] for x in ("n", "at_ms", "price", "venues", "listed", "quotes"))
        if at is not None and now < at + self.pace.look_ms:
            self._keep(known, n, at, price, venues, at + self.pace.look_ms)
            return
        markets = [(*market, quotes[market], *listed[market]) for market in sorted(quotes, key=str)]
        state = valued(markets, now, self.pace.stale_ms)
        wake = [q["price_ms"] + self.pace.stale_ms + 1 for _, _, q, _, connected in markets if connected and q["price_ms"] is not None and now <= q["price_ms"] + self.pace.stale_ms]
        told = None
        if state is None:
            if price is not None:  # told once that there is no price any more
                n, at, price, venues = n + 1, now, None, 0
                told = Row(asset=key[0], n=n, at_ms=now, price=None, method=None, venues_used=0, venues_seen=0, dispersion_bps=None, volume_24h_usd=None)
        else:
            moved = price is None or (abs(state["price"] - price) / price * 10_000 > self.pace.least_move_bps if self.pace.least_move_bps > 0 else state["price"] != price)
            beat = self.pace.heartbeat_ms is not None and at is not None and now >= at + self.pace.heartbeat_ms
            if moved or state["venues_used"] != venues or beat:
                n, at, price, venues = n + 1, now, state["price"], state["venues_used"]
                told = Row(asset=key[0], n=n, at_ms=now, **state)
            if self.pace.heartbeat_ms is not None:
                wake.append(at + self.pace.heartbeat_ms)
        self._keep(known, n, at, price, venues, min(wake, default=None))
        if told is not None:
            yield told


def live_book(rows: DataFrame, pace: Pace = Pace(), clock: str = "event") -> DataFrame:
    """States as they are told. rows: a stream of INPUT; with the event clock it has a watermark, behind which rows are too late. The state is kept in RocksDB, as maps and timers need it."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    mode = {"event": "EventTime", "processing": "ProcessingTime"}[clock]
    said = rows.select("asset", *[c for c in rows.columns if c != "asset" and c not in _SAID], F.to_json(F.struct(*_SAID)).alias("said"))
    return said.groupBy("asset").transformWithState(LiveBook(pace, clock), TOLD, "Update", mode)


def listing_changes(before: DataFrame | None, after: DataFrame, version: int, ts_ms: int) -> DataFrame:
    """Rows of INPUT that bring the book from one generation of listed markets to the next. before, after: asset, venue, symbol, quote, rate, connected; assets of the former that the latter lacks get an empty listing."""
    m = F.struct("venue", "symbol", "quote", "rate", "connected")
    listed = after.groupBy("asset").agg(F.sort_array(F.collect_list(m)).alias("markets"))  # as many as an asset has markets
    if before is not None:
        gone = before.select("asset").distinct().join(after.select("asset"), "asset", "left_anti")
        listed = listed.unionByName(gone.select("asset", F.array().cast(listed.schema["markets"].dataType).alias("markets")))
    nulls = {f: F.lit(None).cast("double").alias(f) for f in FIELDS}
    return listed.select(F.col("asset").cast("string").alias("asset"), F.lit(ts_ms).cast("long").alias("ts_ms"), F.lit(-1).cast("long").alias("id"), F.lit(None).cast("string").alias("venue"), F.lit(None).cast("string").alias("symbol"), *nulls.values(), F.lit(version).cast("int").alias("version"), "markets")


def tick_rows(ticks: DataFrame) -> DataFrame:
    """Ticks (asset, venue, symbol, ts_ms, id and any of FIELDS) as rows of INPUT."""
    have = set(ticks.columns)
    fields = [(F.col(f) if f in have else F.lit(None)).cast("double").alias(f) for f in FIELDS]
    none = [F.lit(None).cast("int").alias("version"), F.lit(None).cast("array<struct<venue:string,symbol:string,quote:string,rate:double,connected:boolean>>").alias("markets")]
    return ticks.select(F.col("asset").cast("string").alias("asset"), F.col("ts_ms").cast("long").alias("ts_ms"), F.col("id").cast("long").alias("id"), F.col("venue").cast("string").alias("venue"), F.col("symbol").cast("string").alias("symbol"), *fields, *none)


def told_in_steps(steps: list[DataFrame], where: str, pace: Pace, schema: str = INPUT) -> DataFrame:
    """Runs one stream over batches of INPUT that arrive one after the other, and gives all that was told. Batches are written by tasks; the driver only waits. While a batch is being written the stream rests: files come into the folder one by one, and it would take the first of them, move the watermark, and drop the others as late."""
    spark = steps[0].sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/out/part={number}")

    for step in steps:
        step.write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(schema).parquet(f"{where}/in").withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", "0 seconds")
        run = live_book(stream, pace).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema(TOLD).option("recursiveFileLookup", "true").parquet(f"{where}/out")


def latest_told(rows: DataFrame) -> DataFrame:
    """The last that was told of each asset, from all that was."""
    return rows.groupBy("asset").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "asset"]), "n").alias("t")).select("asset", "t.*")
