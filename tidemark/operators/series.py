"""Series per asset: returns, volatility and path-dependent indicators, with gates on how much history there is.

Points: asset, ts_ms, id (last tie-break), price. Windows end at an asset's own latest point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import let

HOUR_MS, SLOTS_PER_HOUR, SLOTS_PER_YEAR, MOST_MISSING = 3_600_000, 4, 35_040, 0.35
WINDOW_HOURS = {"1h": 1, "4h": 4, "24h": 24, "7d": 168, "30d": 720}
LEAST = {"1h": 4, "4h": 12, "24h": 48, "7d": 240}


def _in_order():
    return Window.partitionBy("asset").orderBy("ts_ms", "id")


def trailing(points: DataFrame, hours: int) -> DataFrame:
    return points.withColumn("_last", F.max("ts_ms").over(Window.partitionBy("asset"))).filter(F.col("ts_ms") >= F.col("_last") - hours * HOUR_MS).drop("_last")


def log_returns(points: DataFrame) -> DataFrame:
    """log_return to the point before; null at the first and where either price is not positive."""
    before = F.lag("price").over(_in_order())
    return points.withColumn("log_return", F.when((F.col("price") > 0) & (before > 0), F.ln(F.col("price") / before)))


def window_returns(points: DataFrame, hours: int) -> DataFrame:
    """last / first - 1 of two or more points in the window."""
    inside = trailing(points, hours)
    at = F.struct("ts_ms", "id")
    first, last = F.min_by("price", at), F.max_by("price", at)
    return inside.groupBy("asset").agg(F.when((F.count("price") >= 2) & (first > 0), last / first - 1).alias("change"), F.count("price").alias("points"))


def volatility(points: DataFrame, hours: int, least: int) -> DataFrame:
    """Sample deviation of log returns, a year's worth; null without enough points or with too many slots missing."""
    inside = log_returns(trailing(points, hours))
    expected = hours * SLOTS_PER_HOUR
    enough = (F.count("price") >= least) & (1 - F.count("price") / expected <= MOST_MISSING)
    return inside.groupBy("asset").agg(F.when(enough, F.stddev_samp("log_return") * F.sqrt(F.lit(float(SLOTS_PER_YEAR)))).alias("realised"), F.count("price").alias("points"))


def true_range(points: DataFrame, n: int = 14) -> DataFrame:
    """Mean of the last n absolute moves over the last price, in bps; needs n + 1 prices."""
    newest = Window.partitionBy("asset").orderBy(F.desc("ts_ms"), F.desc("id"))
    moves = points.withColumns({"move": F.abs(F.col("price") - F.lag("price").over(_in_order())), "back": F.row_number().over(newest)})
    return moves.groupBy("asset").agg(F.when(F.count("price") >= n + 1, F.avg(F.when(F.col("back") <= n, F.col("move"))) / F.max_by("price", F.struct("ts_ms", "id")) * 10_000.0).alias("atr_bps"))


def paths(points: DataFrame) -> DataFrame:
    """prices: each asset's prices in order; a series is as long as its retention, 31 days of slots at most."""
    return points.groupBy("asset").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts_ms", "id", "price"))), lambda p: p["price"]).alias("prices"))


def ema(prices: Column, span: int) -> Column:
    alpha = 2.0 / (span + 1)
    return F.when(F.size(prices) >= span, F.aggregate(F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0))), F.get(prices, F.lit(0)), lambda a, x: F.lit(alpha) * x + F.lit(1 - alpha) * a))


def rsi(prices: Column, n: int = 14) -> Column:
    """Smoothed gains against losses: the first n moves are averaged, later ones enter with weight 1/n."""

    def of_moves(moves: Column) -> Column:
        mean = lambda part: F.aggregate(F.slice(moves, 1, n), F.lit(0.0), lambda a, m: a + part(m)) / n
        up, down = (lambda m: F.greatest(m, F.lit(0.0))), (lambda m: F.greatest(-m, F.lit(0.0)))
        step = lambda s, m: F.struct(((s["g"] * (n - 1) + up(m)) / n).alias("g"), ((s["l"] * (n - 1) + down(m)) / n).alias("l"))
        end = lambda s: F.when(s["l"] == 0, F.when(s["g"] > 0, 100.0).otherwise(50.0)).otherwise(100.0 - 100.0 / (1.0 + s["g"] / F.nullif(s["l"], F.lit(0.0))))
        return F.aggregate(F.slice(moves, n + 1, F.greatest(F.size(moves) - n, F.lit(0))), F.struct(mean(up).alias("g"), mean(down).alias("l")), step, end)

    moves = F.zip_with(F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0))), F.slice(prices, 1, F.greatest(F.size(prices) - 1, F.lit(0))), lambda b, a: b - a)
    return F.when(F.size(prices) >= n + 1, let(moves, of_moves))


def measures(points: DataFrame, changes: dict[str, int], volatilities: dict[str, tuple[int, int]], n: int = 14) -> DataFrame:
    """Of each asset: change_<w> and realised_<w> over windows of hours (with the least number of points), atr_bps, and prices in order.

    All windows come from one pass: a point knows the one before it, and a return
    belongs to a window if both its points do. What window_returns, volatility,
    true_range and paths say is the same.
    """
    order, newest = _in_order(), Window.partitionBy("asset").orderBy(F.desc("ts_ms"), F.desc("id"))
    before, since = F.lag("price").over(order), F.lag("ts_ms").over(order)
    known = points.withColumns({"_last": F.max("ts_ms").over(Window.partitionBy("asset")), "_before": before, "_since": since}).withColumn("_back", F.row_number().over(newest))
    at, moved = F.struct("ts_ms", "id"), F.when((F.col("price") > 0) & (F.col("_before") > 0), F.ln(F.col("price") / F.col("_before")))
    made = [F.transform(F.array_sort(F.collect_list(F.struct("ts_ms", "id", "price"))), lambda p: p["price"]).alias("prices")]
    made.append(F.when(F.count("price") >= n + 1, F.avg(F.when(F.col("_back") <= n, F.abs(F.col("price") - F.col("_before")))) / F.max_by("price", at) * 10_000.0).alias("atr_bps"))
    for name, hours in changes.items():
        price = F.when(F.col("ts_ms") >= F.col("_last") - hours * HOUR_MS, F.col("price"))
        first, last = F.min_by(price, F.when(price.isNotNull(), at)), F.max_by(price, F.when(price.isNotNull(), at))
        made.append(F.when((F.count(price) >= 2) & (first > 0), last / first - 1).alias(f"change_{name}"))
    for name, (hours, least) in volatilities.items():
        start = F.col("_last") - hours * HOUR_MS
        price, inside = F.when(F.col("ts_ms") >= start, F.col("price")), F.when((F.col("ts_ms") >= start) & (F.col("_since") >= start), moved)
        enough = (F.count(price) >= least) & (1 - F.count(price) / (hours * SLOTS_PER_HOUR) <= MOST_MISSING)
        made.append(F.when(enough, F.stddev_samp(inside) * F.sqrt(F.lit(float(SLOTS_PER_YEAR)))).alias(f"realised_{name}"))
    return known.groupBy("asset").agg(*made)


def bollinger_width(points: DataFrame, n: int = 20) -> DataFrame:
    """4 deviations of the last n prices over their mean, in bps."""
    newest = Window.partitionBy("asset").orderBy(F.desc("ts_ms"), F.desc("id"))
    last = points.withColumn("back", F.row_number().over(newest)).filter(F.col("back") <= n)
    return last.groupBy("asset").agg(F.when((F.count("price") == n) & (F.avg("price") > 0), 4 * F.stddev_samp("price") / F.avg("price") * 10_000.0).alias("width_bps"))


def nearest(points: DataFrame, ago_ms: int, tolerance_ms: int) -> DataFrame:
    """The price nearest to `ago_ms` before an asset's as_of_ms, at most the tolerance away; of equally near ones the earlier."""
    off = F.abs(F.col("ts_ms") - (F.col("as_of_ms") - ago_ms))
    return points.filter((F.col("ts_ms") < F.col("as_of_ms")) & (off <= tolerance_ms)).groupBy("asset").agg(F.min_by("price", F.struct(off, F.col("ts_ms"), F.col("id"))).alias("price_then"))
