"""Robust statistics per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import let, ratio, total


def _ranked(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Rows with a positive finite weight, with the weight up to them in order of (value, weight) and the group's half.

    All windows share one partitioning, hence one exchange and one sort, and spill.
    """
    sound = df.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")) & (F.col(weight) > 0) & (F.col(weight) != float("inf")))
    order = Window.partitionBy(*keys).orderBy(value, weight)
    up_to, rest = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sound.withColumns({"_cum": F.sum(weight).over(up_to), "_half": F.sum(weight).over(rest) / 2, "_next": F.lead(value).over(order), "_row": F.row_number().over(order)})


def weighted_median(df: DataFrame, keys: list[str], value: str, weight: str, name: str = "weighted_median") -> DataFrame:
    """The first value whose running weight passes half of all; where it is exactly half, the mean of it and the next."""
    at = _ranked(df, keys, value, weight).filter(F.col("_cum") >= F.col("_half"))
    middle = F.when(F.col("_cum") == F.col("_half"), F.coalesce((F.col(value) + F.col("_next")) / 2, F.col(value))).otherwise(F.col(value))
    return at.groupBy(*keys).agg(F.min_by(middle, "_row").alias(name))


def over_median(df: DataFrame, keys: list[str], value: str, weight: str, ties: list[str], name: str) -> DataFrame:
    """df with the weighted median of its group on each row, in the partitioning by keys that it has. Rows without a weight do not count."""
    order, every = Window.partitionBy(*keys).orderBy(F.col(weight).isNull(), value, *ties), Window.partitionBy(*keys)
    counted = F.when(F.col(weight).isNotNull(), F.col(value))
    ranked = df.withColumns({"_cum": F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_half": F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) / 2, "_next": F.lead(counted).over(order)})
    middle = F.when(F.col("_cum") == F.col("_half"), F.coalesce((F.col(value) + F.col("_next")) / 2, F.col(value))).otherwise(F.col(value))
    at = F.when(F.col(weight).isNotNull() & (F.col("_cum") >= F.col("_half")), F.struct(F.col("_cum").alias("c"), F.col(value).alias("x"), middle.alias("m")))
    return ranked.withColumn("_at", at).withColumn(name, F.min("_at").over(every)["m"]).drop("_cum", "_half", "_next", "_at")


def weighted_mad(df: DataFrame, keys: list[str], value: str, weight: str, name: str = "weighted_mad") -> DataFrame:
    """Weighted median of distances from the weighted median."""
    centre = weighted_median(df, keys, value, weight, "_centre")
    return weighted_median(df.join(centre, keys).withColumn("_off", F.abs(F.col(value) - F.col("_centre"))), keys, "_off", weight, name)


def weighted_mean(value: str, weight: str) -> Column:
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def percentile_rank(df: DataFrame, keys: list[str], value: str, name: str = "percentile_rank") -> DataFrame:
    """Per row: (values below + half of those equal) / all * 100."""
    w = Window.partitionBy(*keys).orderBy(value)
    upto = F.count(value).over(w.rangeBetween(Window.unboundedPreceding, 0))
    equal = F.count(value).over(w.rangeBetween(0, 0))
    every = F.count(value).over(Window.partitionBy(*keys))
    return df.withColumn(name, (upto - equal + equal / 2) / every * 100)


def trimmed_mean(df: DataFrame, keys: list[str], value: str, fraction: float = 0.1, name: str = "trimmed_mean") -> DataFrame:
    """Mean without int(n * fraction) values at either end."""
    by = Window.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).withColumns({"_r": F.row_number().over(by.orderBy(value)), "_n": F.count(value).over(by)})
    cut = F.floor(F.col("_n") * fraction)
    return ranked.filter((F.col("_r") > cut) & (F.col("_r") <= F.col("_n") - cut)).groupBy(*keys).agg(F.avg(value).alias(name))


def concentration(df: DataFrame, group: str, member: str, amount: str) -> DataFrame:
    """Herfindahl index of members' shares, the effective number of members, and the largest share."""
    summed = df.filter(F.col(amount) > 0).groupBy(group, member).agg(F.sum(amount).alias("_a"))
    share = F.col("_a") / F.sum("_a").over(Window.partitionBy(group))
    out = summed.withColumn("_s", share).groupBy(group).agg(F.sum(F.col("_s") * F.col("_s")).alias("hhi"), F.max("_s").alias("largest_share"))
    return out.withColumn("effective_count", ratio(F.lit(1.0), "hhi"))


def cap_weights(weights: Column, most: float) -> Column:
    """Weights as shares of which none is over `most`; excess goes to the others by the room that they have.

    Shares sum to 1, so where the cap can be met there is as much room as excess
    at least, and dealing it out once brings no other share over the cap. Shares
    are equal where the cap cannot be met, and 0 without any weight.
    """

    def spread(shares: Column) -> Column:
        over = total(F.transform(shares, lambda s: F.greatest(F.lit(0.0), s - most)))
        room = total(F.transform(shares, lambda s: F.greatest(F.lit(0.0), most - s)))

        def deal(m: Column) -> Column:
            moved = F.transform(shares, lambda s: F.when(s >= most, F.lit(most)).otherwise(s + m["over"] * (most - s) / m["room"]))
            return F.when((m["over"] <= 1e-12) | (m["room"] <= 1e-12), shares).otherwise(moved)

        return let(F.struct(over.alias("over"), room.alias("room")), deal)

    def capped(w: Column) -> Column:
        every = total(w)
        dealt = let(let(every, lambda t: F.transform(w, lambda x: x / t)), spread)
        final = let(dealt, lambda d: let(total(d), lambda t: F.transform(d, lambda x: x / t)))
        return (
            F.when(F.size(w) == 0, w)
            .when(every <= 0, F.transform(w, lambda _: F.lit(0.0)))
            .when(most * F.size(w) <= 1.0, F.transform(w, lambda _: 1.0 / F.size(w)))
            .otherwise(final)
        )

    return let(weights, capped)


def median_of(pairs: Column) -> Column:
    """Weighted median of an array of (x, w) that is sorted by them; the array form of weighted_median."""

    def fold(sound: Column) -> Column:
        half = total(F.transform(sound, lambda p: p["w"])) / 2

        def walk(h: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("x"), F.lit(False).alias("tie"))

            def step(s: Column, p: Column) -> Column:
                cum = s["cum"] + p["w"]
                open_ = s["x"].isNull()
                x = F.when(s["tie"], (s["x"] + p["x"]) / 2).when(~open_, s["x"]).when(cum >= h, p["x"])
                return F.struct(cum.alias("cum"), x.alias("x"), (open_ & (cum == h)).alias("tie"))

            return F.aggregate(sound, start, step, lambda s: s["x"])

        return let(half, walk)

    return let(F.filter(pairs, lambda p: p["w"] > 0), fold)
