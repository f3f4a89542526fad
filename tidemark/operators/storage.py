"""Stored generations: history, slots of a day, compaction, retention, and the gate before publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SLOT_MS, shard
from tidemark.operators.ingest import deduped_last

HISTORY_ASSETS, HISTORY_MS, GRACE_MS, DAY_MS, SLOTS_A_DAY = 600, 744 * 3_600_000, 24 * 3_600_000, 86_400_000, 96


def extended_history(old: DataFrame, new: DataFrame, ranked: DataFrame, as_of_ms: int, most: int = HISTORY_ASSETS) -> DataFrame:
    """Old and new rows, the newest insert of each (asset, observed_at); no older than retention; of assets that rank among the first, or were seen within the grace."""
    top = ranked.orderBy(F.desc_nulls_last("volume"), "asset").limit(most).select("asset", F.lit(True).alias("top"))
    both = deduped_last(old.withColumn("insert", F.lit(0)).unionByName(new.withColumn("insert", F.lit(1))), ["asset", "observed_at"], ["insert"]).drop("insert")
    return both.filter((F.col("observed_at") <= as_of_ms) & (F.col("observed_at") >= as_of_ms - HISTORY_MS)).join(top, "asset", "left").filter(F.col("top") | (F.col("observed_at") >= as_of_ms - GRACE_MS)).drop("top")


def slots_of(rows: DataFrame, ms: str) -> DataFrame:
    return rows.select((F.col(ms) - F.pmod(F.col(ms), F.lit(SLOT_MS))).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))


def missing_slots(rows: DataFrame, ms: str) -> DataFrame:
    """Slots without a row on days that have any; they are reported and never filled."""
    there = slots_of(rows, ms)
    days = there.select((F.col("slot") - F.pmod(F.col("slot"), F.lit(DAY_MS))).alias("day")).distinct()
    due = days.select("day", F.explode(F.sequence("day", F.col("day") + DAY_MS - SLOT_MS, F.lit(SLOT_MS).cast("long"))).alias("slot"))
    return due.join(there, "slot", "left_anti").select("day", "slot")


def unexpected_slots(rows: DataFrame, ms: str, first_ms: int, last_ms: int) -> DataFrame:
    """Slots with rows outside of the span that is expected."""
    return slots_of(rows, ms).filter((F.col("slot") < first_ms) | (F.col("slot") > last_ms)).select("slot", "n")


def rollup(rows: DataFrame, unit: str) -> DataFrame:
    """First, last, least, greatest, mean and number of values by unit of time. rows: ts, id, value."""
    at = F.struct("ts", "id")
    return rows.groupBy(F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("since")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean"), F.min_by("value", at).alias("first"), F.max_by("value", at).alias("last"))


def duplicate_slots(manifests: DataFrame) -> DataFrame:
    return manifests.groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")


def compacted_day(rows: DataFrame) -> DataFrame:
    """A day's generations as one table, the last row of each (asset, slot)."""
    return deduped_last(rows, ["asset", "slot"], ["ts_ms", "id"])


def shard_rows(ids: DataFrame, column: str, shards: int = 64) -> DataFrame:
    return ids.select(shard(F.col(column), shards).alias("shard_index")).groupBy("shard_index").agg(F.count("*").alias("n"))


def slot_report(generations: DataFrame) -> DataFrame:
    """What became of each slot that is due on a day with any generation, and of those that are not due. generations: id, ts_ms, due (whether a schedule started it), valid.

    missing, duplicate and invalid are facts of their own: two runs may claim one
    slot and both have failed. A slot is successful if one of its runs is valid.
    """
    own = generations.withColumn("slot", F.col("ts_ms") - F.pmod("ts_ms", F.lit(SLOT_MS))).withColumn("day", F.col("slot") - F.pmod("slot", F.lit(DAY_MS)))
    taken = own.groupBy("day", "slot").agg(F.count_if("due").alias("runs"), F.count_if(F.col("due") & F.col("valid")).alias("good"), F.count_if(~F.col("due")).alias("unexpected"))
    due = own.select("day").distinct().select(F.col("day").alias("d_day"), F.explode(F.sequence("day", F.col("day") + DAY_MS - SLOT_MS, F.lit(SLOT_MS).cast("long"))).alias("d_slot"))
    every = due.join(taken, F.col("d_slot") == F.col("slot"), "left")
    runs, good = F.coalesce("runs", F.lit(0)), F.coalesce("good", F.lit(0))
    return every.select(F.col("d_day").alias("day"), F.col("d_slot").alias("slot"), (good > 0).alias("successful"), (runs == 0).alias("missing"), (runs > 1).alias("duplicate"), ((runs > 0) & (good == 0)).alias("invalid"), F.coalesce("unexpected", F.lit(0)).alias("unexpected"))


def compactable(generations: DataFrame, report: DataFrame) -> DataFrame:
    """Generations that go into their day's table: those of successful slots that no other run claims. Which of two runs counts is not for us to choose."""
    good = report.filter("successful and not duplicate").select(F.col("slot").alias("g_slot"))
    return generations.filter("due").join(good, (F.col("ts_ms") - F.pmod("ts_ms", F.lit(SLOT_MS))) == F.col("g_slot"), "left_semi")


def closed_days(report: DataFrame, compacted: DataFrame, now_ms: int) -> DataFrame:
    """Days that may be compacted: over, without a slot that two runs claim, not compacted yet, and with a successful slot at least. compacted: day."""
    over = report.filter(F.col("day") + DAY_MS <= now_ms).groupBy("day").agg(F.count_if("successful").alias("slots")).filter("slots > 0")
    return over.join(report.filter("duplicate").select("day"), "day", "left_anti").join(compacted.select("day"), "day", "left_anti")


#: Guards of a deletion, and how many there may be in one run.
TAG_PREFIX, PROTECTED_PREFIX, LEAST_HOURS, MOST_DELETIONS = "data-", "data-latest", 48.0, 200


def deletion_plan(candidates: DataFrame, most: int = MOST_DELETIONS) -> DataFrame:
    """What a clean-up does with each candidate (tag, age_hours, has_replacement, verified): `delete`, or the first guard that holds it back. Beyond `most` the oldest go first, by a top-k over what passed."""
    held = (
        F.when(~F.col("tag").startswith(TAG_PREFIX), "foreign_tag").when(F.col("tag").startswith(PROTECTED_PREFIX), "protected_tag").when(F.col("age_hours") < LEAST_HOURS, "too_young")
        .when(~F.coalesce("has_replacement", F.lit(False)), "no_replacement").when(~F.coalesce("verified", F.lit(False)), "not_verified")
    )
    judged = candidates.withColumn("held", held)
    first = judged.filter("held is null").orderBy(F.desc("age_hours"), "tag").limit(most).select(F.col("tag").alias("d_tag"))
    return judged.join(first, F.col("tag") == F.col("d_tag"), "left").withColumn("action", F.coalesce("held", F.when(F.col("d_tag").isNull(), "over_the_limit"), F.lit("delete"))).drop("held", "d_tag")


def retention_action(age_h: Column, is_latest: Column, newest_rank: Column, keep: int = 3, least_h: int = 6, most_h: int = 48) -> Column:
    """What happens to a generation, by the first guard that holds."""
    return F.when(is_latest, "keep_latest").when(newest_rank <= keep, "keep_newest").when(age_h < least_h, "keep_young").when(age_h <= most_h, "keep_retained").otherwise("delete")


def gate(m: dict[str, Column]) -> Column:
    """The reasons why a generation must not be published, in order; empty if it may. m: venues, expected_venues, assets, previous_assets, shard_rows, parse_failures, missing_tables and bad_checksums (numbers)."""
    tests = [
        (m["missing_tables"] > 0, "missing_tables"), (m["bad_checksums"] > 0, "checksums"),
        (m["venues"] < 4, "too_few_venues"), (F.try_divide(m["venues"].cast("double"), m["expected_venues"]) < 0.35, "venue_ratio"),
        (m["shard_rows"] != m["assets"], "shard_rows"), (m["assets"] < m["previous_assets"] * 0.5, "asset_drop"), (m["parse_failures"] > 0.25, "parse_failures"),
    ]
    return F.filter(F.array(*[F.when(test, F.lit(name)) for test, name in tests]), lambda x: x.isNotNull())
