"""Results that collectors elsewhere publish as plain files, and how far they are trusted.

A relay is a folder on any file system that Spark reaches: a manifest, and one
file for each venue's result, under the SHA-256 of its bytes. Whoever pulls it
checks every result by itself and gets a row for every venue that was asked for:
either the result, or an explicit failure with the first guard that did not hold.
Nothing is raised for a relay's faults, and a stale result never passes for a new
one. Files are written, read and hashed by tasks; the driver has the manifest,
which has one entry for each venue. Bytes that passed their digest are kept in a
cache by content, so that an unchanged result is not pulled again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.sources.collections import _HEALTH, _TICKER

MANIFEST, OLDEST_S, AHEAD_S, LARGEST = "manifest.json", 1200, 300, 32 << 20
RESULT = f"venue_slug string, run_id string, collection_started_at bigint, collection_finished_at bigint, health {_HEALTH}, tickers array<{_TICKER}>, _corrupt string"
ENTRY = "struct<path:string,sha256:string,size_bytes:bigint,status:string,collection_finished_at:bigint>"
#: The guards, in the order in which they are tried.
GUARDS = ("not_relayed", "no_manifest", "not_published", "missing_file", "too_large", "digest_mismatch", "unreadable", "other_venue", "too_old", "in_the_future")


def _parsed(body):
    return F.from_json(body, RESULT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def _sound(result):
    return result.isNotNull() & result["_corrupt"].isNull() & result["run_id"].isNotNull() & result["collection_finished_at"].isNotNull() & result["venue_slug"].isNotNull()


def publish(results: DataFrame, folder: str, now_ms: int, guarded: bool = True) -> dict:
    """Writes results (venue, body) and then, by a rename, the manifest. A result that is missing, is no result or is another venue's is left out, so that it cannot go stale under a new manifest."""
    spark, folder = results.sparkSession, folder.rstrip("/")
    told = results.filter("body is not null").withColumn("result", _parsed(F.col("body")))
    if guarded:
        told = told.filter(_sound(F.col("result")) & (F.col("result.venue_slug") == F.col("venue")))
    named = told.withColumn("sha256", F.sha2(F.concat("body", F.lit("\n")).cast("binary"), 256))  # a text file ends its line
    named.select("sha256", "body").dropDuplicates(["sha256"]).repartition("sha256").write.mode("append").partitionBy("sha256").text(f"{folder}/results")
    stored = files.digests(spark, f"{folder}/results", "*.txt").select("path", F.col("sha256").alias("f_sha256"), "bytes").dropDuplicates(["f_sha256"])
    rows = named.join(stored, F.col("sha256") == F.col("f_sha256")).select("venue", F.concat(F.lit("results/"), "path").alias("path"), "sha256", "bytes", "result.health.status", "result.collection_finished_at").collect()  # one for each venue
    entries = {r.venue: {"path": r.path, "sha256": r.sha256, "size_bytes": r.bytes, "status": r.status, "collection_finished_at": r.collection_finished_at} for r in rows}
    manifest = {"generated_at": now_ms, "files": entries}
    files.write_text(spark, f"{folder}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
    return manifest


def _manifest(spark: SparkSession, folder: str) -> dict | None:
    """The manifest's entries; None if there is none or it is not one."""
    path = f"{folder}/{MANIFEST}"
    if not files.exists(spark, path):
        return None
    try:
        found = json.loads(files.read_text(spark, path))["files"]
        return {v: e for v, e in found.items() if isinstance(e, dict) and isinstance(e.get("sha256"), str) and isinstance(e.get("path"), str)}
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


def _cached(spark: SparkSession, cache: str | None, digests: list[str]) -> DataFrame:
    """Of the cache the bodies with these digests that still hash to their names. A body stands in the partition of its digest, so others are not read."""
    none = spark.createDataFrame([], "sha256 string, body string")
    if cache is None or not digests or not files.exists(spark, cache):
        return none
    kept = spark.read.schema("body string, sha256 string").parquet(cache).filter(F.col("sha256").isin(digests)).select("sha256", "body")
    return kept.filter(F.sha2(F.concat("body", F.lit("\n")).cast("binary"), 256) == F.col("sha256")).dropDuplicates(["sha256"])


def fetched(venues: DataFrame, folder: str, now_ms: int, cache: str | None = None, oldest_s: int = OLDEST_S, ahead_s: int = AHEAD_S, largest: int = LARGEST) -> DataFrame:
    """A row for each of venues (venue, egress; only those of egress `relay` may be pulled): status, reason, source (relay or cache), and the result's run_id, collection_finished_at, health and tickers."""
    spark, folder = venues.sparkSession, folder.rstrip("/")
    manifest = _manifest(spark, folder)
    entries = spark.createDataFrame([(v, e["path"], e["sha256"], e.get("size_bytes")) for v, e in (manifest or {}).items()], "m_venue string, path string, sha256 string, size_bytes long")
    wanted = sorted({e["sha256"] for e in (manifest or {}).values()})
    have = _cached(spark, cache, wanted)
    known = {r.sha256 for r in have.select("sha256").collect()}  # one for each venue at most
    paths = sorted({e["path"] for e in (manifest or {}).values() if e["sha256"] not in known and files.exists(spark, f"{folder}/{e['path']}")})
    pulled = spark.createDataFrame([], "f_path string, length long, body string, got string")
    if paths:
        raw = spark.read.format("binaryFile").load([f"{folder}/{p}" for p in paths])
        name = F.concat_ws("/", F.slice(F.split(F.col("path"), "/"), -3, 3))
        small = F.col("length") <= largest
        pulled = raw.select(name.alias("f_path"), "length", F.when(small, F.col("content").cast("string")).alias("text"), F.when(small, F.sha2("content", 256)).alias("got")).select("f_path", "length", F.regexp_replace("text", "\n$", "").alias("body"), "got")
    j = venues.select("venue", "egress").join(entries, F.col("venue") == F.col("m_venue"), "left")
    j = j.join(have.select(F.col("sha256").alias("c_sha256"), F.col("body").alias("c_body")), F.col("sha256") == F.col("c_sha256"), "left")
    j = j.join(pulled, F.concat_ws("/", F.slice(F.split(F.col("path"), "/"), -3, 3)) == F.col("f_path"), "left")
    from_cache = F.col("c_body").isNotNull()
    j = j.withColumn("body", F.coalesce("c_body", F.when(F.col("got") == F.col("sha256"), F.col("body")))).withColumn("result", _parsed(F.col("body")))
    age = (now_ms - F.col("result.collection_finished_at")) / 1000
    tests = [
        ~F.col("egress").eqNullSafe("relay"), F.lit(manifest is None), F.col("m_venue").isNull(), ~from_cache & F.col("f_path").isNull(), ~from_cache & (F.col("length") > largest),
        ~from_cache & ~F.col("got").eqNullSafe(F.col("sha256")), ~F.coalesce(_sound(F.col("result")), F.lit(False)), F.col("result.venue_slug") != F.col("venue"), age > oldest_s, age < -ahead_s,
    ]
    reason = F.when(F.lit(False), "")
    for name, test in zip(GUARDS, tests):
        reason = reason.when(test, name)
    told = j.withColumn("reason", reason)
    if cache is not None and paths:
        fresh = told.filter(F.col("c_body").isNull() & F.col("body").isNotNull()).select("sha256", "body").dropDuplicates(["sha256"])
        fresh.repartition("sha256").write.mode("append").partitionBy("sha256").parquet(cache)
    good = F.col("reason").isNull()
    of = lambda c: F.when(good, F.col(f"result.{c}")).alias(c)
    return told.select(
        "venue", F.when(good, "success").otherwise("failed").alias("status"), "reason", F.when(good, F.when(from_cache, "cache").otherwise("relay")).alias("source"), of("run_id"), of("collection_finished_at"), of("health"), of("tickers"),
    )
