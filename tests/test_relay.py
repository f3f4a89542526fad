"""A relay's folder: what is published, which guard holds a result back, and the cache."""

import json

from tidemark.sources import files, relay

NOW = 1_700_000_000_000


def body(venue, age_s=10, **more):
    return json.dumps({"venue_slug": venue, "run_id": f"run-{venue}", "collection_finished_at": NOW - age_s * 1000, "health": {"status": "success"}, "tickers": [{"symbol_native": "A", "last_price": 1.5}]} | more)


def pulled(spark, folder, venues, cache=None, **limits):
    df = spark.createDataFrame([(v, "relay") for v in venues], "venue string, egress string")
    return {r.venue: r for r in relay.fetched(df, folder, NOW, cache, **limits).collect()}


def test_publish_leaves_out_what_is_no_result(spark, tmp_path):
    folder = str(tmp_path / "r")
    results = spark.createDataFrame([("a", body("a")), ("b", "{broken"), ("c", body("other")), ("d", None), ("e", '{"venue_slug": "e"}')], "venue string, body string")
    assert set(relay.publish(results, folder, NOW)["files"]) == {"a"}
    got = pulled(spark, folder, "abz")
    assert (got["a"].status, got["a"].source, got["a"].run_id, got["a"].tickers[0].last_price) == ("success", "relay", "run-a", 1.5)
    assert [(got[v].status, got[v].reason, got[v].tickers) for v in "bz"] == [("failed", "not_published", None)] * 2


def test_no_manifest(spark, tmp_path):
    assert pulled(spark, str(tmp_path), "a")["a"].reason == "no_manifest"
    (tmp_path / "manifest.json").write_text("[1]")
    assert pulled(spark, str(tmp_path), "a")["a"].reason == "no_manifest"


def test_torn_file_and_ages(spark, tmp_path):
    folder, cache = str(tmp_path / "r"), str(tmp_path / "cache")
    ages = {"a": 1199, "b": 1201, "c": -299, "d": -301}
    manifest = relay.publish(spark.createDataFrame([(v, body(v, age)) for v, age in ages.items()] + [("t", body("t"))], "venue string, body string"), folder, NOW)
    (tmp_path / "r" / manifest["files"]["t"]["path"]).write_text(body("t")[:40])  # another file than the manifest says
    for part in (tmp_path / "r" / manifest["files"]["t"]["path"]).parent.glob(".*crc"):
        part.unlink()
    want = {"a": None, "b": "too_old", "c": None, "d": "in_the_future", "t": "digest_mismatch"}
    assert {v: r.reason for v, r in pulled(spark, folder, want, cache).items()} == want
    again = pulled(spark, folder, want, cache)
    assert {v: r.reason for v, r in again.items()} == want and again["a"].source == "cache"  # an old result is cached, and still too old


def test_what_changes_in_the_cache_is_not_taken(spark, tmp_path):
    folder, cache = str(tmp_path / "r"), str(tmp_path / "cache")
    manifest = relay.publish(spark.createDataFrame([("a", body("a"))], "venue string, body string"), folder, NOW)
    digest = manifest["files"]["a"]["sha256"]
    spark.createDataFrame([(digest, body("a", run_id="forged"))], "sha256 string, body string").write.partitionBy("sha256").parquet(cache)
    got = pulled(spark, folder, "a", cache)["a"]
    assert (got.source, got.run_id) == ("relay", "run-a")
    files.remove(spark, f"{folder}/results")  # from now on only the cache has it
    got = pulled(spark, folder, "a", cache)["a"]
    assert (got.source, got.run_id) == ("cache", "run-a")


def test_limits(spark, tmp_path):
    folder = str(tmp_path / "r")
    relay.publish(spark.createDataFrame([("a", body("a", note="x" * 5000)), ("b", body("b"))], "venue string, body string"), folder, NOW)
    got = pulled(spark, folder, "ab", largest=2000)
    assert got["a"].reason == "too_large" and got["b"].reason is None
    direct = relay.fetched(spark.createDataFrame([("a", "direct"), ("b", None)], "venue string, egress string"), folder, NOW).collect()
    assert [r.reason for r in direct] == ["not_relayed"] * 2
