"""Stored tables over two generations, their types, and how currencies turn into dollars."""

from pyspark.sql import functions as F

from tidemark import cli
from tidemark.operators import ingest
from tidemark.plans import tables
from tidemark.sources import datasets

SF = "/root/testdata/sf0.001"


def test_carried(spark):
    schema = "id string, name string, active boolean"
    first = datasets.carried(spark.createDataFrame([("a", "A", True), ("b", "B", True)], schema), None, "id", 10)
    second = datasets.carried(spark.createDataFrame([("b", "B2", True), ("c", "C", True)], schema), first, "id", 20, "active")
    third = datasets.carried(spark.createDataFrame([("a", "A3", True)], schema), second, "id", 30, "active")
    assert sorted(map(tuple, second.collect())) == [("a", "A", False, 10, 10), ("b", "B2", True, 10, 20), ("c", "C", True, 20, 20)]
    assert sorted(map(tuple, third.collect())) == [("a", "A3", True, 10, 30), ("b", "B2", False, 10, 20), ("c", "C", False, 20, 20)]


def test_two_generations_by_command(spark, tmp_path, capsys):
    root = str(tmp_path / "root")
    for _ in range(2):
        assert cli.main([root, "build-dataset", SF]) == 0
    client = datasets.MarketClient.latest(spark, root)
    assert client.manifest["tables"] == sorted(datasets.TABLES)
    for name, columns in datasets.TABLES.items():
        fields = client.table(name).schema.fields
        assert [f.name for f in fields] == columns
        assert all(f.dataType.simpleString() == {"long": "bigint"}.get(kind := datasets._TYPE_OF.get(f.name, "string"), kind) for f in fields)
    for name in ("assets", "instruments"):
        row = client.table(name).agg(F.count_if(F.col("first_seen_at") < F.col("last_seen_at")).alias("both"), F.count("*").alias("n"), F.count_distinct("first_seen_at", "last_seen_at").alias("kinds")).first()
        assert row.both == row.n > 0 and row.kinds == 1


def test_conversions(spark):
    edges = spark.createDataFrame([("USDT", "USD", 0.9997, "v1", 5), ("USD", "EUR", 0.5, "v2", 6), ("ABC", "USDT", 3.0, "v3", 4), ("LOST", "FAR", 1.0, "v4", 1)], "src string, dst string, rate double, venue string, observed_at long")
    got = {r.currency: r.conversion for r in ingest.conversions(edges, "USD", ["USDT"]).collect()}
    assert set(got) == {"USD", "USDT", "EUR", "ABC"}
    assert (got["USD"].method, got["USD"].rate, got["USD"].path) == ("identity", 1.0, ["USD"])
    assert (got["USDT"].method, got["USDT"].path, round(got["USDT"].deviation_from_parity_bps, 6)) == ("direct", ["USDT", "USD"], -3.0)
    assert (got["EUR"].method, got["EUR"].rate, got["EUR"].source_venue_slug, got["EUR"].deviation_from_parity_bps) == ("inverse", 2.0, "v2", None)
    assert (got["ABC"].method, got["ABC"].path, got["ABC"].observed_at, got["ABC"].source_venue_slug) == ("chained", ["ABC", "USDT", "USD"], 4, "v3")


def test_unknown_columns_are_typed(spark):
    t = datasets.built_table("instruments", spark.createDataFrame([("i", 1)], "instrument_id string, extra int"))
    assert t.columns == datasets.TABLES["instruments"] and dict(t.dtypes)["tick_size"] == "double" and dict(t.dtypes)["active"] == "boolean" and t.first().venue_slug is None
    assert tables.tables(spark, SF, "g", 1)["venue_asset_state"].columns[-3:] == ["conversion", "included_in_reference_price", "exclusion_reason"]


def test_relay_by_command(spark, tmp_path, capsys):
    (tmp_path / "runs").mkdir()
    body = '{"venue_slug": "okx", "run_id": "r", "collection_finished_at": 1, "tickers": [{"symbol_native": "A"}]}'
    for name, text in {"okx": body, "kraken": body, "bybit": "{"}.items():
        (tmp_path / "runs" / f"{name}.json").write_text(text)
    assert cli.main([str(tmp_path / "relay"), "publish-relay", str(tmp_path / "runs")]) == 0
    assert capsys.readouterr().out.split() == ["okx"]
    assert cli.main([str(tmp_path / "own"), "pull-relay", str(tmp_path / "relay")]) == 0
    told = capsys.readouterr().out
    assert "too_old" in told and told.count("not_published") >= 10
