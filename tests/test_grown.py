"""Queries against their SQL on rows that only larger tables have."""

import glob
import os

import duckdb
import pytest

from tests.test_catalogue import rows
from tidemark.plans import catalogue, client_queries, live_queries, star_queries, state_queries, venue_queries  # noqa: F401

SF = "/root/testdata/sf0.1"
#: Assets of which two equal shares under the cap lie at half of all weight.
TIED = (2059, 3195, 3599, 16575)


def _linked(folder, but=()):
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        if os.path.basename(path) not in but:
            os.symlink(path, folder / os.path.basename(path))
    return str(folder)


def _views(folder):
    c = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return c


def same(spark, folder, name):
    got, want = catalogue.QUERIES[name](spark, folder).toPandas(), _views(folder).execute(catalogue.ORACLE_SQL[name]).df()
    assert len(want) and rows(got) == rows(want)


@pytest.fixture(scope="module")
def tied(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tied")
    for name, key in (("lineitem", "l_partkey"), ("part", "p_partkey")):
        duckdb.execute(f"COPY (SELECT * FROM '{SF}/{name}.parquet' WHERE {key} IN {TIED}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return _linked(folder, ("lineitem.parquet", "part.parquet"))


@pytest.mark.parametrize("name", ["reference_price", "price_dispersion", "fragmentation_index", "venue_states", "venue_table"])
def test_ties_at_half_of_all_weight(spark, tied, name):
    same(spark, tied, name)


@pytest.fixture(scope="module")
def unpriced(tmp_path_factory):
    """The smallest tables and a part with two prices of equal weight, both too far from their mean."""
    folder, sf = tmp_path_factory.mktemp("unpriced"), "/root/testdata/sf0.001"
    duckdb.execute(f"COPY (FROM '{sf}/part.parquet' UNION ALL (SELECT * REPLACE (900001 AS p_partkey) FROM '{sf}/part.parquet' LIMIT 1)) TO '{folder}/part.parquet' (FORMAT parquet)")
    line = f"SELECT * REPLACE (900001 AS l_partkey, 'A' AS l_returnflag, 'O' AS l_linestatus, 1 AS l_linenumber, 50000 AS l_extendedprice, %s AS l_discount, %s AS l_tax, %s AS l_suppkey) FROM (FROM '{sf}/lineitem.parquet' LIMIT 1)"
    duckdb.execute(f"COPY (FROM '{sf}/lineitem.parquet' UNION ALL {line % (0.0, 0.0, 1)} UNION ALL {line % (0.1, 0.08, 2)}) TO '{folder}/lineitem.parquet' (FORMAT parquet)")
    return _linked(folder, ("lineitem.parquet", "part.parquet"))


UNPRICED = ["client_counts", "coverage_and_freshness", "market_overview", "market_star", "mql_is_null", "mql_star", "fragmentation_index", "price_dispersion", "reference_price", "web_export", "client_market", "client_search"]


@pytest.mark.parametrize("name", UNPRICED)
def test_assets_without_a_price(spark, unpriced, name):
    same(spark, unpriced, name)


def test_snapshot_of_assets_of_any_rank(spark, tmp_path):
    """Only assets behind the first thousand are asked for."""
    duckdb.execute(f"COPY (SELECT * REPLACE (CASE WHEN event_type = 'signup' AND user_id % 7 <> 6 THEN 'view' ELSE event_type END AS event_type) FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    same(spark, _linked(tmp_path, ("events.parquet",)), "live_snapshot")


def _added(n, x):
    total = 0.0
    for _ in range(n):
        total += x
    return total


def test_plan_by_exact_volumes(spark, tmp_path):
    """Sums that are whole numbers, but not as sums of doubles in any order."""
    found = ((n, x) for n in range(10, 60) for x in range(1_000_000, 1_000_400) if n * x % 100 == 0)
    n, cents = next((n, x) for n, x in found if int(_added(n, x / 100)) != n * x // 100)
    line = f"SELECT * REPLACE (1 AS l_partkey, 1 AS l_suppkey, 1 AS l_linenumber, {cents / 100}::DOUBLE AS l_extendedprice) FROM (FROM '/root/testdata/sf0.001/lineitem.parquet' LIMIT 1), range({n})"
    duckdb.execute(f"COPY (SELECT * EXCLUDE (range) FROM ({line})) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    row = catalogue.QUERIES["book_plan_budgets"](spark, _linked(tmp_path, ("lineitem.parquet",))).first()
    assert row["rank"] == -(n * cents // 100)


def test_payloads_stay_small(spark):
    """More parts make more payloads."""
    from pyspark.sql import functions as F

    from tidemark.sources import venues as S

    feed = next(f for f in S.FEEDS if f.venue == "kraken")
    keys = {k: make() for k, make in venue_queries._ticker_columns(feed)[0].items()}
    longest = lambda n: venue_queries._payloads(spark.range(n).withColumnRenamed("id", "p_partkey"), feed, keys).agg(F.max(F.length("payload"))).first()[0]
    assert longest(40_000) < 1.2 * longest(5_000)


def test_tiers_without_pairs(spark):
    """Instruments are one row for each venue and symbol before they meet observations."""
    from tidemark.operators import ingest

    i = spark.createDataFrame([(0, "X", "spot", "spot", 1), (0, "X", "perpetual_linear", "perpetual", 2), (0, "X", "perpetual_linear", "perpetual", 3), (0, "Y", "future_dated", "future", 4)], "venue long, symbol string, class string, type string, instrument_id long")
    o = spark.createDataFrame([(1, 0, "X", "spot"), (2, 0, "X", "perpetual_linear"), (3, 0, "X", "perpetual"), (4, 0, "X", None), (5, 0, "Y", "derivative"), (6, 0, "Y", None), (7, 1, "X", "spot"), (8, 0, "Y", "spot")], "id long, venue long, symbol string, hint string")
    found = ingest.tiered_match(o, i)
    assert {r.id: r.instrument_id for r in found.collect()} == {1: 1, 2: 2, 3: None, 4: None, 5: 4, 6: 4, 7: None, 8: None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join") :]
    assert "Aggregate [i_venue" in joined


def test_no_leaf_of_a_tree_is_left_large():
    """Sixty times as many assets as are sampled: all leaves stay small, also those that the tree comes to last."""
    import numpy as np

    from tidemark.operators import genomes

    x = np.random.Generator(np.random.PCG64(2)).normal(size=(20_000, 8))
    _, n = np.unique(genomes.leaf_of(x, genomes.splits(x, 60 * len(x), 200)), return_counts=True)
    assert len(n) <= genomes.MOST_LEAVES and n.max() < 20


def test_currencies_go_to_all_tasks(spark):
    """Observations are not dealt out by their quote currency, of which there are few."""
    plan = state_queries.venue_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    on_currency = [line for line in plan.splitlines() if "Join LeftOuter, (quote#" in line]
    assert on_currency and all("rightHint=(strategy=broadcast)" in line for line in on_currency)


def test_queries_of_the_market_store_no_tables(spark, tmp_path):
    """What queries of the market read are the states, each shard in one file; tables are stored with them where they are asked for."""
    folder = _linked(tmp_path)
    states = client_queries.stored(spark, folder)
    assert states.manifest["tables"] == [] and len(states.manifest["files"]) <= states.manifest["shards"]
    assert "quality_events" in client_queries.stored(spark, folder, whole=True).manifest["tables"]
    assert client_queries.stored(spark, folder).manifest["tables"]  # once the tables are there, all read that generation


def test_events_are_judged_once(spark):
    """The test for a reason is made on the reason itself, not on all that it is made of."""
    from tidemark.plans import tables, views

    plan = tables.tables(spark, "/root/testdata/sf0.001", "g", views.AS_OF_MS)["quality_events"]._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.splitlines() if "Filter" in line and "CASE WHEN" in line]
    assert "isnotnull(reason#" in plan and not tests


def test_events_are_sorted_by_more_than_the_venue(spark):
    from tidemark.sources import datasets

    rows = spark.range(5000).selectExpr("'g' AS generation_id", "'1' AS venue_slug", "'P' || id AS asset_id", "'stale' AS event_type", "0L AS observed_at")
    plan = datasets.built_table("quality_events", rows)._jdf.queryExecution().executedPlan().toString()
    assert "asset_id#" in plan[plan.index("rangepartitioning(") :].splitlines()[0]


def test_venues_are_counted_without_groups_of_them(spark):
    """Percentiles of an asset stay one buffer: no aggregate by asset and venue comes before them."""
    from tidemark.operators import derivatives, pricing
    from tidemark.plans import views

    for df in (pricing.reference_prices(views.obs(spark, "/root/testdata/sf0.001")), derivatives.funding_by_asset(views.derivatives(spark, "/root/testdata/sf0.001"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile" in plan and "distinct" not in plan and df.schema["venue_count"].dataType.simpleString() == "bigint"


def test_kept_lines_are_not_moved_again(spark):
    """What is grouped by asset is made where the lines lie, as many parts as there are."""
    from tidemark.operators import pricing
    from tidemark.plans import views

    lines = views.kept_lines(spark, "/root/testdata/sf0.001")
    plan = pricing.reference_prices(views.obs(spark, "/root/testdata/sf0.001", lines))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert not views.obs(spark, "/root/testdata/sf0.001", lines).exceptAll(views.obs(spark, "/root/testdata/sf0.001")).take(1) and lines.count() == views.obs(spark, "/root/testdata/sf0.001").count()


def test_features_of_assets_are_made_once(spark):
    """The search reads its assets several times; it reads a table, not all that they are made of."""
    read = catalogue.QUERIES["genome_nearest"](spark, "/root/testdata/sf0.001").inputFiles()
    assert read and not [f for f in read if "lineitem" in f or "/lines/" in f]


def test_rows_of_venues_read_kept_lines(spark):
    """Their parts join and move no line items of their own."""
    read = state_queries.venue_rows(spark, "/root/testdata/sf0.001").inputFiles()
    assert [f for f in read if "/lines/" in f] and not [f for f in read if "lineitem" in f]
