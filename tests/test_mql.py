import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.mql import Engine, MqlError, MqlSemanticError, MqlSyntaxError
from tidemark.mql.engine import check, market_schema
from tidemark.mql.language import parse


def test_precedence():
    where = parse("SELECT asset FROM market WHERE NOT venue_count = 1 OR venue_count = 2 AND venue_count = 3").where
    assert where[0] == "or" and where[1][0] == "not" and where[2][0] == "and"


@pytest.mark.parametrize("text", ["SELECT", "SELECT * FROM market WHERE", "SELECT * FROM market LIMIT -1", "SELECT a FROM market extra", "SELECT count(*) FROM market", "SELECT 'it''s' FROM market", "SELECT # FROM market"])
def test_syntax_errors_have_a_place(text):
    with pytest.raises(MqlSyntaxError) as e:
        parse(text)
    assert e.value.position is not None


@pytest.mark.parametrize("text,part", [
    ("SELECT reference_prise FROM market", "reference_price"), ("SELECT asset FROM other", "only source"), ("SELECT asset, venue_count AS asset FROM market", "asset"),
    ("SELECT asset FROM market WHERE asset_name = 'x'", "asset_name"), ("SELECT asset FROM market WHERE asset = 4", "compare"), ("SELECT asset FROM market ORDER BY asset_name", "asset_name"),
])
def test_semantic_errors(spark, text, part):
    with pytest.raises(MqlSemanticError, match=part):
        check(parse(text))


@given(st.text(alphabet="SELECT FROMmarket*,()'=<>;-09.\\ asset_", max_size=60))
@settings(max_examples=200, deadline=None)
def test_parser_raises_only_its_own_errors(text):
    try:
        parse(text)
    except MqlError:
        pass


def _market(spark):
    names = [f.name for f in market_schema().fields]
    row = lambda s, p, n: tuple({"symbol": s, "reference_price__value": p, "venue_count": n}.get(c) for c in names)
    return Engine(spark.createDataFrame([row("BTC", 100.0, 5), row("ETH", 10.0, 3), row("ZZZ", None, None)], market_schema()))


def test_runs(spark):
    m = _market(spark)
    rows = lambda q: [r[0] for r in m.run(q).collect()]
    assert rows("select asset from market order by reference_price desc limit 2.9;") == ["BTC", "ETH"]
    assert rows("SELECT asset FROM market ORDER BY reference_price") == ["ETH", "BTC", "ZZZ"]
    assert rows("SELECT asset FROM market WHERE reference_price IS NULL") == ["ZZZ"]
    assert rows("SELECT asset FROM market WHERE venue_count NOT IN (3, NULL)") == []
    assert rows("SELECT asset FROM market WHERE venue_count BETWEEN 4 AND 6 AND asset <> 'x'") == ["BTC"]
    assert len(m.run("SELECT * FROM market").columns) == 62
    assert set(m.explain("SELECT asset FROM market")) == {"text", "tree", "checked", "plan"}


def test_no_files(spark):
    with pytest.raises(MqlSemanticError):
        Engine.of_paths(spark, [])


def test_series_reach_the_market(spark):
    from pyspark.sql import functions as F

    from tidemark.plans import market
    from tidemark.plans import views as V

    sf = "/root/testdata/sf0.001"
    points = spark.range(672).select(F.lit(77).cast("long").alias("asset"), (V.AS_OF_MS - F.col("id") * 900_000).alias("ts_ms"), "id", (100 + F.col("id") % 7).cast("double").alias("price"))
    names = spark.createDataFrame([(77, "a name")], "asset long, asset_name string")
    m = market.States(obs=lambda: V.obs(spark, sf), derivs=lambda: V.derivatives(spark, sf), levels=lambda: V.book(spark, sf), points=lambda: points, names=lambda: names).table()
    made = ["price_change_1h", "price_change_24h", "price_change_7d", "realised_volatility_1h", "realised_volatility_4h", "realised_volatility_24h", "realised_volatility_7d", "atr_14_bps", "rsi_14", "ema_12", "ema_26", "largest_venue_liquidity_share", "liquidity_concentration_hhi"]
    got = Engine(m).run(f"SELECT asset, genome_status, {', '.join(made)} FROM market WHERE realised_volatility_24h > 0").collect()
    assert [r.asset for r in got] == ["P77"] and got[0].genome_status == "warming_up" and None not in got[0]
    assert m.filter("name = 'a name'").count() == 1 and m.count() == V.obs(spark, sf).select("asset").distinct().count()


def test_scanner_text():
    from tidemark.plans.catalogue import scanner_text

    assert scanner_text() == "SELECT asset, venue_count FROM market"
    text = scanner_text(3, 5, (0, 9), "negative", "venue_count", False, 7)
    assert text == "SELECT asset, venue_count FROM market WHERE venue_count >= 3 AND reported_volume_24h_usd >= 5 AND price_dispersion_bps BETWEEN 0 AND 9 AND funding_rate_8h_median < 0 ORDER BY venue_count ASC, asset LIMIT 7"
    parse(text)
