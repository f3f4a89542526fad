import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import robust
from tidemark.operators.pricing import reference_prices


def model_median(pairs):
    pairs = sorted((x, w) for x, w in pairs if w > 0)
    half, cum = sum(w for _, w in pairs) / 2, 0.0
    for k, (x, w) in enumerate(pairs):
        cum += w
        if cum == half and k + 1 < len(pairs):
            return (x + pairs[k + 1][0]) / 2
        if cum >= half:
            return x
    return None


def test_median_against_model(spark):
    r = random.Random(1)
    rows = [(k, float(r.randint(1, 9)), float(r.randint(0, 4))) for k in range(60) for _ in range(r.randint(1, 8))]
    df = spark.createDataFrame(rows, "k int, x double, w double")
    want = {k: model_median([(x, w) for j, x, w in rows if j == k]) for k in range(60)}
    got = {x.k: x.weighted_median for x in robust.weighted_median(df, ["k"], "x", "w").collect()}
    assert got == {k: v for k, v in want.items() if v is not None}
    arrays = df.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("x", "w"))).alias("p")).select("k", robust.median_of(F.col("p")).alias("m"))
    assert {x.k: x.m for x in arrays.collect()} == want


@pytest.mark.parametrize("weights,want", [([], []), ([0.0, 0.0], [0, 0]), ([5.0, 1.0], [0.5, 0.5]), ([1.0, 1.0, 1.0, 1.0], [0.25] * 4)])
def test_caps(spark, weights, want):
    df = spark.createDataFrame([(weights,)], "w array<double>")
    assert df.select(robust.cap_weights(F.col("w"), 0.35).alias("s")).first().s == pytest.approx(want)


def test_caps_hold_and_sum_to_one(spark):
    r = random.Random(2)
    rows = [([r.random() ** 4 for _ in range(r.randint(3, 12))],) for _ in range(50)]
    for row in spark.createDataFrame(rows, "w array<double>").select(robust.cap_weights(F.col("w"), 0.35).alias("s")).collect():
        assert math.isclose(sum(row.s), 1) and max(row.s) <= 0.35 + 1e-9


def _obs(spark, prices):
    rows = [(1, k, "spot", p, v, 0.0, "mid") for k, (p, v) in enumerate(prices)]
    return spark.createDataFrame(rows, "asset int, venue int, kind string, price double, volume double, age_s double, source string")


def test_worked_example(spark):
    vols = [4e9, 1e9, 2.5e8, 1e8, 2e8]
    p = reference_prices(_obs(spark, zip([84400.0, 84410.0, 84395.0, 84405.0, 91000.0], vols))).first()
    assert p.reference_price == 84405 and p.mad_bps == pytest.approx(0.59, abs=0.01) and p.p10_p90_bps == pytest.approx(470, abs=1)
    q = reference_prices(_obs(spark, zip([84400.0, 84410.0, 84395.0, 84405.0, 200000.0], vols))).first()
    assert q.reference_price == 84400 and q.n_extreme_deviation == 1 and q.included_count == 4


def test_one_spot_and_fallback(spark):
    one = reference_prices(_obs(spark, [(5.0, None)])).first()
    assert (one.method, one.mad_bps, one.reference_price) == ("single_venue_spot", None, 5.0)
    perps = _obs(spark, [(5.0, 1.0), (5.1, 1.0)]).withColumn("kind", F.lit("perpetual"))
    assert reference_prices(perps).first().method == "derivative_fallback"


def test_many_observations_of_one_asset(spark):
    """Cost per observation does not depend on how many an asset has; equal ones share their weight."""
    import time

    schema = "asset int, venue int, kind string, price double, volume double, age_s double, source string"
    r = random.Random(4)
    rows = [(1, k % 50, "spot" if k % 3 else "perpetual", 100 + r.random(), float(r.randint(1, 9)), 0.0, "mid") for k in range(10_000)]
    df = spark.createDataFrame(rows + rows[:5], schema)
    began = time.perf_counter()
    got = reference_prices(df).first()
    assert time.perf_counter() - began < 30 and got.included_count + got.excluded_count == 10_005
    spot = sorted((p, max(1e-3, v**0.5)) for _, _, kind, p, v, _, _ in rows + rows[:5] if kind == "spot")
    assert got.reference_price == pytest.approx(model_median(spot))
