"""A market derived from the driver's tables: the same views as DataFrames and as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

AS_OF_MS = 1_706_745_600_000  # the end of January 2024
FX = {0: 1.0, 1: 1.08, 2: 1.27, 3: 0.0068, 4: None}  # USD per unit of a view's currency; one is not convertible


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quote_usd(ccy):
    out = F.when(F.lit(False), F.lit(0.0))
    for k, rate in FX.items():
        out = out.when(ccy == k, F.lit(rate).cast("double"))
    return out


FX_SQL = "CASE ccy " + " ".join(f"WHEN {k} THEN {v}" for k, v in FX.items() if v is not None) + " END"


LINE = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the price of their part: what observations are made of."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(*LINE, "p_retailprice")


def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines() written once, in buckets by part, for plans that read them several times.

    Such a plan would else join and move all line items once for each of its parts,
    as soon as the parts are too many to be broadcast. What is grouped by asset
    moves no more rows, and each part reads only columns that it needs.
    """
    name, buckets = f"lines_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    lines(spark, sf_dir).repartition(buckets, "l_partkey").write.bucketBy(buckets, "l_partkey").sortBy("l_partkey").option("path", files.shared_folder(spark, "lines")).format("parquet").saveAsTable(name)
    return spark.table(name)


def obs(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One price observation per line item: a part is an asset, a supplier modulo 16 a venue. rows: kept_lines(), if there are any."""
    rows = lines(spark, sf_dir) if rows is None else rows
    fallback = F.col("l_partkey") % 10 == 0
    return rows.select(
        F.col("l_partkey").alias("asset"), (F.col("l_suppkey") % 16).alias("venue"),
        F.when(F.col("l_returnflag") == "A", F.when(fallback, "perpetual").otherwise("spot")).when(F.col("l_returnflag") == "N", "perpetual").otherwise("future").alias("kind"),
        (F.col("p_retailprice") * (0.95 + F.col("l_discount")) * F.when(F.col("l_tax") >= 0.08, 1.5).otherwise(1.0)).alias("price"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("volume"), ((F.col("l_linenumber") - 1) * 400).cast("double").alias("age_s"),
        F.when(F.col("l_linestatus") == "O", "mid").otherwise("last").alias("source"), (F.col("l_suppkey") % 5).alias("ccy"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice",
    )


OBS = """
obs AS (SELECT l_partkey AS asset, l_suppkey % 16 AS venue,
  CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_partkey % 10 = 0 THEN 'perpetual' ELSE 'spot' END WHEN l_returnflag = 'N' THEN 'perpetual' ELSE 'future' END AS kind,
  p_retailprice * (0.95::DOUBLE + l_discount) * (CASE WHEN l_tax >= 0.08::DOUBLE THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END) AS price,
  CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS volume, ((l_linenumber - 1) * 400)::DOUBLE AS age_s,
  CASE WHEN l_linestatus = 'O' THEN 'mid' ELSE 'last' END AS source, l_suppkey % 5 AS ccy, lineitem.*, p_retailprice
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def derivatives(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Perpetuals and futures with funding and open interest in all units and semantics."""
    rows = obs(spark, sf_dir, rows).filter("kind <> 'spot'")
    k = F.col("l_linenumber")
    return rows.select(
        "asset", "venue", "kind", "price", F.col("p_retailprice").alias("reference_price"), quote_usd(F.col("ccy")).alias("quote_usd"),
        F.when(k != 6, F.col("l_discount") / 1000).alias("funding_raw"), F.when(k != 5, F.element_at(F.array(*map(F.lit, (8.0, 1.0, 4.0, 2.0))), (F.col("l_suppkey") % 4 + 1).cast("int"))).alias("funding_hours"),
        F.when(F.col("l_suppkey") % 3 == 0, "absolute").when(F.col("l_suppkey") % 7 == 1, "undocumented").otherwise("relative").alias("funding_semantics"), (F.col("l_suppkey") % 2 == 0).alias("inverse"),
        F.when(k != 7, F.col("l_quantity")).alias("oi_raw"), F.element_at(F.array(*map(F.lit, ("usd", "base_asset", "quote_currency", "contracts", "unknown"))), ((k - 1) % 5 + 1).cast("int")).alias("oi_unit"),
        F.lit(None).cast("double").alias("oi_base"), F.when(F.col("l_orderkey") % 11 == 0, F.col("l_extendedprice")).alias("oi_usd"), F.when(F.col("l_tax") > 0, F.col("l_tax") * 100).alias("multiplier"),
    )


DERIVATIVES = OBS + f""",
deriv AS (SELECT asset, venue, kind, price, p_retailprice AS reference_price, {FX_SQL} AS quote_usd,
  CASE WHEN l_linenumber <> 6 THEN l_discount / 1000 END AS funding_raw, CASE WHEN l_linenumber <> 5 THEN [8.0::DOUBLE, 1.0::DOUBLE, 4.0::DOUBLE, 2.0::DOUBLE][l_suppkey % 4 + 1] END AS funding_hours,
  CASE WHEN l_suppkey % 3 = 0 THEN 'absolute' WHEN l_suppkey % 7 = 1 THEN 'undocumented' ELSE 'relative' END AS funding_semantics, l_suppkey % 2 = 0 AS inverse,
  CASE WHEN l_linenumber <> 7 THEN l_quantity END AS oi_raw, ['usd', 'base_asset', 'quote_currency', 'contracts', 'unknown'][(l_linenumber - 1) % 5 + 1] AS oi_unit,
  NULL::DOUBLE AS oi_base, CASE WHEN l_orderkey % 11 = 0 THEN l_extendedprice END AS oi_usd, CASE WHEN l_tax > 0 THEN l_tax * 100 END AS multiplier FROM obs WHERE kind <> 'spot'),
fund AS (SELECT *, CASE WHEN kind <> 'perpetual' THEN 'not_perpetual' WHEN funding_raw IS NULL THEN 'no_rate' WHEN funding_semantics = 'undocumented' THEN 'undocumented_funding_semantics'
  WHEN coalesce(funding_hours, 0) <= 0 THEN 'no_interval' END AS funding_reason,
  CASE WHEN funding_semantics = 'relative' THEN funding_raw WHEN inverse THEN funding_raw * price ELSE funding_raw / price END AS rel FROM deriv),
f8 AS (SELECT *, CASE WHEN funding_reason IS NULL THEN rel * 8.0 / funding_hours END AS rate_8h FROM fund),
oi0 AS (SELECT *, CASE WHEN (oi_usd IS NULL OR oi_base IS NULL) AND oi_unit = 'contracts' AND multiplier IS NULL THEN 'unknown_contract_multiplier'
  WHEN (oi_usd IS NULL OR oi_base IS NULL) AND oi_unit = 'unknown' THEN 'schema_failure' END AS no,
  coalesce(oi_usd, CASE oi_unit WHEN 'usd' THEN oi_raw WHEN 'quote_currency' THEN oi_raw * quote_usd WHEN 'contracts' THEN CASE WHEN inverse THEN oi_raw * multiplier * quote_usd END END) AS u,
  coalesce(oi_base, CASE oi_unit WHEN 'base_asset' THEN oi_raw WHEN 'contracts' THEN CASE WHEN NOT inverse THEN oi_raw * multiplier END END) AS b FROM deriv WHERE oi_raw IS NOT NULL),
oi AS (SELECT *, CASE WHEN no IS NULL THEN coalesce(u, b * reference_price) END AS usd_equivalent, CASE WHEN no IS NULL THEN coalesce(b, u / reference_price) END AS base_equivalent,
  coalesce(no, CASE WHEN u IS NULL AND b IS NULL THEN 'invalid_quote_conversion' END) AS oi_reason FROM oi0)"""


def book(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Order book levels: open lines bid, the others ask, close to the part's price."""
    rows = obs(spark, sf_dir, rows)
    bid = F.col("source") == "mid"
    off = (F.col("l_discount") + 0.0001 * F.col("l_linenumber")) / 20
    return rows.select(
        "asset", "venue", F.when(bid, "bid").otherwise("ask").alias("side"), (F.col("p_retailprice") * F.when(bid, 1 - off).otherwise(1 + off)).alias("price"), F.col("l_quantity").alias("size"),
        F.col("p_retailprice").alias("reference_price"), F.lit(1.0).alias("quote_usd"), F.when(F.col("l_suppkey") % 4 == 0, "perpetual").otherwise("spot").alias("kind"), (F.col("l_suppkey") % 8 == 0).alias("inverse"), F.when(F.col("l_tax") > 0, F.lit(10.0)).alias("multiplier"),
    )


BOOK = OBS + """,
book AS (SELECT *, CASE WHEN kind = 'spot' THEN price * size WHEN multiplier IS NULL THEN NULL WHEN inverse THEN size * multiplier ELSE price * size * multiplier END AS usd FROM (
  SELECT asset, venue, CASE WHEN source = 'mid' THEN 'bid' ELSE 'ask' END AS side,
  p_retailprice * (CASE WHEN source = 'mid' THEN 1 - (l_discount + 0.0001::DOUBLE * l_linenumber) / 20 ELSE 1 + (l_discount + 0.0001::DOUBLE * l_linenumber) / 20 END) AS price, l_quantity AS size,
  p_retailprice AS reference_price, CASE WHEN l_suppkey % 4 = 0 THEN 'perpetual' ELSE 'spot' END AS kind, l_suppkey % 8 = 0 AS inverse, CASE WHEN l_tax > 0 THEN 10.0::DOUBLE END AS multiplier FROM obs))"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series: a user is an asset, an event's value its price."""
    e = table(spark, sf_dir, "events").filter("value > 0")
    return e.select(F.col("user_id").alias("asset"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.col("event_id").alias("id"), F.col("value").alias("price"), F.lit(AS_OF_MS).alias("as_of_ms"), "event_type")


POINTS = f"""
points AS (SELECT user_id AS asset, epoch_us(ts) // 1000 AS ts_ms, event_id AS id, value AS price, {AS_OF_MS} AS as_of_ms, event_type FROM events WHERE value > 0)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of each asset (a user) in the past: an event brings some of its measures."""
    e, k, kind = table(spark, sf_dir, "events").filter("value > 0"), F.col("event_id"), F.col("event_type")
    return e.select(
        F.col("user_id").alias("asset"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), k.alias("id"), F.col("value").alias("price"),
        F.when(kind != "error", (k % 17 - 8) / 100_000).alias("funding_8h"), F.when(kind != "click", (k % 23 - 11).cast("double")).alias("basis_bps"),
        F.when(kind != "signup", F.col("value") * 1000).alias("open_interest_usd"), F.when((kind != "view") | (k % 3 == 0), F.col("value") * 10).alias("volume_usd"),
    )


HISTORY = """
hist AS (SELECT user_id AS asset, epoch_us(ts) // 1000 AS ts_ms, event_id AS id, value AS price, CASE WHEN event_type <> 'error' THEN (event_id % 17 - 8)::DOUBLE / 100000 END AS funding_8h, CASE WHEN event_type <> 'click' THEN (event_id % 23 - 11)::DOUBLE END AS basis_bps,
  CASE WHEN event_type <> 'signup' THEN value * 1000 END AS open_interest_usd, CASE WHEN event_type <> 'view' OR event_id % 3 = 0 THEN value * 10 END AS volume_usd FROM events WHERE value > 0)"""


def median_sql(source: str, keys: str, x: str, w: str, name: str) -> str:
    """Weighted median as a query."""
    over = f"PARTITION BY {keys} ORDER BY {x}, {w}"
    return f"""SELECT {keys}, arg_min(CASE WHEN cum = half THEN coalesce((x + nx) / 2, x) ELSE x END, rn) AS {name} FROM (SELECT {keys}, {x} AS x,
  sum({w}) OVER ({over} ROWS UNBOUNDED PRECEDING) AS cum, sum({w}) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) / 2 AS half,
  lead({x}) OVER ({over}) AS nx, row_number() OVER ({over}) AS rn FROM {source} WHERE {w} > 0 AND {x} IS NOT NULL) WHERE cum >= half GROUP BY {keys}"""


def _over(a: str) -> str:
    return f"list_sum(list_transform({a}, lambda s: greatest(0.0::DOUBLE, s - 0.35)))"


def _room(a: str) -> str:
    return f"list_sum(list_transform({a}, lambda s: greatest(0.0::DOUBLE, 0.35 - s)))"


def cap_sql(weights: str) -> str:
    """Capped shares of a list of weights."""
    step = f"CASE WHEN {_over('a')} <= 1e-12 OR {_room('a')} <= 1e-12 THEN a ELSE list_transform(a, lambda s: CASE WHEN s >= 0.35 THEN 0.35::DOUBLE ELSE s + {_over('a')} * (0.35 - s) / {_room('a')} END) END"
    start = f"list_concat([list_transform({weights}, lambda x: x / list_sum({weights}))], list_transform(range(len({weights})), lambda i: NULL::DOUBLE[]))"
    return f"CASE WHEN 0.35 * len({weights}) <= 1 THEN list_transform({weights}, lambda x: 1.0::DOUBLE / len({weights})) ELSE list_reduce({start}, lambda a, b: {step}) END"


FRESH = "CASE WHEN age_s >= 1800 THEN 0.25::DOUBLE WHEN age_s <= 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - 0.75::DOUBLE * age_s / 1800.0::DOUBLE END"
PRICES = OBS + f""",
w0 AS (SELECT *, max(CASE WHEN kind = 'spot' THEN 1 ELSE 0 END) OVER (PARTITION BY asset) = 1 AS has_spot FROM obs),
w1 AS (SELECT *, CASE WHEN NOT has_spot OR kind = 'spot' THEN greatest(0.001::DOUBLE, (CASE WHEN volume > 0 THEN sqrt(volume) ELSE 0.001::DOUBLE END) * ({FRESH}) * (CASE source WHEN 'mid' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END)) END AS rw FROM w0),
ce AS ({median_sql('w1', 'asset', 'price', 'rw', 'centre')}),
w2 AS (SELECT w1.*, centre, CASE WHEN rw IS NULL THEN 'spot_preferred' WHEN abs((price - centre) / centre * 10000.0) > 2000 THEN 'extreme_deviation' END AS reason FROM w1 JOIN ce USING (asset)),
li AS (SELECT asset, list(price ORDER BY price, rw) AS ps, list(rw ORDER BY price, rw) AS ws FROM w2 WHERE reason IS NULL GROUP BY asset),
ca AS (SELECT asset, unnest(ps) AS price, unnest(ws) AS rw, unnest({cap_sql('ws')}) AS weight FROM li),
rp AS ({median_sql('ca', 'asset', 'price', 'weight', 'reference_price')}),
off AS (SELECT asset, abs(price - reference_price) AS off, weight FROM ca JOIN rp USING (asset)),
md AS ({median_sql('off', 'asset', 'off', 'weight', 'mad')}),
pr AS (SELECT asset, max(reference_price) AS reference_price, count(DISTINCT CASE WHEN reason IS NULL THEN venue END) AS venue_count, count(*) FILTER (reason IS NULL) AS included_count, count(*) FILTER (reason IS NOT NULL) AS excluded_count,
  count(*) FILTER (reason = 'spot_preferred') AS n_spot_preferred, count(*) FILTER (reason = 'extreme_deviation') AS n_extreme_deviation, min(CASE WHEN reason IS NULL THEN price END) AS min_price, max(CASE WHEN reason IS NULL THEN price END) AS max_price,
  CASE WHEN NOT max(has_spot) THEN 'derivative_fallback' WHEN count(*) FILTER (reason IS NULL) = 1 THEN 'single_venue_spot' ELSE 'spot_weighted_median' END AS method,
  CASE WHEN count(*) FILTER (reason IS NULL) >= 2 THEN max(mad) / max(reference_price) * 10000.0 END AS mad_bps,
  CASE WHEN count(*) FILTER (reason IS NULL) >= 4 THEN (quantile_cont(CASE WHEN reason IS NULL THEN price END, 0.9) - quantile_cont(CASE WHEN reason IS NULL THEN price END, 0.1)) / max(reference_price) * 10000.0 END AS p10_p90_bps,
  CASE WHEN count(*) FILTER (reason IS NULL) >= 2 THEN max(CASE WHEN reason IS NULL THEN abs(price - reference_price) END) / max(reference_price) * 10000.0 END AS max_dev_bps
  FROM w2 JOIN rp USING (asset) JOIN md USING (asset) GROUP BY asset)"""
VOLUMES = """
vo AS (SELECT asset, sum(volume) FILTER (kind = 'spot') AS spot_usd, sum(volume) FILTER (kind = 'perpetual') AS perp_usd, sum(volume) FILTER (kind = 'future') AS futures_usd, sum(volume) FILTER (kind = 'option') AS options_usd,
  sum(volume) AS total_usd, sum(volume) FILTER (kind IN ('perpetual', 'future')) AS derivative_usd, sum(volume) FILTER (kind = 'perpetual') / nullif(sum(volume), 0) AS perp_dominance FROM obs GROUP BY asset),
sh AS (SELECT asset, venue, v, v / sum(v) OVER (PARTITION BY asset) AS share FROM (SELECT asset, venue, sum(volume) AS v FROM obs WHERE volume > 0 GROUP BY asset, venue)),
hh AS (SELECT asset, sum(share * share) AS hhi, max(share) AS largest_share, 1 / sum(share * share) AS effective_count FROM sh GROUP BY asset)"""
