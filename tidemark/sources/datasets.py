"""Stored generations: tables and sharded states, a manifest with checksums, a pointer that is written last, and a client.

All paths are Spark's: what is written, read and hashed can be on any file system
that the executors share.
"""

from __future__ import annotations

import hashlib
import json
import time
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import shard
from tidemark.mql.engine import Engine, market_schema
from tidemark.mql.metrics import METRICS
from tidemark.sources import files

SHARDS, LARGEST_FILE = 64, 32 << 20
STATES = "asset_market_state"
# The columns of each table, in their order.
TABLES = {
    "assets": "asset_id symbol name chain_slug chain_id contract_address resolution_state is_stablecoin is_fiat tracks_asset_id first_seen_at last_seen_at venue_count".split(),
    "asset_aliases": "asset_id venue_slug venue_symbol resolution_state evidence confidence_note".split(),
    "asset_relationships": "from_asset_id to_asset_id relationship source note".split(),
    "instruments": (
        "instrument_id venue_slug instrument_type instrument_class symbol_native symbol_normalized base_asset_id quote_asset_id settlement_asset_id underlying_asset_id contract_type contract_multiplier contract_value_asset_id settlement_period "
        "tick_size quantity_step minimum_quantity minimum_notional expiry strike option_type funding_interval_hours funding_semantics open_interest_unit active listing_time delisting_time first_seen_at last_seen_at"
    ).split(),
    "adapter_health": (
        "venue_slug status duration_ms requests_attempted requests_successful timeouts rate_limit_responses application_errors parse_failures http_errors instrument_count ticker_count derivative_observation_count order_book_count "
        "bytes_received circuit_opened error_types unknown_enum_values notes clock_skew_ms"
    ).split(),
    "quality_events": "generation_id venue_slug instrument_id asset_id event_type severity detail observed_at".split(),
    "venue_asset_state": (
        "asset_id venue_slug observed_at price_usd price_source deviation_bps reference_weight spread_bps reported_base_volume_24h reported_quote_volume_24h reported_volume_24h_usd volume_share liquidity_share depth_50bps_usd "
        "funding_rate_raw funding_interval_hours funding_rate_8h mark_price_usd index_price_usd open_interest_raw open_interest_usd instrument_count conversion__from_asset_id conversion__to_asset_id conversion__rate conversion__method "
        "conversion__observed_at conversion__source_venue_slug conversion__path conversion__deviation_from_parity_bps included_in_reference_price exclusion_reason"
    ).split(),
}


#: Columns of these tables that are no text.
TYPES = {
    "long": "chain_id first_seen_at last_seen_at venue_count expiry listing_time delisting_time duration_ms requests_attempted requests_successful timeouts rate_limit_responses application_errors parse_failures http_errors "
    "instrument_count ticker_count derivative_observation_count order_book_count bytes_received observed_at conversion__observed_at clock_skew_ms",
    "double": "contract_multiplier tick_size quantity_step minimum_quantity minimum_notional strike funding_interval_hours price_usd deviation_bps reference_weight spread_bps reported_base_volume_24h reported_quote_volume_24h reported_volume_24h_usd "
    "volume_share liquidity_share depth_50bps_usd funding_rate_raw funding_rate_8h mark_price_usd index_price_usd open_interest_raw open_interest_usd conversion__rate conversion__deviation_from_parity_bps",
    "boolean": "is_stablecoin is_fiat active circuit_opened included_in_reference_price",
}
_TYPE_OF = {name: kind for kind, names in TYPES.items() for name in names.split()}


class AssetNotFound(LookupError):
    pass


class AmbiguousAsset(LookupError):
    pass


class ChecksumMismatch(ValueError):
    pass


class NotPublishable(ValueError):
    pass


def flattened(df: DataFrame) -> DataFrame:
    """Nested structs as parent__child columns; arrays and maps as JSON text."""
    out = []

    def walk(schema, path: str, name: str) -> None:
        for f in schema.fields:
            at, to = f"{path}`{f.name}`", f"{name}{f.name}"
            kind = f.dataType.typeName()
            if kind == "struct":
                walk(f.dataType, f"{at}.", f"{to}__")
            else:
                out.append((F.to_json(F.col(at)) if kind in ("array", "map") else F.col(at)).alias(to))

    walk(df.schema, "", "")
    return df.select(*out)


def searched(assets: DataFrame, text: str) -> DataFrame:
    """Assets whose symbol or name has the text, in any case."""
    needle = F.lit(text.lower())
    return assets.filter(F.contains(F.lower("symbol"), needle) | F.contains(F.lower(F.coalesce("name", F.lit(""))), needle)).select("asset_id", "symbol", "name")


#: How tables are written: small row groups, so that a reader of few rows prunes by their statistics.
PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.block.row.count.limit": "65536", "parquet.enable.summary-metadata": "false"}


def built_table(name: str, rows: DataFrame) -> DataFrame:
    """rows flattened, with a table's columns in their order and of their types, and sorted by the first four, so that ranges stay small where few values lead; a column that rows lack is null. Other columns are left out."""
    flat, columns = flattened(rows), TABLES[name]
    ordered = flat.select(*[(F.col(c) if c in flat.columns else F.lit(None)).cast(_TYPE_OF.get(c, "string")).alias(c) for c in columns])
    return ordered.sort(*[c for c in columns[:4] if c in flat.columns])


def carried(now: DataFrame, before: DataFrame | None, key: str, at_ms: int, live: str | None = None) -> DataFrame:
    """A generation's rows with first_seen_at and last_seen_at, and rows of the generation before that are not among them: those keep what was known, and `live`, if named, becomes false.

    A keyed upsert: one join on the key, of which each side has a row. before has
    the columns of now and both times; None for the first generation.
    """
    columns = [c for c in now.columns if c not in ("first_seen_at", "last_seen_at")]
    fresh = now.select(*columns)
    if before is None:
        return fresh.withColumns({"first_seen_at": F.lit(at_ms).cast("long"), "last_seen_at": F.lit(at_ms).cast("long")})
    old = before.select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"), F.col("first_seen_at").alias("_first"), F.col("last_seen_at").alias("_last"))
    j = fresh.select(F.col(key).alias("_now_key"), F.struct(*columns).alias("_now")).join(old, F.col("_now_key") == F.col("_key"), "full")
    there = F.col("_now").isNotNull()
    told = [(F.when(there, F.col(f"_now.{c}")).otherwise(F.lit(False) if c == live else F.col(f"_old.{c}"))).alias(c) for c in columns]
    return j.select(*told, F.coalesce("_first", F.lit(at_ms)).cast("long").alias("first_seen_at"), F.when(there, F.lit(at_ms)).otherwise(F.col("_last")).cast("long").alias("last_seen_at"))


def write_generation(spark: SparkSession, root: str, generation: str, states: DataFrame, tables: dict[str, DataFrame], shards: int = SHARDS, most_bytes: int = LARGEST_FILE) -> dict:
    """Writes zstd Parquet and the manifest, checks what was written, then moves the pointer. A reader sees the old generation or the whole new one.

    States are sorted by id in their shards, as a reader of one asset prunes by
    shard first; a task writes one shard. Files are hashed by tasks; the driver has their names and digests.
    """
    folder = f"{root.rstrip('/')}/generations/{generation}"
    sharded = states.withColumn("shard_index", shard(F.col("asset_id"), shards))
    sharded.repartitionById(shards, "shard_index").sortWithinPartitions("shard_index", "asset_id").write.options(**PARQUET).partitionBy("shard_index").parquet(f"{folder}/{STATES}")
    for name, df in tables.items():
        (built_table(name, df) if name in TABLES else flattened(df)).write.options(**PARQUET).parquet(f"{folder}/{name}")
    listed = [r.asDict() for r in files.digests(spark, folder).orderBy("path").collect()]  # one row for each file
    if large := [f["path"] for f in listed if f["bytes"] > most_bytes]:
        raise NotPublishable(f"files over {most_bytes} bytes: {', '.join(large)}")
    rows = spark.read.parquet(f"{folder}/{STATES}").agg(F.count("*").alias("n"), F.count_distinct("asset_id").alias("ids")).first()
    if rows.n != rows.ids:
        raise NotPublishable(f"{rows.n} states of {rows.ids} assets")
    manifest = {"generation": generation, "published_at": int(time.time() * 1000), "asset_count": rows.n, "shards": shards, "tables": sorted(tables), "files": listed}
    body = json.dumps(manifest, sort_keys=True)
    files.write_text(spark, f"{folder}/manifest.json", body)
    files.write_text(spark, f"{root.rstrip('/')}/latest.json", json.dumps({"generation": generation, "manifest_sha256": hashlib.sha256(body.encode()).hexdigest()}))
    return manifest


def expired(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Generations that are neither the latest nor among the newest: they may be removed."""
    names = files.subfolders(spark, f"{root.rstrip('/')}/generations")
    latest = json.loads(files.read_text(spark, f"{root.rstrip('/')}/latest.json"))["generation"]
    return [n for n in names[:-keep] if n != latest]


class AssetView:
    """One asset's state; metrics are attributes, under the names that queries use."""

    def __init__(self, row: Row):
        self.row = row

    def __getattr__(self, name: str):
        if name not in METRICS:
            raise AttributeError(name)
        return self.row[METRICS[name].column]


class MarketClient:
    """Read access to one generation."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = json.loads(files.read_text(spark, f"{self.folder}/manifest.json"))

    @classmethod
    def latest(cls, spark: SparkSession, root: str) -> MarketClient:
        pointer = json.loads(files.read_text(spark, f"{root.rstrip('/')}/latest.json"))
        return cls.of(spark, root, pointer["generation"], pointer["manifest_sha256"])

    @classmethod
    def of(cls, spark: SparkSession, root: str, generation: str, sha256: str | None = None) -> MarketClient:
        """A generation by its name; with the digest that a pointer states, its manifest is checked."""
        folder = f"{root.rstrip('/')}/generations/{generation}"
        if sha256 is not None and hashlib.sha256(files.read_text(spark, f"{folder}/manifest.json").encode()).hexdigest() != sha256:
            raise ChecksumMismatch("manifest.json")
        return cls(spark, folder)

    def mismatches(self) -> DataFrame:
        """Files that are not as published, or not there: (path, published, found)."""
        published = self.spark.createDataFrame([(f["path"], f["sha256"]) for f in self.manifest["files"]], "p_path string, published string")
        found = files.digests(self.spark, self.folder).select("path", F.col("sha256").alias("found"))
        return published.join(found, F.col("p_path") == F.col("path"), "left").filter(~F.col("published").eqNullSafe(F.col("found"))).select(F.col("p_path").alias("path"), "published", "found")

    def verify(self) -> int:
        """Hashes every file again; how many there are."""
        if bad := self.mismatches().orderBy("path").first():
            raise ChecksumMismatch(bad.path)
        return len(self.manifest["files"])

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def market(self) -> DataFrame:
        schema = market_schema().add("shard_index", "integer")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{STATES}")

    def query(self, text: str) -> DataFrame:
        return Engine(self.market()).run(text)

    def search(self, text: str) -> DataFrame:
        """Assets whose symbol or name has the text, in any case."""
        return searched(self.market(), text).orderBy("symbol", "asset_id")

    def asset(self, symbol_or_id: str) -> Row:
        """One asset's state; only the shard that can hold its id is read."""
        ids = [symbol_or_id] if symbol_or_id.startswith("asset:") else [r.asset_id for r in self.market().filter(F.col("symbol") == symbol_or_id).select("asset_id").distinct().limit(10).collect()]
        if len(ids) > 1:
            raise AmbiguousAsset(f"{symbol_or_id}: {', '.join(sorted(ids))}")
        found = self.one(ids[0]).limit(1).collect() if ids else []
        if not found:
            raise AssetNotFound(symbol_or_id)
        return found[0]

    def one(self, asset_id: str) -> DataFrame:
        """The state of an id as a table of at most one row, out of one shard."""
        return self.market().filter((F.col("asset_id") == asset_id) & (F.col("shard_index") == self._shard(asset_id)))

    def view(self, symbol_or_id: str) -> AssetView:
        return AssetView(self.asset(symbol_or_id))

    def _shard(self, asset_id: str) -> int:
        return int.from_bytes(hashlib.sha256(asset_id.encode()).digest()[:8], "big") % self.manifest["shards"]

    def asset_count(self) -> int:
        return self.manifest["asset_count"]

    def partial_asset_count(self) -> int:
        """Assets of which no observation made a price."""
        return self.market().filter("is_partial").count()

    def qualified_asset_count(self, min_venues: int) -> int:
        return self.market().filter(F.col("venue_count") >= min_venues).count()

    def top_by_volume(self, n: int, min_venues: int = 1) -> DataFrame:
        return self.market().filter(F.col("venue_count") >= min_venues).orderBy(F.desc_nulls_last("reported_volume_24h_usd"), "asset_id").limit(n)


def export_web(client: MarketClient, out: str, details: int = 200, most_bytes: int = 25 << 20) -> dict[str, int]:
    """Writes the overview and the details of the largest assets as JSON files; their sizes. More than most_bytes is an error."""
    spark, sizes = client.spark, {}
    parts = overview(client.market())
    texts = {"market-overview.json": json.dumps({"generation": client.manifest["generation"]} | {name: [r.asDict() for r in df.collect()] for name, df in parts.items()})}
    for r in client.top_by_volume(details).collect():  # as many as are shown in detail
        texts[f"assets/{hashlib.sha256(r.asset_id.encode()).hexdigest()[:16]}.json"] = json.dumps(unflattened(r))
    if sum(map(len, texts.values())) > most_bytes:
        raise NotPublishable(f"the export has over {most_bytes} bytes")
    for name, text in texts.items():
        files.write_text(spark, str(PurePosixPath(out.rstrip("/")) / name) if "://" not in out else f"{out.rstrip('/')}/{name}", text)
        sizes[name] = len(text)
    return sizes


def unflattened(row: Row) -> dict:
    """A row's a__b__c columns as nested dictionaries."""
    out: dict = {}
    for name, value in row.asDict().items():
        *parents, last = name.split("__")
        at = out
        for p in parents:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def overview(market: DataFrame, top: int = 10, min_venues: int = 2) -> dict[str, DataFrame]:
    """What the web pages show: totals, counts by status, and top lists."""
    several = market.filter(F.col("venue_count") >= min_venues)
    ranked = lambda c: several.orderBy(F.desc_nulls_last(c), "asset_id").limit(top).select("asset_id", "symbol", c)
    return {
        "totals": market.agg(F.count("*").alias("assets"), F.count_if(F.col("venue_count") >= 2).alias("multi_venue"), F.sum("reported_volume_24h_usd").alias("volume"), F.sum("open_interest__total_usd").alias("open_interest"), F.median("dispersion__price_dispersion_bps").alias("median_dispersion")),
        "by_status": market.groupBy("resolution_state").agg(F.count("*").alias("n")), "by_volume": ranked("reported_volume_24h_usd"), "by_open_interest": ranked("open_interest__total_usd"), "by_dispersion": ranked("dispersion__price_dispersion_bps"),
    }
