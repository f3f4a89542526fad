"""Command line over stored generations: python -m tidemark.cli ROOT COMMAND ..."""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import slot
from tidemark.mql import MqlError
from tidemark.operators.ingest import deduped_last
from tidemark.plans.market import market
from tidemark.plans.tables import tables
from tidemark.sources import files, relay
from tidemark.sources.collections import collected
from tidemark.sources.datasets import AmbiguousAsset, AssetNotFound, MarketClient, expired, export_web, unflattened, write_generation
from tidemark.sources.venues import DISABLED, FEEDS


METHODOLOGY = """A reference price is the weighted median of spot prices (of derivatives without any), weights by root of volume, age and source, none over 35 %.
Prices over 20 % from the first median are left out and counted. Unknown values are null, never 0, and every exclusion has a reason."""


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("root")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("status", "verify", "exchanges", "methodology", "housekeeping"):
        commands.add_parser(name)
    for name, arg in (("query", "text"), ("explain", "text"), ("search", "text"), ("asset", "symbol")):
        commands.add_parser(name).add_argument(arg)
    for name, arg in (("build-dataset", "tables"), ("export-web", "out"), ("aggregate", "runs"), ("compact-day", "out"), ("publish-relay", "runs"), ("pull-relay", "relay")):
        commands.add_parser(name).add_argument(arg)
    top = commands.add_parser("market")
    top.add_argument("--top", type=int, default=20)
    top.add_argument("--min-venues", type=int, default=1)
    args = parser.parse_args(argv)
    if args.command == "exchanges":
        print("\n".join(sorted({f.venue for f in FEEDS} | {f"{v} (disabled: {why})" for v, why in DISABLED.items()})))
        return 0
    if args.command == "methodology":
        print(METHODOLOGY)
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "build-dataset":
        now = int(time.time() * 1000)
        before = MarketClient.latest(spark, args.root) if files.exists(spark, f"{args.root}/latest.json") else None
        manifest = write_generation(spark, args.root, f"g{now}", market(spark, args.tables), tables(spark, args.tables, f"g{now}", now, before))
        print(manifest["generation"], manifest["asset_count"], "assets")
        return 0
    if args.command == "publish-relay":
        runs = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(args.runs)
        named = runs.select(F.regexp_extract(F.input_file_name(), "([^/]+)[.]json$", 1).alias("venue"), F.col("value").alias("body"))
        print(", ".join(sorted(relay.publish(named, args.root, int(time.time() * 1000))["files"])))
        return 0
    if args.command == "pull-relay":
        venues = spark.createDataFrame([(v,) for v in sorted({f.venue for f in FEEDS})], "venue string").withColumn("egress", F.lit("relay"))
        found = relay.fetched(venues, args.relay, int(time.time() * 1000), f"{args.root}/relay-cache")
        found.select("venue", "status", "reason", "source", "run_id", F.size("tickers").alias("tickers")).orderBy("venue").show(100, truncate=False)
        return 0
    if args.command == "aggregate":
        runs = collected(spark, args.runs, int(time.time() * 1000))
        runs.groupBy("status", "reason").count().show()
        return 0
    client = MarketClient.latest(spark, args.root)
    try:
        match args.command:
            case "status":
                print(client.manifest["generation"], client.asset_count(), "assets")
            case "verify":
                print(client.verify(), "files are as published")
            case "housekeeping":
                for name in expired(spark, args.root):
                    files.remove(spark, f"{args.root}/generations/{name}")
                    print("removed", name)
            case "export-web":
                print(len(export_web(client, args.out)), "files")
            case "compact-day":
                compacted(spark, args.root, args.out)
            case "query":
                client.query(args.text).show(100, truncate=False)
            case "explain":
                for name, text in client_explain(client, args.text).items():
                    print(f"{name}: {text}")
            case "search":
                client.search(args.text).show(100, truncate=False)
            case "asset":
                print(unflattened(client.asset(args.symbol)))
            case "market":
                client.top_by_volume(args.top, args.min_venues).select("symbol", "reference_price__value", "venue_count", "reported_volume_24h_usd").show(args.top, truncate=False)
    except (MqlError, AssetNotFound, AmbiguousAsset) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


def compacted(spark: SparkSession, root: str, out: str) -> None:
    """All stored generations as one table, the last state of each asset and slot."""
    names = files.subfolders(spark, f"{root}/generations")
    rows = None
    for name in names:
        part = MarketClient.of(spark, root, name).market().withColumns({"generation": F.lit(name), "slot": slot(F.col("observed_at"))})
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is not None:
        deduped_last(rows, ["asset_id", "slot"], ["observed_at", "generation"]).write.mode("overwrite").option("compression", "zstd").parquet(out)


def client_explain(client: MarketClient, text: str) -> dict[str, str]:
    from tidemark.mql import Engine

    return Engine(client.market()).explain(text)


if __name__ == "__main__":
    sys.exit(main())
