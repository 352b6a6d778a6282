"""Runnable stages for spark-submit: ``python -m tidewater.jobs <stage> --root ...``.

    ingest   wire files or a Kafka topic -> Bronze (PL1)
    silver   Bronze -> Silver (PL2)
    gold     Silver -> Gold (PL3)
    publish  Gold -> warehouse (SNK5)
    refresh  Silver, Gold and, unless --no-publish, publish (PL4)

The master, the jars and ``spark.checkpoint.dir`` come from spark-submit. Each
stage prints its report as one JSON line and fails with a non-zero exit code.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from typing import Dict, List, Optional

from pyspark.sql import SparkSession

from .config import LakeConfig
from .plans.jobs import build_gold, build_silver, refresh_batch
from .session import FORMAT_CONF, build_session
from .sinks.tables import publish_gold
from .sources.wire import kafka_source, wire_source
from .streaming.bronze import DEFAULT_TRIGGER, IngestMetricsListener, ingest_bronze, run_until_stopped


def _options(pairs: Optional[List[str]]) -> Dict[str, str]:
    return dict(p.split("=", 1) for p in pairs or [])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater.jobs", description="Lakehouse stages")
    p.add_argument("stage", choices=["ingest", "silver", "gold", "publish", "refresh"])
    p.add_argument("--root", required=True, help="lake root on storage that all machines share")
    p.add_argument("--format", choices=sorted(FORMAT_CONF), default="parquet")
    p.add_argument("--clock", type=dt.datetime.fromisoformat, help="fixed audit time (reruns, tests)")
    p.add_argument("--wire", help="ingest: folder of wire files; otherwise --servers and --topic")
    p.add_argument("--servers")
    p.add_argument("--topic")
    p.add_argument("--trigger", default=DEFAULT_TRIGGER, help='ingest: an interval, or "available_now"')
    p.add_argument("--max-per-trigger", type=int, help="ingest: files or offsets a micro-batch")
    p.add_argument("--target", help="publish: folder of the warehouse tables")
    p.add_argument("--jdbc", action="append", metavar="KEY=VALUE", help="publish: JDBC options")
    p.add_argument("--no-publish", action="store_true")
    return p


def ingest(spark: SparkSession, cfg: LakeConfig, a: argparse.Namespace) -> dict:
    if a.wire:
        source = wire_source(spark, a.wire, streaming=True, max_files_per_trigger=a.max_per_trigger)
    else:
        source = kafka_source(spark, a.servers, a.topic, max_offsets_per_trigger=a.max_per_trigger)
    listener = IngestMetricsListener(spark, cfg.path("bronze", "ingest_metrics"))
    spark.streams.addListener(listener)
    query = ingest_bronze(spark, cfg, source, trigger=a.trigger)
    try:
        run_until_stopped(query)
    finally:
        listener.ended.wait(60)
        spark.streams.removeListener(listener)
    return {"batches": (query.lastProgress.batchId + 1) if query.lastProgress else 0}


def run(spark: SparkSession, a: argparse.Namespace) -> dict:
    cfg = LakeConfig(root=a.root, table_format=a.format, clock=a.clock)
    jdbc = _options(a.jdbc) or None
    if a.stage == "ingest":
        return ingest(spark, cfg, a)
    if a.stage == "silver":
        return build_silver(spark, cfg)
    if a.stage == "gold":
        return build_gold(spark, cfg)
    if a.stage == "publish":
        return {r["table"]: r["rows"] for r in publish_gold(spark, cfg, target=a.target, jdbc=jdbc).collect()}
    done = refresh_batch(spark, cfg, publish=not a.no_publish, target=a.target, jdbc=jdbc)
    return {f"{r.stage}.{r.table}": r.rows for r in done.collect()}


def main(argv: Optional[List[str]] = None) -> None:
    a = parser().parse_args(argv)
    if a.stage == "ingest" and not a.wire and not (a.servers and a.topic):
        parser().error("ingest needs --wire, or --servers and --topic")
    spark = build_session(f"tidewater-{a.stage}", table_format=a.format)
    print(json.dumps({"stage": a.stage, **run(spark, a)}, default=str))


if __name__ == "__main__":
    main()
