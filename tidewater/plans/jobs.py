"""Batch jobs: PL2 build_silver, PL3 build_gold, PL4 refresh_batch.

One session runs all stages (the reference starts a JVM per stage). Each
table is computed once: counts come from the written files (Silver) or from
``Observation`` above the last shuffle of the write (Gold).
"""

from __future__ import annotations

from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession

from ..config import BRONZE_TABLE, GOLD_TABLES, SILVER_TABLE, LakeConfig
from ..operators.gold import GOLD_INPUT_COLUMNS, gold_from_rollup, session_day_rollup
from ..session import shuffle_width
from ..sinks.storage import latest_path, path_size, read_path, write_table
from ..sinks.tables import publish_gold, write_gold, write_silver
from ..sources.tables import read_bronze, read_silver
from .layers import silver_from_bronze
from .parallel import run_jobs

# Internal table of the Gold build (not published).
ROLLUP_TABLE = "_session_day_rollup"


def build_silver(spark: SparkSession, cfg: LakeConfig, bronze: Optional[DataFrame] = None) -> dict:
    """PL2: Bronze -> F1 -> F2 -> P5, P6, P4 -> SNK3, with the F3 report.

    The report is counted from files, not by accumulators inside the job: those
    add up again when a lost executor's map stage is run once more. Bronze's
    files are listed once, so the rows counted are the rows read; a row count
    comes from the files' footers, and unparsed rows from one column, skipping
    row groups whose footers say that it has no NULL.
    """
    src = bronze if bronze is not None else read_bronze(spark, cfg)
    size = path_size(spark, cfg.path("bronze", BRONZE_TABLE)) if bronze is None else None
    with shuffle_width(spark, size):
        written = write_silver(silver_from_bronze(src, cfg.clock), cfg)
    b = src.count()
    u = src.filter("event_id IS NULL").count()
    s = spark.read.format(cfg.table_format).load(written).count()
    return {
        "bronze_rows": b,
        "unparsed_rows": u,
        "duplicate_rows": b - u - s,
        "silver_rows": s,
        "dropped_rows": b - s,
    }


def build_gold(spark: SparkSession, cfg: LakeConfig, concurrent: bool = True, dates: Optional[Iterable] = None) -> dict:
    """PL3: Silver -> session-day rollup -> G1..G5 -> SNK4; rows per table.

    With ``dates`` only these are rebuilt, from partial states kept by date
    (``plans.incremental``); without, everything, as follows.

    C1, the shared scan, as a written table: Silver is aggregated once to the
    session-day grain (the eleven columns the aggregates use, partial
    aggregation map-side) and the rollup is written under the lake root. G1,
    G2, G4 and G5 are then small aggregates over it, and G3 reads its three
    columns from Silver. The rollup is a table, not a cache: it has no memory
    limit, survives the loss of executors and cuts the lineage. Every Gold
    table is rebuilt from all of Silver: a full overwrite is the late-data
    policy, and top content is an all-time aggregate.
    """
    if dates is not None:
        from .incremental import build_gold_by_date

        return build_gold_by_date(spark, cfg, dates)
    silver = read_silver(spark, cfg).select(*GOLD_INPUT_COLUMNS)
    size = path_size(spark, latest_path(spark, cfg.path("silver", SILVER_TABLE))) if cfg.table_format != "delta" else None
    rollup_path = cfg.path("gold", ROLLUP_TABLE)
    with shuffle_width(spark, size):
        write_table(session_day_rollup(silver), cfg, rollup_path, overwrite_schema=True)
        rollup = read_path(spark, cfg, rollup_path)
        tables = gold_from_rollup(rollup, silver)
        tasks = {name: (lambda n=name: write_gold(tables[n], cfg, n)) for name in GOLD_TABLES}
        return run_jobs(tasks, concurrent)


def refresh_batch(
    spark: SparkSession,
    cfg: LakeConfig,
    publish: bool = True,
    target: Optional[str] = None,
    jdbc=None,
) -> DataFrame:
    """PL4: Silver -> Gold -> publish, stopping at the first failure.

    Every stage is a full overwrite of fresh versions, so a rerun gives the
    same tables (idempotent). Returns (stage, table, rows).
    """
    rows = []
    report = build_silver(spark, cfg)
    rows.append(("silver", SILVER_TABLE, report["silver_rows"]))
    for name, n in build_gold(spark, cfg).items():
        rows.append(("gold", name, n))
    if publish:
        for r in publish_gold(spark, cfg, GOLD_TABLES, target=target, jdbc=jdbc).collect():
            rows.append(("publish", r["table"], r["rows"]))
    return spark.createDataFrame(rows, "stage string, table string, rows long")
