"""Batch table scans (SRC3, SRC4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import BRONZE_TABLE, SILVER_TABLE, LakeConfig
from ..schema import BRONZE_DDL
from ..sinks.storage import read_path
from ..sinks.swap import recover


def read_bronze(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Bronze, all published micro-batches: a batch's folder appears by one rename."""
    return read_bronze_batches(spark, cfg).drop("query", "batch")


def read_bronze_batches(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Bronze with ``query`` and ``batch``, the ids it was published under (partition columns on
    Parquet, so a filter on them prunes folders)."""
    path = cfg.path("bronze", BRONZE_TABLE)
    if cfg.table_format == "delta":
        return spark.read.format("delta").load(path)
    recover(spark, path)
    return spark.read.schema(f"{BRONZE_DDL}{', raw_value string' if cfg.keep_raw_value else ''}, query string, batch long").format(cfg.table_format).load(path)


def read_silver(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Silver, latest committed version. A filter on event_date prunes
    partition directories (PartitionFilters in the scan)."""
    return read_path(spark, cfg, cfg.path("silver", SILVER_TABLE))


def read_gold(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    return read_path(spark, cfg, cfg.path("gold", name))


def read_table(spark: SparkSession, cfg: LakeConfig, layer: str, name: str) -> DataFrame:
    """SRC3: scan by layer and name."""
    if layer == "bronze":
        return read_bronze(spark, cfg)
    return read_path(spark, cfg, cfg.path(layer, name))


def read_gold_for_load(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """SRC4: the Gold table for the warehouse load, as a distributed
    DataFrame (the reference pulls it into pandas on one machine)."""
    return read_gold(spark, cfg, name)
