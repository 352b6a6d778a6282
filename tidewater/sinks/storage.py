"""Table storage: atomic full overwrite on plain Parquet, Delta when configured.

Plain Parquet ``mode("overwrite")`` deletes the old files before the new ones
exist, so a failed job leaves no table and a reader sees a half-written one.
Without Delta the writer here puts each overwrite into a fresh hidden version
directory (``<table>/_v<id>``); Spark's job commit writes ``_SUCCESS`` there
last, and readers take the newest committed version. Old versions beyond
``keep_versions`` are removed after a successful commit. A job never reads and
overwrites the same directory.

Paths go through the Hadoop FileSystem of the session, so the same code works
on a local disk, HDFS or an object store.
"""

from __future__ import annotations

import uuid
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import LakeConfig

_VERSION_PREFIX = "_v"


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path`` with the session's settings."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return bool(fs.exists(p))


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from a listing of its files; no data is read."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


def count_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> int:
    fs, p = filesystem(spark, path)
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        if it.next().getPath().getName().endswith(suffix):
            n += 1
    return n


def _version_names(spark: SparkSession, table_path: str) -> list:
    fs, p = filesystem(spark, table_path)
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return sorted(n for n in names if n.startswith(_VERSION_PREFIX))


def committed_versions(spark: SparkSession, table_path: str) -> list:
    """Committed version directories of a table, oldest first."""
    fs, _ = filesystem(spark, table_path)
    jvm = spark.sparkContext._jvm
    done = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{n}/_SUCCESS"))
    return [n for n in _version_names(spark, table_path) if done(n)]


def latest_path(spark: SparkSession, table_path: str) -> str:
    vs = committed_versions(spark, table_path)
    if not vs:
        raise FileNotFoundError(f"no committed version under {table_path}")
    return f"{table_path.rstrip('/')}/{vs[-1]}"


def _number(version: str) -> int:
    return int(version[len(_VERSION_PREFIX):].split("-")[0])


def _new_version(spark: SparkSession, table_path: str) -> str:
    """One more than the largest number there, committed or not: no clock decides which version
    is the newest. The random suffix keeps two writers of the same number apart."""
    names = [n for n in _version_names(spark, table_path)]
    return f"{_VERSION_PREFIX}{max(map(_number, names), default=0) + 1:015d}-{uuid.uuid4().hex[:8]}"


def _cleanup(spark: SparkSession, table_path: str, keep: int) -> None:
    """Removes versions older than the last ``keep`` committed ones, failed ones among them."""
    if keep <= 0:
        return
    fs, _ = filesystem(spark, table_path)
    jvm = spark.sparkContext._jvm
    kept = committed_versions(spark, table_path)[-keep:]
    for name in _version_names(spark, table_path):
        if kept and name < kept[0]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{name}"), True)


def write_table(
    df: DataFrame,
    cfg: LakeConfig,
    table_path: str,
    partition_by: Sequence[str] = (),
    overwrite_schema: bool = False,
) -> str:
    """Full overwrite of a table; returns the directory that now holds it."""
    spark = df.sparkSession
    if cfg.table_format == "delta":
        w = df.write.format("delta").mode("overwrite")
        if overwrite_schema:
            w = w.option("overwriteSchema", "true")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(table_path)
        return table_path
    target = f"{table_path.rstrip('/')}/{_new_version(spark, table_path)}"
    w = df.write.format(cfg.table_format).mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)
    _cleanup(spark, table_path, cfg.keep_versions)
    return target


def read_path(spark: SparkSession, cfg: LakeConfig, table_path: str) -> DataFrame:
    """Latest committed version of a table (Delta: the table itself)."""
    if cfg.table_format == "delta":
        return spark.read.format("delta").load(table_path)
    from .swap import recover

    latest = latest_path(spark, table_path)
    recover(spark, latest)  # a replacement of partitions or files that was cut short
    return spark.read.format(cfg.table_format).load(latest)


def scratch_dir(spark: SparkSession, name: Optional[str] = None) -> str:
    """A fresh folder under the shared checkpoint directory of the cluster.

    Used by the registered queries that write and read back; never a
    machine-local temporary folder.
    """
    from ..session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewater-scratch/{name or 'run'}-{uuid.uuid4().hex[:12]}"
