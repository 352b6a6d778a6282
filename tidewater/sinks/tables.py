"""Layer writers (SNK3, SNK4), warehouse publish (SNK5), CSV export (SNK7).

Row counts come from ``Observation`` on the write itself: one execution per
table, where the reference runs every Gold query a second time for its count.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import GOLD_TABLES, SILVER_TABLE, LakeConfig
from ..functions.expr import audit_time
from ..operators.enrich import upper_columns
from ..plans.parallel import run_jobs
from .storage import read_path, write_table


# Order of Silver rows inside each event_date directory (SNK8's clustering,
# with event time and id last so that a hot user spreads over several tasks).
SILVER_CLUSTER = ("user_id", "event_timestamp", "event_id")


def write_silver(df: DataFrame, cfg: LakeConfig, cluster: bool = True,
                 observation: Optional[Observation] = None) -> str:
    """SNK3: full overwrite partitioned by event_date.

    The rows arrive hash-partitioned by event_id from the dedupe, so every
    task holds every date: written as they are, T tasks and D dates make T x D
    small files (millions at 100 TB over a few years). With ``cluster`` the
    rows are range-partitioned on (event_date, user_id, event_timestamp,
    event_id) first: each task covers a narrow slice of dates, so a date gets
    a few large files, already clustered as the compaction (SNK8) would leave
    them, and a hot date or user is split by the trailing columns. One more
    shuffle instead of a later read-shuffle-write compaction; AQE sizes the
    range partitions. The range partitioner samples its input in a pass of
    its own: that pass re-runs the dedupe's reduce side from the shuffle
    files (the map side is not run again), still far cheaper than rewriting
    the table later.

    ``observation`` receives ``silver_rows``. It is attached above the range
    exchange: the range partitioner samples its input in a job of its own,
    and a count below it would run (and add up) twice.
    """
    if cluster:
        keys = ["event_date", *[c for c in SILVER_CLUSTER if c in df.columns]]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("silver_rows"))
    return write_table(df, cfg, cfg.path("silver", SILVER_TABLE), partition_by=("event_date",))


def write_gold(df: DataFrame, cfg: LakeConfig, name: str) -> int:
    """SNK4: stamp transformed_at, overwrite (schema may change), return rows."""
    obs = Observation(f"gold_{name}")
    stamped = df.withColumn("transformed_at", audit_time(cfg.clock)).observe(
        obs, F.count(F.lit(1)).alias("rows")
    )
    write_table(stamped, cfg, cfg.path("gold", name), overwrite_schema=True)
    return int(obs.get["rows"])


# Rows per statement of a bulk load; the caller's value wins.
JDBC_BATCH = "10000"


#: How a loaded staging table takes the place of the published one, by product. The statements run
#: in one transaction: readers see the old table or the new one.
SWAP_STATEMENTS = {
    "rename": ("DROP TABLE IF EXISTS {table}", "ALTER TABLE {staging} RENAME TO {table}"),
    "swap": ("CREATE TABLE IF NOT EXISTS {table} LIKE {staging}", "ALTER TABLE {table} SWAP WITH {staging}", "DROP TABLE {staging}"),
}


def _write_jdbc(df: DataFrame, jdbc: Mapping[str, str], table: str) -> None:
    df.write.format("jdbc").options(**{"batchsize": JDBC_BATCH, **jdbc, "dbtable": table}).mode("overwrite").save()


def _count_jdbc(spark: SparkSession, jdbc: Mapping[str, str], table: str) -> int:
    """The warehouse's own row count, sent as a query: one row comes back and not the table."""
    reads = {k: v for k, v in jdbc.items() if k not in ("numPartitions", "batchsize")}
    return int(spark.read.format("jdbc").options(**reads).option("query", f"SELECT COUNT(*) AS N FROM {table}").load().first()[0])


def _execute_jdbc(spark: SparkSession, jdbc: Mapping[str, str], statements: Iterable[str]) -> None:
    """Runs the statements on one connection as one transaction; none has effect if one fails."""
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for k, v in jdbc.items():
        given.setProperty(k, str(v))
    if "driver" in jdbc:
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(jdbc["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(jdbc["url"], given)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for text in statements:
                statement.execute(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()


def _load_jdbc(spark: SparkSession, df: DataFrame, jdbc: Mapping[str, str], table: str, swap: Optional[str] = None, written=None) -> int:
    """Replaces ``table`` over JDBC; returns the warehouse's own row count.

    ``numPartitions``, the number of connections, is the caller's to set: what
    the warehouse bears doesn't follow from the size of the data. With ``swap``
    (a key of SWAP_STATEMENTS) the rows are loaded into a staging table, counted
    there against ``written()``, and only then put in the table's place by one
    transaction: a publish that fails leaves the old table as it was. Without,
    Spark's overwrite drops the old table first."""
    if "numPartitions" not in jdbc:
        raise ValueError("publish over JDBC needs numPartitions, the number of connections to write with")
    if swap is None:
        _write_jdbc(df, jdbc, table)
        return _count_jdbc(spark, jdbc, table)
    staging = f"{table}__STAGING"
    _write_jdbc(df, jdbc, staging)
    back = _count_jdbc(spark, jdbc, staging)
    if written is not None and back != written():
        raise RuntimeError(f"publish of {table}: wrote {written()} rows, read back {back}; the published table is unchanged")
    _execute_jdbc(spark, jdbc, [s.format(table=table, staging=staging) for s in SWAP_STATEMENTS[swap]])
    return back


def _load_connector(spark: SparkSession, df: DataFrame, fmt: str, options: Mapping[str, str], table: str) -> int:
    """Replaces ``table`` through any Spark connector that takes ``dbtable``;
    an aggregate push-down of the connector serves the count where it has one."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode("overwrite").save()
    return spark.read.format(fmt).options(**options).option("dbtable", table).load().count()


def write_quarantine(df: DataFrame, cfg: LakeConfig, rules: Optional[list] = None,
                     name: str = "user_events") -> str:
    """V2 sink: valid and rejected rows in one job, partitioned by ``status``
    (with ``violations`` kept for the rejected ones)."""
    from ..operators.quality import quarantine_status

    return write_table(quarantine_status(df, rules), cfg, cfg.path("quarantine", name), partition_by=("status",))


def publish_gold(
    spark: SparkSession,
    cfg: LakeConfig,
    names: Iterable[str] = GOLD_TABLES,
    target: Optional[str] = None,
    jdbc: Optional[Mapping[str, str]] = None,
    concurrent: bool = True,
    connector: Optional[str] = None,
    connector_options: Optional[Mapping[str, str]] = None,
    jdbc_swap: Optional[str] = None,
) -> DataFrame:
    """SNK5: full replace of the warehouse copies, upper-case names.

    ``jdbc`` options (url, driver, user, numPartitions, ...) write through the
    JDBC source from the executors in parallel, with ``jdbc_swap`` through a staging
    table that takes the old one's place in one transaction; ``connector`` names any other
    Spark connector with its ``connector_options``; otherwise ``target`` (default
    ``<root>/warehouse``) receives one table per Gold table. The count read
    back must equal the count written, else the publish fails. Returns
    (table, rows).
    """
    root = target or cfg.path("warehouse", "").rstrip("/")

    def publish_one(name: str):
        src = read_path(spark, cfg, cfg.path("gold", name))
        wh = upper_columns(src)
        obs = Observation(f"publish_{name}")
        wh = wh.observe(obs, F.count(F.lit(1)).alias("rows"))
        table = name.upper()
        if jdbc:
            back = _load_jdbc(spark, wh, jdbc, table, jdbc_swap, lambda: int(obs.get["rows"]))
        elif connector:
            back = _load_connector(spark, wh, connector, connector_options or {}, table)
        else:
            path = f"{root}/{table}"
            write_table(wh, cfg, path, overwrite_schema=True)
            back = read_path(spark, cfg, path).count()
        written = int(obs.get["rows"])
        if back != written:
            raise RuntimeError(f"publish of {table}: wrote {written} rows, read back {back}")
        return table, written

    # Independent tables: one driver thread per table, Spark runs the jobs side by side.
    out = list(run_jobs({n: (lambda n=n: publish_one(n)) for n in names}, concurrent).values())
    return spark.createDataFrame(out, "table string, rows long")


def read_published(spark: SparkSession, cfg: LakeConfig, name: str, target: Optional[str] = None) -> DataFrame:
    root = target or cfg.path("warehouse", "").rstrip("/")
    return read_path(spark, cfg, f"{root}/{name.upper()}")


def export_csv(df: DataFrame, path: str) -> None:
    """SNK7: CSV with a header, written by the executors (one file per task).
    Timestamps keep microseconds."""
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )
