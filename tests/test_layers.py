"""Layer counts of FIXTURES section 5, stream restart, idempotent refresh,
compaction and round-trip properties."""

from pyspark.sql import functions as F

from conftest import SF0001, SF001
import pytest

from tidewater import fixtures, registry
from tidewater.config import GOLD_TABLES, SILVER_TABLE
from tidewater.operators import gold, quality, wire
from tidewater.plans.jobs import build_silver, refresh_batch
from tidewater.schema import EVENT_COLUMNS
from tidewater.sinks.compact import compact_table
from tidewater.sinks.storage import committed_versions, count_files, latest_path
from tidewater.sources.tables import read_bronze, read_gold, read_silver
from tidewater.sources.wire import wire_source, write_wire
from tidewater.streaming.bronze import ingest_bronze, run_until_stopped


def test_wire_fixture_counts(spark):
    w = fixtures.wire_messages(spark, SF001)
    m = quality.ingest_metrics(w).agg(F.sum("messages"), F.sum("failed")).collect()[0]
    assert tuple(m) == (10700, 200)
    r = quality.silver_report(wire.bronze_from_wire(w)).collect()[0].asDict()
    assert r == {"bronze_rows": 10700, "unparsed_rows": 200, "duplicate_rows": 500, "silver_rows": 10000,
                 "dropped_rows": 700}


def test_stream_restart_adds_nothing_and_refresh_is_idempotent(spark, lake):
    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire_path)
    for _ in range(2):
        src = wire_source(spark, wire_path, streaming=True, max_files_per_trigger=2)
        run_until_stopped(ingest_bronze(spark, lake, src, trigger="available_now"))
        assert read_bronze(spark, lake).count() == 1070

    first = refresh_batch(spark, lake, publish=True).collect()
    snap1 = {n: read_gold(spark, lake, n).drop("transformed_at") for n in GOLD_TABLES}
    s1 = {n: sorted(map(tuple, df.collect()), key=repr) for n, df in snap1.items()}
    second = refresh_batch(spark, lake, publish=True).collect()
    s2 = {n: sorted(map(tuple, read_gold(spark, lake, n).drop("transformed_at").collect()), key=repr) for n in GOLD_TABLES}
    assert first == second and s1 == s2
    rows = {(r["stage"], r["table"]): r["rows"] for r in first}
    assert rows[("silver", SILVER_TABLE)] == 1000
    assert [rows[("gold", n)] for n in GOLD_TABLES] == [119, 143, 908, 137, 595]
    # Old versions are pruned; the table keeps the configured number.
    assert len(committed_versions(spark, lake.path("silver", SILVER_TABLE))) <= lake.keep_versions


def test_silver_partitioned_and_pruned(spark, lake):
    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire_path)
    run_until_stopped(ingest_bronze(spark, lake, wire_source(spark, wire_path, streaming=True),
                                    trigger="available_now"))
    build_silver(spark, lake)
    s = read_silver(spark, lake).filter(F.col("event_date") == "2024-01-02")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert s.count() == spark.read.parquet(f"{SF0001}/events.parquet").filter(
        F.to_date("ts") == "2024-01-02").count()
    # The Gold rollup and G3 scans read only the columns they use.
    silver = read_silver(spark, lake).select(*gold.GOLD_INPUT_COLUMNS)
    for df, absent in ((gold.session_day_rollup(silver), ("kafka_key", "app_version", "event_type")),
                       (gold.hourly_event_distribution(silver), ("user_id", "watch_seconds", "kafka_offset"))):
        schema = [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in ln]
        assert schema and not [c for c in absent if any(c in ln for ln in schema)]


def test_compaction_keeps_rows_with_fewer_files(spark, lake):
    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire_path)
    run_until_stopped(ingest_bronze(spark, lake, wire_source(spark, wire_path, streaming=True),
                                    trigger="available_now"))
    # Fragment Silver on purpose: 8 un-coalesced shuffle tasks x 30 dates.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        build_silver(spark, lake)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    path = lake.path("silver", SILVER_TABLE)
    before = read_silver(spark, lake).drop("transformed_at").cache()
    assert before.count() == 1000
    before_files = count_files(spark, latest_path(spark, path))
    compact_table(spark, lake, path, cluster_by=("user_id",), target_files=1, partition_by=("event_date",))
    after_files = count_files(spark, latest_path(spark, path))
    after = read_silver(spark, lake).drop("transformed_at")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
    dates = before.select("event_date").distinct().count()
    assert after_files == dates < before_files


def test_to_wire_then_parse_is_identity(spark):
    silver = registry._silver(spark, SF0001).select(*EVENT_COLUMNS)
    back = wire.from_wire_text(wire.to_wire(silver))
    assert silver.exceptAll(back).count() == 0 and back.exceptAll(silver).count() == 0


def test_gold_event_counts_agree(spark):
    silver = registry._silver(spark, SF0001).cache()
    n = silver.count()
    for name in GOLD_TABLES:
        assert gold.GOLD_BUILDERS[name](silver).agg(F.sum("event_count")).collect()[0][0] == n
    g1 = gold.daily_watch_time_by_country(silver)
    assert g1.filter(F.col("unique_users") > F.col("event_count")).count() == 0
    silver.unpersist()


def test_listener_keeps_the_metrics_of_every_batch(spark, lake):
    from tidewater.streaming.bronze import IngestMetricsListener, batch_metrics

    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001).repartition(105), wire_path)
    src = wire_source(spark, wire_path, streaming=True, max_files_per_trigger=1)
    listener = IngestMetricsListener(spark, lake.path("bronze", "ingest_metrics"))
    spark.streams.addListener(listener)
    try:
        run_until_stopped(ingest_bronze(spark, lake, src, trigger="available_now"))
        assert listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    m = batch_metrics(spark, listener.path).collect()
    # More batches than a query's own recentProgress keeps.
    assert len([b for b in m if b.messages]) == 105
    assert sum(b.messages for b in m) == 1070
    assert sum(b.failed for b in m) == 20 and sum(b.parsed for b in m) == 1050


def test_listener_reports_the_last_error(spark, lake):
    from tidewater.streaming.bronze import IngestMetricsListener, batch_metrics

    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001).coalesce(1), wire_path)
    src = wire_source(spark, wire_path, streaming=True).withColumn("value", F.raise_error(F.lit("broken message")).cast("binary"))
    listener = IngestMetricsListener(spark, lake.path("bronze", "ingest_metrics"))
    spark.streams.addListener(listener)
    try:
        with pytest.raises(Exception, match="broken message"):
            run_until_stopped(ingest_bronze(spark, lake, src, trigger="available_now"))
        assert listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    assert "broken message" in batch_metrics(spark, listener.path).filter("last_error IS NOT NULL").first().last_error


def test_silver_write_keeps_files_per_date_small(spark, lake):
    from tidewater.sinks.storage import latest_path
    from tidewater.sinks.tables import write_silver

    spark.conf.set("spark.sql.shuffle.partitions", "8")
    silver = registry._silver(spark, SF0001).repartition(8, "event_id")
    write_silver(silver, lake)
    root = latest_path(spark, lake.path("silver", SILVER_TABLE))
    files = spark.read.parquet(root).select(F.input_file_name().alias("f"), "event_date").distinct()
    per_date = files.groupBy("event_date").count().collect()
    # Hash-partitioned input would give up to 8 files for each date.
    assert sum(r["count"] for r in per_date) < 8 * len(per_date) / 2
    assert read_silver(spark, lake).count() == 1000


def test_compact_lake_keeps_tables(spark, lake):
    from tidewater.sinks.compact import compact_lake

    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire_path)
    run_until_stopped(ingest_bronze(spark, lake, wire_source(spark, wire_path, streaming=True),
                                    trigger="available_now"))
    refresh_batch(spark, lake, publish=False).collect()
    before_s = sorted(map(tuple, read_silver(spark, lake).drop("transformed_at").collect()), key=repr)
    before_g = sorted(map(tuple, read_gold(spark, lake, "user_session_summary").collect()), key=repr)
    from tidewater.sources.tables import read_gold_for_load, read_table

    assert read_table(spark, lake, "bronze", "user_events").count() == 1070
    assert read_table(spark, lake, "gold", "user_session_summary").count() == len(before_g)
    assert read_gold_for_load(spark, lake, "daily_device_mix").count() == 137
    paths = compact_lake(spark, lake, target_files=1)
    assert set(paths) == {"silver.user_events", "gold.user_session_summary"}
    assert sorted(map(tuple, read_silver(spark, lake).drop("transformed_at").collect()), key=repr) == before_s
    assert sorted(map(tuple, read_gold(spark, lake, "user_session_summary").collect()), key=repr) == before_g


def test_gold_from_rollup_equals_direct_aggregates(spark):
    # NULL keys and NULL watch values included: the rollup must not change them.
    silver = registry._silver(spark, SF0001).select(*gold.GOLD_INPUT_COLUMNS)
    extra = spark.createDataFrame(
        [(None, None, "play", None, "c-1", "movie", "web", "s-x", None, None, None),
         (None, None, "play", "IN", "c-1", "movie", "web", "s-x", "u-x", 5, None)],
        silver.schema,
    )
    silver = silver.unionByName(extra)
    tables = gold.gold_from_rollup(gold.session_day_rollup(silver), silver)
    for name, build in gold.GOLD_BUILDERS.items():
        direct = build(silver)
        got = tables[name]
        assert got.columns == direct.columns, name
        assert [f.dataType for f in got.schema] == [f.dataType for f in direct.schema], name
        assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0, name


def test_processing_time_stream_runs_until_stopped(spark, lake):
    wire_path = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire_path)
    q = ingest_bronze(spark, lake, wire_source(spark, wire_path, streaming=True), trigger="1 second")
    try:
        q.processAllAvailable()
        # A processing-time query keeps running: the wait times out, the query is active.
        assert run_until_stopped(q, timeout=2) is False and q.isActive
        assert read_bronze(spark, lake).count() == 1070
    finally:
        q.stop()
    assert not q.isActive
