"""SNK8: Z-order, bin packing, and Bronze's batches; SNK1: publishing of batches."""

import random

import pytest
from conftest import SF001, SF0001
from pyspark.sql import functions as F

from tidewater import fixtures, registry
from tidewater.config import BRONZE_TABLE, SILVER_TABLE
from tidewater.sinks import compact
from tidewater.sinks.compact import PACKED, compact_bronze, compact_table, first_fit_decreasing, merge_small_files
from tidewater.sinks.storage import latest_path, write_table
from tidewater.sinks.tables import write_silver
from tidewater.sources.tables import read_bronze, read_silver
from tidewater.sources.wire import wire_source, write_wire
from tidewater.streaming import bronze as stream
from tidewater.streaming.bronze import ingest_bronze, publish_batch, run_until_stopped, stored_metrics


def rows(df):
    return sorted((tuple(r) for r in df.drop("transformed_at").collect()), key=repr)


def sizes(spark, path):
    found = spark.read.parquet(path).select(F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")).distinct()
    return {r[0]: (r[1], r[2]) for r in found.collect()}


@pytest.mark.parametrize("order, both", [("zorder", True), ("linear", False)])
def test_z_order_prunes_on_either_column(spark, lake, order, both):
    path = lake.path("silver", "clustered")
    events = registry._silver(spark, SF001)
    # As many users as a real table has in proportion: ids spread over 2,000 values, some of them NULL.
    events = events.withColumn("user_id", F.when(F.col("kafka_offset") % 97 == 0, None).otherwise(F.format_string("u-%04d", F.pmod(F.xxhash64("event_id"), F.lit(2_000)))))
    write_table(events, lake, path)
    before = rows(spark.read.parquet(latest_path(spark, path)))
    compact_table(spark, lake, path, ("user_id", "event_date"), target_files=64, order=order)
    after = spark.read.parquet(latest_path(spark, path))
    assert rows(after) == before and after.columns == events.columns
    borders = after.groupBy(F.input_file_name().alias("f")).agg(
        F.min("user_id").alias("u0"), F.max("user_id").alias("u1"), F.min("event_date").alias("d0"), F.max("event_date").alias("d1")
    ).collect()
    assert len(borders) == 64
    users = [r[0] for r in after.filter("user_id IS NOT NULL").select("user_id").distinct().orderBy("user_id").collect()]
    days = [r[0] for r in after.filter("event_date IS NOT NULL").select("event_date").distinct().orderBy("event_date").collect()]
    hit = lambda lo, hi, v: sum(b[lo] is not None and b[lo] <= v <= b[hi] for b in borders)
    by_user = [hit("u0", "u1", v) for v in users[:: len(users) // 40]]
    by_day = [hit("d0", "d1", v) for v in days]
    assert max(by_user) <= 64 / 3
    assert (max(by_day) <= 64 / 3) == both


def test_z_order_of_odd_tables(spark, lake):
    path = lake.path("silver", "odd")
    for data in ([], [(None, None)], [("a", 1)] * 50, [("a", None), (None, 3), ("é", -5)]):
        df = spark.createDataFrame(data, "user_id string, event_date int")
        write_table(df, lake, path)
        compact_table(spark, lake, path, ("user_id", "event_date"), target_files=4, order="zorder")
        assert rows(spark.read.schema(df.schema).parquet(latest_path(spark, path))) == rows(df)
    with pytest.raises(ValueError, match="linear or zorder"):
        compact_table(spark, lake, path, ("user_id",), order="hilbert")


def test_first_fit_decreasing():
    rng = random.Random(4)
    for _ in range(50):
        capacity = rng.randint(10, 100)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        bins = first_fit_decreasing(items, capacity)
        total = {}
        # Each item, from the largest down, is in the first bin that had room.
        for i in sorted(range(len(items)), key=lambda i: (-items[i], i)):
            assert bins[i] == next(b for b in range(len(items) + 1) if total.get(b, 0) + items[i] <= capacity)
            total[bins[i]] = total.get(bins[i], 0) + items[i]
        used = sorted(total.values())
        assert all(a + b > capacity for a, b in zip(used, used[1:]))


def test_only_small_files_are_packed(spark, lake):
    path = lake.path("silver", SILVER_TABLE)
    silver = registry._silver(spark, SF0001).repartition(6, "event_id")
    # One large file of its own, the rest in fragments.
    write_silver(silver, lake, cluster=False)
    root = latest_path(spark, path)
    big = silver.filter("event_date = '2024-01-05'").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(400))))
    big = big.withColumn("event_id", F.sha2(F.concat_ws(" ", "event_id", "i"), 512)).drop("event_date", "i")
    big.coalesce(1).write.mode("append").parquet(f"{root}/event_date=2024-01-05")
    was = sizes(spark, root)
    target = max(s for s, _ in was.values())
    large = {f: v for f, v in was.items() if v[0] >= target}
    before = rows(read_silver(spark, lake))
    gone = merge_small_files(spark, lake, path, target, sort_by=("user_id",), partition_by=("event_date",))
    now = sizes(spark, root)
    assert rows(read_silver(spark, lake)) == before
    assert gone > 50 and len(now) < len(was) / 3
    assert large and all(now.get(f) == v for f, v in large.items())
    # A second run finds nothing to do, and later fragments are packed with what was packed before.
    assert merge_small_files(spark, lake, path, target, partition_by=("event_date",)) == 0 and sizes(spark, root) == now
    silver.filter("event_date = '2024-01-06'").drop("event_date").coalesce(1).write.mode("append").parquet(f"{root}/event_date=2024-01-06")
    assert merge_small_files(spark, lake, path, target, partition_by=("event_date",)) == 2


def test_null_partitions_and_flat_tables_are_packed(spark, lake):
    path = lake.path("silver", "flat")
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'a b+%:' || id % 2 END AS p").repartition(7)
    for partition_by in ((), ("p",)):
        write_table(df, lake, path, partition_by=partition_by)
        before = rows(spark.read.parquet(latest_path(spark, path)).select("id", "p"))
        assert merge_small_files(spark, lake, path, 1 << 20, partition_by=partition_by) >= 7
        assert rows(spark.read.parquet(latest_path(spark, path)).select("id", "p")) == before
        assert len(sizes(spark, latest_path(spark, path))) == (3 if partition_by else 1)


def _stream(spark, lake, files_per_batch=1):
    src = wire_source(spark, lake.path("landing", "wire"), streaming=True, max_files_per_trigger=files_per_batch)
    run_until_stopped(ingest_bronze(spark, lake, src, trigger="available_now"))


def test_bronze_batches_are_packed_with_their_metrics(spark, lake):
    write_wire(fixtures.wire_messages(spark, SF0001).repartition(6), lake.path("landing", "wire"))
    _stream(spark, lake)
    root = lake.path("bronze", BRONZE_TABLE)
    before, metrics = rows(read_bronze(spark, lake)), rows(stored_metrics(spark, root))
    assert len(before) == 1070 and len(metrics) == 6 and sum(m[2] for m in metrics) == 1070
    assert sum(m[5] for m in metrics) == 20
    n = len(sizes(spark, root))
    assert compact_bronze(spark, lake) == n - 1  # all but the last batch's
    assert rows(read_bronze(spark, lake)) == before and rows(stored_metrics(spark, root)) == metrics
    assert len(sizes(spark, root)) == 2 and len(stored_metrics(spark, root).inputFiles()) == 2
    assert compact_bronze(spark, lake) == 0
    # The stream goes on as if nothing had happened.
    _stream(spark, lake)
    assert rows(read_bronze(spark, lake)) == before
    fixtures.wire_messages(spark, SF0001).limit(10).coalesce(1).write.mode("append").parquet(lake.path("landing", "wire"))
    _stream(spark, lake)
    assert read_bronze(spark, lake).count() == 1080
    assert compact_bronze(spark, lake) >= 1 and read_bronze(spark, lake).count() == 1080
    assert sum(m[2] for m in rows(stored_metrics(spark, root))) == 1080


def test_a_replayed_batch_adds_nothing(spark, lake):
    path = lake.path("bronze", BRONZE_TABLE)
    df = registry._bronze(spark, SF0001).withColumn("_wire_bytes", F.lit(7))
    assert publish_batch(df, path, "q1", 0) and not publish_batch(df, path, "q1", 0)
    assert read_bronze(spark, lake).count() == 1070
    # Another stream starts at batch 0 as well: its rows are its own.
    assert publish_batch(df.limit(5), path, "q2", 0) and read_bronze(spark, lake).count() == 1075
    assert sorted(m[:4] for m in rows(stored_metrics(spark, path))) == [("q1", 0, 1070, 7490), ("q2", 0, 5, 35)]
    assert "_spark_metadata" not in compact.list_names(spark, path)


@pytest.mark.parametrize("where", ["metrics", "rename"])
def test_a_stop_before_a_batch_is_published_loses_nothing(spark, lake, monkeypatch, where):
    write_wire(fixtures.wire_messages(spark, SF0001).repartition(4), lake.path("landing", "wire"))
    calls, real = [], stream.filesystem

    class Stopping:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, *a):
            calls.append(a)
            if len(calls) == 2:
                raise RuntimeError("stopped")
            return self.fs.rename(*a)

    with monkeypatch.context() as m:
        if where == "rename":
            m.setattr(stream, "filesystem", lambda sp, p: (Stopping(real(sp, p)[0]), real(sp, p)[1]))
        else:
            m.setattr(stream, "BATCH_METRICS", "no schema at all")
        with pytest.raises(Exception):
            _stream(spark, lake)
    _stream(spark, lake)
    m = rows(stored_metrics(spark, lake.path("bronze", BRONZE_TABLE)))
    assert read_bronze(spark, lake).count() == 1070 and len(m) == 4
    assert sum(x[2] for x in m) == 1070 and sum(x[4] for x in m) == 1050


def test_packed_files_are_named(spark, lake):
    write_table(spark.range(10).repartition(3), lake, lake.path("silver", "t"))
    merge_small_files(spark, lake, lake.path("silver", "t"))
    (name,) = sizes(spark, latest_path(spark, lake.path("silver", "t")))
    assert name.rsplit("/", 1)[1].startswith(PACKED)


def test_no_task_lays_out_more_than_its_bytes(spark, lake, monkeypatch):
    """A bin or a share above TASK_BYTES is cut along the order; rows stay, and a second run finds nothing to do."""
    path = lake.path("silver", SILVER_TABLE)
    write_silver(registry._silver(spark, SF0001).repartition(6, "event_id"), lake, cluster=False)
    before = rows(read_silver(spark, lake))
    stored = sum(s for s, _ in sizes(spark, latest_path(spark, path)).values())
    monkeypatch.setattr(compact, "TASK_BYTES", stored // 40)
    assert merge_small_files(spark, lake, path, sort_by=("user_id",), partition_by=("event_date",)) > 50
    packed = sizes(spark, latest_path(spark, path))
    dates = {f.split("/")[0] for f in packed}
    assert rows(read_silver(spark, lake)) == before and len(packed) > len(dates)
    assert merge_small_files(spark, lake, path, sort_by=("user_id",), partition_by=("event_date",)) == 0
    compact_table(spark, lake, path, ("user_id", "event_date"), target_files=1)
    assert rows(read_silver(spark, lake)) == before and len(sizes(spark, latest_path(spark, path))) > 5
