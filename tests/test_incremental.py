"""Silver and Gold by date: late events, stops in between, and merged bitmaps."""

import datetime as dt

import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from tidewater import fixtures, registry
from tidewater.config import GOLD_TABLES, SILVER_TABLE, LakeConfig
from tidewater.operators import bitmaps, gold
from tidewater.plans import incremental
from tidewater.plans.incremental import build_gold_by_date, date_range, merge_silver, on_dates, refresh_incremental, touched_dates
from tidewater.plans.jobs import build_gold, build_silver
from tidewater.sinks import swap
from tidewater.sinks.storage import latest_path, scratch_dir
from tidewater.sources.tables import read_gold, read_silver
from tidewater.sources.wire import wire_source, write_wire
from tidewater.streaming.bronze import ingest_bronze, run_until_stopped


def rows(df):
    cols = sorted(c for c in df.columns if c not in ("transformed_at", "ingested_at"))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def ingest(spark, lake, messages, name):
    write_wire(messages, lake.path("landing", f"wire/part={name}"))
    src = wire_source(spark, lake.path("landing", "wire/part=*"), streaming=True)
    run_until_stopped(ingest_bronze(spark, lake, src, trigger="available_now"))


def split(spark):
    w = registry._late(fixtures.wire_messages(spark, SF0001))
    return w.filter("NOT late").drop("late"), w.filter("late").drop("late")


@pytest.fixture(scope="module")
def full(spark):
    """Silver and all Gold tables of one build from all of Bronze: (columns, rows) by name."""
    lake = LakeConfig(root=scratch_dir(spark, "full"), clock=registry.CLOCK)
    ingest(spark, lake, fixtures.wire_messages(spark, SF0001), 1)
    build_silver(spark, lake)
    build_gold(spark, lake)
    return {n: (sorted(df.columns), rows(df)) for n, df in {"silver": read_silver(spark, lake), **{n: read_gold(spark, lake, n) for n in GOLD_TABLES}}.items()}


def assert_equal(spark, lake, full):
    for n, df in {"silver": read_silver(spark, lake), **{n: read_gold(spark, lake, n) for n in GOLD_TABLES}}.items():
        assert (sorted(df.columns), rows(df)) == full[n], n


def files(spark, path):
    return {f for f in spark.read.parquet(path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}


def test_late_events_rewrite_their_dates_only(spark, lake, full):
    early, late = split(spark)
    ingest(spark, lake, early, 1)
    refresh_incremental(spark, lake)
    silver, g1 = (latest_path(spark, lake.path(*p)) for p in (("silver", SILVER_TABLE), ("gold", "daily_watch_time_by_country")))
    before = files(spark, silver), files(spark, g1)
    ingest(spark, lake, late, 2)
    report = refresh_incremental(spark, lake)
    assert set(report["dates"]) == set(registry.LATE_DATES)
    for path, was in zip((silver, g1), before):
        now = files(spark, path)
        changed = {f.split("event_date=")[1][:10] for f in was ^ now}
        assert changed == {str(d) for d in registry.LATE_DATES}
    assert_equal(spark, lake, full)

    # What Gold reads for these dates: their partitions and no others.
    scan = read_silver(spark, lake).filter(on_dates(report["dates"]))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "event_date" in line.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {f.split("event_date=")[1][:10] for f in scan.inputFiles()} >= {str(d) for d in report["dates"]}
    read = scan.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("event_date=")[1][:10] for r in read} == {str(d) for d in report["dates"]}

    # Nothing new: nothing is touched.
    now = files(spark, silver), files(spark, g1)
    report = refresh_incremental(spark, lake)
    assert report == {"dates": [], "rows": {}} and (files(spark, silver), files(spark, g1)) == now


@pytest.mark.parametrize("stop_at", ["build_gold_by_date", "write_gold"])
def test_a_stopped_refresh_is_run_again(spark, lake, full, monkeypatch, stop_at):
    early, late = split(spark)
    ingest(spark, lake, early, 1)
    refresh_incremental(spark, lake)
    ingest(spark, lake, late, 2)

    def stop(*a, **k):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, stop_at, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh_incremental(spark, lake)
    refresh_incremental(spark, lake)
    assert touched_dates(spark, lake) == []
    assert_equal(spark, lake, full)


@pytest.mark.parametrize("steps", [0, 3])
def test_a_stop_inside_a_replacement_is_finished_by_the_next_reader(spark, lake, full, monkeypatch, steps):
    """The file system fails after some deletes and renames; readers still see old or new, never a mix."""
    early, late = split(spark)
    ingest(spark, lake, early, 1)
    refresh_incremental(spark, lake)
    ingest(spark, lake, late, 2)
    finish = swap._finish

    def part(sp, root, intent):
        done = {"delete": intent["delete"][:steps], "add": intent["add"][: max(0, steps - 1)]}
        fs, _ = swap.filesystem(sp, root)
        for name in done["delete"]:
            fs.delete(swap._path(sp, f"{root}/{name}"), True)
        for staged, name in done["add"]:
            fs.delete(swap._path(sp, f"{root}/{name}"), True)
            fs.rename(swap._path(sp, f"{root}/{staged}"), swap._path(sp, f"{root}/{name}"))
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(swap, "_finish", part)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh_incremental(spark, lake)
    assert swap._finish is finish
    refresh_incremental(spark, lake)
    assert_equal(spark, lake, full)


def test_a_date_range_of_gold(spark, lake):
    """PL3's range argument: only these dates are rebuilt, a missing state means all of them."""
    ingest(spark, lake, fixtures.wire_messages(spark, SF0001), 1)
    build_silver(spark, lake)
    few = date_range(dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    assert build_gold_by_date(spark, lake, few) == {n: read_gold(spark, lake, n).count() for n in GOLD_TABLES}
    g3 = lake.path("gold", "hourly_event_distribution")
    before = files(spark, latest_path(spark, g3))
    counts = build_gold_by_date(spark, lake, few)
    assert counts["hourly_event_distribution"] == read_gold(spark, lake, "hourly_event_distribution").filter(on_dates(few)).count()
    changed = {f.split("event_date=")[1][:10] for f in before ^ files(spark, latest_path(spark, g3))}
    assert changed == {str(d) for d in few}


def _bronze(spark, *events):
    base = registry._bronze(spark, SF0001).filter("event_id IS NOT NULL").limit(1)
    out = None
    for event_id, part, offset, ts in events:
        r = base.withColumns({"event_id": F.lit(event_id), "kafka_partition": F.lit(part), "kafka_offset": F.lit(offset).cast("long"), "event_timestamp": F.lit(ts).cast("timestamp")})
        out = r if out is None else out.unionByName(r)
    return out


def test_a_late_copy_that_wins_moves_the_event(spark, lake):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    merge_silver(spark, lake, _bronze(spark, ("a", 3, 10, "2024-01-01 05:00:00"), ("b", 1, 1, "2024-01-02 05:00:00"), ("c", 2, 2, None)))
    # A copy further down the log loses and touches nothing; unparsed messages neither.
    assert merge_silver(spark, lake, _bronze(spark, ("a", 3, 11, "2024-01-03 05:00:00"), ("b", 4, 0, "2024-01-01 05:00:00"), (None, 0, 0, None))) == []
    # One from a lower partition wins: its date and the old one change, and the old partition is empty now.
    assert set(merge_silver(spark, lake, _bronze(spark, ("a", 0, 50, "2024-01-03 05:00:00")))) == {d1, d3}
    got = {(r.event_id, r.event_date, r.kafka_partition) for r in read_silver(spark, lake).collect()}
    assert got == {("a", d3, 0), ("b", d2, 1), ("c", None, 2)}
    # An event without a time lies in the partition of NULL dates, which is replaced like others.
    assert set(merge_silver(spark, lake, _bronze(spark, ("c", 0, 1, "2024-01-02 06:00:00"), ("d", 0, 2, None)))) == {None, d2}
    got = {(r.event_id, r.event_date) for r in read_silver(spark, lake).collect()}
    assert got == {("a", d3), ("b", d2), ("c", d2), ("d", None)}


def test_merged_days_equal_one_pass(spark):
    silver = registry._silver(spark, SF0001).select(*gold.GOLD_INPUT_COLUMNS)
    extra = spark.createDataFrame([(None, None, "play", None, "c-1", "movie", "web", "s-x", None, None, None), (None, 1, "play", "IN", None, "movie", None, None, None, 5, None)], silver.schema)
    rollup = gold.session_day_rollup(silver.unionByName(extra)).checkpoint()
    numbers = {k: bitmaps.new_numbers(rollup, None, scratch_dir(spark, "numbers"), c) for k, c in bitmaps.MEMBERS.items()}
    keys = ("content_id", "content_type")
    days = [r[0] for r in rollup.select("event_date").distinct().orderBy("event_date").collect()]
    parts = [bitmaps.daily_states(rollup.filter(F.col("event_date").eqNullSafe(F.lit(d))), numbers, keys) for d in days[:4]]
    some = rollup.filter(on_dates(days[:4]))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    got = bitmaps.merged(union, keys, "unique_viewers")
    want = gold._distincts_from_rollup(some, list(keys), "unique_viewers")
    assert rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_or_agg" in plan


def test_numbers_are_dense_and_go_on(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "user_id string").repartition(5)
    first = bitmaps.new_numbers(ids("a", "b", None, "c", "a"), None, scratch_dir(spark, "n"), "user_id")
    assert sorted(r.n for r in first.collect()) == [0, 1, 2] and {r.id for r in first.collect()} == {"a", "b", "c"}
    more = bitmaps.new_numbers(ids("c", "d", "e", None), first, scratch_dir(spark, "n"), "user_id")
    assert sorted((r.n for r in more.collect())) == [3, 4] and {r.id for r in more.collect()} == {"d", "e"}
    assert bitmaps.new_numbers(ids(None), None, scratch_dir(spark, "n"), "user_id").collect() == []


def test_rows_outside_the_replaced_partitions_are_refused(spark, lake):
    ingest(spark, lake, fixtures.wire_messages(spark, SF0001), 1)
    build_silver(spark, lake)
    path = latest_path(spark, lake.path("silver", SILVER_TABLE))
    before = rows(read_silver(spark, lake))
    with pytest.raises(ValueError, match="outside the partitions"):
        swap.replace_partitions(read_silver(spark, lake), path, "event_date", [dt.date(2024, 1, 2)])
    assert rows(read_silver(spark, lake)) == before
