"""The runnable stages, publish options, session formats and the wider fixture."""

import json

import pytest
from conftest import SF0001, SF001
from pyspark.sql import functions as F

from tidewater import fixtures, jobs, registry
from tidewater.config import GOLD_TABLES
from tidewater.functions.windows import cumulative_sum
from tidewater.operators import quality
from tidewater.schema import EVENT_COLUMNS
from tidewater.session import FORMAT_CONF
from tidewater.sinks import tables
from tidewater.sources.wire import write_wire
from tidewater.streaming.bronze import batch_metrics


def test_every_stage_runs_through_the_entry(spark, lake, capsys):
    wire = lake.path("landing", "wire")
    write_wire(fixtures.wire_messages(spark, SF0001), wire)

    def stage(name, *more):
        jobs.main([name, "--root", lake.root, "--clock", "2024-02-01T00:00:00", *more])
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert stage("ingest", "--wire", wire, "--trigger", "available_now")["batches"] >= 1
    assert batch_metrics(spark, lake.path("bronze", "ingest_metrics")).agg(F.sum("messages")).first()[0] == 1070
    assert stage("silver")["silver_rows"] == 1000
    gold = stage("gold")
    published = stage("publish")
    assert {n.upper(): gold[n] for n in GOLD_TABLES} == {n.upper(): published[n.upper()] for n in GOLD_TABLES}
    again = stage("refresh", "--no-publish")
    assert again["silver.user_events"] == 1000 and all(again[f"gold.{n}"] == gold[n] for n in GOLD_TABLES)
    with pytest.raises(SystemExit):
        jobs.main(["ingest", "--root", lake.root])


def test_delta_sets_extension_and_catalog():
    assert FORMAT_CONF["delta"] == {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }
    assert jobs.parser().parse_args(["gold", "--root", "r", "--format", "delta"]).format == "delta"


class _Recorder:
    """Stands in for a frame, its writer and a session's reader; keeps what it was told."""

    def __init__(self):
        self.calls = []

    write = read = property(lambda self: self)

    def __getattr__(self, name):
        def call(*args, **kw):
            self.calls.append((name, args, kw))
            return [7] if name == "first" else 7 if name == "count" else self

        return call


def test_jdbc_publish_counts_by_query_and_needs_the_connections():
    df, spark = _Recorder(), _Recorder()
    with pytest.raises(ValueError, match="numPartitions"):
        tables._load_jdbc(spark, df, {"url": "jdbc:x"}, "T")
    assert df.calls == []
    assert tables._load_jdbc(spark, df, {"url": "jdbc:x", "numPartitions": "96"}, "T") == 7
    assert df.calls[1] == ("options", (), {"batchsize": "10000", "url": "jdbc:x", "numPartitions": "96", "dbtable": "T"})
    assert ("option", ("query", "SELECT COUNT(*) AS N FROM T"), {}) in spark.calls
    assert ("options", (), {"url": "jdbc:x"}) in spark.calls


@pytest.mark.parametrize("how, order", [
    ("rename", ["DROP TABLE IF EXISTS T", "ALTER TABLE T__STAGING RENAME TO T"]),
    ("swap", ["CREATE TABLE IF NOT EXISTS T LIKE T__STAGING", "ALTER TABLE T SWAP WITH T__STAGING", "DROP TABLE T__STAGING"]),
])
def test_a_published_table_is_replaced_by_one_transaction(monkeypatch, how, order):
    """The published table is named in no write, and in no statement before the staged rows were counted."""
    done, jdbc = [], {"url": "jdbc:x", "numPartitions": "2"}
    monkeypatch.setattr(tables, "_write_jdbc", lambda df, j, t: done.append(("write", t)))
    monkeypatch.setattr(tables, "_count_jdbc", lambda sp, j, t: done.append(("count", t)) or 7)
    monkeypatch.setattr(tables, "_execute_jdbc", lambda sp, j, statements: done.append(("execute", list(statements))))
    assert tables._load_jdbc(None, None, jdbc, "T", how, lambda: 7) == 7
    assert done == [("write", "T__STAGING"), ("count", "T__STAGING"), ("execute", order)]
    done.clear()
    with pytest.raises(RuntimeError, match="unchanged"):
        tables._load_jdbc(None, None, jdbc, "T", how, lambda: 8)
    assert done == [("write", "T__STAGING"), ("count", "T__STAGING")]


def test_any_connector_takes_the_table():
    df, spark = _Recorder(), _Recorder()
    assert tables._load_connector(spark, df, "warehouse", {"a": "b"}, "T") == 7
    assert df.calls == [("format", ("warehouse",), {}), ("options", (), {"a": "b"}), ("option", ("dbtable", "T"), {}), ("mode", ("overwrite",), {}), ("save", (), {})]


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "double"])
def test_sliced_sums_have_the_plain_type(spark, kind):
    df = spark.range(40).selectExpr("id % 2 AS k", "id AS tie", "timestamp_seconds(id) AS ts", f"CAST(id AS {kind}) AS v")
    plain = cumulative_sum(df, ["k"], "ts", "tie", "v", "s", hot_rows=1_000)
    sliced = cumulative_sum(df, ["k"], "ts", "tie", "v", "s", hot_rows=5, slice_rows=7)
    assert sliced.schema["s"].dataType == plain.schema["s"].dataType
    key = lambda r: r.tie
    assert sorted(sliced.collect(), key=key) == sorted(plain.select(*sliced.columns).collect(), key=key)


def test_fixture_holds_the_cases_the_operators_exist_for(spark):
    wire = fixtures.wire_messages(spark, SF001).checkpoint()
    rules = quality.validate_wire(wire).select(F.explode("violations").alias("v")).distinct().collect()
    assert {r.v for r in rules} == {*quality.rule_names(), quality.NAIVE_RULE}
    silver = registry._silver(spark, SF001).checkpoint()
    audit = quality.session_audit(silver).agg(*[F.sum(c).alias(c) for c in ("resume_without_pause", "events_after_terminal", "watch_decreases", "attribute_changes")]).first()
    assert all(n > 0 for n in audit)
    assert silver.filter(F.col("event_type").isin("pause", "skip")).select("event_type").distinct().count() == 2
    assert silver.filter(F.col("country_code") == "de").count() > 0
    days = silver.groupBy("session_id", "country_code").agg(F.count_distinct("event_date").alias("n")).select("n").distinct().collect()
    assert {2, 3} <= {r.n for r in days}
    sessions, grains = silver.select("session_id").distinct().count(), registry.gold.user_session_summary(silver).count()
    assert grains > sessions
    dark = silver.groupBy("session_id", "event_date").agg(F.max("watch_seconds").alias("m")).filter("m IS NULL").count()
    assert dark > 0


@pytest.mark.parametrize(
    "text, naive",
    [("2024-01-01T05:00:00", True), ("2024-01-01 05:00:00.25", True), ("2024-01-01", True), ("2024-01-01T05:00:00Z", False),
     ("2024-01-01T05:00:00.5+05:30", False), ("2024-01-01T05:00:00-0800", False), ("junk", False)],
)
def test_naive_timestamps(spark, text, naive):
    event = json.dumps({**dict.fromkeys(EVENT_COLUMNS), "event_id": "e", "event_timestamp": text})
    wire = spark.createDataFrame([(b"u", event.encode(), "t", 0, 0, None)], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    got = quality.validate_wire(wire).first()
    assert (quality.NAIVE_RULE in got.violations) is naive
    assert ("event_timestamp_missing" in got.violations) is (text == "junk")


def test_audit_expands_session_rows_not_events(spark):
    df = registry._silver(spark, SF0001).checkpoint()
    plan = quality.session_audit(df)._jdf.queryExecution().optimizedPlan().toString()
    lines = [ln.lstrip(" :+-").split(" ")[0] for ln in plan.splitlines()]
    expand = lines.index("Expand")
    assert "Aggregate" in lines[expand + 1 : lines.index("Window")]
