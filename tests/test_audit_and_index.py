"""V4 from mergeable summaries and F5 through the trigram index, against the plain ways."""

import random

import pyarrow as pa
import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from tidewater import registry
from tidewater.operators import audit, quality, search_index, serving
from tidewater.operators.search_index import literal_parts, search_sessions_indexed, write_postings
from tidewater.sinks.storage import scratch_dir


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def events(spark, seed, n=600):
    """Sessions over several days with ties, NULLs and one session that has half of all events."""
    rng = random.Random(seed)
    kinds = ["play", "pause", "resume", "skip", "seek", "complete", "error", None, "odd"]
    weights = [6, 6, 6, 2, 2, 0.3, 0.3, 1, 1]
    out = []
    for i in range(n):
        session = rng.choice(["hot", "hot", None, *(f"s{j}" for j in range(30)), "hot"] if rng.random() < 0.5 else ["hot"])
        at = None if rng.random() < 0.03 else f"2024-01-0{rng.randint(1, 4)} {rng.randint(0, 23):02d}:{rng.randint(0, 5):02d}:00"
        out.append((session, at, i, rng.choices(kinds, weights)[0], rng.choice([None, *range(20)]), *(rng.choice([None, "a", "b"][: rng.randint(1, 3)]) for _ in range(6))))
    schema = "session_id string, at string, kafka_offset long, event_type string, watch_seconds int, " + ", ".join(f"{a} string" for a in quality.SESSION_ATTRIBUTES)
    df = spark.createDataFrame(out, schema)
    return df.withColumn("event_timestamp", F.col("at").cast("timestamp")).drop("at")


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_days_equal_the_audit_in_one_pass(spark, seed):
    df = events(spark, seed).repartition(7).checkpoint()
    want = rows(quality.session_audit(df))
    summaries, values = audit.session_summaries(df).checkpoint(), audit.session_values(df)
    assert rows(audit.audit(summaries, values)) == want
    # Day by day, each from its own events, merged in any grouping.
    days = [r[0] for r in df.select(F.to_date("event_timestamp").alias("d")).distinct().collect()]
    parts = [df.filter(F.to_date("event_timestamp").eqNullSafe(F.lit(d))) for d in days]
    per_day = None
    for p in parts:
        one = audit.merged(audit.session_summaries(p))
        per_day = one if per_day is None else audit.merged(per_day.unionByName(one))
    assert rows(audit.audit(per_day, values)) == want
    assert rows(audit.merged(per_day)) == rows(per_day)


def test_a_hot_session_is_cut_without_checkpoint_or_row_join(spark):
    df = events(spark, 3, 2_000).checkpoint()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")  # runs go on over many batches
    try:
        summaries = audit.session_summaries(df).checkpoint()
        assert rows(audit.audit(summaries, audit.session_values(df))) == rows(quality.session_audit(df))
        # One summary for each session, day and task, however many batches and rows.
        assert summaries.filter("session_id = 'hot'").count() <= 5 + int(spark.conf.get("spark.sql.shuffle.partitions"))
        plan = audit.session_summaries(df)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Window" not in plan
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_summaries_of_an_empty_table(spark):
    df = events(spark, 4).limit(0)
    assert audit.audit(audit.session_summaries(df), audit.session_values(df)).collect() == []


def test_batch_summaries_merge_like_one_batch():
    import datetime as dt

    day = dt.date(2024, 1, 1)
    data = {
        "session_id": ["a"] * 6 + ["b"], "event_date": [day] * 7, "event_timestamp": [dt.datetime(2024, 1, 1, 0, i) for i in range(7)], "tie": list(range(7)),
        "event_type": ["resume", "pause", "resume", "complete", "resume", "pause", "resume"], "watch_seconds": [5, 3, None, 9, 1, 1, 2],
    }
    types = {"event_date": pa.date32(), "watch_seconds": pa.int32()}
    batch = pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c)) for c, v in data.items()})
    whole = audit._summaries(batch)
    row = lambda s, i: {c: s[c][i] for c in audit._COLUMNS}
    assert (whole["bad"], whole["after"], whole["falls"], whole["terminal"]) == ([2, 1], [2, 0], [2, 0], [True, False])
    for cut in range(1, 6):
        a, b = audit._summaries(batch.slice(0, cut)), audit._summaries(batch.slice(cut, 6 - cut))
        assert audit._merge(row(a, 0), row(b, 0)) == row(whole, 0)


PATTERNS = {
    "abc": ["abc"], "ab": [], "a.bcd": ["bcd"], "abcd?ef": ["abc"], "abcd+efg": ["abcd", "efg"], "abc|def": [], "(abc)def": ["def"], "(a|b)cde[xyz]fgh": ["cde", "fgh"],
    "a\\.bc": ["a.bc"], "abc\\d+def": ["abc", "def"], "(?i)abc": [], "ab[cd": [], "abcd{2}efg": ["abc", "efg"], "abcd*?efg": ["abc", "efg"], "^abc$": ["abc"], "\\Qabc\\E": [],
    "a[b)c]def": ["def"], "((ab)c)def": ["def"], "(?:abc)def": [], "abc)": [], "[^]]abc": [], "": [], "abc\\": [],
}


def test_literal_parts():
    for p, want in PATTERNS.items():
        got = literal_parts(p)
        assert set(got) <= set(want) or got == want, (p, got)
    assert all(literal_parts(p) == PATTERNS[p] for p in ("abc", "abcd?ef", "abcd+efg", "a\\.bc", "(a|b)cde[xyz]fgh", "abc|def", "ab"))


def test_characters_that_match_each_other_fold_alike(spark):
    """All letters up to U+2FFF that a case-insensitive match takes for one another."""
    char = spark._jvm.java.lang.Character
    classes = {}
    for c in range(0x20, 0x2FFF):
        classes.setdefault(char.toLowerCase(char.toUpperCase(c)), []).append(chr(c))
    pairs = spark.createDataFrame([(x[0], y) for x in classes.values() for y in x[1:]], "a string, b string")
    fold = lambda c: search_index.folded(F.col(c))
    assert pairs.count() > 900 and pairs.filter(fold("a") != fold("b")).collect() == []


def test_indexed_search_equals_the_scan(spark):
    g5 = registry._gold(spark, SF0001, "user_session_summary").select("user_id", "session_id", "event_count")
    odd = [("STRASSE-ß1", "xİstanbul"), ("straẞe", "ΟΔΟΣ 1"), ("Kelvin-9", "ſecret"), (None, "u-1 odos"), ("abc.def", None), ("ABCxDEF", "s"), ("", "zz")]
    g5 = g5.unionByName(spark.createDataFrame([(u, s, 1) for u, s in odd], "user_id string, session_id string, event_count long")).checkpoint()
    path = scratch_dir(spark, "postings")
    write_postings(g5, path)
    index = spark.read.parquet(path)
    searches = ["s-1", "S-1.*9", "u-é?1", "ß1", "raße", "RAẞE", "istan", "İSTAN", "kelvin", "SECRET", "οδος", "ΟΔΟΣ 1", "abc.def", "abc\\.def", "none at all", "", "u|s-12", "[a-z]-98", "(s)-1"]
    for text in searches:
        for literal in (False, True):
            got = search_sessions_indexed(g5, index, text, literal)
            assert got.columns == g5.columns and rows(got) == rows(serving.search_sessions(g5, text, literal)), (text, literal)


def test_an_indexed_search_reads_its_own_postings_only(spark):
    g5 = registry._gold(spark, SF0001, "user_session_summary").checkpoint()
    path = scratch_dir(spark, "postings")
    write_postings(g5, path)
    index = spark.read.parquet(path)
    plan = search_sessions_indexed(g5, index, "s-1")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and "bucket" in x)
    assert "PushedFilters" in scan and "gram" in scan.split("PushedFilters")[1]
    (bucket,) = {r.bucket for r in index.filter("gram = 's-1'").select("bucket").distinct().collect()}
    assert "bucket" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and str(bucket) in scan.split("PartitionFilters")[1]
    # Patterns without three literal characters scan the sessions.
    assert "bucket" not in search_sessions_indexed(g5, index, "u-")._jdf.queryExecution().executedPlan().toString()
    assert search_index.GRAM == 3
