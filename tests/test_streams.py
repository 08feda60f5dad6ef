"""Alerts with state, reject rows of the record stream, snapshots that are never missing, and walks over laid-out edges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.summaries import fit_idf
from corpusmill.operators.walks import crawl_links
from corpusmill.sinks import writers as W
from corpusmill.streaming import alerts as A
from corpusmill.streaming import streams as S

START = datetime(2024, 1, 1)
DDL = "ts timestamp, kind string"


def invented(seed, minutes=600):
    """Events in calm, failing, silent and empty stretches."""
    rng = random.Random(seed)
    out, kinds = [], ["ok"]
    for m in range(minutes):
        if m % 40 == 0:
            kinds = rng.choice([["ok"], ["error", "error", "ok"], ["error"], ["other"], []])
        if kinds:
            out += [(START + timedelta(minutes=m, seconds=rng.randrange(60)), rng.choice(kinds)) for _ in range(rng.randrange(1, 4))]
    return sorted(out)


def ends_of(rows, width=5):
    """(window end, errors, successes) of 5 minute windows with events."""
    out = {}
    for ts, kind in rows:
        end = START + timedelta(minutes=(int((ts - START).total_seconds()) // (60 * width) + 1) * width)
        e, s = out.get(end, (0, 0))
        out[end] = (e + (kind == "error"), s + (kind == "ok"))
    return out


def brute_errors(rows, closed, hold=15, limit=0.5):
    windows = ends_of(rows)
    bad = {end for end, (e, s) in windows.items() if e + s and e / (e + s) > limit}
    return {end for end in bad if end <= closed and all(end - timedelta(minutes=5 * k) in bad for k in range(hold // 5 + 1))}


def brute_stalls(rows, closed, hold=15):
    good = {end for end, (_, s) in ends_of(rows).items() if s}
    first = min(ends_of(rows))
    out, end = set(), first
    while end <= closed:
        held = [end - timedelta(minutes=5 * k) for k in range(hold // 5 + 1)]
        if held[-1] >= first and not good & set(held):
            out.add(end)
        end += timedelta(minutes=5)
    return out


def streamed(spark, folder, state, build):
    """Alerts of everything below ``folder`` that this checkpoint has not seen."""
    events = S.read_stream(spark, str(folder), DDL, "parquet")
    A.with_state_store(spark, lambda: S.run_available(build(events), f"{state}/out", f"{state}/state"))
    return [r["fired_at"] for r in spark.read.parquet(f"{state}/out").collect()]


@pytest.mark.parametrize("name", ["errors", "stalls"])
def test_alerts_over_several_runs(spark, tmp_path, name):
    rows = invented(7)
    build = {
        "errors": lambda e: A.error_rate_alert_stream(e, F.col("kind") == "ok", F.col("kind") == "error", "5 minutes", "5 minutes", "2 minutes", 300, 900, 0.5),
        "stalls": lambda e: A.stall_alert_stream(e, F.col("kind") == "ok", 300, 900, "2 minutes"),
    }[name]
    brute = {"errors": brute_errors, "stalls": brute_stalls}[name]
    cuts = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]
    for run, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        spark.createDataFrame(rows[lo:hi], DDL).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
        got = streamed(spark, tmp_path / "events", tmp_path / "run", build)
        # Each run goes on from the state of the last one and repeats no alert.
        assert len(got) == len(set(got))
        assert set(got) == brute(rows[:hi], rows[hi - 1][0] - timedelta(minutes=2)), run
    assert got


def test_a_heartbeat_moves_time_on(spark, tmp_path):
    spark.createDataFrame([(START, "ok")], DDL).write.parquet(f"{tmp_path}/events")
    beats = [(START + timedelta(minutes=m),) for m in range(0, 61)]
    spark.createDataFrame(beats, "timestamp timestamp").write.parquet(f"{tmp_path}/beats")
    heartbeat = S.read_stream(spark, f"{tmp_path}/beats", "timestamp timestamp", "parquet")
    got = streamed(spark, tmp_path / "events", tmp_path / "run", lambda e: A.stall_alert_stream(e, F.col("kind") == "ok", 300, 900, "0 minutes", heartbeat))
    assert sorted(got) == [START + timedelta(minutes=m) for m in range(25, 61, 5)]


def test_short_pages_are_rejected_not_lost(spark, tmp_path):
    long = "A page about rivers and stones that goes on for a while. " * 8
    rows = [(0, "A", long, "en", "c"), (1, "B", "too short", "en", "c"), (2, "C", None, "en", "c"), (3, "D", "", "en", "c")]
    ddl = "seq bigint, title string, text string, lang string, category string"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/pages")
    pages = S.read_stream(spark, f"{tmp_path}/pages", ddl, "parquet")
    idf = fit_idf(spark.createDataFrame([(long,)], "content string"))
    S.record_stream(pages, f"{tmp_path}/built", f"{tmp_path}/state", {"en": ["the"]}, idf)
    good = {r["seq"] for r in spark.read.parquet(f"{tmp_path}/built/records").collect()}
    bad = {r["seq"]: r["reasons"] for r in spark.read.parquet(f"{tmp_path}/built/rejects").collect()}
    assert good | set(bad) == {0, 1, 2, 3} and not good & set(bad)
    assert all("content" in bad[k] for k in (1, 2, 3)) and "content" not in bad.get(0, [])


def test_a_failing_write_leaves_the_old_snapshot(spark, tmp_path):
    path, ddl = str(tmp_path / "snap"), "pages_processed long"
    assert W.read_progress(spark, path, ddl).collect() == []
    for n in (1, 2, 3):
        W.write_progress(spark.createDataFrame([(n,)], ddl), path)
        assert W.read_progress(spark, path, ddl).first()[0] == n
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).cast("long").alias("pages_processed"))
    with pytest.raises(Exception, match="stop"):
        W.write_progress(broken, path)
    assert W.read_progress(spark, path, ddl).first()[0] == 3
    W.write_progress(spark.createDataFrame([(4,)], ddl), path)
    versions = [p.name for p in (tmp_path / "snap").iterdir() if p.name.startswith("version-")]
    assert W.read_progress(spark, path, ddl).first()[0] == 4 and len(versions) == 2


def test_walks_leave_their_edges_where_they_lie(spark):
    links = spark.createDataFrame([(f"p{i}", k, f"/u{i + k}", f"p{i + k}") for i in range(30) for k in (1, 2)], "src string, pos int, url string, dst string")
    starts = spark.createDataFrame([("p0",)], "start string")
    rows = crawl_links(links, starts, depth=2)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "links_" in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = crawl_links(links, starts, depth=1)._jdf.queryExecution().sparkPlan().toString()
        executed = crawl_links(links, starts, depth=1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in physical
    # The scan of the edges reaches its join without an exchange.
    scan = next(i for i, line in enumerate(executed.splitlines()) if "Bucketed: true" in line)
    above = executed.splitlines()[scan - 3 : scan]
    assert not any("Exchange" in line for line in above), executed
    visited = spark.createDataFrame([("p1",)], "title string")
    assert {tuple(r) for r in crawl_links(links, starts, 2, visited).drop("path").collect()} == {tuple(r) for r in crawl_links(links, starts, 2, ["p1"]).drop("path").collect()}
