"""Live status whose space goes by what is new and open."""

import os
import time

import pytest
from pyspark.sql import functions as F

from punctuality.operators import run_log
from punctuality.streaming import open_runs


def feed_file(folder, run, name, text, at):
    os.makedirs(folder / run, exist_ok=True)
    path = folder / run / name
    path.write_text(text)
    os.utime(path, (at, at))


def advance(spark, feed, out, state, **options):
    lines = open_runs.follow_lines(spark, str(feed))
    open_runs.keep_open_runs(lines, str(out), str(state), **options).awaitTermination(120)


def status(spark, out, run):
    rows = open_runs.open_run_status(spark, str(out)).filter(F.col("run_id") == run).collect()
    return {r.step: (r.status, r.seconds) for r in rows}


def open_rows(spark, out):
    last = open_runs._folders(spark, str(out), "refresh")[-1]
    rows = spark.read.option("basePath", str(out)).parquet(f"{out}/refresh={last}")
    return {r.run_id for r in rows.filter("state = 'open'").select("run_id").collect()}


@pytest.fixture
def places(tmp_path):
    return tmp_path / "feed", tmp_path / "out", tmp_path / "state"


def test_runs_expire_when_they_have_ended(spark, places):
    feed, out, state = places
    start = time.time() - 10_000
    feed_file(feed, "a", "1.log", "[PHASE 1] x\n--> [Time] Step 1 (Init) took: 2.5s\n", start)
    feed_file(feed, "b", "1.log", "[PHASE 3] x\n", start + 1)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"a", "b"}
    assert status(spark, out, "a")[1] == ("finish", 2.5) and status(spark, out, "a")[2] == ("process", None)
    feed_file(feed, "a", "2.log", "--> [Time] Step 2 (Read) took: 4.0s\n[SYSTEM] Pipeline finished (Code: 0)\n", start + 10)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"a", "b"}  # ended, but a late line may still come
    feed_file(feed, "b", "2.log", "[SYSTEM] Pipeline finished (Code: 1)\n", start + 700)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"b"}
    feed_file(feed, "c", "1.log", "[PHASE 1] x\n[SYSTEM ERROR] lost\n", start + 2000)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"c"}
    assert status(spark, out, "a") == {1: ("finish", 2.5), 2: ("finish", 4.0), 3: ("process", None), 4: ("wait", None), 5: ("wait", None)}
    assert status(spark, out, "b")[3] == ("process", None)
    # A line of a run that has expired still counts.
    feed_file(feed, "a", "3.log", "--> [Time] Step 3 (Clean) took: 1.0s\n", start + 2001)
    advance(spark, feed, out, state)
    assert status(spark, out, "a")[3] == ("finish", 1.0) and status(spark, out, "a")[2] == ("finish", 4.0)


def test_state_goes_back_to_nothing(spark, places):
    feed, out, state = places
    start = time.time() - 400_000
    for i in range(8):
        feed_file(feed, f"run{i}", "1.log", f"[PHASE {i % 5 + 1}] x\n[SYSTEM] Pipeline finished (Code: 0)\n", start + i)
    advance(spark, feed, out, state)
    assert len(open_rows(spark, out)) == 8
    feed_file(feed, "last", "1.log", "[SYSTEM] Pipeline finished (Code: 0)\n", start + 5000)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"last"}
    feed_file(feed, "silent", "1.log", "[PHASE 1] x\n", start + 6000)
    advance(spark, feed, out, state)
    feed_file(feed, "now", "1.log", "[PHASE 2] x\n", start + 200_000)
    advance(spark, feed, out, state)
    assert open_rows(spark, out) == {"now"}
    assert open_runs.run_rows(spark, str(out)).count() == 11


def test_old_refreshes_are_gathered(spark, places):
    feed, out, state = places
    start = time.time() - 900_000
    for i in range(9):
        feed_file(feed, f"run{i}", "1.log", f"[PHASE {i % 5 + 1}] x\n[SYSTEM] Pipeline finished (Code: 0)\n", start + 2000 * i)
        advance(spark, feed, out, state, gather_every=3)
    refreshes, gathered = (open_runs._folders(spark, str(out), n) for n in ("refresh", "upto"))
    assert gathered == [4] and refreshes == [5, 6, 7, 8]
    found = open_runs.open_run_status(spark, str(out))
    assert found.count() == 45
    assert found.filter("status = 'process'").count() == 9
    whole = run_log.step_status(
        spark.createDataFrame([(f"run{i}", 1, f"[PHASE {i % 5 + 1}] x") for i in range(9)], "run_id string, line_no int, line string")
    )
    columns = ["run_id", "step", "title", "status", "seconds"]
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(map(tuple, whole.select(*columns).collect()), key=repr)


def test_replay_of_a_refresh_gives_the_same(spark, places):
    """The commit of the last batch is lost with its job, after its rows were written."""
    feed, out, state = places
    start = time.time() - 10_000
    for i in range(4):
        feed_file(feed, "a", f"{i}.log", f"[PHASE {i + 1}] x\n", start + i)
        feed_file(feed, f"done{i}", "1.log", "[SYSTEM] Pipeline finished (Code: 0)\n", start + 1000 * i)
        advance(spark, feed, out, state, gather_every=3)
    rows = sorted(map(repr, open_runs.run_rows(spark, str(out)).collect()))
    last = max(int(p) for p in os.listdir(state / "commits") if p.isdigit())
    (state / "commits" / str(last)).unlink()
    (state / "commits" / f".{last}.crc").unlink(missing_ok=True)
    advance(spark, feed, out, state, gather_every=3)
    assert sorted(map(repr, open_runs.run_rows(spark, str(out)).collect())) == rows


def test_large_files_are_read_line_by_line(spark, places):
    feed, out, state = places
    text = "".join(f"line {i}\n" for i in range(50_000))
    feed_file(feed, "big", "1.log", f"[PHASE 1] x\n{text}--> [Time] Step 1 (Init) took: 2.5s\n[PHASE 1] again\n", time.time() - 10)
    split = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(split, "100000")
    try:
        lines = open_runs.follow_lines(spark, str(feed))
        plan = lines._jdf.queryExecution().logical().toString()
        assert "wholetext -> true" not in plan
        open_runs.keep_open_runs(lines, str(out), str(state)).awaitTermination(120)
    finally:
        spark.conf.unset(split)
    assert status(spark, out, "big")[1] == ("process", 2.5)
