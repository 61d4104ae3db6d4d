import random
import re

import pytest
from pyspark.sql import functions as F

from punctuality.operators import run_log
from punctuality.sources.run_log import read_run_log
from punctuality.streaming.live_log import follow_run_log, keep_status, latest_status

LOG = """\
[PHASE 1] Starting
--> [Time] Step 1 (Engine Init) took: 3.21s

[PHASE 2] Reading
[Warning] Connection failed: ...
[Task 1] Loaded from local storage
[Stage 3:====>      (1 + 4) / 9]
[Stage 4:>  (0 + 1) / 1] done
--- 3.1: Minutes by cause
- Impact of [MONTH]: 74.50%
[SUCCESS] Exported
[SYSTEM ERROR] Connection lost.
java.lang.RuntimeException: --> [Task 9]
[ERROR] bad
--> [Time] Step 2 (Ingestion (HDFS)) took: 12.5s
"""

STATUS = {
    1: ("finish", 3.21), 2: ("finish", 12.5), 3: ("process", None), 4: ("wait", None), 5: ("wait", None),
}


def lines_of(spark, text, run="r"):
    rows = [(run, i, line) for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "run_id string, line_no bigint, line string")


def status_of(df):
    return {r.step: (r.status, r.seconds) for r in df.collect()}


def test_lines(spark):
    kept = [r.line for r in run_log.log_lines(lines_of(spark, LOG + " \t 　\n")).collect()]
    assert len(kept) == 13
    assert not any("====>" in line for line in kept) and "[Stage 4:>  (0 + 1) / 1] done" in kept


def test_classes(spark):
    classes = [r.line_class for r in run_log.classify(run_log.log_lines(lines_of(spark, LOG))).collect()]
    assert classes == [
        "phase", "result", "phase", "plain", "task", "plain", "section", "result", "success",
        "plain", "error", "error", "result",
    ]


def test_timings_and_phases(spark):
    text = "--> [Time] Step 3 (a) (b) took: 1.5s\n--> [Time] Step 12 (x) took: 1s\n" \
        "--> [Time] Step 4 (x) took: 1.2.3s\n[PHASE 9] no\n[PHASE 5][PHASE 2]"
    df = lines_of(spark, text)
    assert [(r.step, r.seconds) for r in run_log.step_timings(df).collect()] == [(3, 1.5), (4, None)]
    assert [(r.line_no, r.phase) for r in run_log.phases(df).collect()] == [(4, 5)]


def test_status(spark):
    df = run_log.step_status(lines_of(spark, LOG))
    assert status_of(df) == STATUS
    assert [r.title for r in df.orderBy("step").collect()] == list(run_log.STEPS)
    assert run_log.current_step(df).first().step == 3


def test_status_of_a_silent_run(spark):
    df = run_log.step_status(lines_of(spark, "hello"))
    assert set(status_of(df).values()) == {("wait", None)} and df.count() == 5
    assert run_log.current_step(df).first().step == 1


def fold(lines):
    """The same states, one line after the other."""
    state = {n: ["wait", None] for n in range(1, 6)}
    for line in lines:
        if found := re.search(run_log.TIMING, line):
            step = int(found[1])
            if step in state:
                state[step] = ["finish", float(found[2])]
                if step + 1 in state:
                    state[step + 1][0] = "process"
        for n in state:
            if f"[PHASE {n}]" in line:
                state[n][0] = "process"
    return {n: tuple(s) for n, s in state.items()}


def test_status_of_any_order_of_events(spark):
    rng = random.Random(1)
    runs = {}
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 12)):
            parts = [f"[PHASE {rng.randint(0, 6)}]" for _ in range(rng.randint(0, 2))]
            if rng.random() < 0.6:
                parts.append(f"--> [Time] Step {rng.randint(0, 7)} (x) took: {rng.randint(1, 99)}.5s")
            lines.append(" ".join(parts) or "text")
        runs[f"run{i:02d}"] = lines or ["text"]
    rows = [(run, n, line) for run, lines in runs.items() for n, line in enumerate(lines)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run_id string, line_no bigint, line string").repartition(5)
    found = {}
    for r in run_log.step_status(df).collect():
        found.setdefault(r.run_id, {})[r.step] = (r.status, r.seconds)
    assert found == {run: fold(lines) for run, lines in runs.items()}


def test_reading_files(spark, tmp_path):
    # Long enough to be read as several splits.
    body = "".join(f"text {i}\n" for i in range(5000))
    first, *rest = LOG.split("[PHASE 2]")
    (tmp_path / "run.a.log").write_text(first + body + "[PHASE 2]" + body.join(rest))
    (tmp_path / "run-b.log").write_text("[PHASE 4] x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        lines = read_run_log(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        status = run_log.step_status(lines)
        assert status_of(status.filter("run_id = 'run.a'")) == STATUS
        assert run_log.current_step(status).filter("run_id = 'run-b'").first().step == 4
        in_file_order = [r.line for r in lines.filter("run_id = 'run.a'").orderBy("line_no").collect()]
        assert [line for line in in_file_order if line.startswith("text")] == body.split("\n")[:-1]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("per_trigger", [1, None])
def test_following_a_live_log(spark, tmp_path, per_trigger):
    feed, state = tmp_path / "feed", str(tmp_path / f"state{per_trigger}")
    (feed / "r1").mkdir(parents=True)
    (feed / "r2").mkdir()

    def advance():
        status = run_log.step_status(follow_run_log(spark, str(feed), per_trigger))
        query = (
            status.writeStream.outputMode("complete").format("memory").queryName(f"live{per_trigger}")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination(120)
        found = {}
        for r in spark.table(f"live{per_trigger}").collect():
            found.setdefault(r.run_id, {})[r.step] = (r.status, r.seconds)
        return found

    half = LOG.index("--- 3.1")
    (feed / "r1" / "chunk-1.log").write_text(LOG[:half])
    (feed / "r2" / "chunk-1.log").write_text("nothing yet\n")
    found = advance()
    assert found["r1"][2] == ("process", None) and found["r2"][1] == ("wait", None)
    (feed / "r1" / "chunk-2.log").write_text(LOG[half:])
    found = advance()
    assert found["r1"] == STATUS and found["r2"][1] == ("wait", None)


def test_line_operators_on_a_stream(spark, tmp_path):
    (tmp_path / "r1").mkdir()
    (tmp_path / "r1" / "chunk-1.log").write_text(LOG)
    lines = follow_run_log(spark, str(tmp_path))
    query = (
        run_log.classify(lines).writeStream.format("memory").queryName("classes")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    counts = spark.table("classes").groupBy("line_class").agg(F.count("*").alias("n")).collect()
    assert {r.line_class: r.n for r in counts}["plain"] == 3 and sum(r.n for r in counts) == 13


def test_status_table_of_a_stream(spark, tmp_path):
    feed, out, state = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "state")
    (feed / "r1").mkdir(parents=True)
    (feed / "r2").mkdir()
    (feed / "r2" / "chunk-0.log").write_text("[PHASE 3] x\n")
    half = LOG.index("--- 3.1")
    for n, text in enumerate((LOG[:half], LOG[half:])):
        (feed / "r1" / f"chunk-{n}.log").write_text(text)
        keep_status(follow_run_log(spark, str(feed)), out, state).awaitTermination(120)
        found = latest_status(spark, out)
        assert found.count() == 10
        assert status_of(found.filter("run_id = 'r2'"))[3] == ("process", None)
        assert status_of(found.filter("run_id = 'r1'"))[2][0] == ("process", "finish")[n]
    assert status_of(found.filter("run_id = 'r1'")) == STATUS
    # The second refresh holds the run that changed, and no other.
    refreshes = spark.read.parquet(out)
    last = refreshes.agg(F.max("refresh")).first()[0]
    assert {r.run_id for r in refreshes.filter(F.col("refresh") == last).collect()} == {"r1"}
