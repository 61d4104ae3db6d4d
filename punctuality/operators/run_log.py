"""Run logs as tables: one row ``(run_id, line_no, line)`` per log line.

``line_no`` only has to order the lines of a run. All operators but ``step_status``
and ``current_step`` work line by line, on batch and streaming input alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text patterns of the log.
TIMING_MARK = "--> [Time] Step "
TIMING = r"--> \[Time\] Step (\d) \(.*?\) took: ([\d.]+)s"
PHASE = r"\[PHASE ([1-5])\]"
FINISHED = r"\[SYSTEM\] Pipeline finished \(Code: ([^)]*)\)"
LOST = "[SYSTEM ERROR]"
TOTAL = r"\[DONE\] Total\D*([\d.]+) seconds"
NOT_BLANK = r"[^\s\x0B\p{Zs}\x{FEFF}\x{2028}\x{2029}]"

# The steps of a run, in order.
STEPS = (
    "Engine Initialization",
    "HDFS Ingestion",
    "Data Cleaning",
    "Aggregation",
    "Machine Learning",
)

# Line classes and the texts that mark them; the first match wins.
LINE_CLASSES = (
    ("error", ("[ERROR]", "Exception")),
    ("success", ("[SUCCESS]", "[DONE]")),
    ("phase", ("[PHASE",)),
    ("task", ("[Task",)),
    ("result", ("-->", "- Impact of")),
    ("section", ("---",)),
)
OTHER_CLASS = "plain"


def log_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Drop blank lines and the progress bars that Spark draws."""
    text = F.col(line)
    progress_bar = text.contains("[Stage ") & text.contains("=>")
    return lines.filter(text.rlike(NOT_BLANK) & ~progress_bar)


def _timing(line: str, group: int) -> Column:
    """A group of the timing pattern, which is only tried on lines that bear its mark."""
    found = F.regexp_extract(line, TIMING, group)
    return F.when(F.col(line).contains(TIMING_MARK), F.nullif(found, F.lit("")))


def timed_step(line: str = "line") -> Column:
    """Step number of a timing line, else NULL."""
    return _timing(line, 1).cast("int")


def timed_seconds(line: str = "line") -> Column:
    """Seconds of a timing line; NULL on other lines and for malformed numbers."""
    return _timing(line, 2).try_cast("double")


def phase_of(line: str = "line") -> Column:
    """Number of the first phase marker of a line, else NULL."""
    return F.nullif(F.regexp_extract(line, PHASE, 1), F.lit("")).cast("int")


def line_class(line: str = "line") -> Column:
    """Class of a line."""
    text = F.col(line)
    chain = F
    for name, marks in LINE_CLASSES:
        test = text.contains(marks[0])
        for mark in marks[1:]:
            test = test | text.contains(mark)
        chain = chain.when(test, name)
    return chain.otherwise(OTHER_CLASS)


def step_timings(lines: DataFrame) -> DataFrame:
    """``(run_id, line_no, step, seconds)``, one row per timing line."""
    return lines.filter(timed_step().isNotNull()).select(
        "run_id", "line_no", timed_step().alias("step"), timed_seconds().alias("seconds")
    )


def phases(lines: DataFrame) -> DataFrame:
    """``(run_id, line_no, phase)``, one row per line with a phase marker."""
    return lines.filter(phase_of().isNotNull()).select(
        "run_id", "line_no", phase_of().alias("phase")
    )


def classify(lines: DataFrame) -> DataFrame:
    """The lines with their class."""
    return lines.withColumn("line_class", line_class())


def step_status(lines: DataFrame) -> DataFrame:
    """State of the five steps of every run: ``(run_id, step, title, status, seconds)``.

    The last event that touches a step decides. A timing line finishes its step and
    starts the next; a phase marker starts its step, and comes after a timing on the
    same line. A step without events waits. ``seconds`` is the last time reported.

    Each run is folded into one row of last positions by a single hash aggregation,
    pre-aggregated per task, so a run that holds most of the lines is no hot spot.
    """
    return status_of_runs(run_positions(lines))


def run_positions(lines: DataFrame, *more: Column) -> DataFrame:
    """One row per run: where each step was last started and finished, and its last time.

    ``more`` are further aggregates over the columns of ``lines``.
    """
    at, step = F.col("line_no"), timed_step()
    last = []
    for n in _numbers():
        # Step 0 is no step, so it does not start step 1.
        started = F.col("line").contains(f"[PHASE {n}]") | (F.col("step").eqNullSafe(n - 1) & F.lit(n > 1))
        last.append(F.max(F.when(started, at)).alias(f"started{n}"))
        last.append(F.max(F.when(F.col("step") == n, at)).alias(f"finished{n}"))
        last.append(F.max_by("seconds", F.when(F.col("step") == n, at)).alias(f"seconds{n}"))
    marked = lines.withColumns({"step": step, "seconds": timed_seconds()})
    return marked.groupBy("run_id").agg(*last, *more)


def merge_positions(rows: DataFrame, *more: Column) -> DataFrame:
    """Rows of :func:`run_positions` over parts of the lines, as one row per run."""
    last = []
    for n in _numbers():
        last += [F.max(f"started{n}").alias(f"started{n}"), F.max(f"finished{n}").alias(f"finished{n}")]
        last.append(F.max_by(f"seconds{n}", f"finished{n}").alias(f"seconds{n}"))
    return rows.groupBy("run_id").agg(*last, *more)


def status_of_runs(runs: DataFrame) -> DataFrame:
    """:func:`step_status` from the positions of runs."""
    states = [
        F.struct(
            F.lit(n).alias("step"),
            F.lit(title).alias("title"),
            _state(F.col(f"started{n}"), F.col(f"finished{n}")).alias("status"),
            F.col(f"seconds{n}").alias("seconds"),
        )
        for n, title in enumerate(STEPS, 1)
    ]
    return runs.select("run_id", F.inline(F.array(*states)))


def current_step(status: DataFrame) -> DataFrame:
    """``(run_id, step)``: the last step of each run that is not waiting, else the first."""
    reached = F.max(F.when(F.col("status") != "wait", F.col("step")))
    return status.groupBy("run_id").agg(F.coalesce(reached, F.lit(1)).alias("step"))


def ends_run(line: str = "line") -> Column:
    """Whether a line ends its run."""
    return F.col(line).rlike(FINISHED) | F.col(line).contains(LOST)


def run_outcome(lines: DataFrame) -> DataFrame:
    """``(run_id, outcome, total_seconds)`` of every run.

    The last line that ends a run decides: ``completed`` if it reports code 0, else ``error``;
    a run without such a line is ``running``. ``total_seconds`` is the last total reported.
    As in :func:`step_status`, a run is one row of last positions, pre-aggregated per task.
    """
    text, at = F.col("line"), F.col("line_no")
    code = F.regexp_extract(text, FINISHED, 1)
    good = text.rlike(FINISHED) & (code == "0") & ~text.contains(LOST)
    total = F.nullif(F.regexp_extract(text, TOTAL, 1), F.lit("")).try_cast("double")
    marked = lines.select(
        "run_id", at.alias("at"), good.alias("good"), ends_run().alias("end"), total.alias("total")
    )
    runs = marked.groupBy("run_id").agg(
        F.max(F.when(F.col("end"), F.col("at"))).alias("ended"),
        F.max(F.when(F.col("good"), F.col("at"))).alias("completed"),
        F.max_by("total", F.when(F.col("total").isNotNull(), F.col("at"))).alias("total_seconds"),
    )
    outcome = (
        F.when(F.col("ended").isNull(), "running")
        .when(F.col("completed") == F.col("ended"), "completed").otherwise("error")
    )
    return runs.select("run_id", outcome.alias("outcome"), "total_seconds")


def _numbers() -> range:
    return range(1, len(STEPS) + 1)


def _state(started: Column, finished: Column) -> Column:
    return (
        F.when(finished.isNotNull() & (started.isNull() | (finished > started)), "finish")
        .when(started.isNotNull(), "process")
        .otherwise("wait")
    )
