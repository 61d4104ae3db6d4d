"""Following the log of running jobs.

A run writes its output in chunks, one file each, below ``<directory>/<run_id>/``.
The line operators and ``step_status`` of :mod:`punctuality.operators.run_log` apply
to the stream unchanged; the status needs the update or complete output mode, and its
state is one row per run.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctuality.operators.run_log import log_lines, step_status

RUN_FOLDER = r"([^/]+)/[^/]+$"


def follow_run_log(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream ``(run_id, line_no, line)`` from chunk files as they appear.

    A chunk is split into lines within its row, so chunks should be small, as the
    pieces of a live feed are; finished logs of any size go through ``read_run_log``.
    ``line_no`` orders by arrival time, then file name, then position.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    chunks = reader.text(f"{directory}/*", wholetext=True).select(
        F.regexp_extract("_metadata.file_path", RUN_FOLDER, 1).alias("run_id"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_name").alias("file"),
        F.posexplode(F.split("value", "\n")).alias("position", "line"),
    )
    lines = chunks.select(
        "run_id", F.struct("arrived", "file", "position").alias("line_no"), "line"
    )
    return log_lines(lines)


def keep_status(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the step status of the runs of a line stream as a table below ``path``.

    Each refresh appends the runs that changed, in a folder of its own: a batch that is
    replayed after a failure replaces its folder, and the work of a refresh goes by what
    is new, not by all runs so far. Without ``every`` the query takes in what has arrived
    and ends.
    """

    def write(changed: DataFrame, refresh: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/refresh={refresh}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        step_status(lines)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def latest_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest status of every run in a table written by :func:`keep_status`."""
    refreshes = spark.read.parquet(path)
    return refreshes.groupBy("run_id", "step", "title").agg(
        F.max_by("status", "refresh").alias("status"),
        F.max_by("seconds", "refresh").alias("seconds"),
    )
