"""The status of running jobs, kept in bounded space.

The stream itself holds no state. A refresh folds its new lines to one row of positions per run and
merges them with the rows of the runs that are still open, which the refresh before has left. A run
that has ended, or has been silent for long, expires once event time has passed it by: its row is
written a last time and is not carried on. So a refresh costs what is new and what is open, however many
runs there were. Positions merge by their maxima, so a line that comes after its run has expired still
counts when the table is read, and rows that are there twice do no harm.

Refresh n writes ``refresh=n``, with ``state=open`` and ``state=ended``, in one job from ``refresh=n-1``
and its batch: replayed after a failure, it writes the same. From time to time the ended rows of older
refreshes are gathered in one folder ``upto=m``, and what it stands for is removed.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from punctuality.operators.run_log import ends_run, log_lines, merge_positions, run_positions, status_of_runs
from punctuality.plans.durable import durable
from punctuality.streaming.live_log import RUN_FOLDER

OPEN, ENDED = "open", "ended"
KEPT = 2  # refreshes before the last one that a failure or a reader may still need


def follow_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream ``(run_id, line_no, line, arrived)`` from files as they appear, line by line.

    A file is ``<directory>/<run_id>/<name>`` and may be of any size, as it is read in splits.
    ``line_no`` orders by arrival, file name and split; :func:`keep_open_runs` goes by the order of
    rows within a split.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrived = F.col("_metadata.file_modification_time")
    lines = reader.text(f"{directory}/*").select(
        F.regexp_extract("_metadata.file_path", RUN_FOLDER, 1).alias("run_id"),
        F.struct(
            arrived.alias("arrived"), F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
        ).alias("line_no"),
        F.col("value").alias("line"), arrived.alias("arrived"),
    )
    return log_lines(lines)


def keep_open_runs(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "arrived",
    linger: float = 600,
    silence: float = 86_400,
    gather_every: int = 50,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the positions of the runs of a line stream below ``path``.

    ``time`` is a line's event time, a timestamp. A run expires ``linger`` seconds after its last line
    if one of its lines has ended it, or else after ``silence`` seconds; what counts is the latest time
    of the batch and the open runs. Without ``every`` the query takes in what has arrived and ends.
    """
    ended, seen = F.max(F.when(ends_run(), F.col("line_no"))).alias("ended"), F.max(time).alias("seen")

    def refresh(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        # Lines of one split keep their order: this number ascends within a task, and a task reads a split in order.
        batch = batch.withColumn("line_no", F.struct("line_no", F.monotonically_increasing_id().alias("row")))
        fresh = run_positions(batch, ended, seen)
        before = _refresh(spark, path, n - 1, fresh.schema).filter(F.col("state") == OPEN).drop("state")
        runs = durable(merge_positions(fresh.unionByName(before), F.max("ended").alias("ended"), F.max("seen").alias("seen")))
        now = runs.agg(F.unix_micros(F.max("seen"))).first()[0]
        rows = runs.withColumn("state", F.when(_expired(now, linger, silence), ENDED).otherwise(OPEN))
        rows.write.mode("overwrite").partitionBy("state").parquet(f"{path}/refresh={n}")
        last = n - KEPT
        if n % gather_every == 0 and last >= 0:
            gather(spark, path, last, fresh.schema)
        elif last >= 0:
            _remove(spark, f"{path}/refresh={last}/state={OPEN}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    stream = lines.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return stream.trigger(**trigger).foreachBatch(refresh).start()


def _expired(now: int | None, linger: float, silence: float) -> Column:
    age = (F.lit(now) - F.unix_micros("seen")) / 1e6
    return F.coalesce((age > silence) | (F.col("ended").isNotNull() & (age > linger)), F.lit(False))


def _refresh(spark: SparkSession, path: str, n: int, schema: StructType) -> DataFrame:
    """The rows that a refresh has left; none before the first."""
    return _read(spark, f"{path}/refresh={n}", StructType([*schema.fields, StructField("state", StringType())]))


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the finished folders ``<name>=<number>`` below ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def gather(spark: SparkSession, path: str, last: int, schema: StructType) -> None:
    """Gather the ended rows of the refreshes up to ``last`` in one folder and remove what it stands for.

    The folder is complete before anything is removed, and is not written again if it is there.
    """
    done, refreshes = _folders(spark, path, "upto"), _folders(spark, path, "refresh")
    if last not in done:
        parts = [_read(spark, f"{path}/upto={m}", schema) for m in done if m < last]
        parts += [_refresh(spark, path, m, schema).filter(F.col("state") == ENDED).drop("state") for m in refreshes if m <= last]
        rows = spark.createDataFrame([], schema)
        for part in parts:
            rows = rows.unionByName(part)
        merged = merge_positions(rows, F.max("ended").alias("ended"), F.max("seen").alias("seen"))
        merged.write.mode("overwrite").parquet(f"{path}/upto={last}")
    for m in refreshes:
        if m <= last:
            _remove(spark, f"{path}/refresh={m}")
    for m in done:
        if m < last:
            _remove(spark, f"{path}/upto={m}")


def run_rows(spark: SparkSession, path: str) -> DataFrame:
    """The positions of all runs of a table of :func:`keep_open_runs`, as one row each."""
    refreshes, gathered = _folders(spark, path, "refresh"), _folders(spark, path, "upto")
    latest = refreshes[-1]
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/refresh={n}" for n in refreshes])
    rows = rows.filter((F.col("state") == ENDED) | (F.col("refresh") == latest)).drop("refresh", "state")
    if gathered:
        rows = rows.unionByName(spark.read.parquet(*[f"{path}/upto={m}" for m in gathered]).select(*rows.columns))
    return merge_positions(rows, F.max("ended").alias("ended"), F.max("seen").alias("seen"))


def open_run_status(spark: SparkSession, path: str) -> DataFrame:
    """The step status of every run of a table of :func:`keep_open_runs`."""
    return status_of_runs(run_rows(spark, path))
