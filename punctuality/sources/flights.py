"""Flights tables: CSV in, Parquet landed."""

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from punctuality.functions import year_of
from punctuality.schema import FLIGHT_SCHEMA

log = logging.getLogger(__name__)


def read_flights(
    spark: SparkSession,
    path: str | Sequence[str],
    infer: bool = False,
    schema: str | StructType = FLIGHT_SCHEMA,
) -> DataFrame:
    """Read flights CSV with a header, from any path that Hadoop can reach.

    The explicit schema saves a pass over the files, and a header that does not
    match it fails the read instead of filling the wrong columns. ``infer`` takes
    names and types from the files at the price of that pass.
    """
    paths = path if isinstance(path, str) else list(path)
    if infer:
        return spark.read.csv(paths, header=True, inferSchema=True)
    return spark.read.csv(paths, header=True, schema=schema, enforceSchema=False)


def read_first_available(
    spark: SparkSession, paths: Sequence[str], **options
) -> tuple[DataFrame, str]:
    """Read the first path that yields a readable table; return it with its path.

    A path fails if it cannot be opened or its first row cannot be read with all its
    columns, so that a wrong header counts as a failure. Each failure is logged with its cause, and the
    last one is raised if no path is left.
    """
    if not paths:
        raise ValueError("no path given")
    context = spark.sparkContext._jsc.sc()
    for position, path in enumerate(paths, 1):
        try:
            df = read_flights(spark, path, **options)
            df.head(1)
        except (PySparkException, Py4JJavaError) as cause:
            # What reading raises; a lost session is no reason to try the next path.
            if position == len(paths) or context.isStopped():
                raise
            log.warning("cannot read %s: %s", path, cause)
        else:
            return df, path


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def land(
    df: DataFrame,
    path: str,
    date: str = "FL_DATE",
    mode: str = "errorifexists",
    rebalance: bool = True,
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    cluster: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> None:
    """Write a flights table as Parquet by year (``FL_YEAR``; unreadable dates apart).

    The rebalance hint sends the rows of a year together and lets AQE cut large
    years and join small ones, so files have an even size whatever the input order,
    and no task writes a whole hot year. It shuffles the table; files that already
    come in order of date can do without, as their tasks meet one or two years each.
    ``then`` is applied last, within the stage that writes.

    ``cluster`` sorts each file by these columns, so that a filter on the first skips most row groups by
    their bounds, and adds Bloom filters, by which a filter on any of them skips row groups that lack
    the value. Smaller row groups (``row_group_bytes``) are skipped more sharply. The sort is of one
    task's rows, which the writer sorts by year anyway.
    """
    dated = df.withColumn("FL_YEAR", year_of(date))
    if rebalance:
        dated = dated.hint("rebalance", "FL_YEAR")
    if cluster:
        dated = dated.sortWithinPartitions("FL_YEAR", *cluster)
    writer = then(dated).write.mode(mode).partitionBy("FL_YEAR")
    for name in cluster:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def read_landed(spark: SparkSession, *paths: str) -> DataFrame:
    """Read all tables written by :func:`land` under ``paths`` as one."""
    return spark.read.parquet(*paths)
