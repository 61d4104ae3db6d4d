"""Run-log files."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.operators.run_log import log_lines

# The run id is the file name without its last extension.
FILE_STEM = r"^(.*?)(\.[^./]*)?$"


def run_id_of(file_name: str) -> F.Column:
    return F.regexp_extract(file_name, FILE_STEM, 1)


def run_id_under(root: str) -> F.Column:
    """The path of a file below ``root``, without its last extension."""
    fixed = re.split(r"/?[^/]*[*?\[{]", root.split(":", 1)[-1].rstrip("/"), maxsplit=1)[0]
    mark = "/" + fixed.removeprefix("./").strip("/") + "/"
    path = F.col("_metadata.file_path")
    at = F.locate(mark, path)
    below = F.when(at > 0, F.substring(path, at + len(mark), F.length(path)))
    return F.regexp_extract(F.coalesce(below, "_metadata.file_name"), FILE_STEM, 1)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Read log files, one per run, as ``(run_id, line_no, line)``.

    A run is named by its path below ``path``, so files of one name in several folders
    are several runs.

    ``line_no`` grows along each file but has gaps: it numbers rows by scan
    partition, and Spark assigns the splits of a file to partitions in order.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        run_id_under(path).alias("run_id"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )
    return log_lines(lines)
