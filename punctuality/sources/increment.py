"""Landing what is new, again and again, and keeping the rollup in step.

A source folder holds units: files, or folders of files, one for a year or a month. A landing lists the
folder, leaves out the units that the manifest has in the same version, and writes the others as one
generation of Parquet; the manifest is written last. Names of generations follow from their content and
all writes replace whole partitions, so a landing that is repeated, or that broke off anywhere, leads to
the same table. A unit whose files have changed is landed anew. Its earlier rows stay in place but
no longer count, as readers go by the manifest: a row belongs to the table if its unit's newest
generation is its own. The rollup is kept as one delta per unit and generation, read the same way, so a
restated unit takes its old sums back without another look at the old rows.
"""

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctuality.functions import year_of
from punctuality.plans.rollup import delay_rollup
from punctuality.schema import ORIGIN_KEYS
from punctuality.sources.flights import read_flights

MANIFEST = "unit STRING, version STRING, files BIGINT, bytes BIGINT, step INT, generation STRING"
ROLLUP_KEYS = (*ORIGIN_KEYS, "Flight_Month", "is_clean")

# Fixed value: up to so many units are read one by one, so that no row looks at the path of its file.
READ_APART = 8
# Tasks that each core gets in a landing, and bounds of the bytes of one.
TASKS_PER_CORE = 4
LEAST_TASK_BYTES, MOST_TASK_BYTES = 4 << 20, 64 << 20
# What a file's split and a rebalanced partition may hold.
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def _below(folder: str, path: Column) -> Column:
    """The first part of a path below ``folder``. URLs write the same path with one or three slashes."""
    mark = "/" + folder.split(":", 1)[-1].strip("/") + "/"
    return F.substring_index(F.substring(path, F.locate(mark, path) + len(mark), F.length(path)), "/", 1)


def list_units(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``unit, version, files, bytes, paths`` of what lies in ``folder``; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = reader.load(folder).select(
        _below(folder, F.col("_metadata.file_path")).alias("unit"), "path", "length", F.unix_micros("modificationTime").alias("modified")
    )
    listed = F.sort_array(F.collect_list(F.struct("path", "length", "modified")))
    units = files.groupBy("unit").agg(listed.alias("listed"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return units.select("unit", F.sha2(F.to_json("listed"), 256).alias("version"), "files", "bytes", F.col("listed")["path"].alias("paths"))


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """Every version of every unit that was landed; empty before the first landing."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{target}/manifest")
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(MANIFEST)])


def newest(manifest: DataFrame) -> DataFrame:
    """``unit, generation``: the one that counts for each unit."""
    return manifest.groupBy("unit").agg(F.max_by("generation", "step").alias("generation"))


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write whole partitions; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


@contextmanager
def enough_tasks(spark: SparkSession, size: int) -> Iterator[None]:
    """While this lasts, ``size`` bytes are cut so that every core gets several tasks.

    Spark joins partitions of a rebalance up to one size, however many cores wait; a few tasks of a few
    years each then write the whole landing. Sizes that the session names itself hold.
    """
    cores = spark.sparkContext.defaultParallelism
    share = min(MOST_TASK_BYTES, max(LEAST_TASK_BYTES, size // (TASKS_PER_CORE * cores)))
    unset = [name for name in TASK_SIZES if spark.conf.get(name, None) is None]
    for name in unset:
        spark.conf.set(name, share)
    try:
        yield
    finally:
        for name in unset:
            spark.conf.unset(name)


def _rows_of(
    spark: SparkSession, folder: str, new: list[Row], read: Callable[[SparkSession, list[str]], DataFrame]
) -> DataFrame:
    """The rows of these units with ``unit``, which is text worked out for every row only where units are many."""
    if len(new) <= READ_APART:
        parts = [read(spark, r.paths).select("*", F.lit(r.unit).alias("unit")) for r in new]
        # Types that a reader takes from the files may differ by unit; all units together give the common ones.
        if all(part.schema == parts[0].schema for part in parts):
            return reduce(DataFrame.union, parts)
    rows = read(spark, [path for r in new for path in r.paths])
    return rows.select("*", _below(folder, F.col("_metadata.file_path")).alias("unit"))


def land_new(
    spark: SparkSession,
    folder: str,
    target: str,
    pattern: str = "*.csv",
    read: Callable[[SparkSession, list[str]], DataFrame] = read_flights,
    date: str = "FL_DATE",
) -> int:
    """Land the units of ``folder`` that are new or have changed; give their number.

    The names of new units and their files go through the driver, as any read of files needs them.
    Both the rows and their share of the rollup are written; the rollup comes from the landed Parquet.
    """
    known = read_manifest(spark, target)
    step = (known.agg(F.max("step")).first()[0] or 0) + 1
    current = known.join(newest(known), ["unit", "generation"], "left_semi")
    new = list_units(spark, folder, pattern).join(current, ["unit", "version"], "left_anti").orderBy("unit").collect()
    if not new:
        return 0
    content = "\n".join(f"{r.unit} {r.version}" for r in new)
    generation = f"{step:06d}-{hashlib.sha256(content.encode()).hexdigest()[:16]}"
    rows = _rows_of(spark, folder, new, read)
    rows = rows.withColumn("FL_YEAR", year_of(date)).hint("rebalance", "FL_YEAR")
    with enough_tasks(spark, sum(r.bytes for r in new)):
        # The generation's own folder, so that no row carries its name through the shuffle.
        _replace(rows, f"{target}/data/generation={generation}", "FL_YEAR")
    landed = spark.read.parquet(f"{target}/data").filter(F.col("generation") == generation)
    delta = delay_rollup(landed, refine={"unit": F.col("unit")}).withColumn("generation", F.lit(generation))
    _replace(delta, f"{target}/rollup", "generation")
    entries = [(r.unit, r.version, r.files, r.bytes, step, generation) for r in new]
    _replace(spark.createDataFrame(entries, MANIFEST).coalesce(1), f"{target}/manifest", "generation")
    return len(new)


def _counting(rows: DataFrame, spark: SparkSession, target: str) -> DataFrame:
    """The rows of the newest generation of their unit."""
    return rows.join(newest(read_manifest(spark, target)), ["unit", "generation"], "left_semi")


def read_increments(spark: SparkSession, target: str) -> DataFrame:
    """The table as landed so far, in the columns of the source and ``FL_YEAR``."""
    return _counting(spark.read.parquet(f"{target}/data"), spark, target).drop("unit", "generation")


def read_rollup(spark: SparkSession, target: str) -> DataFrame:
    """The rollup of the table as landed so far, merged from the deltas."""
    deltas = _counting(spark.read.parquet(f"{target}/rollup"), spark, target)
    measures = [c for c in deltas.columns if c not in (*ROLLUP_KEYS, "unit", "generation")]
    return deltas.groupBy(*ROLLUP_KEYS).agg(*[F.sum(c).alias(c) for c in measures])
