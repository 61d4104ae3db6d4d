"""Records that cannot be read under the explicit schema.

Under a schema alone, a bad number becomes NULL in silence. Here the reader marks such a record, and
one pass over the files lands good and bad records side by side, so that nothing is parsed twice.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from punctuality.schema import FLIGHT_SCHEMA

RECORD = "_corrupt_record"
GOOD, BAD = "good", "rejected"


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_marked(
    spark: SparkSession, path: str | Sequence[str], schema: str | StructType = FLIGHT_SCHEMA
) -> DataFrame:
    """Flights CSV with the text of each record that does not fit the schema in ``_corrupt_record``.

    A record is bad if a value cannot be read as its type or the number of values differs from the
    header's. All columns are parsed, as a value may be bad in a column that nobody asks for. A header
    that does not match the schema fails the read.
    """
    marked = StructType([*_schema(schema).fields, StructField(RECORD, StringType())])
    paths = path if isinstance(path, str) else list(path)
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "enforceSchema": False}
    rows = spark.read.options(**options).schema(marked).csv(paths)
    # Names every column, so that the reader prunes none and sees each bad value.
    return rows.select("*", F.col("_metadata.file_name").alias("file"))


def land_checked(marked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write good and bad records of :func:`read_marked` below ``path``, in one pass."""
    state = F.when(F.col(RECORD).isNull(), GOOD).otherwise(BAD)
    marked.withColumn("state", state).write.mode(mode).partitionBy("state").parquet(path)


def read_good(spark: SparkSession, path: str) -> DataFrame:
    """The records that :func:`land_checked` found good, in the columns of the source file."""
    rows = spark.read.parquet(path).filter(F.col("state") == GOOD)
    return rows.drop(RECORD, "file", "state")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``file, record``: the others, as they stand in their file."""
    rows = spark.read.parquet(path).filter(F.col("state") == BAD)
    return rows.select("file", F.col(RECORD).alias("record"))


def reject_values(rejects: DataFrame, schema: str | StructType = FLIGHT_SCHEMA) -> DataFrame:
    """The values of rejected records as text, by the names of the source file, with ``file, n_values``.

    Values that a short record lacks are NULL; ``n_values`` counts those it has, up to one too many.
    """
    names = _schema(schema).fieldNames()
    texts = StructType([StructField(n, StringType()) for n in (*names, "_more")])
    options = {"mode": "PERMISSIVE"}
    parsed = rejects.select("file", "record", F.from_csv("record", texts.simpleString()[7:-1].replace(":", " "), options).alias("v"))
    # Text of a record without its quoted parts, in which a comma separates nothing.
    bare = F.regexp_replace("record", '"[^"]*"', "")
    n_values = F.least(F.size(F.split(bare, ",")), F.lit(len(names) + 1))
    return parsed.select("file", n_values.alias("n_values"), *[F.col(f"v.`{n}`").alias(n) for n in names])
