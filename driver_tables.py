"""Flights and run logs derived from the driver's tables, for Spark and for DuckDB.

The tables hold no NULLs, so the expressions make some in every column that a rule
reads, and some dates that are none. All measures are quarters of minutes, which makes sums independent of the order of rows. Both derivations work
row by row over the whole table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctuality.schema import FLIGHT_SCHEMA

# Enough flights per origin for both the threshold and the top-k cut to matter.
MIN_FLIGHTS = 200

_FLIGHT_COLUMNS = """
    l_orderkey * 10 + l_linenumber AS flight_id,
    CASE WHEN l_orderkey % 229 = 11 THEN NULL WHEN l_orderkey % 227 = 9 THEN 'bad-date'
         ELSE CAST(CAST(l_shipdate AS DATE) AS {text}) END AS FL_DATE,
    CASE WHEN l_orderkey % 211 <> 3 THEN 'C' || (l_suppkey % 17) END AS OP_UNIQUE_CARRIER,
    CASE WHEN l_orderkey % 223 = 5 THEN NULL WHEN l_partkey % 10 = 0 THEN 'R' || (l_partkey % 400)
         ELSE 'H' || (l_partkey % 15) END AS ORIGIN,
    CASE WHEN l_orderkey % 193 = 2 THEN NULL WHEN l_partkey % 10 = 0 THEN 'Rural ' || (l_partkey % 400)
         ELSE 'Hub ' || (l_partkey % 15) END AS ORIGIN_CITY_NAME,
    CASE WHEN l_orderkey % 197 <> 4 THEN 'D' || (l_suppkey % 40) END AS DEST,
    CASE WHEN l_orderkey % 199 <> 7 THEN CAST(100 + l_partkey % 2400 AS DOUBLE) END AS DISTANCE,
    CASE WHEN l_orderkey % 997 = 1 THEN NULL WHEN l_orderkey % 50 = 0 THEN CAST(1 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS CANCELLED,
    CASE WHEN l_orderkey % 61 <> 0 THEN CAST(l_quantity - 20 + l_partkey % 15 AS DOUBLE) END AS DEP_DELAY,
    CASE WHEN l_orderkey % 53 <> 0 THEN CAST(l_quantity - 25 + month(l_shipdate) + l_partkey % 4 / 4.0 AS DOUBLE) END AS ARR_DELAY,
    CASE WHEN l_quantity >= 30 THEN CAST(l_suppkey % 7 AS DOUBLE) END AS CARRIER_DELAY,
    CASE WHEN l_quantity >= 30 THEN CAST(l_partkey % 5 AS DOUBLE) END AS WEATHER_DELAY,
    CASE WHEN l_quantity >= 30 THEN CAST(l_orderkey % 11 AS DOUBLE) END AS NAS_DELAY,
    CASE WHEN l_quantity >= 30 THEN CAST(l_linenumber % 2 AS DOUBLE) END AS SECURITY_DELAY,
    CASE WHEN l_quantity >= 30 THEN CAST(l_quantity - 20 AS DOUBLE) END AS LATE_AIRCRAFT_DELAY
"""

# One text form per line kind: every class, blank lines, progress bars, a malformed
# time, a phase marker and a timing on one line, and steps outside 1 to 5.
_LOG_LINE = """
    CASE event_id % 16
        WHEN 0 THEN '[PHASE ' || {k} || '] ' || event_type
        WHEN 1 THEN '--> [Time] Step ' || {k} || ' (' || event_type || ') took: ' || {v} || 's'
        WHEN 2 THEN '[ERROR] ' || event_type
        WHEN 3 THEN '--> java.lang.IllegalStateException: ' || event_type
        WHEN 4 THEN '[SUCCESS] Exported ' || event_type
        WHEN 5 THEN CASE {wide} WHEN 1 THEN '[SYSTEM] Pipeline finished (Code: 0)'
            WHEN 2 THEN '[SYSTEM] Pipeline finished (Code: ' || {k} || ')' WHEN 3 THEN '[SYSTEM ERROR] ' || event_type
            ELSE '[DONE] Total: ' || {v} || ' seconds' END
        WHEN 6 THEN '[Task ' || {k} || '] ' || event_type
        WHEN 7 THEN '--> Training rows: ' || {v}
        WHEN 8 THEN '- Impact of [' || event_type || ']: ' || {v} || '%'
        WHEN 9 THEN '--- 3.' || {k} || ': ' || event_type
        WHEN 10 THEN '[Warning] ' || event_type || ' ' || {v}
        WHEN 11 THEN '   '
        WHEN 12 THEN '[Stage ' || {k} || ':====>      (1 + 4) / 9]'
        WHEN 13 THEN '[Stage ' || {k} || '] ' || event_type
        WHEN 14 THEN '[PHASE ' || {k} || '] --> [Time] Step ' || {k} || ' (' || event_type || ') took: 1.2.3s'
        ELSE '--> [Time] Step ' || {wide} || ' (' || event_type || ') took: ' || {v} || 's'
    END
"""


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights table over ``lineitem``."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = _FLIGHT_COLUMNS.format(text="STRING")
    return spark.sql(f"SELECT {columns} FROM {{lineitem}}", lineitem=lineitem)


# A rule that a shallow tree recovers exactly: late from April on, but for one carrier.
_PLANTED_DELAY = """
    CASE WHEN month(try_cast(FL_DATE AS DATE)) >= 4 AND OP_UNIQUE_CARRIER <> 'C3'
         THEN CAST(30 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
"""


def planted_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights with arrival delays by the planted rule."""
    return flights(spark, sf_dir).withColumn("ARR_DELAY", F.expr(_PLANTED_DELAY))


def wide_flights(spark: SparkSession, sf_dir: str, text_delays: bool = False) -> DataFrame:
    """The flights in the 49 columns of the source file; ``text_delays``: some delays are no numbers."""
    table = flights(spark, sf_dir)
    if text_delays:
        delay = F.when(F.col("flight_id") % 97 == 0, "n/a").otherwise(F.col("DEP_DELAY").cast("string"))
        table = table.withColumn("DEP_DELAY", delay)
    known = set(table.columns)
    return table.select(*[
        F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
        for f in StructType.fromDDL(FLIGHT_SCHEMA)
    ])


# A sibling table of the flights: a price for each origin from some day on. Some days have several,
# some prices no day or origin.
_PRICE_COLUMNS = """
    o_orderkey AS quote_id,
    CASE WHEN o_orderkey % 131 = 4 THEN NULL WHEN o_custkey % 10 = 0 THEN 'R' || (o_custkey % 400)
         ELSE 'H' || (o_custkey % 15) END AS AIRPORT,
    CASE WHEN o_orderkey % 137 <> 6 THEN CAST(o_orderdate AS DATE) END AS PRICE_DATE,
    CASE WHEN o_orderkey % 139 <> 8 THEN CAST(o_totalprice AS DOUBLE) END AS PRICE
"""


def fuel_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices over ``orders``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(f"SELECT {_PRICE_COLUMNS} FROM {{orders}}", orders=orders)


def _log_columns(events: DataFrame, *more: str) -> DataFrame:
    line = _LOG_LINE.format(
        k="(event_id div 16 % 5 + 1)", wide="(event_id div 16 % 8)", v="CAST(value AS STRING)"
    )
    return events.selectExpr(
        "'run-' || user_id AS run_id", "event_id AS line_no", f"{line} AS line", *more
    )


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfiltered log lines over ``events``, one run per user."""
    return _log_columns(spark.read.parquet(f"{sf_dir}/events.parquet"))


def log_stream(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """:func:`log_table` as a stream, with further columns of ``events``.

    A file stream takes a folder or a pattern but no single file, and the table may be
    either; the pattern matches that one name.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return _log_columns(spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet"), *more)


FLIGHTS_SQL = "SELECT {} FROM lineitem".format(
    _FLIGHT_COLUMNS.format(text="VARCHAR")
)

PRICES_SQL = f"SELECT {_PRICE_COLUMNS} FROM orders"

PLANTED_SQL = f"SELECT * REPLACE ({_PLANTED_DELAY} AS ARR_DELAY) FROM ({FLIGHTS_SQL})"

LOG_SQL = "SELECT 'run-' || user_id AS run_id, event_id AS line_no, {} AS line FROM events".format(
    _LOG_LINE.format(
        k="(event_id // 16 % 5 + 1)", wide="(event_id // 16 % 8)", v="CAST(value AS VARCHAR)"
    )
)
