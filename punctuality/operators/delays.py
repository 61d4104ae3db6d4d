"""The standing questions: minutes by cause, worst origins, delay by month.

They take any flights table, raw or cleaned. NaN counts as missing throughout.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions import as_numbers, month_name, month_of, nan_to_null, present, whole_number
from punctuality.schema import CAUSE_LABELS, CAUSES, MIN_FLIGHTS, ORIGIN_KEYS, TOP_K

DEP_AVERAGE = "Avg_Dep_Delay_Minutes"
ARR_AVERAGE = "Avg_Arr_Delay_Minutes"


# --- minutes by cause -------------------------------------------------------------


def delay_causes(df: DataFrame, causes: Mapping[str, str] = CAUSES) -> DataFrame:
    """Total minutes per cause, in one row. Over no rows the totals are NULL."""
    df = as_numbers(df, *causes)
    return df.select(*[F.sum(nan_to_null(df, c)).alias(name) for c, name in causes.items()])


def delay_cause_share(totals: DataFrame, labels: Mapping[str, str] = CAUSE_LABELS) -> DataFrame:
    """Long form of :func:`delay_causes`: ``(cause, minutes, pct)``, pct to one decimal.

    The grand total is taken within the one row before it is unpivoted, so the
    shares need neither a join nor a window.
    """
    filled = totals.select(*[F.coalesce(F.col(n), F.lit(0.0)).alias(t) for n, t in labels.items()])
    total = sum((F.col(t) for t in labels.values()), F.lit(0.0))
    return (
        filled.withColumn("total", total)
        .unpivot("total", list(labels.values()), "cause", "minutes")
        .select("cause", "minutes", F.round(100 * F.try_divide("minutes", "total"), 1).alias("pct"))
    )


def delay_causes_text(totals: DataFrame, labels: Mapping[str, str] = CAUSE_LABELS) -> DataFrame:
    """The totals as whole minutes with thousands separators, and as one report line."""
    texts = totals.select(*[whole_number(F.col(name)).alias(name) for name in labels])
    parts = [F.concat(F.lit(f"{label}: "), F.col(name)) for name, label in labels.items()]
    return texts.withColumn("line", F.concat_ws(" | ", *parts))


# --- origins ------------------------------------------------------------------------


def origin_delays(
    df: DataFrame, keys: Sequence[str] = ORIGIN_KEYS, delay: str = "DEP_DELAY"
) -> DataFrame:
    """Flights and average departure delay per origin."""
    df = as_numbers(df, delay)
    return (
        df.filter(present(df, delay))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("Total_Flights"),
            F.round(F.avg(delay), 2).alias(DEP_AVERAGE),
        )
    )


def worst_order(keys: Sequence[str] = ORIGIN_KEYS) -> list[Column]:
    """Highest (rounded) average first, then by key: a total order."""
    return [F.desc(DEP_AVERAGE), *[F.asc(key) for key in keys]]


def top_origin_delays(
    origins: DataFrame,
    k: int = TOP_K,
    min_flights: int = MIN_FLIGHTS,
    keys: Sequence[str] = ORIGIN_KEYS,
) -> DataFrame:
    """The ``k`` worst of :func:`origin_delays` among those with more than ``min_flights``."""
    busy = origins.filter(F.col("Total_Flights") > min_flights)
    return busy.orderBy(*worst_order(keys)).limit(k)


def worst_origin(origins: DataFrame, **options) -> DataFrame:
    """The single worst origin, under the same rules as :func:`top_origin_delays`."""
    return top_origin_delays(origins, k=1, **options)


def origin_delays_text(origins: DataFrame) -> DataFrame:
    """One report line per origin."""
    line = F.concat(
        F.col("ORIGIN"), F.lit(" ("), F.coalesce("ORIGIN_CITY_NAME", F.lit("None")), F.lit("): "),
        F.col(DEP_AVERAGE).cast("string"), F.lit(" min avg delay ("),
        whole_number(F.col("Total_Flights")), F.lit(" flights)"),
    )
    return origins.select("ORIGIN", "ORIGIN_CITY_NAME", line.alias("line"))


# --- months ---------------------------------------------------------------------------


def monthly_delays(df: DataFrame, date: str = "FL_DATE", delay: str = "ARR_DELAY") -> DataFrame:
    """Flights and average arrival delay per month, worst first. No date: month NULL."""
    df = as_numbers(df, delay)
    months = (
        df.filter(present(df, delay))
        .withColumn("Flight_Month", month_of(date))
        .groupBy("Flight_Month")
        .agg(
            F.count(F.lit(1)).alias("Total_Flights"),
            F.round(F.avg(delay), 2).alias(ARR_AVERAGE),
        )
    )
    return worst_months(months)


def worst_months(months: DataFrame) -> DataFrame:
    """Order months by descending average, then by month."""
    return months.orderBy(F.desc(ARR_AVERAGE), F.asc("Flight_Month"))


def monthly_trend(months: DataFrame) -> DataFrame:
    """:func:`monthly_delays` in calendar order with month names; unknown month first."""
    return months.select(
        "Flight_Month", month_name("Flight_Month").alias("Month_Name"), ARR_AVERAGE
    ).orderBy("Flight_Month")


def monthly_delays_text(months: DataFrame) -> DataFrame:
    """One report line per month."""
    line = F.concat(
        F.lit("Month "), F.coalesce(F.col("Flight_Month").cast("string"), F.lit("None")),
        F.lit(": "), F.col(ARR_AVERAGE).cast("string"), F.lit(" min avg delay ("),
        whole_number(F.col("Total_Flights")), F.lit(" flights)"),
    )
    return months.select("Flight_Month", line.alias("line"))
