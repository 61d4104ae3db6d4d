"""One scan for all standing questions.

The rollup keeps counts and sums per origin, month and cleaning verdict. It is small
(airports x 13 months x 2), so every analysis, raw or cleaned, is then answered from
it without reading the flights again. Partial aggregation in the scan stage means that
a hot origin sends one row per task and group to the shuffle, like any other.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions import month_of, nan_to_null
from punctuality.operators.clean import is_flown
from punctuality.operators.delays import ARR_AVERAGE, DEP_AVERAGE, worst_months
from punctuality.schema import CAUSES, FLOAT_MEASURES, LATE_MINUTES, ORIGIN_KEYS


def delay_rollup(
    raw: DataFrame,
    origin_keys: Sequence[str] = ORIGIN_KEYS,
    causes: Mapping[str, str] = CAUSES,
    late_minutes: float = LATE_MINUTES,
    refine: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Counts and sums of a raw flights table by origin, month and ``is_clean``.

    Clean rows count with the values that cleaning gives them: missing cause minutes are
    0, and measures have the width of a float.
    ``refine`` adds grouping columns. All answers below are sums over groups, so they
    come out the same from a refined rollup.
    """
    refine = refine or {}
    filler = F.when(F.col("is_clean"), F.lit(0.0))

    def minutes(name: str) -> Column:
        value = nan_to_null(raw, name).cast("double")
        if name not in FLOAT_MEASURES:
            return value
        return F.when(F.col("is_clean"), value.cast("float").cast("double")).otherwise(value)

    dep, arr = minutes("DEP_DELAY"), minutes("ARR_DELAY")
    return (
        raw.withColumns({"Flight_Month": month_of("FL_DATE"), "is_clean": is_flown(raw), **refine})
        .groupBy(*origin_keys, "Flight_Month", "is_clean", *refine)
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.count(dep).alias("dep_flights"),
            F.sum(dep).alias("dep_minutes"),
            F.count(arr).alias("arr_flights"),
            F.sum(arr).alias("arr_minutes"),
            F.count_if(arr > late_minutes).alias("late_flights"),
            *[
                F.sum(F.coalesce(minutes(c), filler)).alias(name)
                for c, name in causes.items()
            ],
        )
    )


def cleaned(rollup: DataFrame) -> DataFrame:
    """The part of the rollup that stands for the cleaned table."""
    return rollup.filter("is_clean")


def rollup_counts(rollup: DataFrame) -> DataFrame:
    """Rows before and after cleaning, as ``(stage, n)``."""
    return rollup.select(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("is_clean"), F.col("flights"))), F.lit(0)).alias("clean"),
    ).unpivot([], ["raw", "clean"], "stage", "n")


def rollup_causes(rollup: DataFrame, causes: Mapping[str, str] = CAUSES) -> DataFrame:
    """``delay_causes`` from the rollup."""
    return rollup.select(*[F.sum(name).alias(name) for name in causes.values()])


def rollup_origins(rollup: DataFrame, keys: Sequence[str] = ORIGIN_KEYS) -> DataFrame:
    """``origin_delays`` from the rollup."""
    return (
        rollup.filter("dep_flights > 0")
        .groupBy(*keys)
        .agg(
            F.sum("dep_flights").alias("Total_Flights"),
            F.round(F.sum("dep_minutes") / F.sum("dep_flights"), 2).alias(DEP_AVERAGE),
        )
    )


def rollup_months(rollup: DataFrame) -> DataFrame:
    """``monthly_delays`` from the rollup."""
    months = (
        rollup.filter("arr_flights > 0")
        .groupBy("Flight_Month")
        .agg(
            F.sum("arr_flights").alias("Total_Flights"),
            F.round(F.sum("arr_minutes") / F.sum("arr_flights"), 2).alias(ARR_AVERAGE),
        )
    )
    return worst_months(months)


def rollup_labels(rollup: DataFrame) -> DataFrame:
    """``label_counts`` from the rollup, as ``(IS_DELAYED, n)``."""
    return (
        rollup.select(
            F.sum("late_flights").alias("late"),
            (F.sum("arr_flights") - F.sum("late_flights")).alias("not_late"),
        )
        .unpivot([], ["late", "not_late"], "side", "n")
        .filter("n > 0")
        .select(F.when(F.col("side") == "late", 1.0).otherwise(0.0).alias("IS_DELAYED"), "n")
    )
