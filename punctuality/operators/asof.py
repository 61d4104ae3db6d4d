"""As-of join: each record with the latest state of a sibling table at its time.

A sibling table (weather, prices) has a state per key from some moment on. Many records share a
moment, so only distinct moments and states are put in order, not the records: both are pre-aggregated
by task, united, and the latest state is carried forward within each key and slice of time. What a
slice begins with comes from a table with one row per key and slice. So a key that holds much of the
records is spread over its slices, and a moment that holds much of them is one row. The records then
take the state of their key and moment by an equi-join, which Spark splits at run time where skewed.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from punctuality.plans.durable import durable

DAY = 86_400


def _ticks(df: DataFrame, time: str) -> Column:
    """Seconds of a date or timestamp, or the number itself."""
    kind = df.schema[time].dataType
    if isinstance(kind, DateType):
        return F.unix_date(time).cast("double") * DAY
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    if isinstance(kind, TimestampType):
        return F.unix_micros(time) / 1e6
    if isinstance(kind, NumericType):
        return F.col(time).cast("double")
    raise TypeError(f"{time} is no date, timestamp or number")


def as_of_join(
    records: DataFrame,
    states: DataFrame,
    by: Sequence[str],
    time: str,
    state_time: str,
    values: Mapping[str, str] | Sequence[str],
    order: Sequence[str] = (),
    exact: bool = True,
    tolerance: float | None = None,
    slice_width: float = 30 * DAY,
) -> DataFrame:
    """``records`` with ``values`` of the state that holds at ``time`` for their key ``by``.

    ``values`` names columns of ``states``, as a mapping with the names they get. The state with the
    greatest ``state_time`` up to ``time`` holds (before it, unless ``exact``); of several at one
    moment, the one that is last by ``order``, then by its values. ``tolerance`` is the greatest age
    of a state, in seconds, or in units of a numeric time; an older one does not hold. Records whose
    key or time is NULL, or that no state is found for, keep NULLs. All records stay, once each.
    """
    if not isinstance(values, Mapping):
        values = {name: name for name in values}
    if clash := set(values.values()) & set(records.columns):
        raise ValueError(f"columns of both tables have the names {sorted(clash)}")
    if records.schema[time].dataType != states.schema[state_time].dataType:
        raise TypeError(f"{time} and {state_time} differ in type")
    keys = [f"_key{i}" for i in range(len(by))]

    def keyed(df: DataFrame, moment: str, *columns: Column) -> DataFrame:
        named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
        rows = df.select(*named, F.col(moment).alias("_time"), _ticks(df, moment).alias("_ticks"), *columns)
        return rows.dropna(subset=[*keys, "_time"])

    place = ["_ticks", "_time"]
    state = F.struct(F.col(state_time).alias("at"), *[F.col(c).alias(n) for c, n in values.items()]).alias("_state")
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in values]).alias("_rank")
    known = keyed(states, state_time, state, rank).groupBy(*keys, *place).agg(F.max_by("_state", "_rank").alias("_state"))
    asked = keyed(records, time).distinct().withColumn("_state", F.lit(None).cast(known.schema["_state"].dataType))
    # A state comes before the records of its moment if it holds for them, after them if not.
    known = known.withColumn("_asked", F.lit(0 if exact else 2))
    both = known.unionByName(asked.withColumn("_asked", F.lit(1)))
    both = durable(both.withColumn("_slice", F.floor(F.col("_ticks") / slice_width)))
    position = F.struct("_ticks", "_time", "_asked")
    ends = both.groupBy(*keys, "_slice").agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), position)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    sofar = Window.partitionBy(*keys, "_slice").orderBy(*place, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_held", F.last("_state", ignorenulls=True).over(sofar)).filter("_asked = 1")
    held = held.join(ends, [*keys, "_slice"]).withColumn("_held", F.coalesce("_held", "_carry"))
    if tolerance is not None:
        found = held.select("*", F.col("_held.at").alias("_at"))
        held = found.filter(F.col("_ticks") - _ticks(found, "_at") <= tolerance)
    held = held.select(*keys, "_time", *[F.col(f"_held.{n}").alias(n) for n in values.values()])
    same = [records[c] == held[k] for c, k in zip(by, keys, strict=True)]
    return records.join(held, [*same, records[time] == held["_time"]], "left").drop(*keys, "_time")
