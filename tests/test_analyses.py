"""Cleaning and the analyses on the edge rows, and properties on the derived flights."""

import math

import pytest
from pyspark.sql import functions as F

from punctuality.functions import month_name, month_of, nan_to_null, present, whole_number
from punctuality.operators import counts, delays, model
from punctuality.operators.clean import clean, is_flown, prune
from punctuality.plans import rollup as rolled
from punctuality.schema import CAUSES, REQUIRED_COLUMNS


@pytest.fixture(scope="module")
def raw(edge):
    return prune(edge)


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean(raw)


def rows(df):
    return [tuple(r) for r in df.collect()]


ORIGINS = [
    ("FLL", "Fort Lauderdale, FL", 2, 20.5),
    ("MIA", "Miami, FL", 2, 20.0),
    ("DEN", "Denver, CO", 3, 3.0),
    ("DEN", None, 1, -3.0),
]
MONTHS = [(1, 2, 26.0), (12, 1, 18.0), (7, 2, 15.5), (None, 2, 4.5), (10, 1, -8.0)]


def test_clean_keeps_the_right_rows(raw, cleaned):
    assert "CANCELLED" not in cleaned.columns
    kept = [(r.FL_DATE, r.DEP_DELAY) for r in cleaned.collect()]
    assert kept == [
        ("2019-01-05", 10.0), ("2019-01-06", 30.0), ("2019-07-01", 20.0), ("2019-07-02", 21.0),
        ("2019-10-02", -3.0), ("bad-date", 2.0), (None, 3.0), ("2019-12-25", 4.0),
    ]
    assert rows(raw.filter(is_flown(raw)).select("FL_DATE", "DEP_DELAY")) == kept
    assert raw.filter(is_flown(raw).isNull()).count() == 0


def test_present_equals_dropna(raw, edge):
    for df, subset in ((raw, list(REQUIRED_COLUMNS)), (edge, ["DISTANCE", "FL_DATE", "CARRIER_DELAY"])):
        # As text, since NaN differs from itself.
        assert str(rows(df.filter(present(df, *subset)))) == str(rows(df.dropna(subset=subset)))


def test_clean_fills_causes(cleaned):
    values = [v for r in cleaned.select(*CAUSES).collect() for v in r]
    assert not any(v is None or math.isnan(v) for v in values)


def test_clean_types(cleaned):
    types = dict(cleaned.dtypes)
    assert {types[c] for c in ("ARR_DELAY", "DEP_DELAY", "DISTANCE")} == {"float"}


def test_cleaning_again_changes_nothing(cleaned):
    again = clean(cleaned.withColumn("CANCELLED", F.lit(0.0)))
    assert rows(again.select(cleaned.columns)) == rows(cleaned)


def test_stage_counts(raw):
    stages = {"raw": F.lit(True), "clean": is_flown(raw)}
    assert rows(counts.stage_counts(raw, stages)) == [("raw", 14), ("clean", 8)]


def test_delay_causes(raw, cleaned):
    assert rows(delays.delay_causes(cleaned)) == [(38.0, 15.0, 21.0, 15.0, 0.0)]
    assert rows(delays.delay_causes(raw)) == [(38.0, 15.0, 21.0, 15.0, 0.0)]


def test_cause_share(cleaned):
    shares = rows(delays.delay_cause_share(delays.delay_causes(cleaned)))
    assert shares == [
        ("Late Aircraft", 38.0, 42.7), ("Carrier", 15.0, 16.9), ("NAS", 21.0, 23.6),
        ("Weather", 15.0, 16.9), ("Security", 0.0, 0.0),
    ]
    assert abs(sum(s[2] for s in shares) - 100) <= 0.25


def test_texts(spark, cleaned):
    totals = delays.delay_causes(cleaned).withColumn("NAS_Error", F.lit(1234567.9))
    text = delays.delay_causes_text(totals).first()
    assert text.line == "Late Aircraft: 38 | Carrier: 15 | NAS: 1,234,567 | Weather: 15 | Security: 0"
    assert spark.range(1).select(whole_number(F.lit(-1999.9))).first()[0] == "-1,999"
    lines = [r.line for r in delays.origin_delays_text(delays.origin_delays(cleaned)).collect()]
    assert "FLL (Fort Lauderdale, FL): 20.5 min avg delay (2 flights)" in lines
    assert "DEN (None): -3.0 min avg delay (1 flights)" in lines
    months = [r.line for r in delays.monthly_delays_text(delays.monthly_delays(cleaned)).collect()]
    assert months[0] == "Month 1: 26.0 min avg delay (2 flights)"
    assert months[3] == "Month None: 4.5 min avg delay (2 flights)"


def test_origins(cleaned):
    origins = delays.origin_delays(cleaned)
    assert rows(origins.orderBy(*delays.worst_order())) == ORIGINS
    assert rows(delays.top_origin_delays(origins, min_flights=1)) == ORIGINS[:3]
    assert rows(delays.top_origin_delays(origins, min_flights=2)) == [ORIGINS[2]]  # strict
    assert rows(delays.top_origin_delays(origins, k=2, min_flights=0)) == ORIGINS[:2]
    assert rows(delays.worst_origin(origins, min_flights=0)) == ORIGINS[:1]
    assert rows(delays.top_origin_delays(origins)) == []


def test_raw_origins_skip_nan(raw):
    origins = {(r[0], r[1]): r[2:] for r in rows(delays.origin_delays(raw))}
    assert origins[("DEN", "Denver, CO")] == (3, 3.0)
    assert origins[("ATL", "Atlanta, GA")] == (2, 4.5)  # one lacks its arrival delay


def test_ties_follow_the_key(spark):
    flights = spark.createDataFrame(
        [("B", "x", 5.001), ("A", "y", 5.0), ("A", "x", 5.0), ("A", None, 5.0)],
        "ORIGIN string, ORIGIN_CITY_NAME string, DEP_DELAY double",
    )
    top = delays.top_origin_delays(delays.origin_delays(flights), min_flights=0)
    assert [r[:2] for r in rows(top)] == [("A", None), ("A", "x"), ("A", "y"), ("B", "x")]


def test_rounding_is_half_up(spark):
    values = [2.675, 1.005, -0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 2))
    assert [r[0] for r in df.collect()] == [2.68, 1.01, -0.13]


def test_months(cleaned):
    months = delays.monthly_delays(cleaned)
    assert rows(months) == MONTHS
    assert rows(delays.monthly_trend(months)) == [
        (None, None, 4.5), (1, "Jan", 26.0), (7, "Jul", 15.5), (10, "Oct", -8.0), (12, "Dec", 18.0),
    ]


def test_month_of_any_date_type(spark):
    df = spark.sql(
        "SELECT '2019-07-01' AS text, DATE'2019-07-01' AS day, TIMESTAMP'2019-07-01 10:00:00' AS time,"
        " 'July' AS bad"
    )
    assert rows(df.select(*[month_of(c) for c in df.columns])) == [(7, 7, 7, None)]
    names = spark.range(1, 13).selectExpr("CAST(id AS INT) AS m").select(month_name("m"))
    assert [r[0] for r in names.collect()] == (
        "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    )


def test_nan_to_null(spark):
    df = spark.sql("SELECT * FROM VALUES (double('NaN'), 1), (2.0D, NULL) AS t(d, i)")
    assert rows(df.select(nan_to_null(df, "d"), nan_to_null(df, "i"))) == [(None, 1), (2.0, None)]


def test_empty_input(cleaned):
    none = cleaned.filter("false")
    assert rows(delays.delay_causes(none)) == [(None,) * 5]
    share = rows(delays.delay_cause_share(delays.delay_causes(none)))
    assert [s[1:] for s in share] == [(0.0, None)] * 5
    assert rows(delays.monthly_delays(none)) == []
    assert rows(delays.delay_causes_text(delays.delay_causes(none)))[0][0] is None


def test_labels(cleaned):
    labelled = model.with_label(cleaned)
    assert sorted(rows(counts.label_counts(labelled))) == [(0.0, 5), (1.0, 3)]
    late = {r.FL_DATE for r in labelled.filter("IS_DELAYED = 1").collect()}
    assert "2019-07-02" in late and "2019-07-01" not in late  # 16 minutes, 15 minutes


def test_rollup_answers_like_the_operators(raw, cleaned):
    rollup = rolled.delay_rollup(raw)
    part = rolled.cleaned(rollup)
    assert rows(rolled.rollup_counts(rollup)) == [("raw", 14), ("clean", 8)]
    assert rows(rolled.rollup_causes(part)) == rows(delays.delay_causes(cleaned))
    assert rows(rolled.rollup_causes(rollup)) == rows(delays.delay_causes(raw))
    assert rows(rolled.rollup_months(part)) == MONTHS
    assert rows(rolled.rollup_months(rollup)) == rows(delays.monthly_delays(raw))
    by_key = lambda df: rows(df.orderBy(*delays.worst_order()))
    assert by_key(rolled.rollup_origins(part)) == ORIGINS
    assert by_key(rolled.rollup_origins(rollup)) == by_key(delays.origin_delays(raw))
    assert sorted(rows(rolled.rollup_labels(part))) == [(0.0, 5), (1.0, 3)]
    assert rows(rolled.rollup_counts(rollup.filter("false"))) == [("raw", 0), ("clean", 0)]
    assert rows(rolled.rollup_causes(part.filter("false"))) == [(None,) * 5]


ANALYSES = {
    "causes": lambda df: delays.delay_causes(clean(df)),
    "origins": lambda df: delays.top_origin_delays(delays.origin_delays(clean(df)), min_flights=200),
    "months": lambda df: delays.monthly_delays(clean(df)),
    "rollup": lambda df: rolled.rollup_months(rolled.cleaned(rolled.delay_rollup(df))),
}


@pytest.mark.parametrize("name", ANALYSES)
def test_partitioning_does_not_matter(driver_flights, name):
    analysis = ANALYSES[name]
    results = [rows(analysis(df)) for df in (
        driver_flights, driver_flights.repartition(7), driver_flights.repartition(3, "ORIGIN"),
    )]
    assert results[0] and results[0] == results[1] == results[2]


def test_counts_add_up(driver_flights):
    cleaned = clean(driver_flights)
    n = cleaned.count()
    assert n < driver_flights.count()
    assert sum(r.Total_Flights for r in delays.monthly_delays(cleaned).collect()) == n
    assert sum(r.Total_Flights for r in delays.origin_delays(cleaned).collect()) == n


def test_other_column_names(spark):
    df = spark.createDataFrame(
        [("a", "2024-02-01", 3.0, 1.0), ("a", "2024-02-02", 5.0, 2.0), ("b", None, 1.0, None)],
        "line string, day string, late double, crew double",
    )
    assert sorted(rows(delays.origin_delays(df, keys=["line"], delay="late"))) == [("a", 2, 4.0), ("b", 1, 1.0)]
    assert rows(delays.monthly_delays(df, date="day", delay="late")) == [(2, 2, 4.0), (None, 1, 1.0)]
    assert rows(delays.delay_causes(df, {"crew": "Crew"})) == [(3.0,)]
