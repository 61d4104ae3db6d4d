import json
import os

import pytest
from edge_data import EDGE_CSV, SCHEMA_NAMES, full_width
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegerType, StringType

from punctuality.operators import delays
from punctuality.operators.clean import clean, prune
from punctuality.schema import NEEDED_COLUMNS
from punctuality.sources.flights import (
    land, preview, read_first_available, read_flights, read_landed,
)


def test_explicit_schema(edge):
    kinds = [type(f.dataType) for f in edge.schema]
    assert edge.columns == SCHEMA_NAMES and len(SCHEMA_NAMES) == 49
    assert [kinds.count(t) for t in (IntegerType, FloatType, StringType)] == [14, 21, 14]
    assert edge.count() == 14
    assert edge.filter("ORIGIN_CITY_NAME = 'Fort Lauderdale, FL'").count() == 4
    assert edge.filter("isnan(CARRIER_DELAY)").count() == 1


def test_inferred_schema(spark, tmp_path):
    path = tmp_path / "kept.csv"
    path.write_text(EDGE_CSV)
    types = {f.name: type(f.dataType) for f in read_flights(spark, str(path), infer=True).schema}
    assert types["FL_DATE"] is StringType  # one value is no date
    assert types["DEP_DELAY"] is types["CARRIER_DELAY"] is DoubleType
    path.write_text("\n".join(EDGE_CSV.splitlines()[:5]))
    dated = read_flights(spark, str(path), infer=True)
    assert isinstance(dated.schema["FL_DATE"].dataType, DateType)
    months = delays.monthly_delays(clean(dated))
    assert [tuple(r) for r in months.collect()] == [(1, 2, 26.0), (7, 2, 15.5)]


def test_swapped_header_is_refused(spark, tmp_path):
    names = list(SCHEMA_NAMES)
    i, j = names.index("DEP_DELAY"), names.index("ARR_DELAY")
    names[i], names[j] = names[j], names[i]
    path = tmp_path / "swapped.csv"
    path.write_text(full_width(names=names))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_flights(spark, str(path)).collect()


def test_malformed_fields(spark, tmp_path):
    header = ",".join(SCHEMA_NAMES)
    path = tmp_path / "rows.csv"
    path.write_text(f"{header}\n7.0,2019-01-01\n7,2019-01-01{',' * 47},extra\n")
    rows = read_flights(spark, str(path)).select("airline_id", "FL_DATE", "ANY_DELAY").collect()
    assert [r.airline_id for r in rows] == [None, 7]
    assert [r.FL_DATE for r in rows] == ["2019-01-01"] * 2


def test_first_available(spark, edge_path, caplog):
    df, path = read_first_available(spark, ["/nowhere/a.csv", "hdfs://no-such-host:1/b.csv", edge_path])
    assert path == edge_path and df.count() == 14
    assert [r.message.split(":")[0] for r in caplog.records] == [
        "cannot read /nowhere/a.csv", "cannot read hdfs",
    ]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_first_available(spark, ["/nowhere/a.csv", "/nowhere/b.csv"])
    with pytest.raises(ValueError):
        read_first_available(spark, [])


def test_several_paths(spark, edge_path):
    assert read_flights(spark, [edge_path, edge_path]).count() == 28


def test_preview(edge):
    assert preview(edge).count() == 5
    assert preview(edge, 20).count() == 14


def test_prune(edge):
    assert tuple(prune(edge).columns) == NEEDED_COLUMNS
    assert prune(edge, ("ORIGIN", "NO_SUCH", "DEST")).columns == ["ORIGIN", "DEST"]


def test_landing_round_trip(spark, edge, tmp_path):
    target = str(tmp_path / "landed")
    land(edge, target)
    folders = {f for f in os.listdir(target) if f.startswith("FL_YEAR")}
    assert folders == {"FL_YEAR=2019", "FL_YEAR=__HIVE_DEFAULT_PARTITION__"}
    landed = read_landed(spark, target)
    by_text = lambda df: sorted(json.dumps(r.asDict()) for r in df.select(SCHEMA_NAMES).collect())
    assert by_text(landed) == by_text(edge)
    assert landed.filter("FL_YEAR IS NULL").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        land(edge, target)


def test_landing_without_shuffle(spark, edge, tmp_path):
    for rebalance in (True, False):
        land(edge, str(tmp_path / str(rebalance)), rebalance=rebalance)
    counts = [read_landed(spark, str(tmp_path / str(r))).groupBy("FL_YEAR").count() for r in (True, False)]
    assert sorted(map(str, counts[0].collect())) == sorted(map(str, counts[1].collect()))


def test_landing_splits_a_hot_year(spark, tmp_path):
    """A year that holds nearly all rows is written by several tasks."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "CASE WHEN id % 100 = 0 THEN '2018-05-05' ELSE '2019-05-05' END AS FL_DATE", "uuid() AS note"
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "1m")
    try:
        land(rows, str(tmp_path / "hot"))
    finally:
        spark.conf.unset(name)
    files = {f: os.listdir(tmp_path / "hot" / f) for f in os.listdir(tmp_path / "hot") if "=" in f}
    parts = {f: sum(n.endswith(".parquet") for n in names) for f, names in files.items()}
    assert parts["FL_YEAR=2019"] > 3 and parts["FL_YEAR=2018"] == 1
    assert read_landed(spark, str(tmp_path / "hot")).count() == 200_000
