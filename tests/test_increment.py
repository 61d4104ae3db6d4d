"""Landings repeated, broken off and restated."""

import pytest

import driver_tables
from punctuality.plans import rollup as rolled
from punctuality.plans.observed import land_counted
from punctuality.sources import increment
from punctuality.sources.flights import read_flights, read_landed

SF_DIR = "/root/testdata/sf0.001"
SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.fixture
def wide(spark):
    return driver_tables.wide_flights(spark, SF_DIR).limit(400).cache()


def write(df, folder, unit):
    df.coalesce(2).write.mode("overwrite").csv(f"{folder}/{unit}", header=True)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def same(spark, target, sources):
    """What was landed is what a read of the sources gives, and so is the rollup."""
    fresh = read_flights(spark, sources)
    landed = increment.read_increments(spark, target)
    assert rows_of(landed.drop("FL_YEAR")) == rows_of(fresh)
    assert rows_of(increment.read_rollup(spark, target)) == rows_of(rolled.delay_rollup(fresh))


def test_landing_again_changes_nothing(spark, wide, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    write(wide.filter("flight_id % 3 = 0") if "flight_id" in wide.columns else wide.limit(150), folder, "one")
    assert increment.land_new(spark, folder, target) == 1
    assert increment.land_new(spark, folder, target) == 0
    same(spark, target, [f"{folder}/one"])
    write(wide.limit(60), folder, "two")
    assert increment.land_new(spark, folder, target) == 1
    same(spark, target, [f"{folder}/one", f"{folder}/two"])


def test_restated_unit_replaces_its_rows(spark, wide, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    write(wide.limit(80).selectExpr(*[c if c != "FL_DATE" else "'2031-05-05' AS FL_DATE" for c in wide.columns]), folder, "one")
    write(wide.limit(40), folder, "two")
    assert increment.land_new(spark, folder, target) == 2
    write(wide.limit(90), folder, "one")
    assert increment.land_new(spark, folder, target) == 1
    same(spark, target, [f"{folder}/one", f"{folder}/two"])
    assert increment.read_increments(spark, target).filter("FL_YEAR = 2031").count() == 0
    assert increment.read_manifest(spark, target).filter("unit = 'one'").count() == 2


@pytest.mark.parametrize("broken", ["delay_rollup", "MANIFEST"])
def test_crash_between_writes(spark, wide, tmp_path, monkeypatch, broken):
    """A landing that ends after its rows, or after its rollup, leaves the table as it was; the next one lands all."""
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    write(wide.limit(50), folder, "one")
    increment.land_new(spark, folder, target)
    write(wide.limit(120), folder, "two")

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        if broken == "delay_rollup":
            patched.setattr(increment, "delay_rollup", crash)
        else:
            replace = increment._replace
            patched.setattr(increment, "_replace", lambda rows, path, *p: crash() if path.endswith("manifest") else replace(rows, path, *p))
        with pytest.raises(RuntimeError):
            increment.land_new(spark, folder, target)
    same(spark, target, [f"{folder}/one"])
    # A third unit has come meanwhile, so the next generation is another one.
    write(wide.limit(30), folder, "three")
    assert increment.land_new(spark, folder, target) == 2
    same(spark, target, [f"{folder}/{u}" for u in ("one", "two", "three")])


def test_every_core_gets_tasks(spark, wide, tmp_path, monkeypatch):
    """A landing is cut for the cores that wait, of one year too; the session keeps its sizes."""
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(increment, "LEAST_TASK_BYTES", 2000, raising=False)
    before = {name: spark.conf.get(name, None) for name in SIZES}
    write(wide.withColumn("FL_DATE", driver_tables.F.lit("2001-02-03")), folder, "one")
    write(wide.limit(9), folder, "two")
    assert increment.land_new(spark, folder, target) == 2
    files = spark.read.parquet(f"{target}/data").inputFiles()
    assert len([f for f in files if "FL_YEAR=2001" in f]) >= spark.sparkContext.defaultParallelism
    assert {name: spark.conf.get(name, None) for name in SIZES} == before
    same(spark, target, [f"{folder}/one", f"{folder}/two"])
    # A session's own size holds.
    spark.conf.set(SIZES[0], "32m")
    try:
        with increment.enough_tasks(spark, 1):
            assert spark.conf.get(SIZES[0]) == "32m" and spark.conf.get(SIZES[1]) == "2000"
        assert spark.conf.get(SIZES[0]) == "32m"
    finally:
        spark.conf.unset(SIZES[0])


@pytest.mark.parametrize("apart", [0, 8])
def test_rows_know_their_unit(spark, wide, tmp_path, monkeypatch, apart):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(increment, "READ_APART", apart, raising=False)
    for unit, n in {"one": 30, "two 2": 50, "three": 0}.items():
        write(wide.limit(n), folder, unit)
    assert increment.land_new(spark, folder, target) == 3
    found = spark.read.parquet(f"{target}/data").groupBy("unit").count()
    units = {r.unit for r in increment.read_manifest(spark, target).collect()}
    assert dict(map(tuple, found.collect())) == {"one": 30, next(u for u in units if u.startswith("two")): 50}


def test_readers_types_may_differ_by_unit(spark, wide, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    header = ",".join(wide.columns)
    for unit, number in {"a": "1", "b": "1.5"}.items():
        row = [number if c == "ARR_DELAY" else "" for c in wide.columns]
        (folder / f"{unit}.csv").write_text(header + "\n" + ",".join(row) + "\n")
    read = lambda session, paths: read_flights(session, paths, infer=True)
    assert increment.land_new(spark, str(folder), target, read=read) == 2
    assert rows_of(increment.read_increments(spark, target).select("ARR_DELAY")) == [(1.0,), (1.5,)]


def test_single_files_are_units(spark, wide, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    header = ",".join(wide.columns)
    (folder / "a b.csv").write_text(header + "\n" + "," * (len(wide.columns) - 1) + "\n")
    (folder / "notes.txt").write_text("not a table")
    assert increment.land_new(spark, str(folder), target) == 1
    assert increment.read_increments(spark, target).count() == 1
    assert increment.read_manifest(spark, target).first().files == 1


def test_counts_come_with_the_landing(spark, wide, tmp_path):
    """The stages are counted by the jobs of the write; nothing reads the table again."""
    stages = {"raw": driver_tables.F.lit(True), "clean": rolled.is_flown(wide), "none": driver_tables.F.lit(False)}
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        found = land_counted(wide, str(tmp_path / "out"), stages)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("landing")
        rows = dict(map(tuple, found.collect()))
        after = spark.sparkContext.statusTracker().getJobIdsForGroup("landing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows == {"raw": 400, "clean": wide.filter(rolled.is_flown(wide)).count(), "none": 0}
    assert len(jobs) <= 3 and len(after) - len(jobs) <= 1
    assert read_landed(spark, str(tmp_path / "out")).count() == 400
