"""Rules that a first round got wrong: one rule each for casts, small fractions, probes, run ids."""

from pyspark.sql import functions as F

from driver_tables import flights
from edge_data import full_width
from punctuality.operators import counts, delays, model, run_log, sampling
from punctuality.operators.clean import clean, prune
from punctuality.plans import rollup as rolled
from punctuality.sources.flights import read_first_available, read_landed
from punctuality.sources.run_log import read_run_log


def test_rollup_and_cleaned_table_agree_on_wide_measures(spark, driver_flights):
    raw = prune(driver_flights).withColumn("ARR_DELAY", F.lit(15.0000001))
    direct = counts.label_counts(model.with_label(clean(raw))).collect()
    from_rollup = rolled.rollup_labels(rolled.cleaned(rolled.delay_rollup(raw))).collect()
    assert sorted(map(tuple, direct)) == sorted(tuple(r) for r in from_rollup if r[1])


def test_small_fractions_keep_rows(spark):
    assert 1 <= sampling.sample_by_key(spark.range(20_000_000), 4e-7).count() <= 30


def test_probe_reads_a_whole_row(spark, tmp_path):
    good = full_width()
    header, rest = good.split("\n", 1)
    names = header.split(",")
    names[1], names[2] = names[2], names[1]
    swapped, page, fine = (tmp_path / n for n in ("swapped.csv", "page.csv", "fine.csv"))
    swapped.write_text(",".join(names) + "\n" + rest)
    page.write_text("<html>\n<body>not found</body>\n</html>\n")
    fine.write_text(good)
    assert read_first_available(spark, [str(swapped), str(page), str(fine)])[1] == str(fine)


def test_all_landed_paths_are_read(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / name))
    assert read_landed(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 6


def test_logs_of_one_name_are_several_runs(spark, tmp_path):
    for day in ("a", "b"):
        (tmp_path / "logs" / day).mkdir(parents=True)
        (tmp_path / "logs" / day / "run.log").write_text("[PHASE 1] x\n[PHASE 2] y\n")
    for path in (tmp_path / "logs", tmp_path / "logs" / "*"):
        found = read_run_log(spark, str(path)).groupBy("run_id").count().collect()
        assert sorted(map(tuple, found)) == [("a/run", 2), ("b/run", 2)]


def test_binding_reaches_every_rule(spark):
    table = flights(spark, "/root/testdata/sf0.01")
    missing = table.select([F.count_if(F.col(c).isNull()).alias(c) for c in table.columns]).first()
    assert all(missing[c] for c in table.columns if c != "flight_id")
    assert table.filter("FL_DATE = 'bad-date'").count() and table.filter("ARR_DELAY <> floor(ARR_DELAY)").count()


def test_text_among_measures_counts_as_missing(spark):
    rows = [("A", "a", "2019-01-05", "10"), ("A", "a", "2019-01-06", "n/a"), ("A", "a", "2019-01-07", None)]
    raw = spark.createDataFrame(rows, "ORIGIN string, ORIGIN_CITY_NAME string, FL_DATE string, DEP_DELAY string")
    assert [tuple(r) for r in delays.origin_delays(raw).collect()] == [("A", "a", 1, 10.0)]
    months = delays.monthly_delays(raw.withColumnRenamed("DEP_DELAY", "ARR_DELAY"))
    assert [tuple(r) for r in months.collect()] == [(1, 1, 10.0)]


def test_run_outcome(spark):
    lines = [
        ("good", 1, "[DONE] Total: 3.5 seconds"), ("good", 2, "[SYSTEM] Pipeline finished (Code: 0)"),
        ("bad", 1, "[SYSTEM] Pipeline finished (Code: 0)"), ("bad", 2, "[SYSTEM] Pipeline finished (Code: 137)"),
        ("killed", 1, "[SYSTEM] Pipeline finished (Code: null)"), ("lost", 1, "[SYSTEM ERROR] Connection lost."),
        ("open", 1, "[PHASE 1] x"),
    ]
    found = run_log.run_outcome(spark.createDataFrame(lines, "run_id string, line_no bigint, line string"))
    assert {r.run_id: (r.outcome, r.total_seconds) for r in found.collect()} == {
        "good": ("completed", 3.5), "bad": ("error", None), "killed": ("error", None),
        "lost": ("error", None), "open": ("running", None),
    }
