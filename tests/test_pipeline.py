import json
import os

import pytest
from edge_data import full_width

from punctuality.__main__ import main
from punctuality.operators import delays, model, run_log
from punctuality.operators.clean import clean, prune
from punctuality.plans import pipeline
from punctuality.plans import rollup as rolled
from punctuality.plans.durable import checkpoint_folder, durable
from punctuality.sources.results import publish, result_document
from punctuality.sources.run_log import read_run_log


@pytest.fixture(scope="module")
def finished(spark, driver_flights, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("out") / "document")
    lines = []
    settings = pipeline.Settings(min_flights=200, sample_fraction=1.0)
    results = pipeline.run(spark, [], output, settings, emit=lines.append, flights=driver_flights)
    return results, lines, output


def read_document(folder):
    parts = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(folder, parts[0]), encoding="utf-8") as f:
        (line,) = f.read().splitlines()
    return json.loads(line)


def test_results(finished, driver_flights):
    results, _, _ = finished
    cleaned = clean(prune(driver_flights))
    assert results.causes.collect() == delays.delay_causes(cleaned).collect()
    assert results.months.collect() == delays.monthly_delays(cleaned).collect()
    origins = delays.origin_delays(cleaned)
    assert results.top_origins.collect() == delays.top_origin_delays(origins, min_flights=200).collect()
    assert {r.stage: r.n for r in results.counts.collect()} == {
        "raw": driver_flights.count(), "clean": cleaned.count(),
    }
    assert set(results.seconds) == {2, 3, 4, 5}


def test_log_can_be_read_back(spark, finished, tmp_path):
    _, lines, _ = finished
    (tmp_path / "run.log").write_text("\n".join(lines))
    log = read_run_log(spark, str(tmp_path))
    status = run_log.step_status(log).orderBy("step").collect()
    assert [r.status for r in status] == ["finish"] * 5 and all(r.seconds >= 0 for r in status)
    classes = {r.line_class for r in run_log.classify(log).select("line_class").distinct().collect()}
    assert classes == {"phase", "result", "task", "section", "success", "plain"}


def test_document(finished):
    results, _, output = finished
    document = read_document(output)
    analysis, learning = document["analysis"], document["machine_learning"]
    assert analysis["delay_causes"] == results.causes.first().asDict()
    assert list(analysis["delay_causes"]) == list(results.causes.columns)
    assert analysis["top_origin_delays"] == [r.asDict() for r in results.top_origins.collect()]
    assert analysis["monthly_delays"] == [r.asDict() for r in results.months.collect()]
    assert learning["accuracy"] == pytest.approx(100 * results.accuracy.first().value)
    assert [f["feature"] for f in learning["feature_importance"]] == ["CARRIER", "DISTANCE", "MONTH"]
    assert sum(f["impact"] for f in learning["feature_importance"]) == pytest.approx(100)


def test_document_keeps_nulls_and_order(spark, edge, tmp_path):
    part = durable(rolled.cleaned(rolled.delay_rollup(prune(edge))))
    accuracy = spark.createDataFrame([("accuracy", None)], "metric string, value double")
    importance = spark.createDataFrame([], "position int, feature string, impact double")
    document = result_document(
        rolled.rollup_causes(part),
        delays.top_origin_delays(rolled.rollup_origins(part), min_flights=0),
        rolled.rollup_months(part),
        accuracy, importance,
    )
    for _ in range(2):  # a second run replaces the first
        publish(document, str(tmp_path / "doc"))
    found = read_document(tmp_path / "doc")
    assert [m["Flight_Month"] for m in found["analysis"]["monthly_delays"]] == [1, 12, 7, None, 10]
    assert [o["ORIGIN"] for o in found["analysis"]["top_origin_delays"]] == ["FLL", "MIA", "DEN", "DEN"]
    assert found["machine_learning"] == {"accuracy": None, "feature_importance": []}


def test_sample_has_one_row_per_flight(driver_flights):
    settings = pipeline.Settings(sample_fraction=1.0)
    sample = pipeline.model_sample(clean(prune(driver_flights)), settings)
    n = pipeline.sample_counts(sample).first()
    rows = model.ml_input(clean(driver_flights))
    assert n.sampled == rows.count()
    assert n.train + n.test + n.skipped == n.sampled
    assert n.skipped == rows.filter("FL_DATE = 'bad-date'").count() > 0
    assert abs(n.train - 0.7 * n.sampled) < 250


def test_skipped_rows_are_counted(edge):
    sample = pipeline.model_sample(clean(prune(edge)), pipeline.Settings(sample_fraction=1.0))
    n = pipeline.sample_counts(sample).first()
    assert (n.sampled, n.skipped, n.train + n.test) == (7, 1, 6)


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named in checkpoint_folder(spark)
    df = durable(spark.range(10))
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_command_line(spark, edge_path, tmp_path, capsys):
    main(["land", "/nowhere.csv", edge_path, "--target", str(tmp_path / "landed")])
    main([
        "run", "--landed", str(tmp_path / "landed"), "--output", str(tmp_path / "doc"),
        "--min-flights", "1", "--sample-fraction", "1",
    ])
    out = capsys.readouterr().out
    assert "[Task 2] raw: 14 records" in out and "[Task 2] clean: 8 records" in out
    assert "FLL (Fort Lauderdale, FL): 20.5 min avg delay (2 flights)" in out
    assert read_document(tmp_path / "doc")["analysis"]["delay_causes"]["NAS_Error"] == 21.0
    main([
        "run", edge_path, "--sample-fraction", "1", "--random-draws", "--categorical",
        "--index-on-whole-sample", "--max-depth", "2",
    ])
    assert "[Task 4] Model complete" in capsys.readouterr().out
    main(["explore", edge_path, "--min-flights", "1"])
    out = capsys.readouterr().out
    assert "Late_Aircraft_Error" in out and "Avg_Arr_Delay_Minutes" in out


def test_csv_and_landed_runs_agree(spark, tmp_path, edge_path):
    def run(**options):
        lines = []
        settings = pipeline.Settings(min_flights=0, sample_fraction=1.0)
        pipeline.run(spark, [edge_path], settings=settings, emit=lines.append, **options)
        return [line for line in lines if line.startswith("  ") and "{" not in line]

    from punctuality.sources.flights import land, read_flights, read_landed

    land(read_flights(spark, edge_path), str(tmp_path / "landed"))
    assert run() == run(flights=read_landed(spark, str(tmp_path / "landed")))


def test_empty_file(spark, tmp_path):
    """No rows give empty reports, and the model stage says that it has nothing to learn."""
    path = tmp_path / "empty.csv"
    path.write_text(full_width().splitlines()[0] + "\n")
    results = pipeline.run(spark, [str(path)], str(tmp_path / "doc"), emit=lambda line: None)
    assert results.model is None
    document = read_document(tmp_path / "doc")
    assert set(document["analysis"]["delay_causes"].values()) == {None}
    assert document["machine_learning"] == {"accuracy": None, "feature_importance": []}


def test_random_draws(driver_flights):
    settings = pipeline.Settings(sample_fraction=0.5, random_draws=True)
    n = pipeline.sample_counts(durable(pipeline.model_sample(clean(driver_flights), settings))).first()
    assert abs(n.sampled - 0.5 * 5679) < 200 and abs(n.train - 0.7 * n.sampled) < 150


def test_sample_goes_by_flight_where_flights_are_known(edge, driver_flights):
    assert "OP_CARRIER_FL_NUM" in pipeline.sample_keys(edge)
    assert pipeline.sample_keys(driver_flights) == driver_flights.columns


def test_sample_keys_survive_pruning(spark, driver_flights):
    settings = pipeline.Settings(sample_keys=("flight_id", "DEST"), sample_fraction=0.5)
    lines = []
    pipeline.run(spark, [], settings=settings, emit=lines.append, flights=driver_flights)
    expected = pipeline.sample_counts(pipeline.model_sample(clean(driver_flights), settings)).first()
    assert any(f"--> Sample: {expected.sampled:,} " in line for line in lines)


@pytest.mark.parametrize("fraction", [0.3, 1.0])
def test_sample_within_the_rollup(driver_flights, edge, fraction):
    """One scan yields the rows that cleaning, labelling and sampling would pick one by one."""
    # Keys that cleaning does not touch.
    keys = ("FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN", "ORIGIN_CITY_NAME", "DEST")
    settings = pipeline.Settings(sample_fraction=fraction, sample_keys=keys)
    for source in (prune(driver_flights), edge):
        refined = pipeline.refined_rollup(source, settings)
        expected = pipeline.model_sample(clean(source), settings)
        found = pipeline.sample_of(refined).select(expected.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        plain = rolled.delay_rollup(prune(source))
        for answer in (rolled.rollup_counts, rolled.rollup_causes, rolled.rollup_months, rolled.rollup_labels):
            for part in (lambda df: df, rolled.cleaned):
                assert answer(part(refined)).collect() == answer(part(plain)).collect()
        origins = [rolled.rollup_origins(r).orderBy(*delays.worst_order()).collect() for r in (refined, plain)]
        assert origins[0] == origins[1]


def test_random_draws_agree_across_columns(driver_flights):
    """A row drawn at random is drawn for all grouping columns or for none."""
    settings = pipeline.Settings(sample_fraction=0.3, random_draws=True)
    rollup = durable(pipeline.refined_rollup(prune(driver_flights), settings))
    inside, outside = rollup.filter("in_sample"), rollup.filter("NOT in_sample")
    for name in (model.CARRIER, model.DISTANCE, model.LABEL, "split"):
        assert inside.filter(f"{name} IS NULL").count() == 0
        assert outside.filter(f"{name} IS NOT NULL").count() == 0
    n = pipeline.sample_counts(pipeline.sample_of(rollup)).first()
    assert abs(n.sampled - 0.3 * 5679) < 180
