
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_tables import (  # noqa: E402
    MIN_FLIGHTS, flights, fuel_prices, log_stream, log_table, planted_flights, wide_flights,
)
from oracle_queries import ORACLES  # noqa: E402
from punctuality.functions import present  # noqa: E402
from punctuality.operators import (  # noqa: E402
    counts, delays, encoding, interval, model, quantiles, quotas, run_log, sampling,
)
from punctuality.operators.asof import as_of_join  # noqa: E402
from punctuality.operators.clean import clean, is_flown, prune  # noqa: E402
from punctuality.plans import pipeline  # noqa: E402
from punctuality.plans import rollup as rolled  # noqa: E402
from punctuality.plans.durable import checkpoint_folder, durable  # noqa: E402
from punctuality.plans.observed import land_counted  # noqa: E402
from punctuality.schema import NEEDED_COLUMNS  # noqa: E402
from punctuality.sources.flights import land, preview, read_first_available, read_flights, read_landed  # noqa: E402
from punctuality.sources.increment import land_new, read_increments, read_rollup  # noqa: E402
from punctuality.sources.rejects import land_checked, read_good, read_marked, read_rejects, reject_values  # noqa: E402
from punctuality.sources import results  # noqa: E402
from punctuality.sources.results import analysis_rows, result_document  # noqa: E402
from punctuality.sources.run_log import read_run_log  # noqa: E402
from punctuality.streaming import open_runs  # noqa: E402
from punctuality.streaming.live_log import keep_status, latest_status  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    import punctuality.llm.queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    # The text operators are optional: without their folder the other queries work as they are.
    if missing.name not in ("corpus_pipeline", "punctuality.llm", "punctuality.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# What identifies a flight in the derived table, for samples and splits.
ROW_KEY = ("flight_id", "FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST")

SMOKE_DIR = "/root/testdata/sf0.001"


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived flights, pruned to what the analyses read."""
    return prune(flights(spark, sf_dir))


def clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_flights(spark, sf_dir))


def keyed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned flights with their number."""
    return clean(prune(flights(spark, sf_dir), (*NEEDED_COLUMNS, "flight_id")))


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log.log_lines(log_table(spark, sf_dir))


portable_sample = partial(sampling.sample_by_key, keys=ROW_KEY, portable=True)
SETTINGS = pipeline.Settings(min_flights=MIN_FLIGHTS, sample_keys=ROW_KEY, portable=True)


def stages_of(raw: DataFrame) -> dict[str, Column]:
    """The stages of a run as predicates over the raw flights."""
    flown = is_flown(raw)
    usable = present(raw, model.CARRIER, model.DISTANCE, model.DATE)
    chosen = flown & usable & sampling.in_sample(ROW_KEY, SETTINGS.sample_fraction, portable=True)
    side = sampling.split_number(ROW_KEY, portable=True)
    return {
        "raw": F.lit(True), "clean": flown,
        "train": chosen & (side == 0), "test": chosen & (side == 1),
    }


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = flights(spark, sf_dir)
    return counts.stage_counts(raw, stages_of(raw))


def observed_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, taken from the landing of the flights."""
    raw = flights(spark, sf_dir)
    return land_counted(raw, f"{checkpoint_folder(spark)}/counted-{uuid.uuid4().hex}", stages_of(raw))


def flights_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each flight with the price that holds at its origin on its day."""
    raw = flights(spark, sf_dir).select("flight_id", "ORIGIN", F.col("FL_DATE").try_cast("date").alias("FL_DAY"))
    prices = fuel_prices(spark, sf_dir).withColumnRenamed("AIRPORT", "ORIGIN")
    return as_of_join(raw, prices, ["ORIGIN"], "FL_DAY", "PRICE_DATE", ["PRICE_DATE", "PRICE"], order=["quote_id"])


def carrier_delay_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, 90 and 99 percent of the arrival delay by carrier, from the histograms of two halves."""
    cleaned = clean_flights(spark, sf_dir)
    halves = [cleaned.filter(test) for test in ("ARR_DELAY < 10", "NOT ARR_DELAY < 10")]
    by = ["OP_UNIQUE_CARRIER"]
    parts = [quantiles.value_histogram(half, by, "ARR_DELAY") for half in halves]
    return quantiles.quantiles(quantiles.merge_histograms(parts, by), by)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and test side with exactly 70 percent of each class."""
    labelled = model.with_label(keyed_flights(spark, sf_dir)).select("flight_id", model.LABEL)
    split = quotas.with_quota(labelled, [model.LABEL], ["flight_id"], 700, portable=True)
    return split.select("flight_id", model.LABEL, F.when(F.col(quotas.CHOSEN), "train").otherwise("test").alias("side"))


def carrier_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each flight with the share of late flights of its carrier in the other folds."""
    labelled = model.with_label(keyed_flights(spark, sf_dir)).select("flight_id", model.CARRIER, model.LABEL)
    return encoding.encode(labelled, model.CARRIER, model.LABEL, ["flight_id"], "CARRIER_RATE", portable=True)


def accuracy_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well a late departure foretells a late arrival, and how sure that is."""
    labelled = model.with_label(keyed_flights(spark, sf_dir))
    rule = labelled.withColumn("prediction", F.when(F.col("DEP_DELAY") > 15, 1.0).otherwise(0.0))
    return interval.accuracy_interval(rule, model.LABEL, "prediction", ["flight_id"])


def landed_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One origin of the flights as landed in clusters; other row groups are skipped."""
    path = csv_path(spark, wide_flights(spark, sf_dir))
    land(read_flights(spark, path), f"{path}-clustered", cluster=("ORIGIN", "OP_UNIQUE_CARRIER"))
    return prune(read_landed(spark, f"{path}-clustered").filter("ORIGIN = 'H3'"))


def checked_landing(spark: SparkSession, sf_dir: str) -> str:
    """Where the flights lie as landed from a CSV in which some delays are no numbers."""
    path = csv_path(spark, wide_flights(spark, sf_dir, text_delays=True))
    land_checked(read_marked(spark, path), f"{path}-checked")
    return f"{path}-checked"


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = reject_values(read_rejects(spark, checked_landing(spark, sf_dir)))
    return values.select("FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "DEP_DELAY", "n_values")


def csv_good_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune(read_good(spark, checked_landing(spark, sf_dir)))


def landed_in_steps(spark: SparkSession, sf_dir: str) -> str:
    """Where the flights lie after four landings: wrong late years, nothing new, and those years restated."""
    wide, late = wide_flights(spark, sf_dir), F.col("FL_DATE") >= "1999"
    # Neither early nor late, and what has no date; the date is made for every row, so it is looked at once.
    middle = F.coalesce(F.substring("FL_DATE", 1, 4).isin("1997", "1998"), F.lit(True))
    folder = f"{checkpoint_folder(spark)}/units-{uuid.uuid4().hex}"
    target = f"{folder}-landed"

    def write(rows: DataFrame, unit: str) -> None:
        rows.write.mode("overwrite").csv(f"{folder}/{unit}", header=True)

    write(wide.filter(F.col("FL_DATE") < "1997"), "early")
    land_new(spark, folder, target)
    write(wide.filter(late).withColumns({"ARR_DELAY": F.col("ARR_DELAY") + 7, "FL_DATE": F.lit("2005-01-01")}), "late")
    write(wide.filter(middle), "middle")
    land_new(spark, folder, target)
    land_new(spark, folder, target)
    write(wide.filter(late), "late")
    land_new(spark, folder, target)
    return target


def landed_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune(read_increments(spark, landed_in_steps(spark, sf_dir)))


def rollup_after_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rollup(spark, landed_in_steps(spark, sf_dir))


def split_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the split in one pass."""
    side = F.when(sampling.split_number(ROW_KEY, portable=True) == 0, "train").otherwise("test")
    return keyed_flights(spark, sf_dir).withColumn("side", side)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, test_rows = sampling.split_rows(clean_flights(spark, sf_dir))
    n = F.count(F.lit(1)).alias("n")
    return train_rows.select(F.lit("train").alias("side")).unionByName(
        test_rows.select(F.lit("test").alias("side"))
    ).groupBy("side").agg(n)


def ml_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.ml_input(keyed_flights(spark, sf_dir), sampler=portable_sample)
    return rows.select(model.CARRIER, model.DISTANCE, model.DATE, model.LABEL)


def rollup_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled.delay_rollup(raw_flights(spark, sf_dir))


def clean_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled.cleaned(rollup_of(spark, sf_dir))


def learned(spark: SparkSession, sf_dir: str):
    """The model's sample and what was learned from it."""
    sample = durable(pipeline.model_sample(keyed_flights(spark, sf_dir), SETTINGS))
    return sample, pipeline.learn(sample, SETTINGS)


def delay_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the sample that the model was not trained on, with its prediction."""
    rows, (fitted, _, _) = learned_rows(keyed_flights(spark, sf_dir))
    return model.score(fitted, rows.filter("split > 0"))


def learned_rows(cleaned: DataFrame):
    """The drawn rows, kept from one scan of the source, and what their tally teaches."""
    drawn = pipeline.with_draws(cleaned, SETTINGS)
    rows = durable(model.ml_input(drawn, SETTINGS.late_minutes, lambda df: df.filter("drawn")))
    return rows, pipeline.learn(durable(model.tally(rows, "split")), SETTINGS)


def planted(spark: SparkSession, sf_dir: str):
    """:func:`learned_rows` over flights whose delays follow a known rule."""
    return learned_rows(clean(prune(planted_flights(spark, sf_dir), (*NEEDED_COLUMNS, "flight_id"))))


def planted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (fitted, _, _) = planted(spark, sf_dir)
    scored = model.score(fitted, rows.filter("split > 0"), "flight_id")
    return scored.select("flight_id", model.LABEL, "prediction")


def csv_path(spark: SparkSession, wide: DataFrame) -> str:
    """Where ``wide`` now lies as CSV with a header; the caller of the query removes it."""
    path = f"{checkpoint_folder(spark)}/flights-{uuid.uuid4().hex}"
    wide.write.csv(path, header=True)
    return path


def csv_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune(read_flights(spark, csv_path(spark, wide_flights(spark, sf_dir))))


def csv_inferred_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw analysis of a file whose schema is inferred and whose delays are not all numbers."""
    path = csv_path(spark, wide_flights(spark, sf_dir, text_delays=True))
    return delays.origin_delays(read_flights(spark, path, infer=True))


def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table from the last of three paths: one is missing, one has two names exchanged."""
    wide = wide_flights(spark, sf_dir)
    good = csv_path(spark, wide)
    names = {"ORIGIN": "DEST", "DEST": "ORIGIN"}
    wrong = csv_path(spark, wide.limit(1).toDF(*[names.get(c, c) for c in wide.columns]))
    return prune(read_first_available(spark, [f"{good}-missing", wrong, good])[0])


def landed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the flights as landed; the other years' folders are not read."""
    path = csv_path(spark, wide_flights(spark, sf_dir))
    land(read_flights(spark, path), f"{path}-landed")
    return prune(read_landed(spark, f"{path}-landed").filter("FL_YEAR = 1995"))


def dashboard_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of a staged run, from one scan."""
    raw = prune(flights(spark, sf_dir), (*NEEDED_COLUMNS, "flight_id"))
    rollup = durable(pipeline.refined_rollup(raw, SETTINGS))
    part = rolled.cleaned(rollup)
    _, accuracy, importance = pipeline.learn(durable(pipeline.sample_of(rollup)), SETTINGS)
    return result_document(
        rolled.rollup_causes(part),
        delays.top_origin_delays(rolled.rollup_origins(part), min_flights=MIN_FLIGHTS),
        rolled.rollup_months(part),
        accuracy,
        importance,
    )


def live_step_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log taken in as a stream up to its present end."""
    folder = f"{checkpoint_folder(spark)}/live-{uuid.uuid4().hex}"
    lines = run_log.log_lines(log_stream(spark, sf_dir))
    keep_status(lines, f"{folder}/status", f"{folder}/state").awaitTermination()
    return latest_status(spark, f"{folder}/status")


def open_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log taken in as a stream whose runs expire by event time."""
    folder = f"{checkpoint_folder(spark)}/open-{uuid.uuid4().hex}"
    lines = run_log.log_lines(log_stream(spark, sf_dir, "CAST(ts AS TIMESTAMP) AS arrived"))
    open_runs.keep_open_runs(lines, f"{folder}/runs", f"{folder}/state").awaitTermination()
    return open_runs.open_run_status(spark, f"{folder}/runs")


def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as read back from one file per run; ``line_no`` is the place among the run's lines."""
    folder = f"{checkpoint_folder(spark)}/logs-{uuid.uuid4().hex}"
    lines = log_table(spark, sf_dir).repartition("run_id").sortWithinPartitions("run_id", "line_no")
    lines.select("run_id", "line").write.partitionBy("run_id").text(folder)
    found = read_run_log(spark, folder)
    # The writer names the files; the folder names the run.
    run = F.regexp_extract("run_id", "run_id=([^/]*)/", 1)
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("line_no")).cast("bigint")
    return found.withColumn("run_id", run).select("run_id", place.alias("line_no"), "line")


def analysis_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results that need no model, from one scan: the document's rows in their order."""
    rollup = durable(clean_rollup(spark, sf_dir))
    top = delays.top_origin_delays(rolled.rollup_origins(rollup), min_flights=MIN_FLIGHTS)
    return analysis_rows(results.analysis_document(rolled.rollup_causes(rollup), top, rolled.rollup_months(rollup)))


def entry(spark: SparkSession) -> DataFrame:
    """Average arrival delay by month over the smallest data set."""
    return delays.monthly_delays(clean_flights(spark, SMOKE_DIR))


def text_queries() -> dict[str, Query]:
    """The queries of the text operators, if that subpackage is there."""
    if llm_queries is None:
        return {}
    return {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    """All registered queries; each takes ``(spark, sf_dir)``."""
    top = partial(delays.top_origin_delays, min_flights=MIN_FLIGHTS)
    worst = partial(delays.worst_origin, min_flights=MIN_FLIGHTS)

    def over(source: Query, *operators: Callable[[DataFrame], DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = source(spark, sf_dir)
            for operator in operators:
                df = operator(df)
            return df

        return query

    return {
        # Cleaning and counts
        "flights_pruned": raw_flights,
        "flights_clean": clean_flights,
        "preview": over(raw_flights, preview),
        "stage_counts": stage_counts,
        "observed_stage_counts": observed_stage_counts,
        # Analyses
        "delay_causes": over(clean_flights, delays.delay_causes),
        "raw_delay_causes": over(raw_flights, delays.delay_causes),
        "delay_causes_text": over(clean_flights, delays.delay_causes, delays.delay_causes_text),
        "delay_cause_share": over(clean_flights, delays.delay_causes, delays.delay_cause_share),
        "origin_delays": over(clean_flights, delays.origin_delays),
        "top_origin_delays": over(clean_flights, delays.origin_delays, top),
        "raw_top_origin_delays": over(raw_flights, delays.origin_delays, top),
        "worst_origin": over(clean_flights, delays.origin_delays, worst),
        "origin_delays_text": over(
            clean_flights, delays.origin_delays, top, delays.origin_delays_text
        ),
        "monthly_delays": over(clean_flights, delays.monthly_delays),
        "raw_monthly_delays": over(raw_flights, delays.monthly_delays),
        "monthly_trend": over(clean_flights, delays.monthly_delays, delays.monthly_trend),
        "monthly_delays_text": over(
            clean_flights, delays.monthly_delays, delays.monthly_delays_text
        ),
        "carrier_delay_quantiles": carrier_delay_quantiles,
        "flights_asof": flights_asof,
        # The same from one scan
        "delay_rollup": rollup_of,
        "rollup_counts": over(rollup_of, rolled.rollup_counts),
        "rollup_causes": over(clean_rollup, rolled.rollup_causes),
        "rollup_top_origin_delays": over(clean_rollup, rolled.rollup_origins, top),
        "rollup_monthly_delays": over(clean_rollup, rolled.rollup_months),
        "rollup_label_counts": over(clean_rollup, rolled.rollup_labels),
        # Samples, splits and model inputs
        "delay_label_counts": over(clean_flights, model.with_label, counts.label_counts),
        "sample_rows": over(clean_flights, sampling.sample_rows),
        "sample_by_key": over(keyed_flights, portable_sample),
        "split_counts": split_counts,
        "split_by_key": split_by_key,
        "stratified_split": stratified_split,
        "carrier_encoding": carrier_encoding,
        "accuracy_interval": accuracy_interval,
        "ml_input": ml_input,
        "carrier_index": over(clean_flights, model.carrier_index),
        "ml_features": over(ml_input, durable, lambda df: model.ml_features(df).drop("features")),
        # The model
        "delay_model": lambda s, d: model.describe_model(learned(s, d)[1][0]),
        "delay_predictions": delay_predictions,
        "model_accuracy": lambda s, d: learned(s, d)[1][1],
        "feature_importance": lambda s, d: learned(s, d)[1][2],
        "importance_percent": lambda s, d: model.importance_percent(learned(s, d)[1][2]),
        "sample_counts": over(keyed_flights, lambda df: pipeline.model_sample(df, SETTINGS), pipeline.sample_counts),
        "planted_predictions": planted_predictions,
        "planted_accuracy": lambda s, d: planted(s, d)[1][1],
        "planted_top_feature": lambda s, d: model.top_feature(planted(s, d)[1][2]).select("feature"),
        # Sources
        "csv_flights": csv_flights,
        "csv_inferred_delays": csv_inferred_delays,
        "first_available": first_available,
        "landed_flights": landed_flights,
        "landed_origin": landed_origin,
        "csv_rejects": csv_rejects,
        "csv_good_flights": csv_good_flights,
        "landed_increment": landed_increment,
        "rollup_after_updates": rollup_after_updates,
        "top_feature": lambda s, d: model.top_feature(learned(s, d)[1][2]),
        # Run logs
        "log_lines": log_of,
        "log_step_timings": over(log_of, run_log.step_timings),
        "log_phases": over(log_of, run_log.phases),
        "log_line_classes": over(log_of, run_log.classify),
        "log_step_status": over(log_of, run_log.step_status),
        "log_run_outcome": over(log_of, run_log.run_outcome),
        "log_current_step": over(log_of, run_log.step_status, run_log.current_step),
        "log_files": log_files,
        "live_step_status": live_step_status,
        "open_run_status": open_run_status,
        # Result document
        "analysis_document": analysis_document,
        "dashboard_document": dashboard_document,
        **text_queries(),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query. Random draws, fitted models and the document that holds
    a model's results have none."""
    found = dict(ORACLES)
    if llm_queries is not None:
        found |= llm_queries.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
