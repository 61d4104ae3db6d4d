"""The staged run: ingest, clean, analyse, learn, publish.

The source is scanned once. The rollup of that scan answers every count and every
standing question, and it is refined, for the rows of the model's sample only, by what
the tree sees of a row, so that the tally to train on can be read from it as well.
"""

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.functions import month_of, present
from punctuality.operators import delays, model, sampling
from punctuality.operators.clean import is_flown, prune
from punctuality.plans import rollup as rolled
from punctuality.plans.durable import durable
from punctuality.schema import (
    FLIGHT_KEY, LATE_MINUTES, MIN_FLIGHTS, NEEDED_COLUMNS, SAMPLE_FRACTION, SEED, SPLIT_WEIGHTS,
    TOP_K, TREE_DEPTH,
)
from punctuality.sources.flights import preview, read_first_available
from punctuality.sources.results import publish, result_document


@dataclass(frozen=True)
class Settings:
    """Parameters of a run.

    The sample and the split go by a hash of ``sample_keys`` (see :func:`sample_keys`),
    so copies of a flight stay together. Where copies are many, ``random_draws`` decides
    row by row instead, at the price of a sample that changes with the file layout.
    ``portable`` takes a hash that other engines can reproduce.
    """

    min_flights: int = MIN_FLIGHTS
    top_k: int = TOP_K
    late_minutes: float = LATE_MINUTES
    sample_fraction: float = SAMPLE_FRACTION
    split_weights: Sequence[float] = SPLIT_WEIGHTS
    sample_keys: Sequence[str] | None = None
    random_draws: bool = False
    portable: bool = False
    seed: int = SEED
    max_depth: int = TREE_DEPTH
    categorical: bool = False
    index_on_whole_sample: bool = False


@dataclass
class Results:
    """Outcome of a run. The tables are small and rest on checkpointed data."""

    rollup: DataFrame
    counts: DataFrame
    causes: DataFrame
    top_origins: DataFrame
    months: DataFrame
    model: PipelineModel | None
    accuracy: DataFrame
    importance: DataFrame
    seconds: dict[int, float] = field(default_factory=dict)

    def document(self) -> DataFrame:
        return result_document(
            self.causes, self.top_origins, self.months, self.accuracy, self.importance
        )


class RunLog:
    """Emits the phase, timing and task lines that ``operators.run_log`` reads."""

    def __init__(self, emit: Callable[[str], None] = print):
        self.emit = emit
        self.seconds: dict[int, float] = {}

    @contextmanager
    def step(self, number: int, name: str):
        self.emit(f"[PHASE {number}] {name}")
        start = time.perf_counter()
        yield
        self.seconds[number] = time.perf_counter() - start
        self.emit(f"--> [Time] Step {number} ({name}) took: {self.seconds[number]:.2f}s")


def sample_keys(df: DataFrame) -> Sequence[str]:
    """What identifies a row: the flight key if the table has it, else all columns."""
    return FLIGHT_KEY if set(FLIGHT_KEY) <= set(df.columns) else df.columns


def with_draws(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add to every row whether it is ``drawn`` for the model, and its ``split`` number.

    Split 0 is for training.
    """
    if settings.random_draws:
        first = settings.split_weights[0] / sum(settings.split_weights)
        drawn = F.rand(settings.seed) < settings.sample_fraction
        split = (F.rand(settings.seed + 1) >= first).cast("int")
    else:
        keys = settings.sample_keys or sample_keys(df)
        drawn = sampling.in_sample(keys, settings.sample_fraction, settings.seed, settings.portable)
        split = sampling.split_number(keys, settings.split_weights, settings.seed, settings.portable)
    return df.withColumns({"drawn": drawn, "split": split})


def model_sample(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Tally of the sampled model input by split number.

    Sampling, split and pre-aggregation happen in the scan stage.
    """
    drawn = with_draws(cleaned, settings)
    rows = model.ml_input(drawn, settings.late_minutes, lambda df: df.filter("drawn"))
    return model.tally(rows, "split")


def refined_rollup(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rollup of a raw table, its rows for the model grouped by the model's inputs too.

    The finer grain applies to the sample alone; all other rows fall into the few
    groups of the plain rollup and hardly add to the shuffle.
    """
    drawn = with_draws(raw, settings)
    chosen = (
        is_flown(raw) & present(raw, model.CARRIER, model.DISTANCE, model.DATE) & F.col("drawn")
    )
    late = F.col("ARR_DELAY").cast("float") > settings.late_minutes
    refine = {
        "in_sample": chosen,
        model.CARRIER: F.when(chosen, F.col(model.CARRIER)),
        model.DISTANCE: F.when(chosen, F.col(model.DISTANCE).cast("float")),
        model.LABEL: F.when(chosen, late.cast("double")),
        "split": F.when(chosen, F.col("split")),
    }
    return rolled.delay_rollup(drawn, late_minutes=settings.late_minutes, refine=refine)


def sample_of(rollup: DataFrame) -> DataFrame:
    """:func:`model_sample` as held in a :func:`refined_rollup`."""
    month = "Flight_Month"
    return (
        rollup.filter("in_sample")
        .groupBy(model.CARRIER, model.DISTANCE, month, model.LABEL, "split")
        .agg(F.sum("flights").alias("flights"))
        .withColumn(model.DATE, F.make_date(F.lit(2000), F.col(month), F.lit(1)))
        .drop(month)
    )


def learn(
    sample: DataFrame, settings: Settings = Settings()
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Train on split 0 of a sample: the model, its test accuracy and its importances.

    The accuracy is lazy; it is measured on the rows outside split 0.
    """
    fitted = model.train(
        sample.filter("split = 0"),
        max_depth=settings.max_depth,
        categorical=settings.categorical,
        index_on=sample if settings.index_on_whole_sample else None,
        seed=settings.seed,
        weight="flights",
    )
    predictions = model.score(fitted, sample.filter("split > 0"), "flights")
    return fitted, model.evaluate(predictions, "flights"), model.feature_importance(fitted)


def nothing_learned(spark: SparkSession) -> tuple[None, DataFrame, DataFrame]:
    """What :func:`learn` amounts to without training rows."""
    return (
        None,
        spark.createDataFrame([("accuracy", None)], "metric string, value double"),
        spark.createDataFrame([], "position int, feature string, impact double"),
    )


def sample_counts(sample: DataFrame) -> DataFrame:
    """Rows of a sample: all, those whose features are complete, and those by side."""
    usable = present(sample, model.CARRIER, model.DISTANCE) & month_of(model.DATE).isNotNull()
    first = F.col("split") == 0

    def count(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("flights"))), F.lit(0))

    return sample.select(
        count(F.lit(True)).alias("sampled"),
        count(~usable).alias("skipped"),
        count(usable & first).alias("train"),
        count(usable & ~first).alias("test"),
    )


def run(
    spark: SparkSession,
    paths: Sequence[str],
    output: str | None = None,
    settings: Settings = Settings(),
    emit: Callable[[str], None] = print,
    engine_start: float | None = None,
    flights: DataFrame | None = None,
) -> Results:
    """Run all stages over the first readable path and publish the result document.

    ``flights`` supplies a table directly, such as a landed one, in place of ``paths``.
    ``engine_start`` is the ``time.perf_counter()`` at which the session was requested.
    """
    log = RunLog(emit)
    began = time.perf_counter() if engine_start is None else engine_start
    emit("[PHASE 1] Engine Init")
    emit(f"--> [Time] Step 1 (Engine Init) took: {time.perf_counter() - began:.2f}s")

    with log.step(2, "Ingestion"):
        if flights is None:
            flights, source = read_first_available(spark, paths)
            emit(f"[Task 1] Reading {source}")
        emit(f"[Debug] {len(flights.columns)} columns; first rows:")
        for row in preview(flights).toJSON().collect():
            emit(f"  {row}")
        keys = settings.sample_keys or FLIGHT_KEY
        raw = prune(flights, tuple(dict.fromkeys((*NEEDED_COLUMNS, *keys))))

    with log.step(3, "Cleaning"):
        rollup = durable(refined_rollup(raw, settings))
        counts = rolled.rollup_counts(rollup)
        for row in counts.collect():
            emit(f"[Task 2] {row.stage}: {row.n:,} records")

    with log.step(4, "Analysis"):
        clean_part = rolled.cleaned(rollup)
        causes = rolled.rollup_causes(clean_part)
        months = rolled.rollup_months(clean_part)
        top_origins = delays.top_origin_delays(
            rolled.rollup_origins(clean_part), k=settings.top_k, min_flights=settings.min_flights
        )
        _report(emit, "4.1: Delay minutes by cause", delays.delay_causes_text(causes))
        _report(emit, "4.2: Worst origins", delays.origin_delays_text(top_origins))
        _report(emit, "4.3: Arrival delay by month", delays.monthly_delays_text(months))
        emit("[Task 3] Analysis complete")

    with log.step(5, "Machine Learning"):
        sample = durable(sample_of(rollup))
        n = sample_counts(sample).first()
        emit(f"--> Sample: {n.sampled:,} | Skipped: {n.skipped:,} | Train: {n.train:,} | Test: {n.test:,}")
        if n.train:
            fitted, accuracy, importance = learn(sample, settings)
        else:
            fitted, accuracy, importance = nothing_learned(spark)
            emit("[Warning] no complete row to train on")
        accuracy = durable(accuracy)
        for row in accuracy.dropna().collect():
            emit(f"--> [RESULT 4] Accuracy: {100 * row.value:.2f}%")
        for row in importance.orderBy("position").collect():
            emit(f"- Impact of [{row.feature}]: {row.impact:.2f}%")
        emit("[Task 4] Model complete")

    results = Results(
        rollup, counts, causes, top_origins, months, fitted, accuracy, importance, log.seconds
    )
    if output:
        publish(results.document(), output)
        emit(f"[SUCCESS] Results written to {output}")
    emit(f"[DONE] Total: {time.perf_counter() - began:.2f} seconds")
    return results


def _report(emit: Callable[[str], None], title: str, lines: DataFrame) -> None:
    emit(f"--- {title}")
    for row in lines.collect():
        emit(f"  {row.line}")
