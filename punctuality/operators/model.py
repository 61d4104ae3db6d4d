"""Late-arrival prediction: a decision tree on carrier, distance and month."""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality.functions import month_of, present
from punctuality.schema import LATE_MINUTES, SEED, TREE_DEPTH

# Model inputs, and the names they carry in the importance table.
CARRIER, DISTANCE, DATE = "OP_UNIQUE_CARRIER", "DISTANCE", "FL_DATE"
FEATURES = {"CARRIER_INDEX": "CARRIER", "DISTANCE": "DISTANCE", "Month_Index": "MONTH"}
LABEL = "IS_DELAYED"
CODE = "CARRIER_CODE"

# MLlib's own default for the number of bins per feature.
DEFAULT_BINS = 32


def with_label(df: DataFrame, late_minutes: float = LATE_MINUTES, delay: str = "ARR_DELAY") -> DataFrame:
    """Records with a known delay and their class: 1.0 if more than ``late_minutes`` late."""
    return df.filter(present(df, delay)).withColumn(
        LABEL, F.when(F.col(delay) > late_minutes, 1.0).otherwise(0.0)
    )


def ml_input(
    df: DataFrame,
    late_minutes: float = LATE_MINUTES,
    sampler: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Labelled, optionally sampled records that have carrier, distance and date."""
    labelled = with_label(df, late_minutes)
    sampled = sampler(labelled) if sampler else labelled
    return sampled.filter(present(sampled, CARRIER, DISTANCE, DATE))


def tally(rows: DataFrame, *also: str, weight: str = "flights") -> DataFrame:
    """Model rows that agree in carrier, distance, month, label and ``also`` as one row.

    The tree sees nothing else of a row, so training on the tally with ``weight`` is
    training on the rows, as long as there are fewer combinations than MLlib samples for its
    split candidates (about 10,000); beyond, both fits draw candidates and may differ. However many rows there are, their tally is no larger than
    the number of such combinations, and the many passes of the fit run over that.
    A date stands for its month; ``weight`` counts the rows.
    """
    month = "Month_Index"
    return (
        rows.groupBy(CARRIER, DISTANCE, month_of(DATE).alias(month), LABEL, *also)
        .agg(F.count(F.lit(1)).alias(weight))
        .withColumn(DATE, F.make_date(F.lit(2000), F.col(month), F.lit(1)))
        .drop(month)
    )


def fit_carrier_index(df: DataFrame, weight: str | None = None) -> StringIndexerModel:
    """Number the carriers by descending frequency, ties alphabetically.

    The model holds the distinct carriers, which are counted per task before they
    reach the driver: their number, not that of the rows, bounds its size.
    """
    if weight is None:
        indexer = StringIndexer(inputCol=CARRIER, outputCol=CODE, handleInvalid="skip")
        return indexer.fit(df)
    ranked = (
        df.dropna(subset=[CARRIER])
        .groupBy(CARRIER)
        .agg(F.sum(weight).alias("n"))
        .orderBy(F.desc("n"), CARRIER)
    )
    labels = [row[CARRIER] for row in ranked.collect()]
    return StringIndexerModel.from_labels(
        labels, inputCol=CARRIER, outputCol=CODE, handleInvalid="skip"
    )


def carrier_index(df: DataFrame) -> DataFrame:
    """The carrier numbering as a table ``(OP_UNIQUE_CARRIER, CARRIER_INDEX)``.

    Only the counts of the distinct carriers are ordered as a whole.
    """
    sizes = df.dropna(subset=[CARRIER]).groupBy(CARRIER).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), CARRIER)) - 1
    return sizes.select(CARRIER, place.cast("double").alias("CARRIER_INDEX"))


def feature_stages(indexer: StringIndexerModel, categorical: bool = False) -> list:
    """Stages from a labelled record to its feature vector.

    The cast to double strips the index of its nominal metadata, so the tree splits
    carriers by order of frequency; ``categorical`` keeps the metadata. Rows with a
    missing feature, such as the month of an unreadable date, are skipped.
    """
    carrier = CODE if categorical else f"CAST({CODE} AS DOUBLE)"
    derive = SQLTransformer(
        statement=f"SELECT * EXCEPT ({DISTANCE}), {carrier} AS CARRIER_INDEX, "
        f"CAST({DISTANCE} AS DOUBLE) AS {DISTANCE}, "
        f"CAST(month(TRY_CAST({DATE} AS DATE)) AS DOUBLE) AS Month_Index FROM __THIS__"
    )
    assemble = VectorAssembler(
        inputCols=list(FEATURES), outputCol="features", handleInvalid="skip"
    )
    return [indexer, derive, assemble]


def ml_features(
    df: DataFrame, indexer: StringIndexerModel | None = None, categorical: bool = False
) -> DataFrame:
    """Label, the three feature columns, and the vector made of them."""
    stages = feature_stages(indexer or fit_carrier_index(df), categorical)
    return PipelineModel(stages).transform(df).select(LABEL, *FEATURES, "features")


def train(
    train_df: DataFrame,
    max_depth: int = TREE_DEPTH,
    categorical: bool = False,
    index_on: DataFrame | None = None,
    seed: int = SEED,
    weight: str | None = None,
) -> PipelineModel:
    """Fit the tree and return it with its feature stages as one pipeline.

    With ``weight``, rows count as often as that column says, as in a :func:`tally`.

    Carriers are numbered on the training rows, so test rows cannot influence the
    order; pass the whole sample as ``index_on`` to number them on that instead.
    """
    indexer = fit_carrier_index(train_df if index_on is None else index_on, weight)
    stages = feature_stages(indexer, categorical)
    bins = max(DEFAULT_BINS, len(indexer.labels)) if categorical else DEFAULT_BINS
    tree = DecisionTreeClassifier(
        labelCol=LABEL, featuresCol="features", maxDepth=max_depth, maxBins=bins, seed=seed
    )
    kept = ["features", LABEL]
    if weight is not None:
        tree.setWeightCol(weight)
        kept.append(weight)
    rows = PipelineModel(stages).transform(train_df).select(*kept)
    return PipelineModel([*stages, tree.fit(rows)])


def score(model: PipelineModel, df: DataFrame, *also: str) -> DataFrame:
    """Features, label, prediction and ``also`` of every row that has all features."""
    return model.transform(df).select(*FEATURES, LABEL, "prediction", *also)


def evaluate(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """``(metric, value)``: the accuracy as a fraction, NULL over no rows."""
    hit = (F.col(LABEL) == F.col("prediction")).cast("double")
    if weight is None:
        accuracy = F.avg(hit)
    else:
        accuracy = F.sum(hit * F.col(weight)) / F.sum(weight)
    return predictions.select(accuracy.alias("accuracy")).unpivot([], ["accuracy"], "metric", "value")


def feature_importance(model: PipelineModel) -> DataFrame:
    """``(position, feature, impact)`` with the impact in percent."""
    tree = model.stages[-1]
    rows = [
        (i, name, 100.0 * float(weight))
        for i, (name, weight) in enumerate(
            zip(FEATURES.values(), tree.featureImportances.toArray(), strict=True)
        )
    ]
    return SparkSession.active().createDataFrame(rows, "position int, feature string, impact double")


def importance_percent(importance: DataFrame) -> DataFrame:
    """The importances to two decimals, as reports show them."""
    return importance.withColumn("impact", F.round("impact", 2))


def top_feature(importance: DataFrame) -> DataFrame:
    """The most important feature; of equals, the last."""
    return importance.orderBy(F.desc("impact"), F.desc("position")).limit(1)


def describe_model(model: PipelineModel) -> DataFrame:
    """One row on the fitted tree: its size, and the carriers it knows."""
    indexer, tree = model.stages[0], model.stages[-1]
    row = (tree.depth, tree.numNodes, tree.numFeatures, tree.numClasses, len(indexer.labels))
    return SparkSession.active().createDataFrame(
        [row], "depth int, nodes int, features int, classes int, carriers int"
    )

