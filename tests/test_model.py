import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from punctuality.operators import model
from punctuality.operators.clean import clean, prune


@pytest.fixture(scope="module")
def cleaned(edge):
    return clean(prune(edge))


@pytest.fixture(scope="module")
def planted(spark):
    """Summer flights of C1 are late, and nothing else is."""
    df = spark.range(6000).select(
        F.concat(F.lit("C"), (F.col("id") % 4).cast("string")).alias("OP_UNIQUE_CARRIER"),
        (100.0 + F.col("id") % 37).alias("DISTANCE"),
        F.date_format(F.make_date(F.lit(2019), (F.col("id") % 12 + 1).cast("int"), F.lit(3)), "yyyy-MM-dd")
        .alias("FL_DATE"),
    )
    late = (F.col("OP_UNIQUE_CARRIER") == "C1") & F.month("FL_DATE").isin(2, 6, 10)
    return df.withColumn("ARR_DELAY", F.when(late, 40.0).otherwise(0.0))


def test_ml_input_and_features(cleaned):
    rows = model.ml_input(cleaned)
    assert rows.count() == 7  # one lacks distance and date
    features = model.ml_features(rows)
    assert features.count() == 6  # one date is unreadable
    by_month = {(r.CARRIER_INDEX, r.Month_Index): r.features.toArray().tolist() for r in features.collect()}
    # UA leads with three flights, then AA and DL with two each, in alphabetical order.
    assert by_month[(1.0, 1.0)] == [1.0, 1089.0, 1.0]
    assert by_month[(2.0, 7.0)] == [2.0, 581.0, 7.0]
    assert by_month[(0.0, 12.0)] == [0.0, 888.0, 12.0]


def test_sampler_runs_between_label_and_drop(cleaned):
    seen = []

    def sampler(df):
        seen.append(df)
        return df

    model.ml_input(cleaned, sampler=sampler)
    assert model.LABEL in seen[0].columns and seen[0].count() == 8


def test_carrier_index(spark):
    names = ["b", "a", "c", "c", None, "b", "a", "d"]
    df = spark.createDataFrame([(n,) for n in names], "OP_UNIQUE_CARRIER string")
    index = {r.OP_UNIQUE_CARRIER: r.CARRIER_INDEX for r in model.carrier_index(df).collect()}
    assert index == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_tree_finds_the_planted_rule(planted):
    labelled = model.ml_input(planted)
    fitted = model.train(labelled)
    accuracy = model.evaluate(model.score(fitted, labelled)).first()
    majority = 1 - labelled.agg(F.avg(model.LABEL)).first()[0]
    assert accuracy.metric == "accuracy"
    assert majority < 0.95 and accuracy.value > 0.999
    importance = model.feature_importance(fitted).collect()
    assert [r.feature for r in importance] == ["CARRIER", "DISTANCE", "MONTH"]
    assert sum(r.impact for r in importance) == pytest.approx(100.0)
    assert importance[1].impact < 1.0


def test_predictions_agree_with_evaluator(planted):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    labelled = model.ml_input(planted)
    predictions = model.score(model.train(labelled, max_depth=1), labelled)
    evaluator = MulticlassClassificationEvaluator(
        labelCol=model.LABEL, predictionCol="prediction", metricName="accuracy"
    )
    assert model.evaluate(predictions).first().value == pytest.approx(evaluator.evaluate(predictions))


def test_depth_is_bounded(planted):
    shape = model.describe_model(model.train(model.ml_input(planted), max_depth=2)).first()
    assert shape.depth <= 2 and (shape.features, shape.classes, shape.carriers) == (3, 2, 4)


def test_numeric_and_categorical_carriers(planted):
    labelled = model.ml_input(planted)
    metadata = {
        kind: model.ml_features(labelled, categorical=kind).schema["CARRIER_INDEX"].metadata
        for kind in (False, True)
    }
    assert metadata[False] == {} and metadata[True]["ml_attr"]["type"] == "nominal"


def test_many_carriers_as_categories(planted):
    many = planted.withColumn(
        "OP_UNIQUE_CARRIER", F.concat(F.lit("C"), (F.hash("DISTANCE", "FL_DATE") % 40).cast("string"))
    )
    labelled = model.ml_input(many)
    fitted = model.train(labelled, categorical=True)
    assert len(fitted.stages[0].labels) > model.DEFAULT_BINS
    assert fitted.stages[-1].getMaxBins() == len(fitted.stages[0].labels)


def test_unseen_carrier_is_skipped(planted):
    labelled = model.ml_input(planted)
    known = labelled.filter("OP_UNIQUE_CARRIER <> 'C3'")
    n, n_known = labelled.count(), known.count()
    assert model.score(model.train(known), labelled).count() == n_known
    assert model.score(model.train(known, index_on=labelled), labelled).count() == n


def test_model_can_be_saved(planted, tmp_path):
    labelled = model.ml_input(planted)
    fitted = model.train(labelled)
    fitted.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    both = [model.score(m, labelled).groupBy("prediction").count().orderBy("prediction").collect()
            for m in (fitted, again)]
    assert both[0] == both[1]


def test_top_feature(spark):
    rows = [(0, "CARRIER", 40.0), (1, "DISTANCE", 20.0), (2, "MONTH", 40.0)]
    importance = spark.createDataFrame(rows, "position int, feature string, impact double")
    assert model.top_feature(importance).first().feature == "MONTH"


def test_evaluate_nothing(spark):
    none = spark.createDataFrame([], "IS_DELAYED double, prediction double")
    assert [tuple(r) for r in model.evaluate(none).collect()] == [("accuracy", None)]


def test_tally_trains_the_same_tree(planted):
    """Noise on top of the rule makes a deep tree; rows and tally must agree on it."""
    noisy = planted.withColumn(
        "ARR_DELAY", F.when(F.pmod(F.xxhash64("FL_DATE", "DISTANCE", "OP_UNIQUE_CARRIER"), F.lit(5)) == 0, 40.0)
        .otherwise(F.col("ARR_DELAY"))
    )
    rows = model.ml_input(noisy)
    counted = model.tally(rows)
    assert counted.count() < rows.count() == counted.agg(F.sum("flights")).first()[0]
    trees = [model.train(rows), model.train(counted, weight="flights")]
    texts = ["\n".join(t.stages[-1].toDebugString.splitlines()[1:]) for t in trees]
    assert trees[0].stages[0].labels == trees[1].stages[0].labels
    assert texts[0] == texts[1] and texts[0].count("If") > 50
    by_row = model.evaluate(model.score(trees[0], rows)).first().value
    by_tally = model.evaluate(model.score(trees[1], counted, "flights"), "flights").first().value
    assert by_row == pytest.approx(by_tally)


def test_tally_counts_rows_without_a_month(cleaned):
    counted = model.tally(model.ml_input(cleaned))
    assert counted.agg(F.sum("flights")).first()[0] == 7
    assert counted.filter("FL_DATE IS NULL").count() == 1


def test_weighted_carrier_index(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 5), ("c", 2), ("c", 3), (None, 9)], "OP_UNIQUE_CARRIER string, flights bigint"
    )
    assert model.fit_carrier_index(df, "flights").labels == ["b", "c", "a"]
