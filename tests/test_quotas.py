"""Exact quotas, out-of-fold encoding, bootstrap intervals and clustered files."""

import glob

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from punctuality.functions.hashing import BUCKETS
from punctuality.operators import encoding, interval, quotas
from punctuality.sources.flights import land, read_landed


def counts_of(df, *by):
    return {tuple(r[c] for c in by): (r.n, r.chosen) for r in df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("chosen").alias("chosen")).collect()}


@pytest.mark.parametrize("per_mille", [0, 1, 50, 700, 1000])
@pytest.mark.parametrize("prefixes", [1 << 16, 4])
def test_quota_is_exact(spark, monkeypatch, per_mille, prefixes):
    monkeypatch.setattr(quotas, "PREFIXES", prefixes)
    sizes = {"hot": 3000, "rare": 7, "single": 1, None: 40}
    rows = [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, s string")
    found = quotas.with_quota(df.repartition(5), ["s"], ["k"], per_mille)
    assert counts_of(found, "s") == {(s,): (n, (n * per_mille + 500) // 1000) for s, n in sizes.items()}
    again = quotas.with_quota(df.repartition(3), ["s"], ["k"], per_mille)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found.collect()), key=repr)


def test_quota_of_equal_rows_and_none(spark):
    df = spark.createDataFrame([("same", 1)] * 100 + [("other", 1)], "k string, s int")
    assert counts_of(quotas.with_quota(df, ["s"], ["k"], 300), "s") == {(1,): (101, 30)}
    assert quotas.stratified_sample(df, [], ["k"], 500).count() == 51
    assert quotas.with_quota(df.limit(0), ["s"], ["k"], 500).count() == 0
    with pytest.raises(ValueError, match="chosen"):
        quotas.with_quota(df.withColumn("chosen", F.lit(1)), ["s"], ["k"], 500)
    assert quotas.PREFIXES < BUCKETS


def test_quota_sorts_no_stratum(spark):
    """What is ranked is the border prefix only, and the histogram is counted before it moves."""
    df = spark.range(10_000).selectExpr("id AS k", "id % 2 AS s")
    plan = quotas.with_quota(df, ["s"], ["k"], 500)._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "row_number" in line)
    below = plan[plan.index(window):]
    assert "_prefix" in below and "= _end" in below.replace("#", " #").replace("  ", " ") or "(_prefix#" in below


def many_carriers(spark, n=6000, carriers=500):
    rng = np.random.default_rng(1)
    late = rng.random(carriers) < 0.5
    of = rng.integers(0, carriers, n)
    label = np.where(rng.random(n) < 0.9, late[of], ~late[of]).astype(float)
    return spark.createDataFrame(
        [(i, f"C{c}", float(y)) for i, (c, y) in enumerate(zip(of.tolist(), label.tolist(), strict=True))], "id int, c string, y double"
    )


def test_encoding_leaves_the_own_fold_out(spark):
    rows = [(i, c, y) for i, (c, y) in enumerate([("a", 1.0), ("a", 0.0), ("a", 1.0), ("b", 1.0), ("b", 1.0), (None, 1.0), ("c", 0.0), ("d", None)])]
    df = spark.createDataFrame(rows, "id int, c string, y double")
    found = encoding.encode(df, "c", "y", ["id"], "rate", folds=3, weight=2.0)
    assert found.columns == ["id", "c", "y", "rate"] and found.count() == len(rows)
    fold = dict(map(tuple, df.select("id", F.pmod(encoding.row_bucket(["id"], encoding.SEED + 2), F.lit(3)).cast("int")).collect()))
    known = [(i, c, y) for i, c, y in rows if c is not None and y is not None]
    prior = sum(y for _, _, y in known) / len(known)
    for i, c, _, rate in map(tuple, found.collect()):
        others = [y for j, d, y in known if d == c and fold[j] != fold[i]]
        want = (sum(others) + 2.0 * prior) / (len(others) + 2.0)
        assert rate is None if c in (None, "d") else rate == pytest.approx(want)


def test_tally_gives_the_same_means(spark):
    df = many_carriers(spark, 900, 20).withColumn("fold", F.col("id") % 4)
    tally = df.groupBy("c", "y", "fold").agg(F.count("*").alias("k"))
    plain = encoding.fold_means(df, "c", "y", "fold")
    counted = encoding.fold_means(tally, "c", "y", "fold", count="k")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, counted.collect()))
    assert encoding.fold_means(df.limit(0), "c", "y", "fold").count() == 0


def test_tree_with_500_carriers(spark):
    """An index is more than the tree's bins hold; the encoding tells late carriers from others."""
    df = many_carriers(spark)
    indexed = StringIndexer(inputCol="c", outputCol="index").fit(df).transform(df)
    vector = VectorAssembler(inputCols=["index"], outputCol="features").transform(indexed)
    with pytest.raises(Exception, match="maxBins"):
        DecisionTreeClassifier(labelCol="y", maxBins=32).fit(vector)
    encoded = encoding.encode(df, "c", "y", ["id"], "rate")
    vector = VectorAssembler(inputCols=["rate"], outputCol="features").transform(encoded)
    fitted = DecisionTreeClassifier(labelCol="y", maxDepth=3).fit(vector)
    right = fitted.transform(vector).select(F.avg((F.col("y") == F.col("prediction")).cast("int"))).first()[0]
    assert right > 0.8


def test_interval_holds_the_accuracy(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(y), float(y if rng.random() < 0.8 else 1 - y)) for i, y in enumerate(rng.integers(0, 2, 3000))]
    df = spark.createDataFrame(rows, "id int, y double, p double")
    found = dict(map(tuple, interval.accuracy_interval(df, "y", "p", ["id"]).collect()))
    accuracy = sum(y == p for _, y, p in rows) / len(rows)
    spread = (accuracy * (1 - accuracy) / len(rows)) ** 0.5
    assert found["rows"] == 3000 and found["accuracy"] == pytest.approx(accuracy)
    assert found["base_rate"] == pytest.approx(max(np.mean([y for _, y, _ in rows]), 1 - np.mean([y for _, y, _ in rows])))
    assert found["low"] < accuracy < found["high"]
    assert 2.5 * spread < found["high"] - found["low"] < 5.5 * spread
    again = dict(map(tuple, interval.accuracy_interval(df.repartition(7), "y", "p", ["id"]).collect()))
    assert again == found


def test_replicates_draw_poisson_numbers(spark):
    weights = interval.replicate_weights(["id"], 16)
    drawn = np.array([r[0] for r in spark.range(3000).select(weights).collect()])
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.05
    assert abs((drawn == 0).mean() - np.exp(-1)) < 0.01
    assert np.abs(np.corrcoef(drawn.T) - np.eye(16)).max() < 0.08


def test_interval_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 1.0)], "id int, y double, p double")
    found = dict(map(tuple, interval.accuracy_interval(df, "y", "p", ["id"]).collect()))
    assert found == {"rows": 0.0, "accuracy": None, "base_rate": None, "low": None, "high": None}


def test_point_filter_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "CONCAT('O', LPAD(CAST(id * 7919 % 300 AS STRING), 3, '0')) AS ORIGIN", "CONCAT('C', id % 17) AS CARRIER",
        "CAST(DATE_ADD(DATE'2001-01-01', CAST(id % 300 AS INT)) AS STRING) AS FL_DATE", "MD5(CAST(id AS STRING)) AS filler",
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    land(rows, plain, row_group_bytes=100_000)
    land(rows, clustered, cluster=("ORIGIN", "CARRIER"), row_group_bytes=100_000)

    def groups(path):
        held = total = 0
        for name in glob.glob(f"{path}/FL_YEAR=*/*.parquet"):
            meta = pq.ParquetFile(name).metadata
            at = meta.schema.names.index("ORIGIN")
            for i in range(meta.num_row_groups):
                bounds = meta.row_group(i).column(at).statistics
                total += 1
                held += bounds.min <= "O123" <= bounds.max
        return held, total

    (every, n_plain), (few, n_clustered) = groups(plain), groups(clustered)
    assert n_plain > 8 and n_clustered > 8 and every > 0.9 * n_plain and few <= 0.25 * n_clustered
    wanted = "ORIGIN = 'O123'"
    found = sorted(map(tuple, read_landed(spark, clustered).filter(wanted).collect()))
    assert found == sorted(map(tuple, read_landed(spark, plain).filter(wanted).collect())) and len(found) == 200
    text = read_landed(spark, clustered).filter(wanted)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ORIGIN,O123)" in text
