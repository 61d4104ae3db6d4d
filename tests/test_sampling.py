import pytest
from pyspark.sql import functions as F

from punctuality.functions.hashing import BUCKETS, row_bucket
from punctuality.operators import sampling

N = 20_000


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(N).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("portable", [False, True])
def test_keyed_sample_is_stable(numbers, portable):
    take = lambda df: ids(sampling.sample_by_key(df, 0.05, keys=["id"], portable=portable))
    first = take(numbers)
    assert first == take(numbers.repartition(3)) == take(numbers.repartition(11, "name"))
    assert abs(len(first) - 0.05 * N) < 5 * (0.05 * 0.95 * N) ** 0.5
    assert first != ids(sampling.sample_by_key(numbers, 0.05, keys=["id"], seed=7, portable=portable))


def test_sample_bounds(numbers):
    assert sampling.sample_by_key(numbers, 1.0).count() == N
    assert sampling.sample_by_key(numbers, 0.0).count() == 0


def test_hot_key_needs_a_row_key(spark):
    """A third of all rows share one name; with all columns as key they still split evenly."""
    df = spark.range(N).withColumn("name", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold"))
    hot = sampling.sample_by_key(df, 0.1).filter("name = 'hot'").count()
    assert abs(hot - 0.1 * N / 3) < 5 * (0.09 * N / 3) ** 0.5


@pytest.mark.parametrize("portable", [False, True])
def test_keyed_split_covers_all_rows_once(numbers, portable):
    parts = sampling.split_by_key(numbers, (0.5, 0.3, 0.2), keys=["id"], portable=portable)
    found = [ids(p) for p in parts]
    assert sorted(sum(found, [])) == list(range(N))
    for part, share in zip(found, (0.5, 0.3, 0.2), strict=True):
        assert abs(len(part) - share * N) < 5 * (share * (1 - share) * N) ** 0.5


def test_split_is_independent_of_the_sample(numbers):
    sample = sampling.sample_by_key(numbers, 0.2, keys=["id"])
    n = sample.count()
    train, _ = sampling.split_by_key(sample, (0.7, 0.3), keys=["id"])
    assert abs(train.count() - 0.7 * n) < 5 * (0.21 * n) ** 0.5


def test_missing_keys_have_a_bucket(spark):
    df = spark.sql("SELECT * FROM VALUES (CAST(NULL AS STRING), 1), ('a', NULL) AS t(s, i)")
    for portable in (False, True):
        values = [r[0] for r in df.select(row_bucket(["s", "i"], 1, portable)).collect()]
        assert all(0 <= v < BUCKETS for v in values)


def test_random_draws(numbers):
    sample = sampling.sample_rows(numbers)
    assert ids(sample) == ids(sampling.sample_rows(numbers))
    assert len(set(ids(sample))) == sample.count() > 0
    train, test = sampling.split_rows(numbers)
    assert sorted(ids(train) + ids(test)) == list(range(N))
    assert abs(train.count() - 0.7 * N) < 500
