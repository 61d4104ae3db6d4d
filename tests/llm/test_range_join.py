"""The metric range join against comparing all pairs."""

import numpy as np
import pytest

from punctuality.llm import range_join

THRESHOLD = 0.95


def table_of(spark, rows, kind="float"):
    rows = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    return df.selectExpr("vec_id", "embedding", "'x' AS node", "'x' AS v", "'x' AS n", "'x' AS root", "'x' AS cell")


def found_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(rows):
    """All pairs, in double precision."""
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    label, count = list(range(len(rows))), [0] * len(rows)
    near = set()
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and usable[i] and usable[j] and len(a) == len(b):
                a_, b_ = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if a_ @ b_ / np.sqrt(a_ @ a_) / np.sqrt(b_ @ b_) >= THRESHOLD:
                    near.add((i, j))
                    count[i] += 1
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if label[j] < label[i]:
                label[i], changed = label[j], True
    names = {}
    for i, root in enumerate(label):
        if rows[i][0] is not None:
            names[root] = min(names.get(root, rows[i][0]), rows[i][0])
    return sorted(
        ((k, count[i], names.get(label[i]), k is not None and k == names.get(label[i])) for i, (k, _) in enumerate(rows)), key=repr
    )


def clustered(seed, n=260, d=12):
    """Clusters of several widths, a hot one, strays, exact and scaled copies."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, d))
    groups = centers[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.1, 0.25], n)[:, None]
    hot = centers[0] + 0.04 * rng.normal(size=(n // 2, d))
    vectors = np.concatenate([groups, hot, rng.normal(size=(n // 4, d))]).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:15], vectors[5:12] * np.float32(2)])
    return list(zip(rng.permutation(len(vectors)).tolist(), vectors.tolist(), strict=True))


@pytest.mark.parametrize("sizes", [{}, {"cell": 40, "limit": 12, "sample": 150}, {"cell": 90, "limit": 1000}])
def test_links_are_those_of_all_pairs(spark, sizes):
    rows = clustered(1)
    found = range_join.near_vectors(table_of(spark, rows), "vec_id", "embedding", THRESHOLD, **sizes)
    assert found_of(found) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, -0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
        (8, [1e30, 1e29]), (9, [1e-38, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (None, [0.0, 1.0]), (None, [0.0, 2.0]),
        (12, [3.0]), (13, [0.5]), (14, [-0.5]), (None, [-3.0, 0.1]), (15, [1.0, -0.0]),
    ]
    for sizes in ({}, {"cell": 2, "limit": 1}):
        found = range_join.near_vectors(table_of(spark, rows), "vec_id", "embedding", THRESHOLD, **sizes)
        assert found_of(found) == brute(rows)
    assert range_join.near_vectors(table_of(spark, []), "vec_id", "embedding").count() == 0


def test_double_vectors_at_the_threshold(spark):
    """A pair exactly at the threshold is linked, one just below is not, which single precision can't tell."""
    rows = [(1, [1.0, 0.0]), (2, [0.95, float(np.sqrt(1 - 0.95**2))]), (3, [0.95 - 1e-9, -float(np.sqrt(1 - (0.95 - 1e-9) ** 2))])]
    found = range_join.near_vectors(table_of(spark, rows, "double"), "vec_id", "embedding", 0.95)
    assert found_of(found) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    for wrong in (0.3, 1.0):
        with pytest.raises(ValueError, match="cosine"):
            range_join.near_vectors(table_of(spark, rows), "vec_id", "embedding", wrong)


def test_hot_group_is_linked_without_pairs(spark, monkeypatch):
    """Members within half a radius of the pivot are counted as a whole: no block of them is compared."""
    rng = np.random.default_rng(5)
    center = rng.normal(size=16)
    center /= np.sqrt(center @ center)
    hot = center + 0.01 * rng.normal(size=(900, 16))
    far = rng.normal(size=(100, 16))
    rows = list(enumerate(np.concatenate([hot, far]).astype(np.float32).tolist()))
    df = table_of(spark, rows)
    classes = range_join._as_bytes(df.selectExpr("embedding AS v", "1L AS n", "vec_id AS node").select("node", "n", "v"), False)
    radius = float(np.sqrt(2 - 2 * THRESHOLD))
    pivots = range_join._pivots(classes, "<f4", radius, 100, 400)
    placed = range_join._placed(classes, "<f4", radius, pivots).filter("home").toPandas()
    core = placed[placed["bucket"] < range_join.BUCKETS // 2 - 1]
    assert len(core) >= 900
    found = {r.vec_id: (r.n_links, r.component_id) for r in range_join.near_vectors(df, "vec_id", "embedding", cell=100, limit=50).collect()}
    assert all(found[i] == (899, 0) for i in range(900))


def test_no_pair_is_lost_between_cells():
    """Of any two rows in range, one is sent to the cell of the other."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(400, 3))
    points /= np.sqrt((points**2).sum(1, keepdims=True))
    radius = 0.3
    pivots = range_join.choose_pivots(points[:60], 12, radius)
    assert len(pivots) > 3
    far = range_join.apart(points, pivots)
    own = far.argmin(1)
    i, j = np.nonzero(range_join.apart(points, points) <= radius)
    assert (np.abs(far[i, own[j]] - far[i, own[i]]) <= 2 * radius + 1e-9).all()
