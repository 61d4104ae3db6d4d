"""Near-duplicate vectors by an exact metric range join.

Unit vectors with cosine c are sqrt(2 - 2c) apart, so "cosine at least t" is a range join of radius
r = sqrt(2 - 2t) in a metric space. Equal vectors are one class first. Pivots, well apart from each
other, partition the classes: each lives in the cell of its nearest pivot. By the triangle inequality,
a class whose distances to another pivot and to its own differ by more than 2r has no partner in that
other cell; all others are replicated across that boundary, in one direction for each pair of cells, so
that each pair of classes meets once. Cells are joined independently. Within a cell, rows are dealt into
slices by their distance to the pivot: slices whose distances differ by more than r never meet, and
slices whose distances sum to r or less are linked as a whole, without a comparison, so that a hot
group around a pivot costs its size only. What is left is compared in blocks: single precision with a
proven margin, then double precision for all that are within the margin. Tasks return counts and a
spanning forest of their links, never pairs.

Data without clusters has no triangle that excludes much: rows then go to nearly all cells, and the
join is the blocked comparison of all with all, shared out over cells and slices.

Cases: a vector that is null, empty, zero or holds a null or non-finite component links with nothing
and is its own component. Only vectors of equal length are compared. Repeated rows are rows of their
own, each linked to the others. A row without an id counts as a vector, is named by the smallest id it
reaches (null if none) and gives no name. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import fields, sampled, small_batches
from punctuality.llm.components import components
from punctuality.llm.simhash import Union
from punctuality.plans.durable import durable

BUCKETS = 64  # steps of distance within one radius
SLACK = 1e-6  # far beyond the rounding of a distance
BLOCK = 1024
PIVOT_BYTES = 16 << 20  # most that pivots take on each executor
SLICE_BYTES = 32 << 20  # most that the vectors of a slice take, about


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision from equally long rows of bytes."""
    vectors = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of two sets of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def choose_pivots(sample: np.ndarray, wanted: int, radius: float) -> np.ndarray:
    """At most ``wanted`` pivots: sampled vectors more than ``radius`` from each other, moved into
    the middle of the sampled vectors around them."""
    chosen = np.empty((0, sample.shape[1]))
    open_ = np.ones(len(sample), bool)
    while open_.any() and len(chosen) < wanted:
        pivot = sample[np.flatnonzero(open_)[0]]
        near = apart(sample, pivot[None])[:, 0] <= radius
        near[np.flatnonzero(open_)[0]] = True
        middle = sample[near].mean(0)
        size = sqrt(middle @ middle)
        chosen = np.vstack([chosen, middle / size if size > 0.5 else pivot])
        open_ &= ~near
    return chosen


def linked_rows(
    left: np.ndarray, left_d: np.ndarray, right: np.ndarray | None, right_d: np.ndarray | None,
    threshold: float, radius: float, left_n: np.ndarray, right_n: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows (weights summed) for each row, and the first row that each hangs together with.

    Rows are unit vectors with their distance to the pivot and the number of rows each stands for;
    without ``right``, pairs within ``left``. Right rows are numbered after the left ones.
    """
    own = right is None
    other, other_d, other_n = (left, left_d, left_n) if own else (right, right_d, right_n)
    base = 0 if own else len(left)
    count = np.zeros(base + len(other))
    single, other_single = left.astype(np.float32), other.astype(np.float32)
    # Rounding of the components and of each of their products and sums.
    margin = np.float32((left.shape[1] + 4) * 2.0**-22)
    union = Union(base + len(other))
    for a in range(0, len(left), BLOCK):
        rows = slice(a, min(a + BLOCK, len(left)))
        for b in range(a if own else 0, len(other), BLOCK):
            cols = slice(b, b + BLOCK)
            low, high = left_d[rows].min(), left_d[rows].max()
            other_low, other_high = other_d[cols].min(), other_d[cols].max()
            if low - other_high > radius + SLACK or other_low - high > radius + SLACK:
                continue
            near = None
            if high + other_high > radius - SLACK:
                product = single[rows] @ other_single[cols].T
                near = product >= np.float32(threshold) - margin
                if not near.any():
                    continue
                x, y = np.nonzero(near & (product <= np.float32(threshold) + margin))
                for at in range(0, len(x), 1 << 14):
                    i, j = x[at : at + (1 << 14)], y[at : at + (1 << 14)]
                    near[i, j] = (left[a + i] * other[b + j]).sum(1) >= threshold
            else:
                near = np.ones((len(left_d[rows]), len(other_d[cols])), bool)
            if own and a == b:
                np.fill_diagonal(near, False)
            count[rows] += near @ other_n[cols]
            if not (own and a == b):
                count[base + b : base + b + near.shape[1]] += left_n[rows] @ near
            # Each row and its first partner, and each column and its first: then what is left apart.
            hit = near.any(1)
            i = np.flatnonzero(hit)
            union.join(a + i, base + b + near[i].argmax(1))
            j = np.flatnonzero(near.any(0))
            union.join(a + near[:, j].argmax(0), base + b + j)
            while True:
                label, label_other = union.label[rows], union.label[base + b : base + b + near.shape[1]]
                i = np.flatnonzero((near & (label[:, None] != label_other[None])).any(1))
                if not len(i):
                    break
                first = (near[i] & (label[i, None] != label_other[None])).argmax(1)
                union.join(a + i, base + b + first)
    return count, union.label


def near_vectors(
    df: DataFrame, id_col: str, vector_col: str, threshold: float = 0.95,
    cell: int = 16384, limit: int = 8192, sample: int = 16384,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row.

    ``cell`` classes are aimed at for a cell, at most twice ``limit`` rows are in a slice, fewer if the
    vectors are long, and pivots come from about ``sample`` rows by hash, which also bounds what the
    driver sees.
    """
    if not 0.5 <= threshold < 1:
        raise ValueError("the threshold is a cosine from 0.5 to below 1")
    radius = sqrt(2 - 2 * threshold)
    wide = df.schema[vector_col].dataType.elementType.simpleString() != "float"
    kind = "<f8" if wide else "<f4"
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    if wide:
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.col("v")))
    classes = rows.filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    # Numbers are given before the table is kept, so they hold for all that reads it.
    classes = durable(classes.withColumn("node", F.monotonically_increasing_id()))
    found = _cell_links(_as_bytes(classes, wide), kind, threshold, radius, cell, limit, sample)
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = classes.join(counted, "node", "left").join(roots, "node", "left")
    nodes = durable(nodes.select("v", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    names = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    nodes = nodes.join(names, "root").select("v", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.filter("v IS NOT NULL").join(nodes, "v").select("vec_id", "n_links", "component_id")
    alone = rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _as_bytes(classes: DataFrame, wide: bool) -> DataFrame:
    """``node, n, d, v`` with the vectors as bytes, which move faster than arrays."""
    kind, schema = ("<f8" if wide else "<f4"), fields("node bigint, n bigint, d int, v binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values, ends = lists.flatten().to_numpy().astype(kind), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            raw = [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            sizes = pa.array(np.diff(ends), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(raw, pa.binary())], names=schema.fieldNames())

    return small_batches(classes.select("node", "n", "v")).mapInArrow(run, schema)


def _pivots(classes: DataFrame, kind: str, radius: float, cell: int, sample: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors that the sample holds; the bytes of all are bounded."""
    total, size = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("v")), F.lit(0))).first()
    if total <= cell:
        return {}
    # Long vectors are fewer, so that their bytes stay bounded too.
    sample = max(2, min(sample, PIVOT_BYTES * total // size))
    drawn = classes.filter(sampled(F.col("node"), sample, total)).select("d", "v").limit(2 * sample).collect()
    pivots = {}
    by_length: dict[int, list[bytes]] = {}
    for r in drawn:
        by_length.setdefault(r.d, []).append(bytes(r.v))
    for d, raw in by_length.items():
        share = len(raw) / len(drawn)
        wanted = min(-(-round(total * share) // cell), PIVOT_BYTES // len(by_length) // (8 * d))
        if wanted > 1:
            pivots[d] = choose_pivots(unit(raw, kind), wanted, radius)
    return pivots


def _placed(classes: DataFrame, kind: str, radius: float, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Each class in its own cell (``home``) and in those whose boundary it is near."""
    schema = fields("d int, cell int, home boolean, bucket int, distance double, node bigint, n bigint, v binary")
    gaps = {d: np.maximum(apart(p, p), 1e-9) for d, p in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, d = (batch.column(i).to_numpy() for i in range(3))
            raw = batch.column(3).to_pylist()
            for length in np.unique(d):
                at = np.flatnonzero(d == length)
                points = pivots.get(int(length))
                if points is None:  # one cell around the origin: all are as far from it
                    row, column, far, own = np.arange(len(at)), np.zeros(len(at), int), np.ones((len(at), 1)), np.zeros(len(at), int)
                else:
                    far = apart(unit([raw[i] for i in at], kind), points)
                    own = far.argmin(1)
                    nearest = far[np.arange(len(at)), own]
                    # The triangle inequality leaves differences up to 2r; in Euclidean space the distance
                    # to the plane between two pivots says the same more sharply.
                    plane = (far**2 - nearest[:, None] ** 2) / (2 * gaps[int(length)][own])
                    close = (far - nearest[:, None] <= 2 * radius + SLACK) & (plane <= radius + SLACK)
                    # Of two cells, one takes the other's rows; which one alternates.
                    j = np.arange(len(points))
                    takes = (own[:, None] < j) == ((own[:, None] + j) % 2 == 0)
                    row, column = np.nonzero((close & takes & (own[:, None] != j)) | (own[:, None] == j))
                distance = far[row, column]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), length, np.int32)), pa.array(column.astype(np.int32)), pa.array(own[row] == column),
                    pa.array((distance / radius * BUCKETS).astype(np.int32)), pa.array(distance),
                    pa.array(node[at][row]), pa.array(n[at][row]), pa.array([raw[at[i]] for i in row], pa.binary()),
                ], names=schema.fieldNames())

    return small_batches(classes).mapInArrow(run, schema)


def _cell_links(
    classes: DataFrame, kind: str, threshold: float, radius: float, cell: int, limit: int, sample: int
) -> DataFrame:
    """``node, links, root``: for each task that links a class, how many rows, and what it hangs on."""
    pivots = _pivots(classes, kind, radius, cell, sample)
    placed = _placed(classes, kind, radius, pivots)
    side = ["d", "cell", "home"]
    # A row for each cell and step of distance, whatever the number of vectors.
    steps = placed.groupBy(*side, "bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.min("node").alias("first"))
    before = F.sum("rows").over(Window.partitionBy(*side).orderBy("bucket")) - F.col("rows")
    most = F.greatest(F.lit(1), F.least(F.lit(limit), F.floor(F.lit(SLICE_BYTES) / (8 * F.col("d")))))
    steps = durable(steps.withColumn("slice", F.floor(before / most)).withColumn("parts", F.ceil(F.col("rows") / most)))
    whole = 2 * (F.col("bucket") + 1) <= BUCKETS - 1
    # Home rows within half a radius of the pivot are all linked: sums instead of pairs.
    core = steps.filter(F.col("home") & whole).groupBy("d", "cell").agg(F.sum("n").alias("core_n"), F.min("first").alias("core_first"))
    in_core = F.coalesce(F.col("home") & whole, F.lit(False))
    span = steps.select(*side, in_core.alias("core"), F.explode(F.sequence("slice", F.col("slice") + F.col("parts") - 1)).alias("slice"), "bucket")
    span = span.groupBy(*side, "core", "slice").agg(F.min("bucket").alias("low"), F.max("bucket").alias("high"))
    a, b = span.filter("home").alias("a"), span.alias("b")
    reach = (F.col("b.low") - F.col("a.high") <= BUCKETS + 2) & (F.col("a.low") - F.col("b.high") <= BUCKETS + 2)
    # Two home slices meet once, core with core never.
    once = ~F.col("b.home") | (F.struct("a.core", "a.slice") <= F.struct("b.core", "b.slice"))
    apart_cores = ~(F.col("a.core") & F.col("b.core"))
    meetings = durable(
        a.join(b, (F.col("a.d") == F.col("b.d")) & (F.col("a.cell") == F.col("b.cell")) & reach & once & apart_cores).select(
            "a.d", "a.cell", F.col("a.core").alias("a_core"), F.col("a.slice").alias("a_slice"),
            F.col("b.home").alias("b_home"), F.col("b.core").alias("b_core"), F.col("b.slice").alias("b_slice"),
            F.xxhash64("a.d", "a.cell", "a.core", "a.slice", "b.home", "b.core", "b.slice").alias("task"),
        )
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = placed.join(steps.select(*side, "bucket", "slice", "parts"), [*side, "bucket"]).select(
        *side, in_core.alias("core"), (F.col("slice") + part).alias("slice"), "distance", "node", "n", "v"
    )
    key = ["task", "d", "cell", "a_core", "a_slice", "b_home", "b_core", "b_slice"]
    row = ["distance", "node", "n", "v"]
    left = dealt.filter("home").withColumnsRenamed({"core": "a_core", "slice": "a_slice"}).drop("home")
    left = left.join(meetings, ["d", "cell", "a_core", "a_slice"]).select(*key, *row)
    right = dealt.withColumnsRenamed({"home": "b_home", "core": "b_core", "slice": "b_slice"})
    other = ~(F.col("b_home") & (F.col("a_core") == F.col("b_core")) & (F.col("a_slice") == F.col("b_slice")))
    right = right.join(meetings.filter(other), ["d", "cell", "b_home", "b_core", "b_slice"])
    right = right.select(*[F.col(c).alias(c) for c in (*key, *row)])  # names of its own, told apart from the left ones

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        same = len(one) and bool(one["b_home"].iloc[0]) and (one["a_core"].iloc[0], one["a_slice"].iloc[0]) == (one["b_core"].iloc[0], one["b_slice"].iloc[0])
        if not len(one) or not len(two) and not same:
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        one, two = one.sort_values(["distance", "node"]), two.sort_values(["distance", "node"])
        node = one["node"].to_numpy() if same else np.concatenate([one["node"].to_numpy(), two["node"].to_numpy()])
        right = (None, None, None) if same else (unit(list(two["v"]), kind), two["distance"].to_numpy(), two["n"].to_numpy(np.float64))
        count, first = linked_rows(
            unit(list(one["v"]), kind), one["distance"].to_numpy(), right[0], right[1], threshold, radius,
            one["n"].to_numpy(np.float64), right[2],
        )
        at = np.flatnonzero(count)
        return pd.DataFrame({"node": node[at], "links": count[at].astype(np.int64), "root": node[first[at]]})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "node bigint, links bigint, root bigint")
    cores = dealt.filter("core").join(core, ["d", "cell"]).select(
        "node", (F.col("core_n") - F.col("n")).alias("links"), F.col("core_first").alias("root")
    ).filter("links > 0")
    return durable(found.union(cores))
