"""Near-duplicates by SimHash fingerprints, found in BK-trees.

Equal fingerprints are one node. Distinct ones are cut into five blocks of bits; fingerprints that
differ in three bits at most agree on two blocks at least, so each is sent to one shard for each
pair of blocks. A shard's BK-tree keys a node's children by their Hamming distance to it, and a
query at distance d follows only the edges from d - radius to d + radius. Trees go to the tasks that
hold their queries: a broadcast of all trees to all executors would grow with the corpus. A shard
with very many members is cut into several trees of bounded size, and its queries into slices; each
slice meets each tree in a group of its own, so that both sides of a group are bounded.

Cases: a null text has no words; texts without words have fingerprint zero and are linked like any
other. Repeated rows are copies. A row without an id gets its group's smallest id and never gives
one; the id is null if no row of the group has one. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, map_texts
from punctuality.llm.components import components
from punctuality.plans.durable import durable

SEED = 42
WIDTHS = (13, 13, 13, 13, 12)  # bits of the blocks
TREE = 8192  # most members of a tree, about
SLICE = 1 << 15  # most queries that visit a tree together, about
BATCH = 1 << 16  # members of trees that are built together


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of a whole text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


class BKForest:
    """BK-trees of many shards at once. ``points`` are distinct within a tree."""

    def __init__(self, points: np.ndarray, tree: np.ndarray):
        """``tree``: the number of each point's tree, in ascending order."""
        self.points = points
        names, self.roots, inverse = np.unique(tree, return_index=True, return_inverse=True)
        self.names = names
        items = np.setdiff1d(np.arange(len(points)), self.roots)
        at, edges, nodes = self.roots[inverse[items]], [], []
        while len(items):
            # A node and a distance name an edge; the first to come along it is the child.
            edge = at * 65 + np.bitwise_count(points[items] ^ points[at])
            new, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(new)
            nodes.append(items[first])
            left = np.ones(len(items), bool)
            left[first] = False
            at, items = items[first][inverse][left], items[left]
        edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
        order = np.argsort(edge)
        self.edges = edge[order]
        self.children = np.concatenate(nodes)[order] if nodes else np.empty(0, np.int64)

    def within(self, queries: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and point numbers at ``radius`` or less, each query in its own tree."""
        query, node = np.arange(len(queries)), self.roots[np.searchsorted(self.names, tree)]
        left, right = [], []
        while len(query):
            d = np.bitwise_count(queries[query] ^ self.points[node]).astype(np.int64)
            near = d <= radius
            left.append(query[near])
            right.append(node[near])
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right") - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return np.concatenate(left), np.concatenate(right)


class Union:
    """Groups of numbers, each known by its smallest."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            np.minimum.at(self.label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def links(key: np.ndarray, points: np.ndarray, in_tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the points of each shard ``key`` that are near each other."""
    members = np.flatnonzero(in_tree)
    forest, union = BKForest(points[members], key[members]), Union(len(points))
    at, step = 0, 4096
    while at < len(points):
        part = slice(at, at + step)
        a, b = forest.within(points[part], key[part], radius)
        union.join(a + at, members[b])
        at += step
        # Keeps the pairs in memory bounded where most members are near each other.
        step = max(64, min(4096, step * (1 << 20) // max(1, len(a))))
    moved = np.flatnonzero(union.label != np.arange(len(points)))
    return points[moved], points[union.label[moved]]


def dealt(found: DataFrame, radius: int, tree: int = TREE, slice_: int = SLICE) -> DataFrame:
    """``key, tree, in_tree, fp``: each fingerprint at its trees, as a member or as a query."""
    if radius > len(WIDTHS) - 2:
        raise ValueError(f"the blocks find at most {len(WIDTHS) - 2} differing bits")
    starts = [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]
    block = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, WIDTHS, strict=True)]
    pairs = [(i, j) for i in range(len(WIDTHS)) for j in range(i)]
    keys = [F.shiftleft(F.lit(n).cast("bigint"), 26) + F.shiftleft(block[i], 13) + block[j] for n, (i, j) in enumerate(pairs)]
    sent = found.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = sent.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    n = F.col("n")
    trees, slices = F.ceil(n / F.lit(tree)).cast("int"), F.ceil(n / F.lit(slice_)).cast("int")
    own = F.pmod(F.xxhash64("fp"), trees).cast("int")
    asking = F.pmod(F.xxhash64("fp", F.lit(1)), slices).cast("int")
    # As a query it goes to all trees, as a member to all slices of queries.
    groups = F.array_distinct(F.concat(
        F.transform(F.sequence(F.lit(0), trees - 1), lambda t: t * slices + asking),
        F.transform(F.sequence(F.lit(0), slices - 1), lambda s: own * slices + s),
    ))
    sent = sent.join(sizes, "key").select("key", F.explode(groups).alias("tree"), own.alias("own"), slices.alias("slices"), "fp")
    return sent.select("key", "tree", (F.floor(F.col("tree") / F.col("slices")) == F.col("own")).alias("in_tree"), "fp")


def shard_links(found: DataFrame, radius: int, tree: int = TREE, slice_: int = SLICE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all near ones."""
    sent = dealt(found, radius, tree, slice_)
    sent = sent.repartition("key", "tree").sortWithinPartitions("key", "tree", "fp")
    schema = fields("a bigint, b bigint")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, in_tree, points in whole_groups(batches):
            a, b = links(key, points.view(np.uint64), in_tree, radius)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return sent.mapInArrow(linked, schema)


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of sorted batches again, cut only between shards; shards become ascending numbers."""
    kept: list[np.ndarray] = []
    for batch in _with_end(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            key, tree, in_tree, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            rows = np.rec.fromarrays([key, tree, in_tree, fp], names="key,tree,in_tree,fp")
            kept.append(rows)
            if sum(map(len, kept)) < BATCH:
                continue
        if not kept:
            continue
        rows = np.concatenate(kept)
        new = np.concatenate(([True], (rows["key"][1:] != rows["key"][:-1]) | (rows["tree"][1:] != rows["tree"][:-1])))
        end = len(rows) if batch is None else int(np.flatnonzero(new)[-1])
        kept = [rows[end:]]
        if end:
            yield np.cumsum(new[:end]), rows["in_tree"][:end], np.ascontiguousarray(rows["fp"][:end])


def _with_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def fingerprints(df: DataFrame, key_col: str, text_col: str, shingle: int) -> DataFrame:
    """``doc_id, fp`` for each row."""
    rows = df.select(F.col(key_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", fields("fp bigint"), lambda ts: ((fingerprint(t, shingle),) for t in ts)).select("doc_id", "fp")


def near_duplicates(
    df: DataFrame, key_col: str, text_col: str, shingle: int = 3, radius: int = 3, tree: int = TREE, slice_: int = SLICE
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row; ``component_id`` is the smallest id reached."""
    docs = durable(fingerprints(df, key_col, text_col, shingle))
    nodes = docs.groupBy("fp").agg(F.min("doc_id").alias("first"))
    edges = shard_links(nodes.select("fp"), radius, tree, slice_)
    roots = components(edges).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    nodes = nodes.select("fp", "root").join(named, "root")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return docs.join(nodes.select("fp", "component_id"), "fp").select("doc_id", digits, "component_id")


def kept(df: DataFrame, key_col: str, text_col: str, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` that stay: of each group the document with the smallest id.

    A row without an id can't be named as any group's document, so it stays. Rows that repeat an id
    are one document and are kept or dropped together.
    """
    found = near_duplicates(df, key_col, text_col, shingle, radius)
    dropped = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return df.join(dropped, df[key_col] == dropped["_dropped"], "left_anti")
