"""Exact top-k by inner product, score at a time over an impact-ordered index.

Candidates are indexed in blocks of bounded size. A component, less the least of its dimension, is
quantised by significance: its leading bits make the first level, each bit after them one more.
The candidates of a dimension that share a level form a posting segment, whose impact is the level's
weight. Segments are processed by descending quantised impact, those of one significance in all
dimensions at once and for many queries at once. What has been added and what the bits still to come
can add at most and at least bound each candidate's score. A query stops as soon as the bounds prove
that all but a few candidates are out, which on most data the first levels do, or at the end of the
index; those left are scored exactly. Queries go in blocks too, so one task holds one block of each,
whatever the numbers are.

Cases: vectors that are null or hold a null or non-finite component, and rows without an id, take
no part. Only vectors of equal length are compared. A query is not its own candidate, nor are other
rows with its id; repeated candidates count as rows, repeated queries as one. Ties go to the smaller
id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FINE = 3  # bits that are levels of their own; those before them are the first level
FEW = 16  # one of so many candidates may be left for exact scores
BLOCK_BYTES = 32 << 20  # most that a block's vectors and levels take, about
TOGETHER = 64  # queries that share a pass over the segments
SCALE = 256


def integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Ids and integer vectors ``floor(256 * x)`` of the rows that take part."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite)
    return rows.select("id", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


class ImpactIndex:
    """One block of candidates, level by level of significance."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = self.vectors.min(0, initial=np.iinfo(np.int64).max) if len(ids) else np.zeros(vectors.shape[1], np.int64)
        above = self.vectors - self.low
        self.levels = []  # (weight of the level, level of each candidate and dimension)
        shift = int(above.max(initial=0)).bit_length()
        while shift > 0:
            bits = max(1, shift - FINE)
            shift -= bits
            self.levels.append((1 << shift, ((above >> shift) & ((1 << bits) - 1)).astype(np.float64)))
        # Beyond 53 bits sums in double precision are rounded; the bounds leave room for that.
        self.most = float(np.abs(self.vectors).max(initial=0)) * vectors.shape[1]

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query the ``k`` best (id, score), without the rows whose id is its ``own``."""
        found: list[list[tuple[int, int]]] = [[] for _ in queries]
        self.processed = 0  # levels, summed over the queries
        asked = np.arange(len(queries))
        exact = queries.astype(np.float64)
        rising, falling = np.maximum(exact, 0).sum(1), np.maximum(-exact, 0).sum(1)
        slack = np.abs(exact).max(1, initial=0) * self.most * 2.0**-48
        sofar = np.repeat((exact @ self.low)[:, None], len(self.ids), axis=1)
        closed = self.ids == own[:, None]
        for weight, level in [*self.levels, (1, None)]:
            if level is not None:
                self.processed += len(asked)
                sofar += (weight * exact[asked]) @ level.T
            # The bits to come of a component are below the weight of its last level.
            rest = weight - 1
            least = sofar - (rest * falling[asked] + slack[asked])[:, None]
            least[closed] = -np.inf
            possible = np.ones_like(closed)
            if len(self.ids) > k:
                limit = np.partition(least, -k, axis=1)[:, -k]
                possible = sofar + (rest * rising[asked] + slack[asked])[:, None] >= limit[:, None]
            possible &= ~closed
            done = possible.sum(1) <= max(k, len(self.ids) // FEW)
            if level is None or weight == 1:
                done[:] = True
            for i in np.flatnonzero(done):
                at = np.flatnonzero(possible[i])
                score = self.vectors[at] @ queries[asked[i]]
                best = np.lexsort((self.ids[at], -score))[:k]
                found[asked[i]] = list(zip(self.ids[at[best]].tolist(), score[best].tolist(), strict=True))
            sofar, closed, asked = sofar[~done], closed[~done], asked[~done]
            if not len(asked):
                break
        return found


def top_k(
    df: DataFrame, id_col: str, vector_col: str, k: int = 5, every: int = 50,
    block: int = 8192, query_block: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` for each row whose id ``every`` divides."""
    rows = integers(df, id_col, vector_col)
    queries = rows.filter(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    n, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    m = queries.count()
    block = max(64, min(block, BLOCK_BYTES // (8 * (FINE + 2) * max(1, longest))))
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-m // query_block))

    def dealt(table: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        return table.select(
            F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), F.size("v").alias("d"), "id", "v",
        )

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(asked):
            table = lambda df: np.array(df["v"].tolist(), np.int64).reshape(len(df), df["d"].iloc[0])
            index = ImpactIndex(candidates["id"].to_numpy(np.int64), table(candidates))
            for at in range(0, len(asked), TOGETHER):
                part = asked.iloc[at : at + TOGETHER]
                own = part["id"].to_numpy(np.int64)
                for i, key, best in zip(own.tolist(), part["key"], index.top(table(part), own, k), strict=True):
                    found += [(i, key, *b) for b in best]
        return pd.DataFrame(found, columns=["query_id", "key", "vec_id", "score"])

    key = ["block", "query_block", "d"]
    left = dealt(rows, "block", blocks, "query_block", query_blocks)
    right = dealt(queries, "query_block", query_blocks, "block", blocks).withColumn("key", F.xxhash64("v"))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        search, "query_id bigint, key bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
