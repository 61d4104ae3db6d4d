"""Ranked lexical search with range-maximum tables over posting lists.

One pass over the documents finds their length and how often they hold a term of an item; frequencies
and lengths are summed over all documents. Each task then takes its documents in shards of bounded
size. A shard has a posting list for each term, in the order of its documents, and over it a sparse
table that answers in constant time where the greatest impact of any stretch is. A search starts with
the whole shard as one interval. The sum of its terms' maxima bounds all scores in an interval. The
intervals with the greatest bounds are split first, each at the document that has the maximum impact of
the interval; that document is scored exactly, the parts beside it get bounds of their own. The search
ends when no interval can hold a score as good as the last of the best found, in this or an earlier
shard of the task. Documents with the same weightiest term lie side by side, so that intervals are alike.

Items go in blocks whose terms are few enough to be sent to each task; one block is enough for some
thousand items. Documents are not shuffled, and a task gives at most ``k`` rows for each item.

Cases: a null text, or one without any term, is not counted in N, L and df. Documents that repeat are
documents of their own. A document without an id is ranked after others of its score. Items that
repeat with the same text are one; an item without terms, or one that no document shares a term with,
gives no rows. Texts are read whole. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import fields, rows_to_batch, small_batches
from punctuality.plans.durable import durable

# All that is no letter or digit of ASCII separates terms; capitals become small.
_TERM = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()
VOCABULARY = 200_000  # terms of a block of items, about
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 19
WIDTH = 1 << 14  # ranges that one step of a search measures
KEPT = 1 << 22  # ranges that a search holds


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order."""
    return (text or "").encode("utf-8", "replace").translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Shard:
    """Posting lists of some documents, one after the other, with a range-maximum table over all.

    ``count``: postings of each document; ``term`` and ``value``: of each posting, document by document.
    """

    def __init__(self, count: np.ndarray, term: np.ndarray, value: np.ndarray, weights: np.ndarray):
        self.n = len(count)
        # The weightiest term of each document says where it lies.
        heavy = np.full(self.n, -1)
        some = np.flatnonzero(count)
        starts = (np.cumsum(count) - count)[some]
        if len(some):
            heavy[some] = np.maximum.reduceat(weights[term] * len(weights) + term, starts)
        self.order = np.argsort(heavy, kind="stable")
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        key = term.astype(np.int64) * self.n + np.repeat(place, count)
        by_list = np.argsort(key)
        self.key, self.value = key[by_list], value[by_list].astype(np.int64)
        self.place = (self.key % max(1, self.n)).astype(np.int32)
        longest = int(np.bincount(term).max(initial=1))
        # best[k][i]: the place of the greatest of 2**k values from i on. Lists are never crossed, as
        # no range that is asked for does.
        self.best = np.zeros((longest.bit_length(), max(1, len(key))), np.int32)
        self.best[0, : len(key)] = np.arange(len(key))
        for k in range(1, len(self.best)):
            half, size = 1 << (k - 1), len(key) - (1 << k) + 1
            left, right = self.best[k - 1, :size], self.best[k - 1, half : half + size]
            self.best[k, :size] = np.where(self.value[left] >= self.value[right], left, right)

    def measure(self, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each row of ranges, and the place of the document with the greatest impact."""
        size = high - low
        k = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        empty = size <= 0
        left = self.best[k, np.where(empty, 0, low)]
        right = self.best[k, np.where(empty, 0, high - (1 << k))]
        top = np.where(self.value[left] >= self.value[right], left, right)
        most = np.where(empty, 0, self.value[top] * weights)
        return most.sum(1), self.place[top[np.arange(len(top)), most.argmax(1)]]

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Put the documents that rank among the ``best`` there; gives how many were scored."""
        ends = np.searchsorted(self.key, np.concatenate([wanted * self.n, (wanted + 1) * self.n]))
        here = ends[: len(wanted)] < ends[len(wanted) :]
        wanted, weights = wanted[here], weights[here]
        if not len(wanted):
            return 0
        scored, step, batch = 0, max(1, KEPT // len(wanted)), max(1, WIDTH // len(wanted))
        for start in range(0, self.n, step):
            stretch = np.array([[start], [min(start + step, self.n)]])
            ends = np.searchsorted(self.key, wanted * self.n + stretch).astype(np.int32)
            low, high = ends[:1], ends[1:]
            bound, at = self.measure(low, high, weights)
            while True:
                possible = bound >= best.limit
                if not possible.all():
                    low, high, bound, at = low[possible], high[possible], bound[possible], at[possible]
                if not len(bound):
                    break
                if len(bound) > batch:
                    first = np.argpartition(-bound, batch - 1)
                    now, later = first[:batch], first[batch:]
                else:
                    now, later = np.arange(len(bound)), np.arange(0)
                cut = np.searchsorted(self.key, wanted * self.n + at[now, None]).astype(np.int32)
                held = (cut < high[now]) & (self.place[np.minimum(cut, len(self.place) - 1)] == at[now, None])
                score = np.where(held, self.value[np.minimum(cut, len(self.value) - 1)] * weights, 0).sum(1)
                best.put(score, self.order[at[now]])
                scored += len(now)
                new_low, new_high = np.concatenate([low[now], cut + held]), np.concatenate([cut, high[now]])
                new_bound, new_at = self.measure(new_low, new_high, weights)
                open_ = new_bound >= best.limit
                low, high = np.concatenate([low[later], new_low[open_]]), np.concatenate([high[later], new_high[open_]])
                bound, at = np.concatenate([bound[later], new_bound[open_]]), np.concatenate([at[later], new_at[open_]])
        return scored


class Best:
    """The ``k`` best documents of one item so far; equal scores go by id, those without one last."""

    def __init__(self, k: int):
        self.k, self.limit = k, 1
        self.score, self.missing, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.ids: np.ndarray | None = None

    def within(self, ids: np.ndarray, missing: np.ndarray) -> Best:
        """The same, where documents now are numbers into these ids."""
        self.ids, self.without = ids, missing
        return self

    def put(self, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.limit
        if not good.any():
            return
        self.score = np.concatenate([self.score, score[good]])
        self.missing = np.concatenate([self.missing, self.without[doc[good]]])
        self.id = np.concatenate([self.id, self.ids[doc[good]]])
        order = np.lexsort((self.id, self.missing, -self.score))[: self.k]
        self.score, self.missing, self.id = self.score[order], self.missing[order], self.id[order]
        if len(order) == self.k:
            self.limit = max(1, int(self.score[-1]))


def counted(docs: DataFrame, key_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each document that has a term, with those of its terms that have a number."""
    schema = fields("doc_id bigint, n bigint, terms array<int>, tfs array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.keys()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if found:
                    tf = Counter(filter(known.__contains__, found))
                    rows.append((key, len(found), [numbers[t] for t in tf], list(tf.values())))
            yield rows_to_batch(rows, schema)

    return small_batches(docs).select(F.col(key_col).cast("bigint"), F.col(text_col)).mapInArrow(run, schema)


def ranked(found: DataFrame, asked: list[tuple], n_docs: int, n_terms: int, weights: np.ndarray, k: int) -> DataFrame:
    """``item_id, number, doc_id, score``: the ``k`` best of each task for each (item, numbers, repeats) ``asked``."""
    schema = fields("item_id bigint, number int, doc_id bigint, score bigint")
    asked = [(item, np.array(t, np.int64), np.array(c, np.int64) * weights[t]) for item, t, c in asked]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        """Documents up to the bounds of a shard; a document is never cut."""
        held, docs, postings = [], 0, 0
        for batch in batches:
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
            at = 0
            while at < batch.num_rows:
                room = np.searchsorted(ends, (ends[at - 1] if at else 0) + SHARD_POSTINGS - postings, "right") - at
                take = max(0 if docs else 1, min(int(room), SHARD_DOCS - docs, batch.num_rows - at))
                if take:
                    held.append(batch.slice(at, take))
                    docs, postings = docs + take, postings + int(ends[at + take - 1] - (ends[at - 1] if at else 0))
                    at += take
                if at < batch.num_rows:
                    yield held
                    held, docs, postings = [], 0, 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked]
        for part in shards(batches):
            table = pa.Table.from_batches(part).combine_chunks()
            ids, n, term_lists, tf_lists = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns)
            count = term_lists.value_lengths().to_numpy().astype(np.int64)
            term, tf = term_lists.flatten().to_numpy().astype(np.int64), tf_lists.flatten().to_numpy().astype(np.int64)
            m = 100 - 25 + 25 * n.to_numpy().astype(np.int64) * n_docs // n_terms
            shard = Shard(count, term, impact(tf, np.repeat(m, count)), weights)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for (_, wanted, weight_), top in zip(asked, best, strict=True):
                shard.search(wanted, weight_, top.within(ids, missing))
        rows = []
        for number, ((item, _, _), top) in enumerate(zip(asked, best, strict=True)):
            rows += [(item, number, None if gone else int(i), int(s)) for i, gone, s in zip(top.id, top.missing, top.score, strict=True)]
        yield rows_to_batch(rows, schema)

    return found.mapInArrow(run, schema)


def search(
    docs: DataFrame, key_col: str, text_col: str, items: DataFrame, item_col: str, item_text_col: str, k: int = 20,
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for each item."""
    schema = fields("item_id bigint, terms array<binary>, repeats array<int>")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf = [Counter(terms(t)) for t in batch.column(1).to_pylist()]
            rows = [(i, list(c), list(c.values())) for i, c in zip(batch.column(0).to_pylist(), tf, strict=True) if c]
            yield rows_to_batch(rows, schema)

    named = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text")).dropDuplicates()
    named = durable(small_batches(named).mapInArrow(split, schema))
    total = named.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // vocabulary))
    parts = []
    for block in range(blocks):
        asked = named.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        numbers = {t: i for i, t in enumerate(sorted({bytes(t) for r in asked for t in r.terms}))}
        found = durable(counted(docs, key_col, text_col, numbers))
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(numbers), np.int64)
        # At most as many rows as the block has terms.
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
            df[r.term] = r.df
        weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
        queries = [(r.item_id, [numbers[bytes(t)] for t in r.terms], list(r.repeats)) for r in asked]
        parts.append(ranked(found, queries, n_docs, max(1, n_terms), weights, k).withColumn("block", F.lit(block)))
    order = Window.partitionBy("block", "number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
