"""Benchmark passages in documents, by latent semantic retrieval.

The collection is the benchmark: items, or parts of long ones, as TF-IDF vectors whose inverse
frequencies are counted over all documents. A distributed randomised SVD gives latent spaces:
tasks multiply passages by a random matrix, the range of the products is made orthogonal, and tasks
that each hold some terms project the matrix on it. Every document then goes past in overlapping
windows. A leak is a window near which the longest common subsequence of words covers the item, or
covers a good part of it and the item's answer (its last sentence) is there too, as in a paraphrase.

Candidates come from search in the latent spaces: a window and its neighbourhood are projected like a
passage, and a passage is retrieved where its inner product with them reaches its floor. That is the
least that the words of a leak can give, less a bound of what the space has lost of the passage, so no
leak is below it. A cosine has no such floor, as other words around a copy lower it without limit; the
one reported tells how near a leak is to the item. A space holds no more passages than it has
dimensions, so that it loses next to nothing and the floor stays sharp for benchmarks of any size.
Of the windows retrieved, those go on to the comparison that also have as many of the passage's rarest
words (its anchors) as every leak has.

The benchmark is taken in blocks of bounded size, each against all documents.

Items of fewer than :data:`LEAST` words are found by their exact sequence only, as parts of them come up
by chance.

Cases: null and empty texts hold nothing. Items of fewer than :data:`SHORTEST` words are words and no
passages; they are not looked for. Repeated items and documents are treated like single ones. A row
without an id is searched too. An empty table or benchmark gives no leaks. Ties go to the earlier
window. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, filter_texts, rows_to_batch, small_batches

LEAST = 8  # words of an item that is found in parts and paraphrases
SHORTEST = 3  # words of an item that is looked for
PART = 64  # most words of one passage of an item
HALF = 16  # windows are two halves long and start at each half
BLOCK = 1024  # passages that are searched together
REACH = 2 * HALF + 2 * PART  # a window and its neighbourhood on both sides
STRETCH = 1 << 16  # words of texts whose anchors are sorted together
HALVES = 1 << 10  # halves of windows that are projected together
ROUNDING = 1e-4  # of single precision, for each unit of weight in a window
SENTENCE = re.compile(r"(?<=[.?!])\s+")
MARKS = re.compile(r"[^\w\s]+|_+")


ASCII_MARKS = "".join(c for c in map(chr, range(128)) if MARKS.match(c)).encode()
OTHER_MARKS = re.compile(r"[^\w\s]+")


def terms(text: str) -> list[str]:
    """The words of a text in lower case, without what is neither letter nor digit."""
    # Most marks are single bytes, which are taken out without a look at the characters.
    text = text.lower().encode("utf-8", "surrogatepass").translate(None, ASCII_MARKS).decode("utf-8", "surrogatepass")
    return (text if text.isascii() else OTHER_MARKS.sub("", text)).split()


@dataclass
class Passage:
    item_id: int
    words: list[str]
    answer: list[str]


def passages_of(item_id: int, text: str | None) -> list[Passage]:
    words = terms(text or "")
    if len(words) < SHORTEST:
        return []
    sentences = [s for s in map(terms, SENTENCE.split(text)) if s]
    answer = sentences[-1] if len(sentences) > 1 else []
    n = -(-len(words) // PART)
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [
        Passage(item_id, words[a:b], answer if b == len(words) else [])
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]


def common_length(masks: dict[int, int], size: int, other: Iterable[int]) -> int:
    """Length of the longest common subsequence; one bit for each word of the first sequence."""
    row, full = 0, (1 << size) - 1
    for w in other:
        mask = masks.get(w)
        if mask:
            grown = row | mask
            row = grown & ~(grown - ((row << 1) | 1)) & full
    return row.bit_count()


def masks_of(ids: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(ids):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def least_words(size: int, part: float) -> int:
    """How many words of a passage every leak has in order."""
    return next(n for n in range(size + 1) if n / size >= part) if size >= LEAST else size


@dataclass
class Space:
    """The latent space of some passages of a block."""

    first: int  # place of the first of these passages in the block
    rows: np.ndarray  # row of each term of the block; terms of other spaces only have the last one
    terms: np.ndarray  # weighted terms by latent dimensions, the last row zero
    passages: np.ndarray  # their vectors by latent dimensions
    lost: np.ndarray  # length of what the space has lost of each
    gains: list[np.ndarray]  # what each word of a passage adds to the inner product with it, ascending


def sums(table: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of rows of a table, ``counts`` of them at a time."""
    order = np.argsort(-counts, kind="stable")
    counts, first = counts[order], (np.cumsum(counts) - counts)[order]
    added = np.zeros((len(counts), table.shape[1]), table.dtype)
    for i in range(int(counts.max(initial=0))):
        n = np.searchsorted(-counts, -i)  # so many have a row more
        added[:n] += table[rows[first[:n] + i]]
    made = np.empty_like(added)
    made[order] = added
    return made


@dataclass
class Matcher:
    """Finds the passages of one block in whole texts."""

    passages: list[Passage]
    vocabulary: dict[str, int]
    found: np.ndarray  # windows with each term; decides which words are anchors, not what is found
    idf: np.ndarray  # weight of each term
    spaces: list[Space]
    whole: float = 0.8
    part: float = 0.6

    def __post_init__(self):
        self.ids = [[self.vocabulary[w] for w in p.words] for p in self.passages]
        self.masks = [masks_of(x) for x in self.ids]
        self.counts = [Counter(x) for x in self.ids]
        self.answers = [[self.vocabulary.get(w, -1) for w in p.answer] for p in self.passages]
        self.sizes = np.array([len(x) for x in self.ids], np.int64)
        self.need = np.ones(len(self.ids), np.int64)
        posts: list[tuple[int, int]] = []
        for p, (count, size) in enumerate(zip(self.counts, self.sizes.tolist(), strict=True)):
            # A leak has ``least`` words of the passage in order. The words that are no anchors
            # give ``least - need`` of them at most, so ``need`` or more are anchors.
            least = least_words(size, self.part)
            self.need[p] = max(1, least // 4)
            rest = size
            for w in sorted(count, key=lambda w: (self.found[w], w)):
                if rest <= least - self.need[p]:
                    break
                posts.append((w, p))
                rest -= count[w]
        term, passage = np.array(sorted(posts), np.int64).reshape(-1, 2).T
        self.posts, self.n_posts = passage, np.bincount(term, minlength=len(self.vocabulary) + 1)
        self.first_post = np.cumsum(self.n_posts) - self.n_posts
        self.around = -(-self.sizes // HALF)  # halves that hold a neighbourhood, on each side
        self.floors = np.array([
            gains[: least_words(len(gains), self.part)].sum() for space in self.spaces for gains in space.gains
        ])

    def encode(self, text: str | None) -> np.ndarray:
        """A number for each term of the text."""
        return np.array(list(map(self.vocabulary.get, terms(text or ""), repeat(len(self.vocabulary)))), np.int64)

    def retrieved(self, encoded: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Rows of (half, passage), ascending: windows whose neighbourhood reaches the passage's floor in its latent space.

        Halves of all texts are numbered through. A leak has words that give the floor, no word takes
        from an inner product, and what a space has lost of a passage is at most its length times that of
        the window's vector; so all windows of leaks are there. At the ends of a text the next one's
        words are seen too, which retrieves more, never less.
        """
        sizes = np.array([len(x) for x in encoded], np.int64)
        n_halves = -(-sizes // HALF)
        first = np.cumsum(n_halves) - n_halves
        ids = np.concatenate(encoded)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        half = np.repeat(first, sizes) + within // HALF
        known = ids < len(self.vocabulary)
        ids, half = ids[known], half[known]
        floors = np.nextafter(self.floors.astype(np.float32), np.float32(-1))
        end, most = int(n_halves.sum()), int(self.around.max(initial=0))
        for start in range(0, end, HALVES):
            stop = min(start + HALVES, end)
            low = start - most  # the first half in a neighbourhood; halves before and after all texts are empty
            a, b = np.searchsorted(half, (low, stop + most + 1))
            place, word, n = half[a:b] - low, ids[a:b], stop - start
            made = []
            for space in self.spaces:
                row = space.rows[word]
                inside = np.flatnonzero(row < len(space.terms) - 1)
                if not len(inside):
                    continue
                at, size = place[inside], n + 2 * most + 1
                halves = np.column_stack((
                    sums(space.terms, row[inside], np.bincount(at, minlength=size)),
                    np.bincount(at, self.idf[word[inside]], size).astype(np.float32),
                ))
                own = slice(space.first, space.first + len(space.lost))
                around = halves[most : most + n] + halves[most + 1 : most + 1 + n]
                for reach in range(1, most + 1):
                    around += halves[most - reach : most - reach + n]
                    around += halves[most + 1 + reach : most + 1 + reach + n]
                    of = np.flatnonzero(self.around[own] == reach)
                    if len(of):
                        vectors = np.column_stack((space.passages[of], space.lost[of] + ROUNDING)).astype(np.float32)
                        at, p = np.nonzero(around @ vectors.T >= floors[own][of])
                        made.append(np.column_stack((start + at, space.first + of[p])))
            if made:
                rows = np.concatenate(made)
                yield rows[np.lexsort((rows[:, 1], rows[:, 0]))]

    def anchored(self, encoded: list[np.ndarray]) -> np.ndarray:
        """Rows of (text, passage, first and last half) where the neighbourhoods of windows have the anchors a leak needs."""
        sizes = np.array([len(x) for x in encoded], np.int64)
        # Texts lie so far apart that no neighbourhood reaches the next one.
        base = np.cumsum(sizes + REACH) - sizes - REACH
        ids = np.concatenate(encoded)
        at = np.flatnonzero(self.n_posts[ids])
        place, ids = at + (np.repeat(np.arange(len(sizes)), sizes) * REACH)[at], ids[at]
        found = [np.empty((0, 4), np.int64)]
        end = int(place[-1]) + 1 if len(place) else 0
        for start in range(0, end, STRETCH):
            a, b = np.searchsorted(place, (start, start + STRETCH + REACH))
            n = self.n_posts[ids[a:b]]
            post = np.repeat(self.first_post[ids[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            key = np.sort(self.posts[post] * (end + REACH) + np.repeat(place[a:b], n))
            passage = key // (end + REACH)
            last = np.arange(len(key)) + self.need[passage] - 1
            inside = np.flatnonzero(last < len(key))
            near = inside[key[last[inside]] - key[inside] < 2 * HALF + 2 * self.sizes[passage[inside]]]
            passage, low, high = passage[near], key[near] % (end + REACH), key[last[near]] % (end + REACH)
            text = np.searchsorted(base, low, "right") - 1
            size, low, high = self.sizes[passage], low - base[text], high - base[text]
            final = np.maximum(-(-sizes[text] // HALF) - 2, 0)
            lowest = np.maximum(-((2 * HALF + size - 1 - high) // HALF), 0)
            highest = np.minimum((low + size) // HALF, final)
            rows = np.unique(np.column_stack((text, passage, lowest, highest)), axis=0)
            found.append(rows[rows[:, 2] <= rows[:, 3]])
        return np.concatenate(found)

    def candidates(self, encoded: list[np.ndarray]) -> dict[tuple[int, int], set[int]]:
        """Halves where a window starts, by text and passage: those retrieved that have the anchors."""
        n_halves = np.array([-(-len(x) // HALF) for x in encoded], np.int64)
        first = np.cumsum(n_halves) - n_halves
        # Starts and ends of the anchors' ranges, by passage and half; a retrieved half lies in one if more have begun than ended.
        text, passage, lowest, highest = self.anchored(encoded).T
        width = int(n_halves.sum()) + 1
        begun = np.sort(passage * width + first[text] + lowest)
        ended = np.sort(passage * width + first[text] + highest)
        found: dict[tuple[int, int], set[int]] = {}
        for rows in self.retrieved(encoded):
            key = rows[:, 1] * width + rows[:, 0]
            rows = rows[np.searchsorted(begun, key, "right") > np.searchsorted(ended, key, "left")]
            texts = np.searchsorted(first, rows[:, 0], "right") - 1
            for t, p, half in zip(texts.tolist(), rows[:, 1].tolist(), (rows[:, 0] - first[texts]).tolist(), strict=True):
                found.setdefault((t, p), set()).add(half)
        return found

    def cosine(self, p: int, ids: np.ndarray, half: int) -> float:
        """Of a passage and the nearest stretch as long around a window, both in the latent space.

        Words that no passage has are not in that space and don't count, however rare or common.
        """
        size = len(self.ids[p])
        space = next(x for x in reversed(self.spaces) if x.first <= p)
        latent = space.passages[p - space.first]
        latent = latent / max(np.linalg.norm(latent), 1e-12)
        near = space.terms[space.rows[ids[max(0, half * HALF - size) : half * HALF + 2 * HALF + size]]]
        sums = np.vstack((np.zeros((1, near.shape[1])), np.cumsum(near, 0, np.float64)))
        size = min(size, len(near))
        stretches = sums[size:] - sums[: len(sums) - size]
        norm = np.maximum(np.linalg.norm(stretches, axis=1), 1e-12)
        return float((stretches @ latent / norm).max())

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float, float, float, int]]]:
        """For each text: item, cosine, covered share of the passage, of its answer, and first word; best per item."""
        encoded = [self.encode(t) for t in texts]
        best: list[dict[int, tuple]] = [{} for _ in texts]
        if not texts:
            return []
        for (t, p), halves in sorted(self.candidates(encoded).items()):
            ids, size, answer, item = encoded[t], len(self.ids[p]), self.answers[p], self.passages[p].item_id
            top = None
            for half in sorted(halves):
                begin = max(0, half * HALF - size)
                near = ids[begin : half * HALF + 2 * HALF + size].tolist()
                # Words in common, in whatever order, are an upper bound of those in order.
                if sum(self.counts[p][w] for w in self.counts[p].keys() & set(near)) < self.part * size:
                    continue
                if size < LEAST:
                    if any(near[i : i + size] == self.ids[p] for i in range(len(near) - size + 1)):
                        top = (1.0, 1.0, half)
                        break
                    continue
                share = common_length(self.masks[p], size, near) / size
                told = common_length(masks_of(answer), len(answer), near) / len(answer) if answer else 0.0
                if share >= self.whole or share >= self.part and told >= self.whole:
                    if top is None or share > top[0]:
                        top = (share, told, half)
            if top and (item not in best[t] or top[0] > best[t][item][2]):
                share, told, half = top
                best[t][item] = (item, self.cosine(p, ids, half), share, told, half * HALF)
        return [list(b.values()) for b in best]


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[Passage]]:
    """The passages of the benchmark, :data:`BLOCK` at a time."""
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    block: list[Passage] = []
    for row in rows.orderBy("i", "t").toLocalIterator():
        block += passages_of(row.i, row.t)
        while len(block) >= BLOCK:
            yield block[:BLOCK]
            block = block[BLOCK:]
    if block:
        yield block


def frequencies(docs: DataFrame, text_col: str, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many windows of all documents each term is, and how many windows there are."""
    counter = Matcher([], vocabulary, *[np.empty(0)] * 2, [])
    schema = fields("term bigint, n bigint")
    size, width = len(vocabulary), 2 * HALF

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, windows = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                ids = counter.encode(text.as_py())
                if not len(ids):
                    continue
                window = np.arange(len(ids)) // width
                windows += int(window[-1]) + 1
                at = np.unique(window[ids < size] * size + ids[ids < size]) % max(size, 1)
                sums[:size] += np.bincount(at, minlength=size)
        sums[size] = windows
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at), pa.array(sums[at])], names=["term", "n"])

    sums = small_batches(docs).select(text_col).mapInArrow(count, schema).groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(size + 1, np.int64)
    found[sums.term] = sums.n
    return found[:size], int(found[size])


def latent_space(
    docs: DataFrame, rows: list[tuple[int, list[int], list[float]]], n_terms: int, rank: int, seed: int = 7
) -> np.ndarray:
    """Right singular vectors of the passages' matrix, by a randomised SVD that Spark distributes."""
    spark = docs.sparkSession
    k = min(rank, len(rows))
    table = spark.createDataFrame(rows, "row int, terms array<int>, weights array<double>")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each task draws the same matrix from the seed.
        omega = np.random.default_rng(seed).standard_normal((n_terms, k))
        for batch in batches:
            made = [
                (r, (np.array(w) @ omega[t]).tolist())
                for r, t, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            ]
            yield rows_to_batch(made, sampled)

    sampled = fields("row int, y array<double>")
    y = np.zeros((len(rows), k))
    for r in table.mapInArrow(project, sampled).collect():  # at most BLOCK rows
        y[r.row] = r.y
    q, _ = np.linalg.qr(y)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                (t, (np.array(w) @ q[r]).tolist())
                for t, r, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            ]
            yield rows_to_batch(made, combined)

    combined = fields("term int, b array<double>")
    entries = table.select("row", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
    by_term = entries.groupBy(F.col("e.terms").alias("term")).agg(F.collect_list(F.struct("row", "e.weights")).alias("p"))
    by_term = by_term.select("term", F.col("p.row").alias("rows"), F.col("p.weights").alias("weights"))
    b = np.zeros((n_terms, k))
    for r in by_term.mapInArrow(combine, combined).collect():  # at most BLOCK * PART terms
        b[r.term] = r.b
    values, vectors = np.linalg.eigh(b.T @ b)
    good = values > max(values[-1], 0) * 1e-10
    return b @ vectors[:, good] / np.sqrt(values[good])


def matcher(docs: DataFrame, text_col: str, passages: list[Passage], rank: int = 256) -> Matcher:
    """The latent spaces of some passages, ``rank`` in each, with frequencies counted over all ``docs``."""
    vocabulary: dict[str, int] = {}
    for p in passages:
        for w in p.words:
            vocabulary.setdefault(w, len(vocabulary))
    found, windows = frequencies(docs, text_col, vocabulary)
    idf = np.log((windows + 1) / (found + 0.5))
    spaces = []
    for first in range(0, len(passages), rank):
        counted = [
            np.unique([vocabulary[w] for w in p.words], return_counts=True) for p in passages[first : first + rank]
        ]
        own = np.unique(np.concatenate([ids for ids, _ in counted]))
        row = np.full(len(vocabulary) + 1, len(own), np.int32)
        row[own] = np.arange(len(own))
        weights = [n * idf[ids] for ids, n in counted]
        weights = [w / (np.linalg.norm(w) or 1) for w in weights]
        rows = [(i, row[ids].tolist(), w.tolist()) for i, ((ids, _), w) in enumerate(zip(counted, weights, strict=True))]
        basis = latent_space(docs, rows, len(own), rank)
        latent, lost = [], []
        for (ids, _), w in zip(counted, weights, strict=True):
            latent.append(w @ basis[row[ids]])
            rest = -(basis @ latent[-1])
            rest[row[ids]] += w
            lost.append(np.linalg.norm(rest))
        spaces.append(Space(
            first, row, np.vstack((basis * idf[own, None], np.zeros((1, basis.shape[1])))).astype(np.float32),
            np.array(latent, np.float32), np.array(lost),
            [np.sort(np.repeat(idf[ids] * w, n)) for (ids, n), w in zip(counted, weights, strict=True)],
        ))
    return Matcher(passages, vocabulary, found, idf, spaces)


LEAKS = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_share double, first_word bigint"


def leaks(docs: DataFrame, key_col: str, text_col: str, benchmark: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """A row for each document and benchmark item found in it."""
    schema = fields(LEAKS)
    rows = small_batches(docs).select(F.col(key_col).cast("bigint"), F.col(text_col))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, id_col, item_col):
        own = matcher(docs, text_col, block)

        def search(batches: Iterator[pa.RecordBatch], own: Matcher = own) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                yield rows_to_batch([
                    (key, *leak) for key, leaks in zip(keys, own.search(texts), strict=True) for leak in leaks
                ], schema)

        found = found.union(rows.mapInArrow(search, schema))
    # Passages of one item may have been in two blocks.
    best = F.max(F.struct("lcs_share", "cosine", "answer_share", "first_word")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.cosine", "b.lcs_share", "b.answer_share", "b.first_word"
    )


def clean(docs: DataFrame, text_col: str, benchmark: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, whole and with all their columns."""
    kept = docs
    for block in blocks(benchmark, id_col, item_col):
        own = matcher(docs, text_col, block)
        kept = filter_texts(kept, text_col, lambda texts, own=own: (not found for found in own.search(texts)))
    return kept
