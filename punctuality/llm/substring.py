"""Repeated passages, found by backward search in an FM-index for each shard.

A window is a run of ``window`` words of one document. It goes where its smallest 8-word gram hash
(its minimizer) sends it, so equal windows meet; consecutive windows with one minimizer are a
segment. Segments of equal words are one class, known by the smallest document that has it, before
any text is moved. A class that stands alone under its minimizer needs no search: all its windows
occur in its copies only. The others go to shards. A shard's classes are indexed by a compressed
FM-index (a wavelet matrix over the Burrows-Wheeler transform of their words), and all their windows
stream through it, word by word from the end; the matching statistic of a place, capped at the
window, says whether the window occurs elsewhere, and the final interval gives the smallest document
that has it. Intervals of windows that a smaller document has are reported.

A minimizer with very many classes is cut into slices of bounded size. Each slice is searched by
itself; the smallest documents of equal windows of different slices then meet by hash of the window.

Cases: a null text has no words. Rows without an id neither lose words nor take any from others.
Rows that repeat an id don't take words from each other. Texts of fewer words than a window stay. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, rows_to_batch, small_batches
from punctuality.plans.durable import durable

GRAM = 8
SHARD_WORDS = 400_000  # words of an index, unless one minimizer has more
SLICE = 2048  # most classes of one minimizer in an index
KEEP = 300_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, which is what ``split`` of bytes cuts at."""
    return (text or "").encode("utf-8", "replace").split()


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes_of(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > KEEP:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.array(list(map(known.__getitem__, words)), np.uint64)


def segments(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, hash of the words, first window and number of windows of each segment."""
    gram, step = h, 1
    while step < GRAM:
        gram = stirred(gram[:-step] * ODD + gram[step:])
        step *= 2
    low, span, width = gram, 1, window - GRAM + 1
    while span < width:
        shift = min(span, width - span)
        low, span = np.minimum(low[:-shift], low[shift:]), span + shift
    first = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    count = np.diff(np.append(first, len(low)))
    # Hash of all words of the segment from sums of powers: equal words, equal hash, at any place.
    n = len(h)
    power = np.full(n + 1, ODD, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    back = np.full(n + 1, inverse, np.uint64)
    back[0] = 1
    back = np.cumprod(back)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(stirred(h) * power[:-1])))
    end = first + count + window - 1
    return low[first], stirred((sums[end] - sums[first]) * back[first] + (end - first).astype(np.uint64)), first, count


class FMIndex:
    """Backward search over integer sequences, each with the number of its document."""

    def __init__(self, sequences: list[np.ndarray], docs: np.ndarray, longest: int):
        """Symbols are from 1 up; ``longest`` bounds the sequences' lengths."""
        n_seq = len(sequences)
        lengths = np.array([len(s) for s in sequences])
        self.begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        n = int((lengths + 1).sum())
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.begin + lengths] = False
        text[inside] = np.concatenate(sequences)
        self.text = text
        # Suffixes are sorted by doubling. The ends are distinct, so none need be compared beyond.
        rank = text + n_seq
        rank[~inside] = np.arange(n_seq)
        span = 1
        while span <= longest:
            after = np.zeros(n, np.int64)
            after[:-span] = rank[span:] + 1
            key = rank * (n + n_seq + int(text.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            span *= 2
        suffixes = np.argsort(rank, kind="stable")
        self.doc_at = np.repeat(docs, lengths + 1)[suffixes]
        bwt = text[suffixes - 1]  # the end before a sequence, and before the first, is 0
        self.levels = max(1, int(text.max()).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        row = bwt
        for level in reversed(range(self.levels)):
            bit = (row >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8)).view("<u8")
            self.bits.append(packed)
            self.ranks.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(int(len(row) - bit.sum()))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        symbols = np.arange(int(text.max()) + 2)
        below = np.searchsorted(np.sort(bwt), symbols)
        # Where a symbol's suffixes start, less where its occurrences start in the last level.
        self.base = below - self.through(symbols, np.zeros(len(symbols), np.int64))

    def through(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions carried through all levels of the wavelet matrix along the symbols' bits."""
        for k in range(self.levels):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ranks[k][word] + np.bitwise_count(self.bits[k][word] & mask)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def smallest(self, end: np.ndarray, own: np.ndarray, window: int) -> np.ndarray:
        """For windows whose last word is at ``end`` of the text: the smallest document with it.

        A window that is down to one suffix before its first word occurs once, in document ``own``.
        """
        found = own.copy()
        lane = np.arange(len(end))
        low, high = np.zeros(len(end), np.int64), np.full(len(end), len(self.text))
        for back in range(window):
            symbol = self.text[end[lane] - back]
            both = self.through(np.tile(symbol, 2), np.concatenate((low, high))) + np.tile(self.base[symbol], 2)
            low, high = both[: len(lane)], both[len(lane) :]
            more = high - low > 1
            lane, low, high = lane[more], low[more], high[more]
            if not len(lane):
                return found
        starts, at, inverse = np.unique(low, return_index=True, return_inverse=True)
        edges = np.column_stack((starts, high[at])).ravel()
        least = np.minimum.reduceat(np.append(self.doc_at, np.iinfo(np.int64).max), edges)[::2]
        found[lane] = least[inverse]
        return found


def search(texts: list[list[bytes]], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For every window of every text, the smallest of ``docs`` that has it, by an FM-index."""
    ids: dict[bytes, int] = {}
    sequences = [np.array([ids.setdefault(w, len(ids) + 1) for w in t], np.int64) for t in texts]
    index = FMIndex(sequences, docs, max(map(len, sequences)))
    counts = np.array([len(s) - window + 1 for s in sequences])
    before = np.concatenate(([0], np.cumsum(counts)))
    start = np.repeat(index.begin, counts) + np.arange(before[-1]) - np.repeat(before[:-1], counts)
    least = index.smallest(start + window - 1, np.repeat(docs, counts), window)
    return np.split(least, before[1:-1])


def found_segments(rows: DataFrame, window: int) -> DataFrame:
    """Segments of all rows (doc_id, mark, text): minimizer, class, row and place."""
    schema = fields("minimizer bigint, class bigint, doc_id bigint, mark bigint, place bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            parts: list[tuple] = []
            docs, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, mark, text in zip(docs, marks, batch.column(2), strict=True):
                words = words_of(text.as_py())
                if len(words) >= window:
                    low, kind, first, count = segments(hashes_of(words, known), window)
                    n = len(low)
                    parts.append((low.view(np.int64), kind.view(np.int64), np.full(n, doc), np.full(n, mark), (first << 32) + count))
            if parts:
                columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.filter("doc_id IS NOT NULL").mapInArrow(run, schema)


def class_texts(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The words of one occurrence of each wanted class: ``minimizer, class, slice, doc_id, words``."""
    asked = wanted.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("minimizer", "class", "slice", "slices", "place")).alias("asked")
    )
    schema = fields("minimizer bigint, class bigint, slice int, slices int, doc_id bigint, words binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc, text, asked in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = words_of(text)
                for a in asked:
                    first, count = divmod(a["place"], 1 << 32)
                    made.append((a["minimizer"], a["class"], a["slice"], a["slices"], doc, b" ".join(words[first : first + count + window - 1])))
            yield rows_to_batch(made, schema)

    texts = rows.filter("doc_id IS NOT NULL").join(asked, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    return texts.select("doc_id", "text", "asked").mapInArrow(run, schema)


def searched(texts: DataFrame, window: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``minimizer, class, offset, count, least, slices, kind``: windows and the smallest document.

    Windows under a sliced minimizer come one by one with their own hash, for the slices to meet.
    """
    schema = fields("minimizer bigint, class bigint, offset int, count int, least bigint, slices int, kind bigint")
    names = ("minimizer", "class", "slice", "slices", "doc_id", "words")

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        cut = [r[5].split(b" ") for r in rows]
        made = []
        for (minimizer, kind, _, slices, _, _), words, least in zip(
            rows, cut, search(cut, np.array([r[4] for r in rows]), window), strict=True
        ):
            if slices > 1:
                made += [
                    (minimizer, kind, i, 1, int(d), slices, xxhash.xxh64_intdigest(b" ".join(words[i : i + window])) - (1 << 63))
                    for i, d in enumerate(least)
                ]
                continue
            at = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1))
            n = np.diff(np.append(at, len(least)))
            made += [(minimizer, kind, int(i), int(k), int(least[i]), 1, 0) for i, k in zip(at, n, strict=True)]
        return rows_to_batch(made, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True):
                if rows and size > shard_words and (row[0], row[2]) != last:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(row)
                last, size = (row[0], row[2]), size + row[5].count(b" ") + 1
        if rows:
            yield shard(rows)

    dealt = texts.select(*names).repartition("minimizer", "slice").sortWithinPartitions("minimizer", "slice")
    return dealt.mapInArrow(run, schema)


def repeated(rows: DataFrame, window: int = 50, slice_size: int = SLICE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, mark, place, count``: windows that also start in a smaller document."""
    found = durable(found_segments(rows, window))
    classes = found.groupBy("minimizer", "class").agg(F.min(F.struct("doc_id", "mark", "place")).alias("at"), F.max("doc_id").alias("last"))
    sizes = classes.groupBy("minimizer").agg(
        F.count(F.lit(1)).alias("n"), F.min("at.doc_id").alias("lo"), F.max("last").alias("hi")
    ).filter("lo < hi").select("minimizer", "n")
    classes = durable(classes.join(sizes, "minimizer").select("minimizer", "class", "at.*", "n"))
    alone = classes.filter("n = 1").select(
        "minimizer", "class", F.lit(0).alias("offset"),
        F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("count"), F.col("doc_id").alias("least"),
    )
    slices = F.ceil(F.col("n") / F.lit(slice_size)).cast("int")
    wanted = classes.filter("n > 1").withColumn("slices", slices).withColumn(
        "slice", F.pmod(F.xxhash64("class"), F.col("slices")).cast("int")
    )
    answers = durable(searched(class_texts(rows, wanted, window), window, shard_words))
    across = answers.filter("slices > 1")
    merged = across.groupBy("minimizer", "kind").agg(F.min("least").alias("least"))
    across = across.drop("least").join(merged, ["minimizer", "kind"])
    columns = ("minimizer", "class", "offset", "count", "least")
    verdict = alone.union(answers.filter("slices = 1").select(*columns)).union(across.select(*columns))
    return found.join(verdict, ["minimizer", "class"]).filter("least < doc_id").select(
        "doc_id", "mark", (F.shiftright("place", 32) + F.col("offset")).alias("place"), "count"
    ).distinct()


def dedup(df: DataFrame, key_col: str, text_col: str, window: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row; the digest is of the kept words."""
    return _apply(df, key_col, text_col, window, fields("n_words bigint, n_removed bigint, kept_sha256 string"), _digest)


def deduplicated(df: DataFrame, key_col: str, text_col: str, window: int = 50) -> DataFrame:
    """``doc_id, text``: the documents without the words of repeated windows."""
    return _apply(df, key_col, text_col, window, fields("text string"), lambda words, kept: (b" ".join(kept).decode(),))


def _digest(words: list[bytes], kept: list[bytes]) -> tuple[int, int, str]:
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _apply(df: DataFrame, key_col: str, text_col: str, window: int, result, make) -> DataFrame:
    if window < GRAM:
        raise ValueError(f"windows have at least {GRAM} words")
    rows = small_batches(df).select(F.col(key_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    spans = repeated(rows, window).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("place", "count")).alias("spans"))
    schema = fields("doc_id bigint")
    for field in result:
        schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = kept = words_of(text)
                if spans:
                    drop = np.zeros(len(words) + 1, np.int64)
                    place = np.array([s["place"] for s in spans])
                    np.add.at(drop, place, 1)
                    np.add.at(drop, place + [s["count"] + window - 1 for s in spans], -1)
                    kept = [w for w, d in zip(words, np.cumsum(drop), strict=False) if not d]
                made.append((doc, *make(words, kept)))
            yield rows_to_batch(made, schema)

    return rows.join(spans, ["doc_id", "mark"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
