"""Best-fit packing of token sequences in bulk-synchronous steps.

Documents are ranked by length, longest first, and gaps by size. One step serves all documents of
one length: a sweep over the gaps, from the smallest that is large enough, matches as many of them
as it can, ranks resolve who gets which gap, the gaps are updated, and the next shorter length
follows. Gaps of one size and documents of one length are interchangeable, so a sweep needs counts
only. There are at most ``size`` lengths, so the plan of all steps is bounded, however many
documents there are; ranks and placements are computed in parallel. A piece that fills a sequence has
no gap to look for and is not moved at all. Of the others, each encoding task numbers those of one
length, and sums over the tasks before it make ranks of the numbers, so that no rows of one length meet
in a task. Pieces carry their token ids, as
little-endian unsigned 32-bit integers, all the way; between steps they take 16 bits where that is
enough for the vocabulary.

Cases: a null text is empty and still has its end token. Repeated rows and rows without a key are
packed like others. Texts longer than ``size`` are cut, the first piece being the shorter one. An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import fields, rows_to_batch, small_batches
from punctuality.llm.tokens import Encoder, release
from punctuality.plans.durable import checkpoint_folder

BATCH_BYTES = 4 << 20  # of ids that a task gathers
PACKED = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; all but the first are full."""
    first = n % size or size
    return [(0, first), *((at, size) for at in range(first, n, size))]


def narrow(encoder: Encoder) -> bool:
    """Whether 16 bits are enough for each id."""
    return max(encoder.library.get_vocab_size(), encoder.end_id + 1) <= 1 << 16


def pieces(docs: DataFrame, encoder: Encoder, key_col: str, text_col: str, size: int) -> DataFrame:
    """Every document's pieces: key, number, start, length and the ids (16 bits each if :func:`narrow`),
    and for pieces that aren't full the task and how many of their length it had before."""
    schema = fields("doc_id bigint, piece int, start bigint, length bigint, ids binary, task int, own bigint")
    kind = "<u2" if narrow(encoder) else "<u4"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), [0] * size
        for batch in batches:
            rows, held = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(encoder(text.as_py()), "<u4").astype(kind)
                held += ids.nbytes
                for i, (at, n) in enumerate(piece_bounds(len(ids), size)):
                    part = (None, None)
                    if n < size:
                        part = (task, seen[n])
                        seen[n] += 1
                    rows.append((key, i, at, n, ids[at : at + n].tobytes(), *part))
                if held > BATCH_BYTES:
                    yield rows_to_batch(rows, schema)
                    rows, held = [], 0
            yield rows_to_batch(rows, schema)

    return small_batches(docs).select(F.col(key_col).cast("bigint"), F.col(text_col)).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Move:
    """``count`` documents of one length from ``rank`` on, ``each`` to a sequence from ``first`` on."""

    rank: int
    count: int
    first: int
    each: int
    offset: int


def plan(counts: dict[int, int], size: int) -> dict[int, list[Move]]:
    """Best fit by descending length for ``counts`` documents of each length."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    opened, moves = 0, {}
    for length in sorted(counts, reverse=True):
        left, rank, gap, made = counts[length], 0, length, []
        while left:
            while gap < size and not gaps[gap]:
                gap += 1
            if gap < size:
                first, n = gaps[gap].pop()
            else:
                first, n, gap = opened, -(-left // (size // length)), size
                opened += n
            each = gap // length
            used = min(n, -(-left // each))
            count = min(left, used * each)
            made.append(Move(rank, count, first, each, size - gap))
            full, rest = divmod(count, each)
            if used < n:
                gaps[gap].append((first + used, n - used))
            if full:
                gaps[gap - each * length].append((first, full))
            if rest:
                gaps[gap - rest * length].append((first + full, 1))
            left, rank = left - count, rank + count
        moves[length] = made
    return moves


def place(found: DataFrame, size: int) -> DataFrame:
    """Pieces with ``ids_crc32``, ``sequence_id``, ``offset`` and their ids in 32 bits."""
    parts = found.filter("own IS NOT NULL").groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # Fewer than ``size`` rows.
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves = plan(counts, size)
    opened = max((m.first + -(-m.count // m.each) for made in moves.values() for m in made), default=0)
    table = {
        length: tuple(np.array([getattr(m, f) for m in made]) for f in ("rank", "first", "each", "offset"))
        for length, made in moves.items()
    }
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    parts = parts.select("length", "task", before.alias("before"))
    schema = fields(
        "doc_id bigint, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint"
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # the tokenizer and its recent pieces; nothing is encoded any more
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                if n == size:
                    sequence[at] = opened + rank[at]
                    continue
                ranks, first, each, base = table[int(n)]
                move = np.searchsorted(ranks, rank[at], "right") - 1
                bins, within = np.divmod(rank[at] - ranks[move], each[move])
                sequence[at], offset[at] = first[move] + bins, base[move] + within * n
            ids = batch.column(4)
            wide = [
                x if len(x) == 4 * n else np.frombuffer(x, "<u2").astype("<u4").tobytes()
                for x, n in zip(ids.to_pylist(), length.tolist(), strict=True)
            ]
            columns = [batch.column(i) for i in range(4)] + [pa.array(wide, pa.binary()), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    row = ["doc_id", "piece", "start", "length", "ids"]
    # Any number of its own will do for a sequence of one piece.
    full = found.filter("own IS NULL").select(*row, F.monotonically_increasing_id().alias("rank"))
    others = found.filter("own IS NOT NULL").join(parts, ["length", "task"]).select(*row, (F.col("before") + F.col("own")).alias("rank"))
    done = full.union(others).mapInArrow(placed, schema)
    return done.withColumn("ids_crc32", F.crc32("ids")).select(*PACKED)


def pack(docs: DataFrame, encoder: Encoder, key_col: str, text_col: str, size: int = 1024) -> DataFrame:
    """Every piece of every document with its ids, its sequence and the place there.

    Encoded pieces are written once, below the checkpoint folder; the caller removes them.
    """
    path = f"{checkpoint_folder(docs.sparkSession)}/pieces-{uuid.uuid4().hex}"
    found = pieces(docs, encoder, key_col, text_col, size)
    found.write.option("compression", "zstd").parquet(path)
    return place(docs.sparkSession.read.schema(found.schema).parquet(path), size)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole training sequences: ``sequence_id``, the number of tokens, and the ids of all its pieces in order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("inside")
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside)
    ids = F.aggregate("inside", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return whole.select("sequence_id", "length", ids.alias("ids"))
