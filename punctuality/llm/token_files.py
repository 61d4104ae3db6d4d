"""Token ids in shard files, with a minimal perfect hash index from keys to places.

Documents are written in ascending order of their key. A shard is one row of a Parquet data set, so
it can lie in any store that Spark reads: the raw ids (unsigned 32-bit, little-endian, one document
after the other), where each document starts, and the index. The index hashes a key to a bucket,
whose stored displacement gives the key's slot; every slot holds a fingerprint, the number of the
key's first document and how many there are. A lookup takes constant time.

Cases: a null text is empty and still has its end token. Rows without a key come first and have no
index entry. Repeated keys stand next to each other, ordered by their text's hash, and share one slot of
a shard; they may go on in the next one. An empty
table gives no shards. Only the named columns are read. A document larger than a shard makes the
shard larger, none is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality.llm.common import fields, rows_to_batch, small_batches
from punctuality.llm.tokens import Encoder

SHARD = fields(
    "part int, seq int, first_key bigint, last_key bigint, n_docs bigint, n_tokens bigint, n_keyless bigint, "
    "payload binary, starts binary, keys binary, displacements binary, fingerprints binary, first_doc binary, n_same binary"
)


def mixed(keys: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of integer keys (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0x5EED) >> np.uint64(32)).astype("<u4")


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys, 1) % np.uint64(n // 4 + 1)).astype(np.int64)


def slots_in(keys: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key among ``n``. A negative displacement names the slot of a bucket of one."""
    d = displacements[buckets_of(keys, n)].astype(np.int64)
    hashed = (mixed(keys, np.maximum(d, 0) + 2) % np.uint64(n)).astype(np.int64)
    return np.where(d < 0, -d - 1, hashed)


def displacements(keys: np.ndarray) -> np.ndarray:
    """Displacements that send distinct ``keys`` to distinct slots of as many; large buckets first."""
    n = len(keys)
    bucket = buckets_of(keys, n)
    found, taken = np.zeros(n // 4 + 1, "<i8"), np.zeros(n, bool)
    order = np.argsort(bucket, kind="stable")
    names, starts, sizes = np.unique(bucket[order], return_index=True, return_counts=True)
    free = None
    for i in np.argsort(-sizes, kind="stable"):
        own = keys[order[starts[i] : starts[i] + sizes[i]]]
        if sizes[i] == 1:
            free = iter(np.flatnonzero(~taken)) if free is None else free
            found[names[i]] = -int(next(free)) - 1
            continue
        base, step = 0, 16
        while True:
            tries = np.arange(base, base + step)
            at = (mixed(own[None, :], tries[:, None] + 2) % np.uint64(n)).astype(np.int64)
            fits = ~taken[at].any(1)
            fits[fits] = (np.diff(np.sort(at[fits], 1), axis=1) > 0).all(1)
            if fits.any():
                k = int(fits.argmax())
                found[names[i]] = base + k
                taken[at[k]] = True
                break
            base, step = base + step, min(4 * step, 4096)
    return found


def shard_row(part: int, seq: int, keys: list, ids: list[bytes]) -> tuple:
    """One shard of documents in order."""
    starts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype("<i8")
    keyless = sum(k is None for k in keys)
    own = np.array(keys[keyless:], "<i8")
    distinct, first, same = np.unique(own, return_index=True, return_counts=True)
    d = displacements(distinct)
    prints, first_doc, n_same = (np.zeros(len(distinct), t) for t in ("<u4", "<i8", "<i8"))
    if len(distinct):
        at = slots_in(distinct, d, len(distinct))
        prints[at], first_doc[at], n_same[at] = fingerprint(distinct), first + keyless, same
    return (
        part, seq, int(own[0]) if len(own) else None, int(own[-1]) if len(own) else None,
        len(keys), int(starts[-1]), keyless, b"".join(ids), starts.tobytes(), own.tobytes(),
        d.tobytes(), prints.tobytes(), first_doc.tobytes(), n_same.tobytes(),
    )


class Shard:
    """Keyed access to one shard."""

    def __init__(self, row: dict):
        self.row = row
        self.payload = memoryview(row["payload"])
        self.starts, self.keys = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["keys"], "<i8")
        self.d, self.prints = np.frombuffer(row["displacements"], "<i8"), np.frombuffer(row["fingerprints"], "<u4")
        self.first, self.same = np.frombuffer(row["first_doc"], "<i8"), np.frombuffer(row["n_same"], "<i8")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each key's first document and how many it has; none where the key is absent."""
        if not len(self.prints) or not len(keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = slots_in(keys, self.d, len(self.prints))
        there = self.prints[at] == fingerprint(keys)
        first = np.where(there, self.first[at], 0)
        # A fingerprint is 32 bits; the stored key decides.
        there &= self.keys[np.maximum(first - self.row["n_keyless"], 0)] == keys
        return first, np.where(there, self.same[at], 0)

    def ids(self, doc: int) -> memoryview:
        return self.payload[4 * self.starts[doc] : 4 * self.starts[doc + 1]]


def write(
    docs: DataFrame, encoder: Encoder, key_col: str, text_col: str, path: str, shard_tokens: int = 1 << 20
) -> None:
    """Write all documents as shards of about ``shard_tokens`` ids under ``path``."""
    rows = small_batches(docs).select(F.col(key_col).cast("bigint").alias("key"), F.col(text_col).alias("text"))
    # Texts are smaller than ids, so they are what is shuffled.
    # Rows without a key, or with one that repeats, may be many: their texts' hashes deal them out.
    tie = F.xxhash64("text").alias("tie")
    rows = rows.select("key", "text", tie).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, keys, ids, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = encoder(text.as_py())
                if size and size + len(own) > 4 * shard_tokens:
                    yield rows_to_batch([shard_row(part, seq, keys, ids)], SHARD)
                    seq, keys, ids, size = seq + 1, [], [], 0
                keys.append(key)
                ids.append(own)
                size += len(own)
        if keys:
            yield rows_to_batch([shard_row(part, seq, keys, ids)], SHARD)

    rows.mapInArrow(shards, SHARD).write.option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, before``: the ids in all shards before. Two steps, so no task sees all shards."""
    shards = spark.read.parquet(path).select("part", "seq", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return shards.withColumn("own", own).join(parts, "part").select(
        "part", "seq", (F.col("own") + F.col("parts_before")).alias("before")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``, each found by its key."""
    schema = fields("part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                distinct = np.unique(shard.keys)
                first, same = shard.find(distinct)
                docs = [(None, i) for i in range(row["n_keyless"])]
                docs += [(int(k), int(f) + i) for k, f, n in zip(distinct, first, same, strict=True) for i in range(n)]
                rows = []
                for key, doc in docs:
                    ids = shard.ids(doc)
                    rows.append((row["part"], row["seq"], key, int(shard.starts[doc]), len(ids) // 4, zlib.crc32(ids)))
                yield rows_to_batch(rows, schema)

    found = small_batches(spark.read.parquet(path)).mapInArrow(listed, schema)
    return found.join(shard_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def fetch(spark: SparkSession, path: str, keys: DataFrame, key_col: str) -> DataFrame:
    """``doc_id, ids``: the documents of the given keys, a row for each document.

    Keys and shards meet by bands of keys as wide as the widest shard, so that a shard lies in two
    bands at most; only shards with a wanted key are opened.
    """
    shards = small_batches(spark.read.parquet(path))
    bounds = shards.select("part", "seq", "first_key", "last_key").filter("first_key IS NOT NULL")
    width = (bounds.agg(F.max(F.col("last_key") - F.col("first_key"))).first()[0] or 0) + 1
    band = lambda c: F.floor(F.col(c) / F.lit(width))
    spread = bounds.withColumn("band", F.explode(F.sequence(band("first_key"), band("last_key"))))
    wanted = keys.select(F.col(key_col).cast("bigint").alias("key")).dropna().distinct()
    asked = wanted.withColumn("band", band("key")).join(spread, "band").filter("key BETWEEN first_key AND last_key")
    asked = asked.groupBy("part", "seq").agg(F.collect_list("key").alias("asked"))
    schema = fields("doc_id bigint, ids array<bigint>")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, own = Shard(row), np.array(row["asked"], np.int64)
                first, same = shard.find(own)
                yield rows_to_batch([
                    (int(k), np.frombuffer(shard.ids(int(f) + i), "<u4").tolist())
                    for k, f, n in zip(own, first, same, strict=True) for i in range(n)
                ], schema)

    return shards.join(asked, ["part", "seq"]).mapInArrow(opened, schema)
