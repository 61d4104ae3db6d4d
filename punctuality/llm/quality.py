"""Quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from good labelled text and one from bad. The difference of the
two compressed sizes, summed over all pieces of bounded size and divided by the size of the text,
goes through a logistic curve fitted on labelled rows that neither dictionary has seen.

Cases: a null or empty text gets the score of its class of texts, the share of good rows. Labels
that contradict each other for a document are left out. If a class has no labelled row, every score
is the share of good rows (0.5 without any label). Repeated rows get equal scores; other columns
stay; very long texts are compressed to their end, piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, map_texts, rows_to_batch, sampled, small_batches

CHUNK = 1024  # characters of a training piece
PIECE = 2048  # most bytes that are compressed at once
RESULT = fields("score double")


def chunks(key: str, text: str | None, share: float) -> list[str]:
    """The training pieces of a whole text that a hash of its key and their place draws."""
    text, most = text or "", share * 2.0**64
    return [
        text[i : i + CHUNK] for i in range(0, len(text), CHUNK) if xxhash.xxh64_intdigest(f"{key}:{i}") < most
    ]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Measure:
    """Differences in compressed size under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        self.parts, self.level, self.pair = (good, bad), level, None

    def __getstate__(self):
        return {"parts": self.parts, "level": self.level, "pair": None}

    def __call__(self, text: str) -> float:
        if self.pair is None:
            kept = []
            for part in self.parts:
                d = zstandard.ZstdCompressionDict(part)
                d.precompute_compress(level=self.level)
                kept.append(zstandard.ZstdCompressor(
                    dict_data=d, level=self.level, write_content_size=False, write_dict_id=False
                ))
            self.pair = kept
        raw = text.encode("utf-8", "replace")
        # Each piece afresh: a text's own history would hide the dictionaries after some pieces.
        n = -(-len(raw) // PIECE)
        cuts = [len(raw) * i // n for i in range(n + 1)]
        good, bad = (sum(len(c.compress(raw[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)) for c in self.pair)
        return (bad - good) / len(raw)


@dataclass(frozen=True)
class Model:
    measure: Measure | None
    slope: float
    intercept: float
    prior: float

    def score(self, text: str | None) -> float:
        if self.measure is None or not text:
            return self.prior
        z = self.slope * self.measure(text) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method."""
    if not len(x) or not 0 < y.mean() < 1:
        return 0.0, 0.0
    scale = x.std() or 1.0
    a, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, key_col: str, text_col: str, label_col: str,
    rows: int = 8000, size: int = 1 << 17, level: int = 3, pieces: int = 16_000,
) -> Model:
    """Learn from about ``rows`` labelled documents, drawn by hash of the key.

    Half of them give their texts to the dictionaries, cut into pieces to the end, of which a hash
    draws about ``pieces``; the other half places the curve. Both bounds are parameters, so what
    reaches the driver doesn't grow with the input.
    """
    key = F.col("key")
    known = (
        labels.select(F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .filter("key IS NOT NULL AND label IS NOT NULL")
        .groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other").select("key", "label")
    )
    count, good = known.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not count:
        return Model(None, 0.0, 0.0, 0.5)
    drawn = known.filter(sampled(key, rows, count)).withColumn(
        "shown", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(2)) == 0
    )
    # About ``rows`` small rows by construction, hence the broadcast.
    texts = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).filter("text <> ''")
    texts = texts.join(F.broadcast(drawn), "key")
    shown = texts.filter("shown").select(F.col("key").cast("string"), "label", "text")
    total = shown.agg(F.sum(F.ceil(F.char_length("text") / CHUNK))).first()[0] or 1
    share = min(1.0, pieces / total)
    schema = fields("label int, piece string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [
                (label.as_py(), c) for key, label, text in zip(*batch.columns, strict=True)
                for c in chunks(key.as_py(), text.as_py(), share)
            ]
            yield rows_to_batch(drawn, schema)

    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in small_batches(shown).mapInArrow(cut, schema).orderBy("label", "piece").toLocalIterator():
        samples[row.label].append(row.piece.encode("utf-8", "replace"))
    if not samples[0] or not samples[1]:
        return Model(None, 0.0, 0.0, float(good))
    measure = Measure(dictionary(samples[1], size), dictionary(samples[0], size), level)
    held = map_texts(
        texts.filter("NOT shown").select("label", "text"), "text", fields("x double"),
        lambda batch: ((measure(t),) for t in batch),
    ).select("label", "x").toPandas()
    slope, intercept = logistic(held.x.to_numpy(), held.label.to_numpy(float))
    return Model(measure, slope, intercept, float(good))


def score(df: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``df`` with ``score``, the calibrated probability that a whole text is good."""
    return map_texts(df, text_col, RESULT, lambda texts: ((model.score(t),) for t in texts))
