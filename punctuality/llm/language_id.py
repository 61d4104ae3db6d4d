"""Language identification as the inference of a mixture of languages.

A document is taken as drawn from several languages at once. Expectation maximisation finds the
proportions from the likelihoods of its character trigrams; a language joins the set only if the
gain in likelihood exceeds a penalty for one more proportion.

Cases: a null text or one without a letter is ``und`` with score 0. Repeated rows get equal
answers, other columns and their order stay, ties go to the language that sorts first. A table
without labelled rows teaches no language, so everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, filter_texts, map_texts, sampled, small_batches

BUCKETS = 1 << 15  # trigrams are hashed, which bounds the model by the number of languages
UNKNOWN = "und"
RESULT = fields("lang_pred string, score double, n_languages int")
MAX_LANGUAGES = 1000


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the whole text and their counts; all but letters counts as one space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    space = ~(((codes >= 97) & (codes <= 122)) | (codes >= 0xAA))
    codes = np.where(space, np.uint32(32), codes)
    codes = codes[~(space & np.concatenate(([False], space[:-1])))]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    # Fixed odd multipliers, as in common multiplicative hashes.
    mixed = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    found = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
    if len(found) < 4096:
        return np.unique(found, return_counts=True)
    counts = np.bincount(found, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass(frozen=True)
class Model:
    """Trigram probabilities, one row per language."""

    languages: tuple[str, ...]
    probability: np.ndarray
    penalty: float = 3.0

    def mixture(self, p: np.ndarray, n: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
        """Proportions and log likelihood of ``n`` counts under the languages with rows ``p``."""
        share, total = np.full(len(p), 1 / len(p)), n.sum()
        for _ in range(steps):
            part = share[:, None] * p
            new = (part / part.sum(0)) @ n / total
            done = np.abs(new - share).max() < 1e-3
            share = new
            if done:
                break
        return share, float(np.log(share @ p) @ n)

    def infer(self, text: str | None) -> tuple[str, float, int]:
        """The leading language, its proportion, and how many languages the document holds."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0
        at, n = trigrams(text)
        if not len(at):
            return self.languages[0], 1.0 / len(self.languages), 1
        chosen, share, _ = self.explain(at, n)
        first = min(range(len(chosen)), key=lambda i: (-share[i], self.languages[chosen[i]]))
        return self.languages[chosen[first]], float(min(1.0, share[first])), len(chosen)

    def foreign(self, text: str | None, evidence: float) -> bool:
        """Whether the text is in no learned language: it has no letter, or noise, in which all trigrams
        are as likely, gives it a log likelihood greater by ``evidence`` than the best mixture does."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return True
        at, n = trigrams(text)
        return bool(len(at)) and -np.log(BUCKETS) * n.sum() - self.explain(at, n)[2] > evidence

    def explain(self, at: np.ndarray, n: np.ndarray) -> tuple[list[int], np.ndarray, float]:
        """The languages that a document holds, their proportions, and the log likelihood."""
        p = self.probability[:, at]
        single = np.log(p) @ n
        chosen = [int(single.argmax())]
        share, likelihood = np.ones(1), float(single[chosen[0]])
        # A character is in three trigrams, which therefore tell a third of what they seem to.
        total = n.sum()
        price = self.penalty * 0.5 * np.log(total + 1)
        mix = p[chosen[0]]
        while len(chosen) < len(self.languages):
            # The likelihood is concave in the proportions, so its slope towards a language
            # bounds what that language can add.
            slope = (p / mix) @ n - total
            slope[chosen] = -np.inf
            k = int(slope.argmax())
            if slope[k] <= price:
                break
            more, gained = self.mixture(p[[*chosen, k]], n, 50)
            if gained - likelihood <= price:
                break
            chosen, share, likelihood = [*chosen, k], more, gained
            mix = share @ p[chosen]
        # A language that joined early may have become superfluous through later ones.
        while len(chosen) > 2:
            rest = [[c for c in chosen if c != k] for k in chosen]
            tried = [(likelihood - left, i, part) for i, (part, left) in enumerate(self.mixture(p[r], n, 50) for r in rest)]
            loss, i, part = min(tried, key=lambda t: t[:2])
            if loss > price:
                break
            chosen, share, likelihood = rest[i], part, likelihood - loss
        return chosen, share, likelihood


def fit(
    labelled: DataFrame, text_col: str, lang_col: str, key_col: str,
    per_language: int = 2000, penalty: float = 3.0,
) -> Model:
    """Learn from about ``per_language`` labelled rows of each language, drawn by hash of the key.

    What reaches the driver is one count per language and bucket, whatever the input's size.
    """
    rows = small_batches(labelled).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(key_col).alias("key")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{len(sizes)} languages; the model is built for {MAX_LANGUAGES} at most")
    if not sizes:
        return Model((), np.empty((0, BUCKETS)), penalty)
    total = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("lang")]
    rows = rows.filter(sampled(F.coalesce(F.col("key").cast("string"), F.lit("")), per_language, total))
    schema = fields("lang string, bucket int, n bigint")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = trigrams(text)
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[at] += n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], names=schema.fieldNames())

    sums = rows.select("lang", "text").mapInArrow(counted, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = tuple(sorted(sizes))
    counts = np.zeros((len(languages), BUCKETS))
    found = sums.toPandas()
    counts[found.lang.map(languages.index), found.bucket] = found.n
    counts += 0.05
    return Model(languages, (counts / counts.sum(1, keepdims=True)).astype(np.float64), penalty)


def predict(df: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``n_languages`` for each whole text."""
    return map_texts(df, text_col, RESULT, lambda texts: map(model.infer, texts))


def accepted(predicted: DataFrame, min_share: float = 0.0) -> DataFrame:
    """The rows with a language whose proportion is at least ``min_share``."""
    return predicted.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_share))


def kept(df: DataFrame, model: Model, text_col: str, evidence: float = 100.0) -> DataFrame:
    """The rows whose text the learned languages explain, whole and with all their columns.

    The mixture's likelihood is weighed against noise; ``evidence`` is what noise must be ahead by, so
    that a short text with unknown words stays.
    """
    return filter_texts(df, text_col, lambda texts: (not model.foreign(t, evidence) for t in texts))
