"""Personal data: fixed patterns, made consistent by a skip-chain conditional random field.

The patterns find the base spans. Tokens that hold a digit or an @ are the field's nodes. Their
potentials come from the shape of the token, neighbours share one along the text, and distant tokens
that repeat or resemble each other share one across it: two directly, more by way of a node of their
own, so that a label reaches all of them wherever they are. Loopy message passing then carries a label
from a token that a pattern found to its likes that none did; what becomes sure is added. Every text
with nodes is passed through the field, and until the messages settle. Base spans
are evidence and always stay. The weights are learnt from what the patterns find in all texts.

Cases: a null text is empty. Rows without an id and repeated rows are scanned like others, very long
texts whole. An empty table gives no rows, and a field learnt from none adds nothing to the base. Other
columns stay where whole rows are returned; clashing names are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import fields, map_texts, replace_texts, rows_to_batch, sampled, small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # place of the kind, start, end

# The patterns of the contract. A match can only start where the run of its first class does, which
# is said here in another way, so that long runs are not tried from every place.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# Whole tokens only are tried, so that long ones without a digit take no more than linear time.
NODE = re.compile(
    r"(?<![^\s,;:!?\"'<>\[\]{}|])[^\s,;:!?\"'<>\[\]{}|0-9@]*+[0-9@][^\s,;:!?\"'<>\[\]{}|]*"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """All spans of the patterns, by kind, then start; code points."""
    found = list(emails(text)) if "@" in text else []
    if not DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def shape(token: str) -> int:
    """The features of a token as bits; the first is always set."""
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    bits = [
        True, "@" in token, "." in token, "-" in token, "+" in token, "(" in token or ")" in token,
        "/" in token or "=" in token, letters > 0, letters > digits, digits == 0, 1 <= digits <= 3,
        4 <= digits <= 6, 7 <= digits <= 12, digits >= 13, token.count(".") == 3, len(token) > 24,
    ]
    return sum(b << i for i, b in enumerate(bits))


N_SHAPE, N_LABELS = 16, 1 + len(KINDS)


def likeness(token: str) -> str:
    """What tokens that resemble each other have in common."""
    if "@" in token:
        return token.lower().strip(".-")
    digits = "".join(c for c in token if c.isdigit())
    return digits if len(digits) >= 7 else token.lower().strip(".-()+")


@dataclass(frozen=True)
class Graph:
    starts: list[int]
    ends: list[int]
    shapes: np.ndarray
    labels: np.ndarray  # 0: no base span covers the token
    chain: np.ndarray
    skip: np.ndarray  # two tokens that resemble each other
    shared: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))  # token, and number of its group, of three or more

    def repeats(self) -> np.ndarray:
        """Each token and the next one like it."""
        next_one = self.shared[1:, 1] == self.shared[:-1, 1]
        return np.concatenate((self.skip, np.column_stack((self.shared[:-1, 0], self.shared[1:, 0]))[next_one]))


def graph(text: str, base: list[Span]) -> Graph | None:
    """Nodes and edges of a text, or None if it has no node."""
    if "@" not in text and not DIGIT.search(text):
        return None
    nodes = [(m.start(), m.end()) for m in NODE.finditer(text)]
    if not nodes:
        return None
    labels = np.zeros(len(nodes), np.int64)
    starts = np.array([n[0] for n in nodes])
    ends = np.array([n[1] for n in nodes])
    for kind, a, b in base:
        labels[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = kind + 1
    near = np.flatnonzero(starts[1:] - ends[:-1] <= 24)
    alike: dict[str, list[int]] = {}
    for i, (a, b) in enumerate(nodes):
        like = likeness(text[a:b])
        if len(like) >= 4:
            alike.setdefault(like, []).append(i)
    skip = [group for group in alike.values() if len(group) == 2]
    shared = [(i, n) for n, group in enumerate(g for g in alike.values() if len(g) > 2) for i in group]
    shapes = np.array([shape(text[a:b]) for a, b in nodes])
    return Graph(
        starts.tolist(), ends.tolist(), shapes, labels, np.column_stack((near, near + 1)),
        np.array(skip, np.int64).reshape(-1, 2), np.array(shared, np.int64).reshape(-1, 2),
    )


def features(shapes: np.ndarray) -> np.ndarray:
    return ((shapes[:, None] >> np.arange(N_SHAPE)) & 1).astype(float)


@dataclass(frozen=True)
class Field:
    """Weights of the random field."""

    node: np.ndarray  # shape features by labels
    chain: np.ndarray  # label by label
    skip: float  # for equal labels across the text

    def beliefs(self, g: Graph, rounds: int = 200) -> np.ndarray:
        """Marginals of the labels by loopy message passing, base spans being given.

        Messages are passed on until they settle. Neighbours alone have no loops, so theirs do by
        themselves; else each moves half its way only, and after ``rounds`` without rest half as far again.
        """
        nodes = len(g.shapes)
        unary = np.zeros((nodes + int(g.shared[:, 1].max(initial=-1)) + 1, N_LABELS))
        unary[:nodes] = features(g.shapes) @ self.node
        given = np.flatnonzero(g.labels > 0)
        unary[given] = -50.0
        unary[given, g.labels[given]] = 0.0
        edges = np.concatenate((g.chain, g.skip, g.shared + [0, nodes])).astype(np.int64)
        if not len(edges):
            return np.exp(unary - np.logaddexp.reduce(unary, axis=1, keepdims=True))
        # By way of their group, two tokens share as much as by a direct edge.
        equal = np.exp(self.skip)
        way = np.log(equal + np.sqrt(equal**2 + (N_LABELS - 2) * equal - N_LABELS + 1))
        alike = np.eye(N_LABELS)[None]
        pair = np.concatenate((
            np.repeat(self.chain[None], len(g.chain), 0), np.repeat(self.skip * alike, len(g.skip), 0),
            np.repeat(way * alike, len(g.shared), 0),
        ))
        source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        n = len(edges)
        back = np.concatenate((np.arange(n) + n, np.arange(n)))
        message = np.zeros((2 * n, N_LABELS))
        total = unary.copy()
        loops, done = len(g.skip) + len(g.shared) > 0, 0
        step = 0.5 if loops else 1.0
        while True:
            out = total[source] - message[back]
            new = np.logaddexp.reduce(out[:, :, None] + pair, axis=1)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            move = step * (new - message)
            message += move
            total = unary.copy()
            np.add.at(total, target, message)
            done += 1
            if np.abs(move).max() < 1e-4:
                break
            if loops and done % rounds == 0:
                step /= 2
        return np.exp(total - np.logaddexp.reduce(total, axis=1, keepdims=True))[:nodes]


def learn(counts: dict[tuple[int, int, int], int], ridge: float = 1.0) -> Field:
    """A field from counts of (0, shape, label), (1, label, label) and (2, 0, equal or not)."""
    nodes = [(a, b, n) for (k, a, b), n in counts.items() if k == 0]
    weights = np.zeros((N_SHAPE, N_LABELS))
    if nodes:
        x = features(np.array([a for a, _, _ in nodes]))
        y, n = np.eye(N_LABELS)[[b for _, b, _ in nodes]], np.array([n for _, _, n in nodes], float)
        rate = 4.0 / (n.sum() * N_SHAPE)
        for _ in range(1500):
            z = x @ weights
            p = np.exp(z - np.logaddexp.reduce(z, axis=1, keepdims=True))
            weights += rate * (x.T @ (n[:, None] * (y - p)) - ridge * weights)
    chain = np.ones((N_LABELS, N_LABELS))
    for (k, a, b), m in counts.items():
        if k == 1:
            chain[a, b] += m
    # How much more often two labels meet than by chance.
    chain = np.log(chain * chain.sum() / (chain.sum(1, keepdims=True) * chain.sum(0)))
    equal, other = counts.get((2, 0, 1), 0), counts.get((2, 0, 0), 0)
    return Field(weights, np.clip(chain, -2, 2), float(np.clip(np.log((equal + 1) / (other + 1)), 0, 6)))


def fit(df: DataFrame, key_col: str, text_col: str, rows: int | None = None) -> Field:
    """Learn from all documents, or about ``rows`` of them, drawn by hash of the key; only counts reach the driver."""
    drawn = small_batches(df)
    if rows is not None:
        key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
        drawn = drawn.filter(sampled(key, rows, max(1, df.count())))
    schema = fields("k int, a int, b int, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                g = graph(text, base_spans(text)) if text else None
                if g is None:
                    continue
                label = g.labels
                seen = [(0, int(s), int(b)) for s, b in zip(g.shapes, label, strict=True)]
                seen += [(1, int(label[i]), int(label[j])) for i, j in g.chain]
                seen += [(2, 0, int(label[i] == label[j])) for i, j in g.repeats() if label[i] or label[j]]
                for s in seen:
                    sums[s] = sums.get(s, 0) + 1
        yield rows_to_batch([(*k, n) for k, n in sums.items()], schema)

    found = drawn.select(text_col).mapInArrow(count, schema).groupBy("k", "a", "b").agg(F.sum("n").alias("n"))
    return learn({(r.k, r.a, r.b): r.n for r in found.collect()})  # at most 2 ** N_SHAPE shapes by label


def spans(text: str | None, field: Field, sure: float = 0.9) -> tuple[list[Span], list[Span]]:
    """Base spans, and those the field adds: tokens that no base span covers."""
    base = base_spans(text) if text else []
    g = graph(text, base) if text else None
    if g is None or not (g.labels == 0).any():
        return base, []
    belief = field.beliefs(g)
    best = belief.argmax(1)
    added = [
        (int(best[i]) - 1, g.starts[i], g.ends[i])
        for i in np.flatnonzero((g.labels == 0) & (best > 0) & (belief.max(1) >= sure))
    ]
    return base, added


def listed(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(found))


RESULT = fields("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def scan(df: DataFrame, text_col: str, field: Field) -> DataFrame:
    """``df`` with the counts of base spans, their digest, and all spans."""

    def found(texts: list) -> Iterator[tuple]:
        for text in texts:
            base, added = spans(text, field)
            counts = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
            yield (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added))

    return map_texts(df, text_col, RESULT, found)


def masked(text: str | None, field: Field) -> str | None:
    """The text with each span, overlapping ones as one, replaced by the name of its kind."""
    if not text:
        return text
    base, added = spans(text, field)
    out, at = [], 0
    for kind, start, end in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str, field: Field) -> DataFrame:
    """``df`` with personal data masked in the text; all other columns stay as they are."""
    return replace_texts(df, text_col, lambda texts: (masked(t, field) for t in texts))
