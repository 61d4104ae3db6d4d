"""Ranked search against scoring every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from punctuality.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in held:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if gone else doc, -s) for r, (s, gone, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def tables_of(spark, docs, items):
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' AS n", "'x' AS terms", "'x' AS item_id")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS rank", "'x' AS repeats")
    return documents, benchmark


def found_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, n=400, words=150):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "naïve", "日本", "K", "The"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60), p=share / share.sum()))) for i in range(n)]
    items = [(i, ", ".join(rng.choice(vocabulary, rng.integers(0, 25)))) for i in range(12)]
    # Copies tie with each other; one document is an item.
    docs += [(1000 - i, docs[i % 3][1]) for i in range(40)] + [(2000, items[0][1]), (None, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("k", [1, 20, 10_000])
def test_search_finds_the_best(spark, k):
    docs, items = corpus(1)
    documents, benchmark = tables_of(spark, docs, items)
    found = ranked_search.search(documents.repartition(3), "doc_id", "text", benchmark, "item_id", "text", k)
    assert found_of(found) == brute(docs, items, k)


def test_small_shards_and_blocks(spark, monkeypatch):
    """Shards, blocks of items and steps of the search as small as can be."""
    for name, size in {"SHARD_DOCS": 7, "SHARD_POSTINGS": 60, "WIDTH": 3, "KEPT": 40}.items():
        monkeypatch.setattr(ranked_search, name, size)
    docs, items = corpus(2, 120)
    documents, benchmark = tables_of(spark, docs, items)
    found = ranked_search.search(documents.repartition(2), "doc_id", "text", benchmark, "item_id", "text", 5, vocabulary=40)
    assert found_of(found) == brute(docs, items, 5)


def test_odd_documents_and_items(spark):
    docs = [
        (1, None), (2, ""), (3, " .,!"), (4, "apple"), (5, "APPLE pear"), (5, "APPLE pear"), (None, "apple"), (6, "x" * 100_000 + " apple"),
        (7, "pear " * 30_000), (8, "a\x1cb é f"), (9, "naïve_É-é"),
    ]
    items = [
        (1, "Apple, apple pear"), (1, "Apple, apple pear"), (1, "pear"), (2, None), (3, "?"), (4, "unknown"), (None, "B é f"), (5, "É"),
        (6, "x" * 100_000),
    ]
    documents, benchmark = tables_of(spark, docs, items)
    assert found_of(ranked_search.search(documents, "doc_id", "text", benchmark, "item_id", "text")) == brute(docs, items, 20)
    none_docs, none_items = tables_of(spark, [], [])
    assert ranked_search.search(none_docs, "doc_id", "text", benchmark, "item_id", "text").count() == 0
    assert ranked_search.search(documents, "doc_id", "text", none_items, "item_id", "text").count() == 0


def test_bounds_leave_most_documents_unscored():
    """Range maxima hold for every interval, and a search scores a part of the documents only."""
    rng = np.random.default_rng(4)
    count = rng.integers(0, 12, 3000)
    term = np.concatenate([rng.choice(60, c, replace=False) for c in count]).astype(np.int64)
    value = rng.integers(1, 1000, len(term))
    weights = np.sort(rng.integers(1, 5000, 60))
    shard = ranked_search.Shard(count, term, value, weights)
    for t in range(60):
        places = shard.key[shard.key // shard.n == t]
        a, b = np.searchsorted(shard.key, places[0]), np.searchsorted(shard.key, places[-1], "right")
        low, high = sorted(rng.integers(a, b + 1, 2))
        bound, at = shard.measure(np.array([[low]]), np.array([[high]]), np.array([3]))
        assert bound[0] == 3 * shard.value[low:high].max(initial=0)
    best = ranked_search.Best(5).within(np.arange(3000), np.zeros(3000, bool))
    wanted = np.array([3, 17, 40, 59])
    scored = shard.search(wanted, weights[wanted], best)
    full = np.zeros(3000, np.int64)
    hit = np.isin(term, wanted)
    np.add.at(full, np.repeat(np.arange(3000), count)[hit], (value * weights[term])[hit])
    assert best.id.tolist() == np.lexsort((np.arange(3000), -full))[:5].tolist()
    assert scored < (full > 0).sum() / 2
