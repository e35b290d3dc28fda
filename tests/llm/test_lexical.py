import math
import random
import re
from collections import Counter

import pytest

from stormledger.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k):
    words = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(words), sum(n for _, _, n in words)
    df = Counter(w for _, c, _ in words for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in words:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                for w in terms(text)
                if c[w]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["Été", "ÀB", "naïve", "日本", "x-y", "A1"]
    pick = lambda k: " ".join(vocabulary[min(int(rng.expovariate(0.06)), len(vocabulary) - 1)] for _ in range(k))
    docs = [(i, pick(rng.randint(1, 60))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "., -"), (n + 3, "w1 " * 30_000), (None, "w90 w91 w92"), (7, docs[7][1])]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]
    items = [(i, pick(rng.randint(1, 40))) for i in range(12)]
    items += [(50, None), (51, "?"), (52, "nowhere"), (53, " ".join(f"w{i}" for i in range(120))), (54, "w1"), (2, items[2][1])]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"BLOCK_DOCS": 50, "BLOCK_CELLS": 600, "FIRST_MASKS": 2, "SEED_DOCS": 30}])
def test_against_brute_force(spark, docs_of, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = corpus()
    table = docs_of(docs).withColumnsRenamed({"lang": "score", "source": "item"}).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(table, asked, k=20, block_bytes=400 if settings else lexical.ITEM_BYTES)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items, 20)


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame([("a", "w1 w2")], "item_id string, text string")
    assert lexical.search(docs_of([]), items).count() == 0
    assert lexical.search(docs_of([(1, "..."), (2, None)]), items).count() == 0
    none = lexical.search(docs_of([(1, "w1")]), items.limit(0))
    assert none.count() == 0 and none.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert [tuple(r)[:3] for r in lexical.search(docs_of([(1, "W1"), (2, "w2 w3 w3"), (3, "z")]), items).collect()] == [("a", 1, 1), ("a", 2, 2)]


def test_only_documents_near_the_best_leave_a_task(spark, docs_of, monkeypatch):
    """With scores to start from, tasks return far fewer rows than documents that match."""
    docs, items = corpus(9, 2000)
    seen = []
    first = lexical.first_k
    monkeypatch.setattr(lexical, "first_k", lambda found, k: seen.append(found) or first(found, k))
    lexical.search(docs_of(docs).repartition(8), spark.createDataFrame(items[:5], "item_id long, text string"), k=3).collect()
    assert seen[-1].count() <= 8 * 5 * 3
