"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfline.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, counts, n in counted:
            m, score = 100 - 75 + (75 * n * n_docs) // n_terms, 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_terms():
    every = "".join(chr(c) for c in range(0x250)) + "ÄÖ straße日本 x y A-B_c\x7fd'É"
    assert [t.decode() for t in lexical_search.terms(every.encode())] == terms(every)
    assert lexical_search.terms(None) == []


@pytest.mark.parametrize(("seed", "postings", "first_read"), [(1, 40, 1), (2, 300, 2), (3, 1 << 20, 64), (4, 1 << 20, 1)])
def test_best_documents(spark, seed, postings, first_read):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß", "Hot"]

    def text(most):
        return " ".join(rng.choice(vocabulary[: rng.randint(1, len(vocabulary))]) for _ in range(rng.randint(0, most)))

    docs = [(i, text(25)) for i in range(150)] + [(200 + i, "Hot w1 w2") for i in range(40)]
    docs += [(None, "w3 w3 hot"), (None, None), (7, "again w3"), (7, "again w3"), (8, None), (9, ""), (10, "-- ..."), (11, "w5 " * 4000)]
    items = [(i, text(12)) for i in range(12)] + [(3, "w3 w3 w1"), (3, "w3 w3 w1"), (90, None), (91, "absent"), (92, "hot"), (None, "w2")]
    d = spark.createDataFrame([(*r, "x", 1, 0) for r in docs], "doc_id long, text string, item_id string, rank int, salt int").repartition(5)
    q = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id long")
    got = lexical_search.search(d, q, k=4, postings=postings, first_read=first_read, block_bytes=1 << 20 if seed % 2 else 150)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs, items).count() == 1


def test_floor():
    """The heads of the lists decide; a floor that no document reaches leaves none."""
    n = 50_000
    owner = np.concatenate([np.arange(n), np.arange(n)])
    tf = np.concatenate([np.where(np.arange(n) < 5, 50, 1)] * 2)
    lists = lexical_search.ImpactLists(list(range(n)), np.full(n, 10), owner, np.repeat([0, 1], n).astype(np.int32), tf, n, 10 * n)
    found = lists.best([(0, 3), (1, 5)], 5, first_read=16)
    assert [doc for _, doc in found] == [0, 1, 2, 3, 4]
    floor = found[-1][0]
    assert lists.best([(0, 3)], 5, floor=floor) == []
    assert len(lists.best([(0, 3), (1, 5)], 5, floor=floor)) == 5
