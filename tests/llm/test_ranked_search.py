"""Ranked search against a plain version, with small blocks and bundles."""

import random
from collections import Counter
from math import floor, log

import pytest

from tidemark.llm import ranked_search


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() and c < "\x80" or "a" <= c <= "z" or c >= "\x80" else " " for c in text or "")
    return [w for w in folded.split(" ") if w]


def brute(docs, items, k):
    """Scores of every document for every item, straight from the definition."""
    bags = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // n_terms
            weight = lambda t: floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in words(text) if t in bag)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k, n_parts=3):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as block", "'x' as term").repartition(n_parts)
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as rank", "4 as bundle")
    return sorted(map(tuple, ranked_search.top_k(docs, items, k).collect()), key=str)


@pytest.mark.parametrize("rows,items_each", [(4096, 128), (7, 3)])
def test_against_brute_force(spark, monkeypatch, rows, items_each):
    monkeypatch.setattr(ranked_search, "BUNDLE_ITEMS", items_each)
    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", rows)
    rng = random.Random(5)
    vocabulary = ["the"] * 40 + [f"w{i}" for i in range(60)] + ["Ärger", "ÄRGER", "naïve", "x-y", "a_b", "10", "\x7f", " ", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(120)]
    docs += [(None, text(9)), (None, None), (3, text(5)), (3, text(5)), (500, ""), (501, "the " * 3000), (502, "...")] + [(600 + i, "same words here w1") for i in range(30)]
    items = [(i, text(rng.randint(1, 12))) for i in range(15)] + [(99, None), (98, "nowhere"), (97, "W1 w1 The"), (97, "W1 w1 The"), (None, "w2 ärger")]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_nothing_to_search(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a")]
    assert run(spark, docs, [], 5) == [] == run(spark, [], items, 5) == run(spark, [(1, None), (2, " .")], items, 5)
    # a term in every document still has a weight, if less than a thousandth it finds nothing
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_ties_go_by_id_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", 3)
    docs = [(i, "alpha beta") for i in range(40, 0, -1)] + [(None, "alpha beta")] + [(100 + i, "gamma") for i in range(60)]
    got = run(spark, docs, [(7, "alpha")], 20)
    assert sorted(r[2] for r in got) == list(range(1, 21)) and sorted((r[1], r[2]) for r in got) == [(i, i) for i in range(1, 21)]
