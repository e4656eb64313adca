"""Blocks of few classes and of few shingles: long texts, three classes, and short ones, the same links."""

import random

import pytest
from test_dedup import jaccard_links, table

from tidemark.llm import near_dedup


@pytest.mark.parametrize("classes,shingles", [(4096, 500_000), (4096, 900), (3, 500_000), (2, 300)])
def test_links_do_not_depend_on_the_blocks(spark, monkeypatch, classes, shingles):
    monkeypatch.setattr(near_dedup, "BLOCK", classes)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", shingles)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for n in range(14):  # long texts that differ in a few words
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(400)] = f"x{n}"
        texts.append(" ".join(words))
    texts += [" ".join(base[:40])] * 2 + [" ".join([*base[:39], "other"]), "", None, "one two"]
    links, root = jaccard_links(texts)
    got = {r.doc_id: r for r in near_dedup.links(table(spark, texts)).collect()}
    assert [(got[n].class_id, got[n].n_links) for n in range(len(texts))] == [(root[n], len(links[n])) for n in range(len(texts))]
