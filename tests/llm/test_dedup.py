"""Exact, near and suffix dedup against plain versions of what they compute."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.llm import exact_dedup, near_dedup, suffix_dedup
from tidemark.llm.shingles import shingle_sets


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


# --- exact --------------------------------------------------------------------


def test_exact_groups(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab \n") for _ in range(draw.randint(0, 5))) for _ in range(400)] + [None] * 5 + ["a b"] * 300
    got = {r.doc_id: r for r in exact_dedup.members(table(spark, texts)).collect()}
    groups = defaultdict(list)
    for n, t in enumerate(texts):
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append(n)
    for norm, ids in groups.items():
        keep = min(ids, key=lambda n: (-len(texts[n] or ""), n))
        for n in ids:
            r = got[n]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), n == keep)
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    kept = exact_dedup.keep_one(table(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(n for n, r in got.items() if r.kept)


def test_texts_with_one_digest_are_told_apart(spark):
    """A digest of two values: content decides."""
    texts = ["a", "b", "c", "a ", "b", "cc", "a"]
    weak = lambda c: F.when(F.length(c) > 1, "long").otherwise("short")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.members(table(spark, texts), digest=weak).collect()}
    assert got == {0: (3, 3), 3: (3, 3), 6: (3, 3), 1: (1, 2), 4: (1, 2), 2: (2, 1), 5: (5, 1)}


def test_repeated_and_null_ids(spark):
    data = [(5, "x"), (5, "x"), (None, "x"), (None, "y"), (None, "y"), (-(2**63), "z"), (2**63 - 1, "z")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = exact_dedup.members(docs)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == Counter(
        [(5, 5, 3, True), (5, 5, 3, False), (None, 5, 3, False), (None, None, 2, True), (None, None, 2, False),
         (-(2**63), -(2**63), 2, True), (2**63 - 1, -(2**63), 2, False)]
    )
    assert rows(exact_dedup.keep_one(docs)) == rows(spark.createDataFrame([(5, "x"), (None, "y"), (-(2**63), "z")], docs.schema))


def test_kept_rows_whatever_the_ids_and_names(spark):
    shape = "doc_id long, text string, __length long, row string, kept_id long, own_text string, `a.b` long"
    data = [(1, "x y", 99, "r", 5, "o", 1), (1, "xy ", 98, "r", 5, "o", 2), (2, "xy", 97, "r", 5, "o", 3), (None, "z", 1, "r", 5, "o", 4),
            (None, "z  ", 2, "r", 5, "o", 5), (3, "w", 3, "r", 5, "o", 6), (3, "v", 4, "r", 5, "o", 7), (4, None, 5, "r", 5, "o", 8)]
    docs = spark.createDataFrame(data, shape).repartition(3)
    got = exact_dedup.keep_one(docs)
    assert got.columns == docs.columns
    kept = sorted(r["a.b"] for r in got.collect())
    assert kept in ([1, 5, 6, 7, 8], [2, 5, 6, 7, 8])
    assert {tuple(r) for r in got.collect()} <= {*data}
    assert kept == sorted(r["a.b"] for r in exact_dedup.keep_one(docs.repartition(2)).collect())


def test_the_plan_has_no_python(spark):
    plan = exact_dedup.members(table(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- near ---------------------------------------------------------------------


def near_texts(draw, families=12):
    words = [f"w{n}" for n in range(400)]
    texts = []
    for _ in range(families):
        base = [draw.choice(words) for _ in range(draw.randint(4, 120))]
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(draw.choice([" ", "\n"]).join(copy))
    return texts + ["", " ", None, "one", "one", "a b c d", "a b c d"]


def jaccard_links(texts):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a and b and 10 * len(a & b) >= 8 * len(a | b)):
                links[i].add(j)
                links[j].add(i)
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            least = min([root[i], *(root[j] for j in links[i])])
            changed |= least != root[i]
            root[i] = least
    return links, root


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 3)])
def test_near_groups(spark, monkeypatch, seed, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts(random.Random(seed))
    links, root = jaccard_links(texts)
    got = {r.doc_id: r for r in near_dedup.links(table(spark, texts)).collect()}
    for n in range(len(texts)):
        assert (got[n].class_id, got[n].n_links, got[n].kept) == (root[n], len(links[n]), root[n] == n), texts[n]
    kept = near_dedup.keep_one(table(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*root})


def test_tries_are_shortened_until_the_recall():
    depths = near_dedup.matched_depths(0.8, 0.9999, 20, 8)
    assert 1 - np.prod([1 - 0.8**d for d in depths]) >= 0.9999
    longer = sorted(depths)
    longer[0] += 1
    assert 1 - np.prod([1 - 0.8**d for d in longer]) < 0.9999


def test_shingles_of_batches_are_those_of_texts():
    texts = [b"", b"a b c d e f", b"a  b\tc d\ne f", b"one", b"x " * 50, "ä ö ü ß é".encode()]
    together = shingle_sets(texts)
    for text, found in zip(texts, together):
        assert (shingle_sets([text])[0] == found).all()
    assert (together[1] == together[2]).all() and len(together[1]) == 2 and len(together[0]) == 0


def test_components_of_paths_and_stars(spark):
    path = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 140)] + [(7, 7)]
    got = near_dedup.components(spark.createDataFrame(path, "a long, b long"), "a", "b")
    assert {(r.node, r.root) for r in got.collect()} == {(n, 0) for n in range(41)} | {(n, 100) for n in range(100, 140)}


# --- suffixes -----------------------------------------------------------------


def plain_removal(texts, length=100):
    """(removed, spans, what is left) of each text, in order."""
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = True
            seen.add(window)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def repeating_texts(draw):
    passages = ["".join(draw.choice("abcdé fgh") for _ in range(draw.randint(90, 400))) for _ in range(12)]
    texts = ["", None, "x" * 99, "x" * 100, "x" * 101, "ab" * 300, "y" * 1000]
    for _ in range(120):
        parts = []
        for _ in range(draw.randint(1, 5)):
            p = draw.choice(passages)
            a, b = sorted((draw.randrange(len(p)), draw.randrange(len(p))))
            parts.append(draw.choice([p, p[a:b], "".join(draw.choice("ijkl ") for _ in range(draw.randint(0, 60)))]))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("hot,run_size", [(10**9, 100_000), (2, 7), (0, 50)])
def test_suffix_removal(spark, hot, run_size):
    texts = repeating_texts(random.Random(hot + run_size))
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.without_repeats(table(spark, texts), hot=hot, run_size=run_size).collect()}
    assert [got[n] for n in range(len(texts))] == plain_removal(texts)


def test_suffix_removal_in_texts_longer_than_a_buffer(spark):
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(3000))
    noise = lambda n: "".join(draw.choices("ijklmnop ", k=n))
    texts = [noise(700_000) + passage + noise(348_000) + passage + noise(90_000), passage + noise(500)]
    found = suffix_dedup.without_repeats(table(spark, texts), bytes_too=True)
    got = {r.doc_id: r for r in found.collect()}
    assert [(got[n].n_removed, got[n].n_spans, got[n].kept_sha256) for n in range(2)] == plain_removal(texts)
    assert got[1].kept.decode() == texts[1][3000:] and got[1].spans[0].end == 3000


def test_merging_keeps_order_and_shared_prefixes():
    draw = random.Random(3)
    runs = []
    for r in range(7):
        run = sorted(("".join(draw.choice("ab") for _ in range(draw.randint(32, 60))).encode(), 32, r, 0, n) for n in range(draw.randint(0, 60)))
        runs.append(run)
    got = list(suffix_dedup.merged([suffix_dedup.decode_run(suffix_dedup.encode_run(run)) for run in runs if run]))
    want = sorted((p[0], p[1:]) for run in runs for p in run)
    assert [(s, t) for _, s, t in got] == want
    for (_, a, _), (shared, b, _) in zip(got, got[1:]):
        assert shared == suffix_dedup.shared_prefix(a, b, 0)


def test_equal_ids(spark):
    text = "".join(random.Random(4).choices("abcdef ", k=150))
    docs = spark.createDataFrame([(1, text), (1, text), (1, text + "!"), (None, text)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.without_repeats(docs).collect())
    assert got[None, 150, 150] == 1
    # Equal rows of an id are one document; of two texts of an id one comes first.
    assert got in (Counter({(None, 150, 150): 1, (1, 150, 0): 2, (1, 151, 150): 1}), Counter({(None, 150, 150): 1, (1, 150, 150): 2, (1, 151, 0): 1}))
