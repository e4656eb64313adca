"""Language mixtures, secret tagging, metric search, mixing."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, metric_search, mixing, secrets
from tidemark.llm.texts import table

SF = "/root/testdata/sf0.01"


# --- languages ----------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    found = language_id.held_out_predictions(docs).join(docs, "doc_id").where("held_out")
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 150 and right >= 0.98
    assert language_id.accepted(docs).count() >= 0.99 * docs.count()


@pytest.fixture(scope="module")
def model(spark):
    return language_id.learn(table(spark, SF, "documents"))


def test_mixtures_are_found(spark, model):
    labels, chances = model
    texts = {r.lang: r.text for r in table(spark, SF, "documents").where("n_chars > 3000").collect()}
    share = language_id.infer([texts["de"][:2000] + " " + texts["fr"][:1000], texts["es"]], chances)
    mixed = dict(zip(labels, share[0]))
    assert abs(mixed["de"] - 2 / 3) < 0.1 and abs(mixed["fr"] - 1 / 3) < 0.1
    assert dict(zip(labels, share[1]))["es"] > 0.95
    assert (language_id.infer(["", "12 34", "\0"], chances) == 0).all()


def test_batches_do_not_matter(model):
    texts = ["the of and", "", "der die und", "la de les et", "ß", "İstanbul"]
    together = language_id.infer(texts, model[1])
    for text, row in zip(texts, together):
        assert np.allclose(language_id.infer([text], model[1])[0], row)


def test_proportions_grow_the_likelihood(model):
    bucket, _ = language_id.trigrams(["the der and und of die " * 5])
    bucket, n = np.unique(bucket, return_counts=True)
    chance, starts = model[1][bucket].astype(float), np.array([0])
    every = np.ones((1, chance.shape[1]))
    share, value = language_id.fit(chance, n.astype(float), starts, every)
    flat = np.full(chance.shape[1], 1 / chance.shape[1])
    assert value[0] >= (n * np.log(chance @ flat)).sum() and abs(share.sum() - 1) < 1e-9


# --- secrets ------------------------------------------------------------------

PLAIN = {
    "assign": r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            size = len(m[1]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), order, kind, m.end()))
    return [(a, b, kind) for a, _, kind, b in sorted(out)]


def test_base_spans():
    draw = random.Random(5)
    parts = ["password", "Token", "API_KEY", "ſecret", "toKen", "=", ":", " ", '"', "'", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "deadbeef", "x", "/", "é"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 14)))
        assert [s[:3] for s in secrets.base_spans(text)] == plain_spans(text)


@pytest.fixture(scope="module")
def tagger():
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9)))
    code = lambda n: "".join(draw.choice("abcdef0123456789") for _ in range(n))
    texts = []
    for _ in range(400):
        body = [word() for _ in range(60)]
        if draw.random() < 0.5:
            body[30] = draw.choice(["password={}", "token: {}", "secret = {}", 'api_key="{}"']).format(code(20))
        else:
            body[30] = str(draw.randrange(2000))
        texts.append(" ".join(body))
    return secrets.SecretTagger(*secrets.train(secrets.sequences(texts))), code, word


def test_the_crf_finds_what_the_patterns_miss(tagger):
    crf, code, word = tagger
    value = code(20)
    text = f"{word()} {word()} pin: {value} {word()} 1984 {word()}"
    assert secrets.base_spans(text) == []
    assert [text[a:b] for a, b in crf.spans(text)] == [value]


def test_cutting_the_chain_changes_no_tag(tagger):
    crf, code, word = tagger
    assert crf.cut
    whole = secrets.SecretTagger(crf.weights, crf.moves)
    whole.cut = False
    draw = random.Random(7)
    parts = [lambda: code(20), word, lambda: "password", lambda: "=", lambda: "42", lambda: " " * 300, lambda: "!" * 9, lambda: "TOKEN:", lambda: "é" * 40]
    for _ in range(150):
        text = " ".join(draw.choices(parts, weights=[1, 12, 1, 1, 1, 1, 1, 1, 1])[0]() for _ in range(120))
        assert crf.spans(text) == whole.spans(text)


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(1)
    for _ in range(20):
        score, moves = draw.normal(size=(5, 3)), draw.normal(size=(3, 3))
        paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
        value = lambda p: sum(score[t, p[t]] for t in range(5)) + sum(moves[p[t], p[t + 1]] for t in range(4))
        assert list(secrets.viterbi(score, moves)) == list(max(paths, key=value))


# --- search -------------------------------------------------------------------


def best_of(data, query_ids, k):
    whole = {n: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for n, v in data}
    out = {}
    for q in query_ids:
        scores = sorted(((-int(whole[q] @ whole[n]), n) for n in whole if n != q))[:k]
        out[q] = [(n, -s) for s, n in scores]
    return out


@pytest.mark.parametrize("tree,chunk", [(4096, 2048), (40, 3)])
def test_search_is_exact(spark, monkeypatch, tree, chunk):
    monkeypatch.setattr(metric_search, "TREE", tree)
    monkeypatch.setattr(metric_search, "CHUNK", chunk)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(6, 8))
    data = [(n, (centres[n % 6] + 0.3 * draw.normal(size=8)).astype(np.float32).tolist()) for n in range(700)]
    data += [(n, data[0][1]) for n in range(700, 820)]  # a common vector
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4)
    queries = [n for n, _ in data if n % 50 == 0]
    got = {}
    for r in metric_search.top_k(frame, F.col("vec_id") % 50 == 0, k=5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == best_of(data, queries, 5)


def test_bounds_spare_scores():
    draw = np.random.default_rng(3)
    centres = 400 * draw.normal(size=(40, 8))
    whole = (centres[draw.integers(0, 40, 6000)] + 5 * draw.normal(size=(6000, 8))).astype(np.int64)
    radius2 = float((whole**2).sum(1).max())
    tree, ids = metric_search.MTree(whole, radius2), [np.array([n]) for n in range(6000)]
    for q in range(0, 6000, 500):
        best, scored = tree.search(whole[q], ids, [], 5, radius2)
        scores = whole @ whole[q]
        assert best == sorted(((int(s), n) for n, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:5]
        assert scored < 3000


@pytest.mark.parametrize("tree,chunk", [(4096, 2048), (20, 2)])
def test_large_components_are_exact(spark, monkeypatch, tree, chunk):
    monkeypatch.setattr(metric_search, "TREE", tree)
    monkeypatch.setattr(metric_search, "CHUNK", chunk)
    draw = np.random.default_rng(5)
    data = [(n, [float(x) for x in draw.normal(size=4) * 10.0 ** draw.integers(-1, 9)]) for n in range(300)]
    data += [(300, [70000.0, 0.0, 1.0]), (301, [1e15, 3.0]), (302, [-1e15, 0.25]), (350, [0.0, 0.0, 1.0]), (400, [1e30])]
    whole = {n: [int(np.floor(256 * x)) for x in v] for n, v in data}
    held = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    want = {}
    for q in (n for n in whole if n % 50 == 0):
        scores = sorted((-held(sum(a * b for a, b in zip(whole[q], whole[n]))), n) for n in whole if n != q)
        want[q] = [(n, -s) for s, n in scores[:5]]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in metric_search.top_k(frame, F.col("vec_id") % 50 == 0, k=5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == want


# --- mixing -------------------------------------------------------------------


def filled(sizes, weights, budget, most):
    """Targets by water-filling, source by source."""
    full = set()
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        open_ = sum(weights[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and weights[s] * left / open_ > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weights[s] * left / open_ for s in sizes}
        full |= over


def test_targets_and_takes(spark):
    draw = random.Random(8)
    data = [(n, " ".join("w" for _ in range(draw.randint(0, 40))), draw.choice(["a", "b", "c", "d", None] + ["big"] * 5)) for n in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(2)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 40
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_one_source_takes_all(spark):
    docs = spark.createDataFrame([(n, "a b", "s") for n in range(10)], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert {r.target for r in got} == {30.0} and sum(r.taken for r in got) == 30


@pytest.mark.parametrize("ids", [lambda n: None, lambda n: 7, lambda n: n % 3 or None])
def test_targets_are_met_whatever_the_ids(spark, ids):
    """Rows without id, with one id, and rows that repeat in all columns."""
    data = [(ids(n), "one two three four five" if n % 2 else f"text {n} of five words", "a" if n % 4 else "b", n % 5) for n in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, __words long").repartition(3)
    got = mixing.mix(docs).collect()
    assert len(got) == len(data)
    assert sorted((r.source, r.taken) for r in got) == sorted((r.source, r.taken) for r in mixing.mix(docs.repartition(5)).collect())
    for source in "ab":
        rows = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2.5 and max(r.copies for r in rows) <= 2
    left = mixing.mixed(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, mixing.mixed(docs.repartition(5)).collect()), key=str)
    taken = {s: sum(r.taken for r in got if r.source == s) for s in "ab"}
    assert {r.source: r["n"] for r in left.groupBy("source").agg((5 * F.count("*")).alias("n")).collect()} == taken


def test_alike_rows_in_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS", 7)
    docs = spark.createDataFrame([(1, "a b", "s", n) for n in range(31)], "doc_id long, text string, source string, n long")
    got = mixing.mix(docs, share_percent=120).collect()
    assert sorted(r.copies for r in got) == [1] * 25 + [2] * 6  # 74.4 words: 37 rows of 2
    assert mixing.mixed(docs, share_percent=120).count() == 37
