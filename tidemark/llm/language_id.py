"""Languages of a document as a mixture, inferred by expectation-maximisation.

Learning counts letter trigrams per label over all labelled rows; each task adds
up one row of counts per label, and Spark adds the tasks' rows. The model has
``BUCKETS`` numbers per label, whatever the input's size, and is broadcast.

A document's trigrams are drawn from a mixture of the labels' models. EM finds
the proportions over all labels. They order the labels, and sets of the first k
are fitted anew: another label joins as long as the penalised likelihood grows.
Its penalty is half the logarithm of the number of trigrams for each label more,
times three, since a letter is part of three trigrams. The prediction is the
label of the largest proportion, the score that proportion.

``accepted`` also asks whether the learned labels fit the text at all. The fit is
the selected set's log-likelihood per trigram above that of a background, all
trigrams alike; a mixture gets back the entropy of its proportions, which is what
not knowing a trigram's language costs it. The cut-off lies half way between the
background and the least fit of held-out labelled texts, a thousandth of them
apart. A text goes if it is below it by ``EVIDENCE`` in all: short ones seldom are.

Defined results: ``und`` and score 0 if the text is null or has no letter, or if
no label could be learned, in which case ``accepted`` keeps every text that has a
letter; rows without label are not learned from but are
predicted; repeated rows each give a row; an empty table gives none; other
columns, whatever their names, are not read. A long text is counted in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import spread
from tidemark.llm.texts import slices

BUCKETS = 1 << 16
MOST_LABELS = 1000  # more distinct labels than this are no languages; an error, not a cut
FLOOR = 0.02  # the part of a model's mass that all trigrams share
STEPS = 12
APART = 0.001  # of the held-out texts, below the least fit that counts
EVIDENCE = 3 * np.log(1000)  # in log-likelihood; a letter is part of three trigrams
SLICE_CHARS = 1 << 19
SPACE = 32

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter; built once a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the texts' trigrams and each one's text number."""
    parts = [f" {t.lower()} " for t in texts]
    bucket, place = _trigrams("".join(parts))
    ends = np.cumsum([len(p) for p in parts])
    return bucket, np.searchsorted(ends, place, side="right")


def _trigrams(joined: str) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[code]
    shown = np.where(letter, code, SPACE).astype(np.uint64)
    a, b, c = shown[:-2], shown[1:-1], shown[2:]
    # Texts are padded by spaces, so a trigram across two texts has two of them.
    used = (letter[:-2] | letter[1:-1] | letter[2:]) & (letter[:-2] | letter[1:-1]) & (letter[1:-1] | letter[2:])
    place = np.flatnonzero(used)
    key = (a[place] << np.uint64(42)) | (b[place] << np.uint64(21)) | c[place]
    return (spread(key) >> np.uint64(48)).astype(np.int64), place


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Labels in code-point order and their trigram models, an array (BUCKETS, labels)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            done = 0
            for part in slices((t.as_py() for t in batch.column(0)), SLICE_CHARS):
                own = labels[done : done + len(part)]
                done += len(part)
                names, number = np.unique(own, return_inverse=True)
                bucket, owner = trigrams(part)
                found = np.bincount(number[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, row in zip(names, found, strict=True):
                    sums[str(name)] = sums.get(str(name), 0) + row
        for name, row in sums.items():
            full = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full)), pa.array(full, pa.int64()), pa.array(row[full], pa.int64())], names=["label", "bucket", "n"]
            )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        row = np.zeros(BUCKETS, np.int64)
        row[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
        return pd.DataFrame({"label": rows["label"].iloc[:1], "counts": [row.tobytes()]})

    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counted = rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")).mapInArrow(
        count, "label string, bucket long, n long"
    )
    summed = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = summed.groupBy("label").applyInPandas(pack, "label string, counts binary").limit(MOST_LABELS + 1).collect()
    if len(found) > MOST_LABELS:
        raise ValueError(f"over {MOST_LABELS} labels; {label_col} does not name languages")
    labels = sorted(r["label"] for r in found)
    counts = {r["label"]: np.frombuffer(r["counts"], np.int64) for r in found}
    if not labels:
        return [], np.empty((BUCKETS, 0), np.float32)
    table = np.stack([counts[x] for x in labels], 1).astype(np.float64)
    model = (1 - FLOOR) * table / table.sum(0) + FLOOR / BUCKETS
    return labels, model.astype(np.float32)


def fit(chance: np.ndarray, n: np.ndarray, starts: np.ndarray, open_labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents at once: proportions within each one's open labels, and log-likelihoods.

    chance: (trigrams, labels); n: occurrences; starts: each document's first trigram.
    """
    sizes = np.diff(starts, append=len(n))
    share = open_labels / open_labels.sum(1, keepdims=True)
    total = np.add.reduceat(n, starts)
    single = (open_labels.sum(1) == 1).all()
    for _ in range(0 if single else STEPS):
        part = np.repeat(share, sizes, 0) * chance
        part *= (n / part.sum(1))[:, None]
        share = np.add.reduceat(part, starts) / total[:, None]
    mixed = (np.repeat(share, sizes, 0) * chance).sum(1)
    return share, np.add.reduceat(n * np.log(mixed), starts)


def infer(texts: list[str], model: np.ndarray) -> np.ndarray:
    """Each text's proportions over the labels of the selected set; zeros if it has no letter."""
    return measured(texts, model)[0]


def measured(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's proportions, its number of trigrams, and its fit; zeros if it has no letter (without labels, all but the number)."""
    out, sizes_of, fits = np.zeros((len(texts), model.shape[1])), np.zeros(len(texts)), np.zeros(len(texts))
    bucket, owner = trigrams(texts)
    if not len(bucket) or not model.shape[1]:
        return out, sizes_of + np.bincount(owner, minlength=len(texts)), fits
    key, n = np.unique(owner * BUCKETS + bucket, return_counts=True)
    docs, starts = np.unique(key // BUCKETS, return_index=True)
    chance, n = model[key % BUCKETS].astype(np.float64), n.astype(np.float64)
    everything = np.ones((len(docs), model.shape[1]))
    share, _ = fit(chance, n, starts, everything)
    # Chance rounding apart, equal proportions keep the labels' order.
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    penalty = 1.5 * np.log(np.maximum(np.add.reduceat(n, starts), 2))
    best, likely = fit(chance, n, starts, (rank < 1).astype(float))
    active = np.arange(len(docs))
    sizes = np.diff(starts, append=len(n))
    for size in range(2, model.shape[1] + 1):
        rows = np.repeat(np.isin(np.arange(len(docs)), active), sizes)
        firsts = np.concatenate(([0], np.cumsum(sizes[active])[:-1]))
        share, value = fit(chance[rows], n[rows], firsts, (rank[active] < size).astype(float))
        better = value - likely[active] > penalty[active]
        active, share, value = active[better], share[better], value[better]
        best[active], likely[active] = share, value
        if not len(active):
            break
    out[docs], sizes_of[docs] = best, np.add.reduceat(n, starts)
    entropy = -(best * np.log(np.where(best > 0, best, 1))).sum(1)
    fits[docs] = likely / sizes_of[docs] + np.log(BUCKETS) + entropy
    return out, sizes_of, fits


def predict(docs: DataFrame, labels: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score and languages, the proportions of the selected set."""
    shared = docs.sparkSession.sparkContext.broadcast((labels, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in batches:
            done = 0
            for part in slices((t.as_py() or "" for t in batch.column(1)), SLICE_CHARS):
                shares = infer(part, table)
                top = shares.argmax(1) if names else np.zeros(len(part), int)
                known = shares.sum(1) > 0
                lang = [names[k] if ok else "und" for k, ok in zip(top, known, strict=True)]
                score = np.where(known, shares.max(1, initial=0), 0).clip(0, 1)
                mixes = [[(names[k], float(row[k])) for k in np.flatnonzero(row > 0)] for row in shares]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(part)),
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(mixes, pa.map_(pa.string(), pa.float64())),
                    ],
                    names=["id", "lang_pred", "score", "languages"],
                )
                done += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, languages map<string,double>").withColumnRenamed("id", id_col)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def held_out_predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Learn from the rows of folds 0, 1 and 3 and predict every row: id, held_out, lang_pred, score, languages."""
    labels, model = learn(docs.where(fold(id_col) != 2), text_col, label_col)
    found = predict(docs, labels, model, id_col, text_col)
    return found.select(id_col, (fold(id_col) == 2).alias("held_out"), "lang_pred", "score", "languages")


def cut_off(held_out: DataFrame, model: np.ndarray, text_col: str = "text") -> float:
    """The fit that texts of the learned labels have, by held-out ones; without any, none is asked for."""
    shared = held_out.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def fit_of(texts: pd.Series) -> pd.Series:
        parts = [measured(part, shared.value) for part in slices((t or "" for t in texts), SLICE_CHARS)]
        return pd.Series([f if n else None for _, sizes, fits in parts for n, f in zip(sizes, fits, strict=True)], dtype="float64")

    if not model.shape[1]:
        return -np.inf
    least = held_out.select(fit_of(F.col(text_col)).alias("fit")).where("fit is not null and not isnan(fit)")
    least = least.agg(F.percentile_approx("fit", APART, 100_000)).first()[0]
    return -np.inf if least is None else least / 2 if least > 0 else least


def accepted(docs: DataFrame, least: float = 0.25, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose text is in learned languages, one of them with at least ``least`` of it."""
    labels, model = learn(docs.where(fold(id_col) != 2), text_col, label_col)
    if not labels:  # nothing to hold a text against
        least = 0.0
    cut = cut_off(docs.where((fold(id_col) == 2) & F.col(label_col).isNotNull()), model, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def stays(texts: pd.Series) -> pd.Series:
        parts = []
        for part in slices((t or "" for t in texts), SLICE_CHARS):
            shares, sizes, fits = measured(part, shared.value)
            # Equal proportions may miss their quarter by rounding.
            parts.append((sizes > 0) & (shares.max(1, initial=0) >= least - 1e-9) & (sizes * np.maximum(cut - fits, 0) <= EVIDENCE))
        return pd.Series(np.concatenate(parts) if parts else [], dtype="bool")

    return docs.where(stays(F.col(text_col)))
