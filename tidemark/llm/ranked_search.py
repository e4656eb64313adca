"""Ranked lexical search of a stated query set against all documents, by pipelined term partitioning.

The postings are divided by term among a few owners. Items travel in bundles, and a bundle
visits the owners one after the other, carrying its accumulators: for each item the scores
so far of the documents that have any of its terms, in sparse form. At each stop, one cogroup
brings the bundle and the owner's postings for its terms together, and the owner's integer
contributions are added. After the last stop the highest scores are selected.

A bundle is carried per block of at most ``BLOCK_ROWS`` documents, so a group holds
(items of a bundle) x (documents of a block) numbers however common a term or long a list:
the postings of a frequent word are as many rows as there are blocks. Documents are cut into
blocks where they are read, postings are pruned to the items' terms before they are moved,
and of each block only the best ``k`` documents of an item go on to the final selection.

Defined results: a null text has no terms and is never found; each document row stands for
itself, also if its id is null or repeated; equal scores go by ascending doc_id, null last.
Rows of the items that are alike in id and text count once; items without a known term, and
a search in no documents, give no rows. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

# Bounds of a group: documents of a block, bytes of text it is cut at, items of a bundle (on average).
BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
BUNDLE_ITEMS = 128
# Owners that the terms are divided among, each one stop of the pipeline.
OWNERS = 3

# What separates terms is every ASCII character but letters and digits.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order: runs of ASCII letters, digits and all other characters, A-Z in lower case."""
    return text.encode().translate(FOLD).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """bundle, slot, term, repeats of every item, and its id; slots number the items of a bundle."""
    alike = items.select("item_id", "text").distinct()
    bundles = max(1, -(-alike.count() // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64("item_id", "text"), F.lit(bundles)).cast("int")
    slot = F.row_number().over(W.partitionBy("bundle").orderBy("item_id", "text")) - 1
    numbered = alike.withColumn("bundle", bundle).withColumn("slot", slot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(batch["text"].to_pylist()):
                rows += [(at, term.decode(), times) for term, times in Counter(terms(text)).items()]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.record_batch(
                [
                    *(batch[c].take(at) for c in ("item_id", "bundle", "slot")),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["item_id", "bundle", "slot", "term", "repeats"],
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return numbered.mapInArrow(run, f"item_id {kind}, bundle int, slot int, term string, repeats long")


def block_postings(docs: DataFrame) -> DataFrame:
    """Documents in blocks: one row per block with its documents, and one per block and term with its postings.

    A block's own row has a ``term`` that begins with a space, as no term does, and holds the
    ids and the number of terms of each document. The others hold the documents' places in
    the block and how often the term occurs there.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[int] = []
        places: dict[bytes, array] = {}
        times: dict[bytes, array] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = (part << 32) + number
            yield pa.record_batch(
                [
                    pa.array([block], pa.int64()),
                    pa.array([f" {block}"], pa.string()),
                    pa.array([b""], pa.binary()),
                    pa.array([b""], pa.binary()),
                    pa.array([ids], schema.field("ids").type),
                    pa.array([sizes], pa.list_(pa.int64())),
                ],
                schema.names,
            )
            found = list(places)
            for start in range(0, len(found), 20_000):
                some = found[start : start + 20_000]
                yield pa.record_batch(
                    [
                        pa.array([block] * len(some), pa.int64()),
                        pa.array([t.decode() for t in some], pa.string()),
                        pa.array([places[t].tobytes() for t in some], pa.binary()),
                        pa.array([times[t].tobytes() for t in some], pa.binary()),
                        pa.nulls(len(some), schema.field("ids").type),
                        pa.nulls(len(some), pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

        schema: pa.Schema | None = None
        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("block", pa.int64()), ("term", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
                        ("ids", pa.list_(batch["doc_id"].type)), ("sizes", pa.list_(pa.int64())),
                    ]
                )
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = terms(text.as_py())
                place = len(ids)
                ids.append(doc_id)
                sizes.append(len(words))
                held += sum(map(len, words))
                for term, count in Counter(words).items():
                    if term not in places:
                        places[term], times[term] = array("H"), array("I")
                    places[term].append(place)
                    times[term].append(count)
                if len(ids) >= BLOCK_ROWS or held >= BLOCK_BYTES:
                    yield from flush()
                    number += 1
                    held = 0
                    ids, sizes, places, times = [], [], {}, {}
        if ids:
            yield from flush()

    shape = f"block long, term string, places binary, times binary, ids array<{kind.simpleString()}>, sizes array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, shape)


def add_contributions(carried: pa.Table, postings: pa.Table) -> pa.Table:
    """One stop: a bundle's accumulators over a block, with the owner's contributions added."""
    length_part = np.frombuffer(carried["lengths"][0].as_py(), np.int64)
    n_docs = len(length_part)
    sums: dict[int, np.ndarray] = {}
    slots, places, scores = (carried[c][0].as_py() for c in ("slots", "places", "scores"))
    for slot, at, score in zip(slots, places, scores):
        sums[slot] = np.zeros(n_docs, np.int64)
        sums[slot][np.frombuffer(at, np.uint16)] = np.frombuffer(score, np.int64)
    wanted = (postings[c].to_pylist() for c in ("weight", "term_slots", "repeats", "term_places", "times"))
    for weight, term_slots, repeats, at, times in zip(*wanted):
        where = np.frombuffer(at, np.uint16)
        tf = np.frombuffer(times, np.uint32).astype(np.int64)
        part = weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * length_part[where]))
        for slot, repeat in zip(term_slots, repeats):
            if slot not in sums:
                sums[slot] = np.zeros(n_docs, np.int64)
            sums[slot][where] += repeat * part
    out = {slot: np.flatnonzero(row) for slot, row in sums.items()}
    return pa.table(
        {
            "block": carried["block"],
            "bundle": carried["bundle"],
            "ids": carried["ids"],
            "lengths": carried["lengths"],
            "slots": pa.array([list(out)], pa.list_(pa.int32())),
            "places": pa.array([[at.astype(np.uint16).tobytes() for at in out.values()]], pa.list_(pa.binary())),
            "scores": pa.array([[sums[slot][at].tobytes() for slot, at in out.items()]], pa.list_(pa.binary())),
        }
    )


def best_of_block(k: int):
    """The k best documents of every item of a bundle within a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                # ids in order, so that a stable sort by score settles ties by id; null last
                ids = batch["ids"][row].values
                order = pa.compute.array_sort_indices(ids, null_placement="at_end").to_numpy()
                rank_of = np.empty(len(order), np.int64)
                rank_of[order] = np.arange(len(order))
                bundle, slots, takes, kept = batch["bundle"][row].as_py(), [], [], []
                carried = (batch[c][row].as_py() for c in ("slots", "places", "scores"))
                for slot, at, score in zip(*carried):
                    at, score = np.frombuffer(at, np.uint16), np.frombuffer(score, np.int64)
                    best = np.lexsort((rank_of[at], -score))[:k]
                    slots += [slot] * len(best)
                    takes.append(at[best].astype(np.int64))
                    kept.append(score[best])
                if not slots:
                    continue
                yield pa.record_batch(
                    [
                        pa.array([bundle] * len(slots), pa.int32()),
                        pa.array(slots, pa.int32()),
                        ids.take(pa.array(np.concatenate(takes))),
                        pa.array(np.concatenate(kept)),
                    ],
                    ["bundle", "slot", "doc_id", "score"],
                )

    return run


def top_k(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents that rank highest for each item."""
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = stage(item_terms(items), "item-terms")
    by_term = wanted.groupBy("bundle", "term").agg(F.collect_list(F.struct("slot", "repeats")).alias("wanted_by"))
    read = block_postings(docs)
    # Blocks and the postings of wanted terms, written in one pass; Spark sends the terms to the postings if they are few.
    own_row = F.startswith("term", F.lit(" "))
    found = read.join(by_term, "term", "left").where(own_row | F.col("wanted_by").isNotNull())
    owner = F.when(own_row, -1).otherwise(F.pmod(F.xxhash64("term"), F.lit(OWNERS))).cast("int")
    held = stage(found.withColumn("owner", owner), "postings", "owner")

    blocks = held.where("owner = -1").select("block", "ids", "sizes")
    totals = blocks.agg(
        F.sum(F.size(F.filter("sizes", lambda n: n > 0))).cast("long").alias("n_docs"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n_terms"),
    )
    df = held.where("owner >= 0").groupBy("bundle", "term").agg(F.sum(F.length("places") / 2).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.col("n_docs") + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = stage(df.crossJoin(F.broadcast(totals)).select("bundle", "term", weight.alias("weight")), "weights")  # one row of totals

    last = wanted.agg(F.coalesce(F.max("bundle"), F.lit(0))).first()[0]
    over = F.greatest("n_terms", F.lit(1))  # no document has a term if there is none

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n_docs, n_terms = batch["n_docs"][row].as_py() or 0, batch["over"][row].as_py()
                part = [75 + (25 * n * n_docs) // n_terms for n in batch["sizes"][row].as_py()]
                yield pa.record_batch(
                    [batch["block"].slice(row, 1), batch["ids"].slice(row, 1), pa.array([np.array(part, np.int64).tobytes()], pa.binary())],
                    ["block", "ids", "lengths"],
                )

    shape = f"block long, ids array<{doc_kind}>, lengths binary"
    empty = {"slots": "array<int>", "places": "array<binary>", "scores": "array<binary>"}
    carried = (
        blocks.crossJoin(F.broadcast(totals.withColumn("over", over)))  # one row of totals
        .mapInArrow(lengths, shape)
        .withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(last))))
        .select("block", "bundle", "ids", "lengths", *[F.array().cast(kind).alias(c) for c, kind in empty.items()])
    )
    bundle_shape = f"block long, bundle int, ids array<{doc_kind}>, lengths binary, " + ", ".join(f"{c} {t}" for c, t in empty.items())
    for stop in range(OWNERS):
        here = held.where(F.col("owner") == stop).join(weights, ["bundle", "term"])
        here = here.select(
            "block",
            "bundle",
            "weight",
            F.col("wanted_by.slot").alias("term_slots"),
            F.col("wanted_by.repeats").alias("repeats"),
            F.col("places").alias("term_places"),
            "times",
        )
        keys = ("block", "bundle")
        carried = carried.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInArrow(add_contributions, bundle_shape)

    best = carried.mapInArrow(best_of_block(k), f"bundle int, slot int, doc_id {doc_kind}, score long").where("score > 0")
    order = W.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = wanted.select("item_id", "bundle", "slot").distinct()
    return ranked.join(names, ["bundle", "slot"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
