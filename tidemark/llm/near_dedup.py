"""Documents of similar word shingles, joined by banded MinHash LSH.

1. A document's set of five-word shingles has a digest. Equal sets are one class,
   counted by a plain aggregate, and only classes go on.
2. Each of ``TREES`` bands is a path of min-hashes. Two sets of similarity s agree
   on a path's d steps with probability s^d. The depths are fixed beforehand: from
   ``DEPTH`` on one band after another loses a step, until sets at the threshold
   meet in some band with the target recall (``matched_depths``). Only these steps
   are computed, and hashed to one label a band. That is no LSH forest: there are
   no sorted tries, and no prefix is shortened by what the data hold.
3. The classes of one label are a bucket. Its smallest class is its pivot,
   and the buckets of all bands with one pivot are a cell: near copies share
   their pivots, so a class is in few cells. A pair counts in the smallest cell
   that holds both, so no pair is counted twice and none has to be listed.
4. A cell is cut into blocks by class, of bounded numbers of classes and of shingles in
   their sets, and one task compares two blocks with their whole sets: intersections are products of 0/1 matrices over common shingles,
   plus the members of rare ones. It returns a row per class: its links, and the
   smallest class it is connected to.
5. These rows are the edges of the groups, joined by star contractions.

A candidate pair is linked if its exact Jaccard similarity is at least the
threshold. Pairs are compared within tasks only; what is moved is linear in the
classes of a cell times its number of blocks.

Defined results: a null text counts as empty; texts without words equal each
other and nothing else; repeated rows each give a row; of a group, one row is
marked kept: the smallest id, a null id last; an empty table gives none; other
columns, whatever their names, are carried through by ``keep_one`` only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import buffers, numbers, spread
from tidemark.llm.shingles import shingle_sets
from tidemark.session import stage

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
TREES = 20
DEPTH = 8
# Bounds of one side of a comparison, on average: its classes, and the shingles in all their sets.
BLOCK = 4096
BLOCK_SHINGLES = 500_000
BUFFER = 1 << 20
ROWS = 512  # rows of a block compared at once


def matched_depths(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> list[int]:
    """The number of min-hashes in each band: shortened in turn until the recall is reached."""
    depths = [depth] * trees
    missed = lambda: math.prod(1 - threshold**d for d in depths)
    while missed() > 1 - recall and max(depths) > 1:
        depths[depths.index(max(depths))] -= 1
    return depths


def digest_of(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray], depths: list[int]) -> np.ndarray:
    """For each non-empty set, the label of its path in each band."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    factors, labels = numbers(sum(depths), 3) | np.uint64(1), np.empty((len(sets), len(depths)), np.uint64)
    steps = iter(factors)
    for tree, depth in enumerate(depths):
        path = np.full(len(sets), tree, np.uint64)
        for _ in range(depth):
            path = spread(path + np.minimum.reduceat(spread(joined * next(steps)), starts))
        labels[:, tree] = path
    return labels


def _encoded(column: pa.Array) -> Iterator[bytes]:
    return ((t.as_py() or "").encode() for t in column)


def sketches(docs: DataFrame, depths: list[int]) -> DataFrame:
    """One row per document: id, class (the digest of its set), n_shingles, labels (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in buffers(_encoded(batch.column(1)), BUFFER):
                sets = shingle_sets(texts, WORDS)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full, depths).astype(np.int64)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(texts)),
                        pa.array([digest_of(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["id", "class", "n_shingles", "labels"],
                )
                done += len(texts)

    return docs.mapInArrow(run, "id long, class binary, n_shingles long, labels array<long>")


def class_sets(docs: DataFrame) -> DataFrame:
    """One row per document: class and its set, as the bytes of sorted 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in buffers(_encoded(batch.column(1)), BUFFER):
                sets = shingle_sets(texts, WORDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["class", "shingles"],
                )

    return docs.mapInArrow(run, "class binary, shingles binary")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of ``left`` in runs from a start: the size of each set's intersection with each of ``right``.

    Shingles of many sets are columns of 0/1 matrices that are multiplied; those
    of few add one for each pair that has them.
    """
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, column, count = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    often = max(2, (len(left) + len(right)) // 64)
    dense = np.flatnonzero(count >= often)
    place = np.full(len(count), -1)
    place[dense] = np.arange(len(dense))
    matrix = np.zeros((len(left) + len(right), len(dense)), np.float32)
    hit = place[column] >= 0
    matrix[owner[hit], place[column[hit]]] = 1
    rare = (count[column] >= 2) & ~hit
    order = np.argsort(column[rare], kind="stable")
    members, columns = owner[rare][order], column[rare][order]
    groups = np.split(members, np.flatnonzero(np.diff(columns)) + 1) if len(members) else []
    pairs = [(g[g < len(left)], g[g >= len(left)] - len(left)) for g in groups]
    pairs = [(a, b) for a, b in pairs if len(a) and len(b)]
    rows = np.concatenate([np.repeat(a, len(b)) for a, b in pairs]) if pairs else np.empty(0, np.int64)
    cols = np.concatenate([np.tile(b, len(a)) for a, b in pairs]) if pairs else np.empty(0, np.int64)
    by_row = np.argsort(rows, kind="stable")
    rows, cols = rows[by_row], cols[by_row]
    for start in range(0, len(left), ROWS):
        stop = min(start + ROWS, len(left))
        found = matrix[start:stop] @ matrix[len(left) :].T
        a, b = np.searchsorted(rows, [start, stop])
        np.add.at(found, (rows[a:b] - start, cols[a:b]), 1)
        yield start, found


def shared_before(left: list[frozenset], right: list[frozenset], pivot: bytes) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrices of the pivots before this one, for both sides: a product above 0 is a pair counted elsewhere."""
    sides = [{p for pivots in side for p in pivots if p < pivot} for side in (left, right)]
    index = {p: k for k, p in enumerate(sides[0] & sides[1])}
    out = []
    for side in (left, right):
        matrix = np.zeros((len(side), len(index)), np.float32)
        for row, pivots in enumerate(side):
            for p in pivots:
                if p in index:
                    matrix[row, index[p]] = 1
        out.append(matrix)
    return out[0], out[1]


class Union:
    """Connected sets of numbers; a set is known by its smallest."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def connect(union: Union, links: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
    """Join what a 0/1 block of links connects, by spreading the smallest row number in it."""
    if not links.any():
        return
    big = len(rows) + 1
    row_label, col_label = np.arange(len(rows)), np.full(len(cols), big)
    while True:
        down = np.where(links, row_label[:, None], big).min(0)
        back = np.where(links, down[None, :], big).min(1)
        back = np.minimum(row_label, back)
        if (back == row_label).all() and (down == col_label).all():
            break
        row_label, col_label = back, down
    for r in np.flatnonzero(links.any(1)):
        union.join(int(rows[r]), int(rows[row_label[r]]))
    for c in np.flatnonzero(col_label < big):
        union.join(int(cols[c]), int(rows[col_label[c]]))


def compare(cell: pd.DataFrame) -> pd.DataFrame:
    """Links of the classes in two blocks of a cell (or within one): class, links, to."""
    cell = cell.drop_duplicates(["class", "side"])
    pivot, i, j = cell["pivot"].iloc[0], cell["i"].iloc[0], cell["j"].iloc[0]
    first, second = (cell[cell["side"] == k].reset_index(drop=True) for k in (i, j))
    sets = [[np.frombuffer(s, np.uint64) for s in side["shingles"]] for side in (first, second)]
    if not sets[0] or not sets[1]:
        return pd.DataFrame({"class": [], "links": [], "to": []})
    sizes = [np.array([len(s) for s in side], np.float32) for side in sets]
    weight = [side["n_docs"].to_numpy(np.int64) for side in (first, second)]
    pivots = [[frozenset(p) for p in side["pivots"]] for side in (first, second)]
    before = shared_before(*pivots, pivot)
    n, same = len(first), i == j
    cols = np.arange(n) if same else n + np.arange(len(second))
    links = [np.zeros(len(side), np.int64) for side in (first, second)]
    union = Union(n if same else n + len(second))
    for start, shared in intersections(*sets):
        stop = start + len(shared)
        either = sizes[0][start:stop, None] + sizes[1][None, :] - shared
        linked = shared >= np.float32(THRESHOLD) * either - 1e-3
        near = linked & (np.abs(shared - np.float32(THRESHOLD) * either) <= 1e-2)
        if near.any():  # on the border, in whole numbers
            r, c = np.nonzero(near)
            linked[r, c] = 10 * shared[r, c].astype(np.int64) >= round(10 * THRESHOLD) * either[r, c].astype(np.int64)
        if before[0].shape[1]:
            linked &= (before[0][start:stop] @ before[1].T) == 0
        rows = np.arange(start, stop)
        if same:
            linked[rows - start, rows] = False
        links[0][start:stop] += linked @ weight[1]
        if not same:
            links[1] += linked.T @ weight[0][start:stop]
        connect(union, linked, rows, cols)
    names = list(first["class"]) + ([] if same else list(second["class"]))
    total = np.concatenate(links[:1] if same else links)
    roots = [union.find(k) for k in range(len(names))]
    smallest: dict[int, bytes] = {}
    for k, root in enumerate(roots):
        smallest[root] = min(smallest.get(root, names[k]), names[k])
    out = pd.DataFrame({"class": names, "links": total, "to": [smallest[r] for r in roots]})
    return out[(out["links"] > 0) | (out["class"] != out["to"])]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every node of an edge.

    Large and small stars in turn: each node's larger neighbours, then its smaller
    ones, are hung on its smallest. Rounds are staged; their number follows the
    logarithm of the longest path. Only two numbers a round reach the driver.
    """
    stars = stage(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "stars")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        stars = stage(small, "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = stars.select("v").distinct().join(stars.select(F.col("u").alias("v")), "v", "left_anti")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id, n_links, n_copies, group_size and kept.

    class_id is the smallest id connected to the document by links, n_links the
    number of other documents at or above the threshold, n_copies those of them
    with an equal set.
    """
    depths = matched_depths()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Staged with a number of its own, by which one row of a group can be told from alike ones.
    found = stage(sketches(rows, depths).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # Labels follow from the class, so any row's will do.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))["row"].alias("min_row")
    classes = found.groupBy("class").agg(
        F.count("*").alias("n_docs"),
        F.min("id").alias("min_id"),
        first,
        F.first("labels", ignorenulls=True).alias("labels"),
        F.first("n_shingles").alias("n_shingles"),
    )
    classes = stage(classes, "classes")
    nodes = classes.select("class", "n_shingles", F.posexplode("labels").alias("tree", "label"))
    buckets = nodes.groupBy("tree", "label").agg(F.min("class").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    pivots = nodes.join(buckets, ["tree", "label"]).groupBy("class")
    pivots = pivots.agg(F.sort_array(F.collect_set("pivot")).alias("pivots"), F.first("n_shingles").alias("n_shingles"))
    pivots = stage(pivots, "pivots")
    members = pivots.select("class", "pivots", "n_shingles", F.explode("pivots").alias("pivot"))
    # The pivot itself may be known by other cells only; every cell holds its pivot since buckets do.
    enough = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    blocks = members.groupBy("pivot").agg(enough.cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = members.join(blocks, "pivot").withColumn("side", own).withColumn("other", other)
    placed = placed.select("class", "pivots", "pivot", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))

    wanted = classes.join(pivots.select("class"), "class").select("class", "n_docs", "min_id")
    of_id = F.col("id").eqNullSafe(F.col("min_id"))
    texts = rows.join(wanted.select("min_id").distinct(), of_id, "left_semi")
    sets = class_sets(texts).dropDuplicates(["class"]).join(wanted.select("class", "n_docs"), "class")
    cells = placed.join(sets, "class")
    compared = cells.groupBy("pivot", "i", "j").applyInPandas(compare, "class binary, links long, to binary")
    compared = stage(compared, "links")
    counted = compared.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(compared, "class", "to").withColumnsRenamed({"node": "class"})

    grouped = classes.select("class", "n_docs", "min_id", "min_row").join(roots, "class", "left").join(counted, "class", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "class"))
    kept = F.min(F.struct(F.col("min_id").isNull().alias("none"), "min_id", "class", "min_row"))["min_row"].alias("kept_row")
    groups = grouped.groupBy("root").agg(F.min("min_id").alias("class_id"), F.sum("n_docs").alias("group_size"), kept)
    by_class = grouped.join(groups, "root").select("class", "class_id", "group_size", "kept_row", "n_docs", F.coalesce("links", F.lit(0)).alias("links"))
    joined = found.select("id", "class", "row").join(by_class, "class")
    kind = docs.schema[id_col].dataType
    return joined.select(
        F.col("id").cast(kind).alias(id_col),
        F.col("class_id").cast(kind).alias("class_id"),
        (F.col("links") + F.col("n_docs") - 1).alias("n_links"),
        (F.col("n_docs") - 1).alias("n_copies"),
        "group_size",
        (F.col("row") == F.col("kept_row")).alias("kept"),
        F.hex("class").alias("class"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of linked documents the row marked kept, with all its columns."""
    kept = links(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("__id"), F.col("class").alias("__class"))
    kept = stage(kept, "kept")
    # Null ids and ids of several rows are told apart by the text's class; alike rows are taken once.
    used = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("__rows"))
    several = stage(used.where("__rows > 1").select("__id"), "several")
    alone = kept.where("__id is not null").join(several, "__id", "left_anti")
    single = docs.join(alone, docs[id_col] == alone["__id"], "left_semi")

    @F.pandas_udf("string")
    def class_of(texts: pd.Series) -> pd.Series:
        parts = [shingle_sets(part, WORDS) for part in buffers(((t or "").encode() for t in texts), BUFFER)]
        return pd.Series([digest_of(s).hex().upper() for part in parts for s in part], dtype="object")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = docs.where(F.col(id_col).isNull()).unionByName(docs.join(several, docs[id_col] == several["__id"], "left_semi"))
    texts = repeated.select(F.struct(*columns).alias("__row"), F.col(id_col).alias("__own"), class_of(F.col(text_col)).alias("__of"))
    same = texts.join(kept, texts["__own"].eqNullSafe(kept["__id"]) & (texts["__of"] == kept["__class"]))
    one = same.groupBy("__id", "__class").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return single.unionByName(one.select("__row.*"))
