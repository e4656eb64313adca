"""Exact top-k by inner product with M-trees and best-first search.

Vectors x become points of a metric space: with R the greatest norm, the point
(x, sqrt(R^2 - |x|^2)) and the query (q, 0) are at squared distance
|q|^2 + R^2 - 2 q.x, so the nearest points are those of greatest inner product.

The points go to the nearest of up to ``MOST_PIVOTS`` pivots, and each pivot's
points, hashed into parts of about ``TREE`` points, become one M-tree each. A
tree's nodes are pages: an inner page holds routing points, their covering radii
and their distances to the page's own routing point; a leaf page holds points and
those distances. Search takes pages from a queue by the least distance any of
their points can have. By the triangle inequality, a child or point whose stored
distance differs from the query's by more than the bound (and the radius) is
passed over without computing its distance; a page beyond the k-th best is not
read. Scores are whole numbers, computed exactly; distances only decide what to
skip, with room for rounding.

Queries first search the trees of their own pivot, then those of other pivots
that the bound found there cannot exclude. One task searches one tree for one
chunk of queries; a tree is copied only as often as its own queries fill chunks.

Equal vectors stand once in a tree, with their ``k + repeats`` smallest ids: no
query's result can hold more of them. Equal queries are searched once.

Defined results: null vectors and those with null or non-finite components take
no part; shorter vectors count as if they ended in zeros; empty vectors score 0;
of equal scores the smaller id comes first, a null id last; a row is not a
candidate of queries with its own id; rows that repeat an id and vector count
once; queries with fewer candidates give fewer rows; an empty table gives none;
other columns, whatever their names, are not read. Components beyond 2^24 in
magnitude are computed in Python's whole numbers; a score beyond 64 bits, which the
result's type can't hold, stands as the nearest that it can.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

TREE = 4096  # points of one tree, about
MOST_PIVOTS = 1024
LEAF, FANOUT = 128, 16
CHUNK = 2048  # queries that one task searches a tree for, about
LARGEST = 1 << 24  # up to here, scores of vectors of 32,768 components fit 64 bits
WIDE = b"w"  # before vectors with a larger component, kept as doubles, which hold the floor of a double exactly
LEAST, MOST = -(2**63), 2**63 - 1
NO_ID = 2**63 - 1  # stands for a null id, after all others


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id and vector as the bytes of whole numbers floor(scale * x); vectors that take no part are left out."""
    value = F.col(vector_col)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | F.abs(x.cast("double")).isin(float("inf")))
    rows = vectors.where(value.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = rows.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.transform(value, lambda x: x.cast("double")).alias("v")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for v in batch.column(1):
                whole = np.trim_zeros(np.floor(scale * np.asarray(v.as_py(), np.float64)), "b")  # trailing zeros change no score
                if len(whole) and np.abs(whole).max() > LARGEST:
                    packed.append(WIDE + (whole + 0.0).astype("<f8").tobytes())
                else:
                    packed.append(whole.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "vector"])

    return rows.mapInArrow(run, "id long, vector binary")


def unpacked(vector: bytes) -> np.ndarray:
    return np.frombuffer(vector, "<f8", offset=1) if vector.startswith(WIDE) and len(vector) % 4 == 1 else np.frombuffer(vector, "<i4")


def matrix(vectors, dims: int) -> np.ndarray:
    """Vectors as rows of one array, padded by zeros: 64-bit numbers, or Python's where a component is large."""
    rows = [unpacked(v) for v in vectors]
    wide = any(row.dtype.kind == "f" for row in rows)
    out = np.zeros((len(rows), dims), object if wide else np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = [int(x) for x in row] if wide else row
    return out


def inner_products(whole: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact scores, held within 64 bits."""
    if whole.dtype != object and query.dtype != object:
        return whole @ query
    scores = whole.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), LEAST), MOST) for s in scores], np.int64)


def points(whole: np.ndarray, radius2: float) -> np.ndarray:
    """Metric points of vectors: one more coordinate brings all to one norm."""
    place = whole.astype(np.float64)
    last = np.sqrt(np.maximum(0.0, radius2 - (place**2).sum(1)))
    return np.concatenate((place, last[:, None]), 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, square))


class MTree:
    """Pages of one tree: inner pages (centres, radii, parent distances, children), leaves (rows, parent distances)."""

    def __init__(self, whole: np.ndarray, radius2: float):
        self.whole, self.pages = whole, []
        self.at = points(whole, radius2)
        every = np.arange(len(whole))
        self.centre = self.at.mean(0)
        away = distances(self.at, self.centre[None])[:, 0]
        self.radius = float(away.max(initial=0.0))
        self.root = self.build(every, away)

    def build(self, rows: np.ndarray, away: np.ndarray) -> int:
        """The number of a page for these points; ``away``: their distances from its routing point."""
        if len(rows) <= LEAF:
            self.pages.append((True, rows, away))
            return len(self.pages) - 1
        pick = rows[np.linspace(0, len(rows) - 1, min(FANOUT, -(-len(rows) // LEAF))).astype(int)]
        to_each = distances(self.at[rows], self.at[pick])
        nearest = to_each.argmin(1)
        if np.bincount(nearest).max() == len(rows):  # all alike: cut evenly
            nearest = np.arange(len(rows)) * len(pick) // len(rows)
        centres, radii, parent, children = [], [], [], []
        for k in range(len(pick)):
            own = nearest == k
            if own.any():
                centres.append(self.at[pick[k]])
                radii.append(to_each[own, k].max())
                parent.append(away[np.searchsorted(rows, pick[k])])
                children.append(self.build(rows[own], to_each[own, k]))
        self.pages.append((False, np.array(centres), np.array(radii), np.array(parent), np.array(children)))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, ids: list[np.ndarray], best: list[tuple[int, int]], k: int, radius2: float) -> tuple[list, int]:
        """The k best (score, id) among ``best`` and the tree, best first, and the number of scores computed."""
        place, norm2 = np.append(query.astype(np.float64), 0.0), float((query.astype(np.float64) ** 2).sum())
        room = 1e-6 * np.sqrt(norm2 + radius2) + 1e-6
        bound = lambda: np.sqrt(max(0.0, norm2 + radius2 - 2.0 * best[-1][0])) + room if len(best) >= k and best[-1][0] > LEAST else np.inf
        start = float(np.sqrt(((place - self.centre) ** 2).sum()))
        queue, limit, scored = [(max(0.0, start - self.radius), self.root, start)], bound(), 0
        while queue:
            least, number, away = heapq.heappop(queue)
            if least > limit:
                break
            page = self.pages[number]
            if page[0]:
                rows = page[1][np.abs(page[2] - away) <= limit]
                scores = inner_products(self.whole[rows], query)
                scored += len(rows)
                if len(best) >= k:
                    good = scores >= best[-1][0]
                    rows, scores = rows[good], scores[good]
                if len(rows) > 4 * k:
                    top = np.partition(scores, -k)[-k]
                    rows, scores = rows[scores >= top], scores[scores >= top]
                if len(rows):
                    best = best + [(int(s), int(i)) for r, s in zip(rows, scores) for i in ids[r]]
                    best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
                    limit = bound()
                continue
            _, centres, radii, parent, children = page
            open_ = np.abs(parent - away) - radii <= limit
            if open_.any():
                far = np.sqrt(((centres[open_] - place) ** 2).sum(1))
                for low, child, d in zip(np.maximum(0.0, far - radii[open_]), children[open_], far):
                    if low <= limit:
                        heapq.heappush(queue, (float(low), int(child), float(d)))
        return best, scored


def nearest_pivot(rows: DataFrame, pivots: np.ndarray, dims: int, radius2: float, query: bool) -> DataFrame:
    """``rows`` with the number of the nearest pivot and the distance to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(batch.column("vector").to_pylist(), dims)
            at = np.concatenate((whole.astype(np.float64), np.zeros((len(whole), 1))), 1) if query else points(whole, radius2)
            away = distances(at, shared.value)
            pivot = away.argmin(1) if len(away) else np.empty(0, int)
            arrays = [pa.array(pivot, pa.int32()), pa.array(away[np.arange(len(away)), pivot], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*columns, "pivot", "away"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", pivot int, away double")


def search_trees(queries: DataFrame, trees: DataFrame, k: int, dims: int, radius2: float) -> DataFrame:
    """The k best of each (query, tree) pair: query vector, score, id. ``queries``: vector, tree, chunk, known (bound score)."""

    def run(asked: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(tree):
            tree = tree.sort_values("vector").reset_index(drop=True)
            built = MTree(matrix(tree["vector"], dims), radius2)
            ids = [np.asarray(x) for x in tree["ids"]]
            for vector, known in zip(asked["vector"], asked["known"]):
                # A score known to be reached k times elsewhere bounds the search; such entries are not results.
                floor = [] if pd.isna(known) else [(int(known), NO_ID + 1)] * k
                best, _ = built.search(matrix([vector], dims)[0], ids, floor, k, radius2)
                out += [(vector, s, i) for s, i in best if i <= NO_ID]
        return pd.DataFrame(out, columns=["vector", "score", "id"])

    chunks = queries.select(F.col("tree").alias("of_tree"), F.col("chunk").alias("for_chunk")).distinct()
    copies = trees.join(chunks, trees["tree"] == chunks["of_tree"]).drop("tree")
    asked = queries.groupBy("tree", "chunk")
    return asked.cogroup(copies.groupBy("of_tree", "for_chunk")).applyInPandas(run, "vector binary, score long, id long")


def in_chunks(queries: DataFrame) -> DataFrame:
    """The queries of each pivot in chunks of about ``CHUNK``; no more of them than that pivot's queries fill."""
    filled = queries.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))  # at most MOST_PIVOTS rows
    return queries.join(F.broadcast(filled), "pivot").withColumn("chunk", F.pmod(F.xxhash64("vector"), F.col("chunks")).cast("int")).drop("chunks")


def top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query row's k best other rows, ties to the smaller id."""
    spark = vectors.sparkSession
    asked = whole_numbers(vectors.where(F.coalesce(is_query, F.lit(False))), id_col, vector_col, scale).distinct()
    asked = stage(asked, "search-queries")
    rows = stage(whole_numbers(vectors, id_col, vector_col, scale).distinct(), "search-vectors")
    # A query leaves out only the rows of its own id, whether or not they are queries too.
    own_ids = rows.join(asked.select("id").distinct(), "id", "left_semi")
    repeats = own_ids.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    most = k + int(repeats)  # of equal vectors and of each query's finds; its own rows are taken out last
    order = Window.partitionBy("vector").orderBy("id")
    alike = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    alike = stage(alike.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "search-distinct")

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [unpacked(v.as_py()).astype(np.float64) for v in batch.column(0)]
            sizes = [len(v) for v in values], [float((v * v).sum()) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(sizes[0], pa.int64()), pa.array(sizes[1], pa.float64())], names=["dims", "norm2"])

    n, dims, norm2 = alike.select("vector").mapInArrow(norms, "dims long, norm2 double").agg(F.count("*"), F.max("dims"), F.max("norm2")).first()
    dims, radius2 = int(dims or 0), float(norm2 or 0)
    # Pivots: a bounded sample of the points, of lowest hash; any choice gives the same results.
    wanted = min(MOST_PIVOTS, -(-n // TREE)) or 1
    sample = [r["vector"] for r in alike.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(wanted).collect()]
    pivots = points(matrix(sample, dims), radius2) if sample else np.zeros((1, dims + 1))

    dealt = nearest_pivot(alike, pivots, dims, radius2, query=False)
    parts = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / TREE).cast("int").alias("parts"), F.max("away").alias("radius"))
    parts = stage(parts, "search-pivots")  # at most MOST_PIVOTS rows
    number = F.concat_ws("-", "pivot", F.pmod(F.xxhash64("vector"), F.col("parts")))
    trees = stage(dealt.join(F.broadcast(parts), "pivot").select("vector", "ids", "pivot", number.alias("tree")), "search-trees")
    each_tree = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.concat_ws("-", "pivot", x)))
    # Of a query's own pivot and of the others alike: tree by tree, in chunks of queries.
    distinct = stage(nearest_pivot(asked.select("vector").distinct(), pivots, dims, radius2, query=True), "search-asked")
    own = in_chunks(distinct).join(F.broadcast(parts), "pivot")
    own = own.select("vector", each_tree.alias("tree"), "chunk", F.lit(None).cast("long").alias("known"))
    first = stage(top(search_trees(own, trees.drop("pivot"), most, dims, radius2), ["vector"], most), "search-first")

    known = first.groupBy("vector").agg(F.min(F.when(F.col("rank") == most, F.col("score"))).alias("known"))
    radii = {r["pivot"]: r["radius"] for r in parts.collect()}
    bounds = spark.sparkContext.broadcast((pivots, radii))

    def other_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radius = bounds.value
        for batch in batches:
            vectors, mine, least = (batch.column(c).to_pylist() for c in ("vector", "pivot", "known"))
            whole = matrix(vectors, dims)
            away = distances(np.concatenate((whole.astype(np.float64), np.zeros((len(whole), 1))), 1), centres)
            norm = (whole.astype(np.float64) ** 2).sum(1)
            out = []
            for r, (vector, pivot, score) in enumerate(zip(vectors, mine, least)):
                limit = np.inf if score is None or score == LEAST else np.sqrt(max(0.0, norm[r] + radius2 - 2.0 * score)) + 1e-6 * np.sqrt(norm[r] + radius2) + 1e-6
                out += [(vector, p, score) for p, size in radius.items() if p != pivot and away[r, p] - size <= limit]
            arrays = [pa.array([x[c] for x in out], kind) for c, kind in enumerate((pa.binary(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vector", "pivot", "known"])

    rest = distinct.join(known, "vector", "left").select("vector", "pivot", "known").mapInArrow(other_pivots, "vector binary, pivot int, known long")
    rest = in_chunks(stage(rest, "search-rest")).join(F.broadcast(parts), "pivot").select("vector", each_tree.alias("tree"), "chunk", "known")
    second = search_trees(rest, trees.drop("pivot"), most, dims, radius2)

    every = top(first.select("vector", "score", "id").unionByName(second), ["vector"], most).drop("rank")
    results = asked.withColumnRenamed("id", "query").join(every, "vector").where("query != id")
    results = top(results, ["query", "vector"], k)
    return results.select(
        F.col("query").alias("query_id"),
        F.col("rank").cast("int").alias("rank"),
        F.when(F.col("id") != NO_ID, F.col("id")).alias("vec_id"),
        "score",
    )
