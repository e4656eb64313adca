"""Remove repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier:
in a document of smaller id, or earlier in the same one.

1. Anchors. Of the ``GRAM``-byte strings inside each window of LENGTH bytes the one
   of least hash, leftmost first, is the window's anchor: windows with equal bytes
   have equal anchors at equal places. Windows of one anchor form a piece, the
   text around the anchor that they cover. A window can only repeat if its
   anchor's string does, so anchors are counted by hash and others go no further.
2. Sorted runs. A piece is sorted by the suffix that starts at its anchor, then by
   what stands before the anchor, read backwards. Each task sorts its pieces,
   keeps the first of equal ones (the others repeat as a whole), front-codes them
   (only what follows the prefix shared with the piece before is sent) and deals
   them out by the hash of the anchor's string.
3. Merge. Each part's runs are merged by a loser tree that knows, for every run's
   head, the length of the prefix it shares with the last output: unequal lengths
   decide a match without looking at bytes, equal ones start to compare there.
   The lengths come out with the order. They bound the pieces of one anchor
   string, and name the windows of a piece that may equal one of another piece;
   those are compared as whole strings, first positions first.
4. Documents meet their repeated spans by id.

An anchor string in more than ``HOT`` places is dealt out window by window, by the
windows' own bytes, so no task gets all its surroundings. Texts of any length are
hashed in chunks. Hashes choose candidates only; all matches compare bytes.

Defined results: a null text is empty and nothing is removed from it; a null id
comes after all others; different texts of one id are ordered by their digest,
equal rows of one id are one document and get the same result; an empty table
gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import Substrings, spread
from tidemark.session import stage

LENGTH = 100
GRAM = 32
BUFFER = 1 << 20  # bytes hashed at once; longer texts in chunks of as many windows
PLACE = np.uint64((1 << 21) - 1)
RUN = 250_000  # pieces of one sorted run
HOT = 200_000
OFTEN = 10_000  # frequent anchor strings that a task keeps in memory, at most
LEVEL = 6  # of compression
PARTS = 2  # parts of the merge for each shuffle partition
NO_ID = 2**63 - 1

Anchors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def anchors_of(data: np.ndarray, ends: np.ndarray) -> Anchors:
    """Pieces of the texts that end at ``ends`` in one buffer: text, first and last window, anchor, hash."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    grams = Substrings(data).windows(GRAM)
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    span, reach = 1, LENGTH - GRAM + 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        least = np.minimum(least[: n], least[reach - span : reach - span + n])
    last_window = np.repeat(ends - LENGTH, np.diff(ends, prepend=0))[:n]
    windows = np.flatnonzero(np.arange(n) <= last_window)
    if not len(windows):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    anchor = (least[windows] & PLACE).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(windows) != 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(windows)])) - 1
    anchor, first, last = anchor[first], windows[first], windows[last]
    return np.searchsorted(ends, first, side="right"), first, last, anchor, spread(grams[anchor])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text starts and ends in them; null is empty."""
    column = column.cast(pa.large_binary())
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8), borders


def pieces_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Anchors]]:
    """Runs of texts (first, one past the last) with their bytes and pieces, places counted in those bytes.

    A text longer than BUFFER comes by itself, its pieces chunk by chunk joined.
    """
    data, borders = texts_of(column)
    start, n = 0, len(column)
    while start < n:
        stop = int(np.searchsorted(borders, borders[start] + BUFFER, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        part = data[borders[start] : borders[stop]]
        if len(part) <= BUFFER:
            yield start, stop, part, anchors_of(part, borders[start + 1 : stop + 1] - borders[start])
        else:
            found = []
            for at in range(0, len(part) - LENGTH + 1, BUFFER):
                chunk = part[at : at + BUFFER + LENGTH - 1]
                text, first, last, anchor, gram = anchors_of(chunk, np.array([len(chunk)]))
                found.append((text, first + at, last + at, anchor + at, gram))
            yield start, stop, part, tuple(np.concatenate(x) for x in zip(*found, strict=True))
        start = stop


def numbered(text: np.ndarray) -> np.ndarray:
    """Each piece's number within its text."""
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    return np.arange(len(text)) - np.repeat(starts, np.diff(starts, append=len(text)))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """One row per piece of (id, text): gram, id and the piece's number in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, _, _, (text, _, _, _, gram) in pieces_of(batch.column(1)):
                arrays = [pa.array(gram.view(np.int64)), pa.array(ids[start + text], pa.int64()), pa.array(numbered(text), pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "id", "number"])

    return docs.mapInArrow(run, "gram long, id long, number int")


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def encode_run(pieces: list[tuple]) -> bytes:
    """A sorted run of (string, split, id, tie, place), front-coded."""
    shared, rest, before = bytearray(), [], b""
    docs: dict[tuple[int, int], int] = {}
    for string, _, number, tie, _ in pieces:
        size = shared_prefix(before, string, 0)
        shared.append(size)
        rest.append(string[size:])
        docs.setdefault((number, tie), len(docs))
        before = string
    arrays = [
        np.array([len(pieces), len(docs)], np.int64).tobytes(),
        np.array(list(docs), np.int64).tobytes(),
        np.array([p[4] for p in pieces], np.int64).tobytes(),
        np.array([docs[p[2], p[3]] for p in pieces], np.int32).tobytes(),
        bytes(shared),
        bytes(len(p[0]) for p in pieces),
        bytes(p[1] for p in pieces),
        *rest,
    ]
    return b"R" + zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(arrays))


def decode_run(data: bytes) -> Iterator[tuple[int, bytes, tuple]]:
    """Pieces of a run: the prefix shared with the one before, the string, and (split, id, tie, place)."""
    data = zstandard.ZstdDecompressor().decompress(data[1:])
    n, n_docs = np.frombuffer(data, np.int64, 2)
    at = 16
    docs = np.frombuffer(data, np.int64, 2 * n_docs, at).reshape(-1, 2).tolist()
    at += 16 * n_docs
    places = np.frombuffer(data, np.int64, n, at).tolist()
    owners = np.frombuffer(data, np.int32, n, at + 8 * n).tolist()
    at += 12 * n
    shared, sizes, splits = (data[at + k * n : at + (k + 1) * n] for k in range(3))
    at, string = at + 3 * n, b""
    for k in range(n):
        own = sizes[k] - shared[k]
        string = string[: shared[k]] + data[at : at + own]
        at += own
        yield shared[k], string, (splits[k], *docs[owners[k]], places[k])


def encode_spans(spans: list[tuple]) -> bytes:
    return b"S" + zstandard.ZstdCompressor(level=LEVEL).compress(np.array(spans, np.int64).T.tobytes())


def decode_spans(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.int64).reshape(4, -1)


def merged(runs: list[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """All runs' pieces in order, each with the prefix it shares with the one before.

    A loser tree over the runs' heads. ``known[r]`` is the prefix that the head of
    run r shares with the last output, or with the winner it last lost to, which
    has been output by the time the head is compared again.
    """
    width = 1 << max(0, (len(runs) - 1).bit_length())
    strings: list[bytes | None] = [None] * width
    tags: list[tuple] = [()] * width
    known = [0] * width

    def pull(r: int) -> None:
        head = next(runs[r], None)
        if head is None:
            strings[r] = None
        else:
            known[r], strings[r], tags[r] = head

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two heads; the loser then knows its prefix shared with the winner."""
        x, y = strings[a], strings[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        size = shared_prefix(x, y, known[a])
        if x[size : size + 1] != y[size : size + 1]:
            first = x[size : size + 1] < y[size : size + 1]
        else:
            first = tags[a] <= tags[b]
        winner, loser = (a, b) if first else (b, a)
        known[loser] = size
        return winner, loser

    for r in range(len(runs)):
        pull(r)
        known[r] = 0
    losers, winners = [0] * width, list(range(width))
    level = width
    while level > 1:
        level //= 2
        played = [match(winners[2 * k], winners[2 * k + 1]) for k in range(level)]
        for k, (winner, loser) in enumerate(played):
            losers[level + k], winners[k] = loser, winner
    top = winners[0]
    while strings[top] is not None:
        yield known[top], strings[top], tags[top]
        pull(top)
        node = (top + width) // 2
        while node:
            top, losers[node] = match(top, losers[node])
            node //= 2


def group_spans(group: list[tuple[int, bytes, tuple]]) -> Iterator[tuple[int, int, int, int]]:
    """Repeated spans (id, tie, start, end) among the pieces of one anchor string, in sorted order."""
    kinds: list[list] = []  # string, tag, prefix shared with a neighbour
    for shared, string, tag in group:
        if kinds and kinds[-1][0] == string and kinds[-1][1][0] == tag[0]:
            if tag != kinds[-1][1]:  # else a repeated row
                yield tag[1], tag[2], tag[3], tag[3] + len(string)  # an equal piece stands earlier
        else:
            if kinds:
                kinds[-1][2] = max(kinds[-1][2], shared)
            kinds.append([string, tag, shared if kinds else 0])
    if len(kinds) < 2:
        return
    seen: set[bytes] = set()
    for string, (split, number, tie, place), shared in sorted(kinds, key=lambda x: x[1][1:]):
        text = string[split:][::-1] + string[:split]
        # Windows that reach beyond the prefix shared with any other piece stand alone.
        stop = min(len(text) - LENGTH, len(text) - split + min(split, shared) - LENGTH) + 1
        start = None
        for k in range(stop):
            window = text[k : k + LENGTH]
            if window in seen:
                start = k if start is None else start
            else:
                seen.add(window)
                if start is not None:
                    yield number, tie, place + start, place + k - 1 + LENGTH
                    start = None
        if start is not None:
            yield number, tie, place + start, place + stop - 1 + LENGTH


def merge_part(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated spans of one part: those its runs bring along and those found by merging them."""
    payloads = list(rows["payload"])
    spans = [decode_spans(p) for p in payloads if p[:1] == b"S"]
    found: list[tuple[int, int, int, int]] = []
    group: list[tuple[int, bytes, tuple]] = []
    for piece in merged([decode_run(p) for p in payloads if p[:1] == b"R"]):
        if piece[0] < GRAM and group:
            found.extend(group_spans(group))
            group = []
        group.append(piece)
    found.extend(group_spans(group))
    spans.append(np.array(found, np.int64).reshape(-1, 4).T)
    every = np.concatenate(spans, 1)
    return pd.DataFrame(dict(zip(("id", "tie", "start", "end"), every, strict=True)))


def tie_of(text: bytes) -> int:
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "big", signed=True)


def sorted_runs(marked: DataFrame, parts: int, run_size: int = RUN) -> DataFrame:
    """Runs of the pieces of (id, text, numbers): rows of part and payload.

    ``numbers`` are those of the pieces to sort, doubled, odd if the anchor string is hot.
    """

    def flush(pieces: list[tuple]) -> pa.RecordBatch:
        pieces.sort()
        out: dict[int, list[tuple]] = {}
        spans: dict[int, list[tuple]] = {}
        first: tuple = ()
        for part, *piece in pieces:
            if first[:3] == (part, piece[0], piece[1]):
                _, _, number, tie, place = piece
                if first[3:] != (number, tie, place):  # else a repeated row
                    spans.setdefault(number % parts, []).append((number, tie, place, place + len(piece[0])))
            else:
                out.setdefault(part, []).append(tuple(piece))
                first = (part, *piece)
        rows = [(p, encode_run(x)) for p, x in out.items()] + [(p, encode_spans(x)) for p, x in spans.items()]
        arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[tuple] = []
        for batch in batches:
            ids, numbers = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for start, stop, part, (text, first, last, anchor, gram) in pieces_of(batch.column(1)):
                data = part.tobytes()
                borders = np.searchsorted(text, np.arange(stop - start + 1))
                origin = texts_of(batch.column(1))[1][start : stop + 1]
                origin = (origin - origin[0]).tolist()
                first, last, anchor, gram = (x.tolist() for x in (first, last, anchor, gram % np.uint64(parts)))
                for t in range(stop - start):
                    low, high = int(borders[t]), int(borders[t + 1])
                    wanted = [x for x in numbers[start + t].as_py() if x // 2 < high - low]
                    if not wanted:
                        continue
                    number, begin = int(ids[start + t]), origin[t]
                    tie = tie_of(data[begin : origin[t + 1]])
                    for x in set(wanted):
                        k = low + x // 2
                        a, p, q = anchor[k], first[k], last[k]
                        if not x % 2:
                            string = data[a : q + LENGTH] + data[p:a][::-1]
                            pieces.append((gram[k], string, q + LENGTH - a, number, tie, p - begin))
                        else:
                            for w in range(p, q + 1):
                                string = data[a : w + LENGTH] + data[w:a][::-1]
                                pieces.append((zlib.crc32(string) % parts, string, w + LENGTH - a, number, tie, w - begin))
                    if len(pieces) >= run_size:
                        yield flush(pieces)
                        pieces = []
        if pieces:
            yield flush(pieces)

    return marked.mapInArrow(run, "part int, payload binary")


def repeated_spans(rows: DataFrame, hot: int = HOT, run_size: int = RUN) -> DataFrame:
    """Spans of (id, text) that repeat earlier bytes: id, tie (the text's digest), start, end; they may overlap."""
    spark = rows.sparkSession
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = anchor_rows(rows)
    counts = stage(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    # The most frequent strings, at most OFTEN of them by their share of all repeats, are looked up in
    # a broadcast table; their anchors then join nothing and are spread by a salt.
    repeats = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counts.where(F.col("n") * OFTEN > repeats).select(F.col("gram").alias("known"), F.col("n").alias("n_often"))
    marked = anchors.join(F.broadcast(often), F.col("gram") == F.col("known"), "left").drop("known")
    marked = marked.withColumn("salt", F.when(F.col("n_often").isNull(), 0).otherwise(1 + F.pmod("id", F.lit(1024))))
    # A remainder, not a constant, so that the salt stays a key of the join.
    rare = counts.select(F.col("gram").alias("of"), F.pmod("n", F.lit(1)).alias("of_salt"), "n")
    joined = marked.join(rare, (F.col("gram") == F.col("of")) & (F.col("salt") == F.col("of_salt")), "left")
    joined = joined.withColumn("n", F.coalesce("n_often", "n")).where("n is not null")
    code = (2 * F.col("number") + (F.col("n") > hot).cast("int")).alias("code")
    wanted = joined.select("id", code).groupBy("id").agg(F.collect_list("code").alias("numbers"))
    runs = sorted_runs(rows.join(wanted, "id"), parts, run_size)
    return runs.groupBy("part").applyInPandas(merge_part, "id long, tie long, start long, end long")


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal removed runs."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    left, at = [], 0
    for start, end in runs:
        left.append(text[at:start])
        at = end
    return b"".join([*left, text[at:]]), [(a, b) for a, b in runs]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bytes_too: bool = False, **options) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256; with ``bytes_too``, also kept and spans."""
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    spans = repeated_spans(rows, **options)
    by_id = spans.groupBy("id").agg(F.collect_list(F.struct("tie", "start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = texts_of(batch.column(1))
            out = []
            for k, found in enumerate(batch.column(2)):
                text = data[borders[k] : borders[k + 1]].tobytes()
                removed: list[tuple[int, int]] = []
                if found.is_valid:
                    flat = found.values.flatten()
                    tie, start, end = (x.to_numpy(zero_copy_only=False) for x in flat)
                    own = tie == tie_of(text)
                    removed = list(zip(start[own].tolist(), end[own].tolist(), strict=True))
                left, removed = _cut(text, removed)
                row = (len(text), sum(b - a for a, b in removed), len(removed), sha256(left).hexdigest())
                out.append((*row, left, removed) if bytes_too else row)
            columns = list(zip(*out, strict=True)) or [()] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types: list = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if bytes_too:
        names += ["kept", "spans"]
        types += [pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        schema += ", kept binary, spans array<struct<start:long,end:long>>"
    found = rows.join(by_id, "id", "left").mapInArrow(run, schema)
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).cast(kind).alias(id_col), *names)
