"""Exact token counts by dynamic programming over prefixes.

The model is a byte-level BPE read from a ``tokenizers`` JSON file. For every
prefix of a pre-token the table holds the last token of that prefix's encoding
and how many tokens it has. A prefix ending at ``i`` ends in the one vocabulary
token ``t`` whose left neighbour, the last token of the prefix before ``t``, BPE
would leave apart from it. So one pass from left to right gives the count at
every prefix. An Aho-Corasick automaton names the tokens that end at each place.

Counts of text prefixes and cuts to a token budget are then read from sums over
pre-tokens; nothing is encoded again.

Defined results: a null text counts as empty (0 bytes, 0 tokens); strings of
special tokens inside a text count as one token, as the library does by default;
repeated rows each give a row; an empty table gives an empty table; other
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import PRE_TOKEN, SharedFile, pre_tokenizer, slices, space_chunks

SLICE_CHARS = 1 << 20
CACHED_CHUNKS = 400_000  # bounds on memory only: beyond them a cache starts anew
CACHED_PAIRS = 1_000_000
BORDER = "\u0100"  # no byte, so in no token


def byte_letters() -> dict[str, int]:
    """The printable letter each byte is written as in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class Known(dict):
    """Counts by chunk; a chunk not known yet counts 0 and is noted."""

    missed: list[str]

    def __missing__(self, chunk: str) -> int:
        self.missed.append(chunk)
        return 0


class PrefixCounter:
    """Token counts at every prefix under one byte-level BPE model."""

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        model, letters = spec["model"], byte_letters()
        pre = spec.get("pre_tokenizer") or {}
        unsupported = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback") if model.get(k)]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or unsupported:
            raise ValueError("only byte-level BPE models without normaliser or affixes are supported")
        as_bytes = lambda piece: bytes(letters[c] for c in piece)
        added = {t["content"] for t in spec.get("added_tokens", ())}
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.token = {as_bytes(p): n for p, n in model["vocab"].items() if p not in added}
        if len({t for t in self.token if len(t) == 1}) < 256:
            raise ValueError("the vocabulary lacks a byte")
        self.found = ahocorasick.Automaton()
        for piece, number in self.token.items():
            self.found.add_word(piece.decode("latin-1"), len(piece) << 20 | number)
        self.found.make_automaton()
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            pair_ids, whole = (self.token[left], self.token[right]), self.token[left + right]
            self.merge.setdefault(pair_ids, rank)
            self.halves.setdefault(whole, (*pair_ids, rank))
        self.apart: dict[int, bool] = {}
        self.known = Known()
        self.split = pre_tokenizer(PRE_TOKEN)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' bytes joined gives the two tokens again.

        The last merge inside either token is undone, later ranks first. A pair
        across the border that merges earlier than the merge last undone on the
        left (at the latest as early, on the right) would have been taken.
        """
        a, b, limit = left, right, float("inf")
        result = True
        while True:
            across = self.merge.get((a, b))
            if across is not None and across < limit:
                result = False
                break
            undo_a, undo_b = self.halves.get(a), self.halves.get(b)
            if undo_a is None and undo_b is None:
                break
            if undo_b is None or (undo_a is not None and undo_a[2] > undo_b[2]):
                a, limit = undo_a[1], undo_a[2]
            else:
                b, limit = undo_b[0], undo_b[2] + 0.5
        if len(self.apart) > CACHED_PAIRS:
            self.apart.clear()
        self.apart[left << 20 | right] = result
        return result

    def table(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Token counts at every byte prefix of many words, and where each word's row starts.

        The words stand in one string with a letter between them that no token has.
        Row ``k`` runs from its start, the empty prefix, to the word's whole length.
        """
        rows = [w.encode().decode("latin-1") for w in words]
        starts = list(accumulate((len(r) + 1 for r in rows), initial=0))
        last, count = [-1] * starts[-1], [0] * starts[-1]
        known = self.apart
        for end, match in self.found.iter(BORDER + BORDER.join(rows)):
            if last[end] < 0:
                token = match & 0xFFFFF
                start = end - (match >> 20)
                left = last[start]
                if left >= 0:
                    pair = left << 20 | token
                    apart = known.get(pair)
                    if apart is None:
                        apart = self.stay_apart(left, token)
                    if not apart:
                        continue
                last[end] = token
                count[end] = count[start] + 1
        return count, starts

    def prefix_counts(self, word: str) -> list[int]:
        """The number of tokens of each byte prefix of one pre-token, from the empty one."""
        return self.table([word])[0]

    def learn(self, chunks: set[str]) -> None:
        """Store the counts of chunks not seen yet; sorted, they walk the automaton along the same paths."""
        new = sorted(chunks)
        if len(self.known) + len(new) > CACHED_CHUNKS:
            self.known.clear()
        words = [self.split(c) for c in new]
        count, starts = self.table([w for ws in words for w in ws])
        totals = (count[s - 1] for s in starts[1:])
        for chunk, ws in zip(new, words):
            self.known[chunk] = sum(islice(totals, len(ws)))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        known, totals, later = self.known, [], []
        for text in texts:
            special = 0
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                chunks, special = [c for part in parts for c in space_chunks(part, self.split)], len(parts) - 1
            else:
                chunks = space_chunks(text, self.split)
            known.missed = []
            totals.append(special + sum(map(known.__getitem__, chunks)))
            later.append(known.missed)
        new = set().union(*later)
        if new:
            self.learn(new)
            totals = [n + sum(map(known.__getitem__, missed)) for n, missed in zip(totals, later)]
        return totals

    def counts_of_words(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token, in order."""
        count, starts = self.table(words)
        return [count[s - 1] for s in starts[1:]]

    def boundaries(self, text: str) -> tuple[list[int], list[int]]:
        """Character offsets where pre-tokens end, from 0, and the tokens up to each."""
        ends, sums = [0], [0]
        spans = [m.span() for m in self.special.finditer(text)] if self.special else []
        start = 0
        for special in [*spans, None]:
            words = self.split(text[start : special[0] if special else len(text)])
            totals = self.counts_of_words(words)
            ends += list(accumulate(map(len, words), initial=start))[1:]
            sums += list(accumulate(totals, initial=sums[-1]))[1:]
            if special:
                start = special[1]
                ends.append(start)
                sums.append(sums[-1] + 1)
        return ends, sums

    def count_prefix(self, text: str, table: tuple[list[int], list[int]], chars: int) -> int:
        """Tokens of the text's first ``chars`` characters, from its ``boundaries``.

        Pre-tokens end where they do in the whole text, but for the last one and
        a run of white space before the cut, which reads ahead; those few are
        looked up by themselves.
        """
        ends, sums = table
        at = bisect_right(ends, max(0, min(chars, len(text)))) - 1
        cut = min(max(chars, 0), len(text))
        if cut in (0, len(text)):
            return sums[-1] if cut else 0
        at = max(0, at - (ends[at] == cut))
        while at and text[ends[at] - 1 : ends[at] + 1].isspace() or at and text[ends[at - 1] : ends[at]].isspace():
            at -= 1
        tail = text[ends[at] : cut]
        return sums[at] + self.counts([tail])[0]

    def cut_at(self, text: str, table: tuple[list[int], list[int]], budget: int) -> int:
        """The most characters, up to a whole pre-token or a prefix of the next, within the budget."""
        ends, sums = table
        at = bisect_right(sums, budget) - 1
        while at and self.count_prefix(text, table, ends[at]) > budget:
            at -= 1
        best = ends[at]
        if at + 1 < len(ends):
            word = text[ends[at] : ends[at + 1]]
            for size in range(len(word) - 1, 0, -1):
                if self.count_prefix(text, table, ends[at] + size) <= budget:
                    return ends[at] + size
        return best


_COUNTERS: dict[str, PrefixCounter] = {}


def counter_of(shared: SharedFile) -> PrefixCounter:
    """The worker's own counter for a model, built once; another model takes its place."""
    if shared.digest not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[shared.digest] = PrefixCounter(shared.value.decode())
    return _COUNTERS[shared.digest]


def token_counts(docs: DataFrame, model_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, n_bytes, n_tokens and whether it is over ``limit`` tokens.

    The model file is read on the driver and broadcast; its size is that of a vocabulary.
    """
    shared = SharedFile(docs.sparkSession, model_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared)
        for batch in batches:
            texts = (t or "" for t in (x.as_py() for x in batch.column(1)))
            n_bytes, n_tokens = [], []
            for part in slices(texts, SLICE_CHARS):
                n_bytes += [len(t.encode()) for t in part]
                n_tokens += counter.counts(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def prefix_table(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``ends`` and ``tokens``, the offsets of pre-token ends and the tokens up to them.

    Budget questions are then answered by ``tokens_within`` without the text.
    """
    shared = SharedFile(docs.sparkSession, model_path)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared)
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                ends, sums = counter.boundaries(text.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([ends], pa.list_(pa.int64())), pa.array([sums], pa.list_(pa.int64()))],
                    names=["id", "ends", "tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(build, f"id {kind}, ends array<long>, tokens array<long>").withColumnRenamed("id", id_col)


def chars_within(budget: int):
    """On a ``prefix_table``: the characters of the longest run of whole pre-tokens within the budget."""
    fits = F.filter(F.arrays_zip("ends", "tokens"), lambda x: x["tokens"] <= budget)
    return F.array_max(F.transform(fits, lambda x: x["ends"]))
