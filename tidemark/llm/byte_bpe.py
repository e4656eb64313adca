"""Byte-level BPE through a sentencepiece model serialised from the vocabulary.

The ranks file gives each token's bytes and rank. ``sentencepiece_model`` writes
a BPE model in sentencepiece's own format straight from it: a piece is the
token's bytes, each as one printable letter, its score is minus its rank, its id
is its rank, and normalisation is the identity. Nothing is trained. Joining the
adjacent pair of best score then is joining the pair of lowest rank, leftmost
first, which is what byte-level BPE does. Pre-tokens are encoded one by one, and
ids are decoded by the inverse of the same mapping.

Defined results: a null text encodes as the empty one (no ids); special strings
are ordinary text; repeated rows each give a row; an empty table gives an empty
table; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain, islice

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import NOT_LATIN, PRE_TOKEN, SharedFile, pre_tokenizer, slices, space_chunks
from tidemark.llm.token_counts import byte_letters

SLICE_CHARS = 1 << 20
CACHED_CHUNKS = 200_000  # a bound on memory only: beyond it only parts of the texts at hand stay


def read_ranks(text: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    pairs = (line.split() for line in text.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model with the tokens as pieces, ids equal to ranks.

    The ranks must run from 0 without gaps; the piece for unknown text follows them.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    letter = {b: c for c, b in byte_letters().items()}
    # Field numbers and codes of sentencepiece's public model format.
    normal, unknown, bpe = 1, 2, 2
    pieces = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(map(letter.__getitem__, token)).encode()
        score = struct.pack("<f", -rank)
        pieces.append(_block(1, _block(1, text) + _varint(2 << 3 | 5) + score + _number(3, normal)))
    pieces.append(_block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, unknown)))
    trainer = _number(3, bpe) + _number(4, len(ranks) + 1) + _number(40, len(ranks))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))  # no begin, end or padding
    normalizer = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class ByteBpe:
    """Encodes texts to ids and ids back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PRE_TOKEN):
        letters = byte_letters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        letter = {b: c for c, b in letters.items()}
        self.letters = "".join(map(letter.__getitem__, range(256)))
        self.ranks = ranks
        pieces = (self.model.id_to_piece(i) for i in range(len(ranks)))
        self.bytes_of = [bytes(map(letters.__getitem__, piece)) for piece in pieces]
        self.spelled = [b"%d " % i for i in range(len(ranks))]
        self.split = pre_tokenizer(pattern)
        self.own_pattern = pattern == PRE_TOKEN
        self.known: dict[str, tuple[int, ...]] = {}
        self.written: dict[str, tuple[bytes, bytes]] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each pre-token. One that is a token as a whole has that token's id alone."""
        data = [w.encode() for w in words]
        found = [[rank] if (rank := self.ranks.get(d)) is not None else None for d in data]
        rest = [d for d, ids in zip(data, found, strict=True) if ids is None]
        if rest:
            # no byte of UTF-8 is 255
            letters = codecs.charmap_decode(b"\xff".join(rest), "strict", self.letters)[0].split(self.letters[255])
            made = iter(self.model.encode(letters, out_type=int, num_threads=1))
            found = [next(made) if ids is None else ids for ids in found]
        return found

    def cut(self, texts: list[str], known: dict, form: Callable[[list[int]], tuple]) -> list[list[str]]:
        """The texts in parts that no pre-token crosses; ``known`` holds the form of each part's ids.

        Parts are the pre-tokens, or longer ones where those are slower to find.
        """
        words: set[str] = set()
        chunks: set[str] = set()
        parts = []
        for text in texts:
            if self.own_pattern and NOT_LATIN.search(text):
                parts.append(space_chunks(text, self.split))
                chunks.update(parts[-1])
            else:
                parts.append(self.split(text))
                words.update(parts[-1])
        new = sorted(words.difference(known))
        longer = sorted(chunks.difference(known, words))
        if len(known) + len(new) + len(longer) > CACHED_CHUNKS:
            # what these texts hold stays
            held = {part: known[part] for part in (words | chunks) & known.keys()}
            known.clear()
            known.update(held)
        known.update(zip(new, map(form, self.encode_words(new)), strict=True))
        inner = [self.split(c) for c in longer]
        ids = iter(self.encode_words([w for ws in inner for w in ws]))
        known.update((c, form(list(chain.from_iterable(islice(ids, len(ws)))))) for c, ws in zip(longer, inner, strict=True))
        return parts

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        for parts in self.cut(texts, self.known, tuple):
            yield list(chain.from_iterable(map(self.known.__getitem__, parts)))

    def write(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Ids as decimals, each with a space after it, and the bytes they decode to."""
        return b"".join(map(self.spelled.__getitem__, ids)), self.decode(ids)

    def write_batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """``write`` of the ids of each text, put together from that of its parts' ids."""
        for parts in self.cut(texts, self.written, self.write):
            found = [self.written[part] for part in parts]
            yield b"".join([spelled for spelled, _ in found]), b"".join([data for _, data in found])

    def encode(self, text: str) -> list[int]:
        return next(self.encode_batch([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODERS: dict[tuple[str, str], ByteBpe] = {}


def coder_of(shared: SharedFile, pattern: str) -> ByteBpe:
    """The worker's own coder for a vocabulary, built once; another takes its place."""
    key = shared.digest, pattern
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ByteBpe(read_ranks(shared.value), pattern)
    return _CODERS[key]


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, columns: dict, rows_of) -> DataFrame:
    """``rows_of(coder, texts)``, a row for every document, as columns of the Arrow types given."""
    shared = SharedFile(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared, pattern)
        for batch in batches:
            done = 0
            for part in slices((t.as_py() or "" for t in batch.column(1)), SLICE_CHARS):
                values = list(rows_of(coder, part))
                arrays = [pa.array(x, kind) for x, (kind, _) in zip(zip(*values), columns.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), *arrays], names=["id", *columns])
                done += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = ", ".join([f"id {kind}", *(f"{name} {sql}" for name, (_, sql) in columns.items())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, ranks_path: str, pattern: str = PRE_TOKEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``ids``, the tokens of its whole text."""
    columns = {"ids": (pa.list_(pa.int32()), "array<int>")}
    return _mapped(docs, ranks_path, pattern, id_col, text_col, columns, lambda coder, texts: ((ids,) for ids in coder.encode_batch(texts)))


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: its id and ``text``, the bytes its ids stand for. No ids, or null: empty."""
    shared = SharedFile(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared, PRE_TOKEN)
        for batch in batches:
            texts = [coder.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, text binary").withColumnRenamed("id", id_col)


def _digests(coder: ByteBpe, texts: list[str]) -> Iterator[tuple[int, str, str]]:
    for spelled, data in coder.write_batch(texts):
        yield spelled.count(b" "), sha256(spelled[:-1]).hexdigest(), sha256(data).hexdigest()


def round_trip(docs: DataFrame, ranks_path: str, pattern: str = PRE_TOKEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, and digests of its ids and of the bytes they decode to.

    Encoding and decoding share one pass, so the ids are not moved.
    """
    columns = {
        "n_tokens": (pa.int64(), "long"),
        "ids_sha256": (pa.string(), "string"),
        "decoded_sha256": (pa.string(), "string"),
    }
    return _mapped(docs, ranks_path, pattern, id_col, text_col, columns, _digests)
