"""Token counts and byte-level BPE against the libraries they must agree with."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, token_counts
from tidemark.llm.texts import PRE_TOKEN, pre_tokenizer, space_chunks

LETTERS = "abcdefgthe ing   \n\t.,'\"<|endoftext|>éñü漢字ー😀²½Ⅷ\x1c\x85\xa0​᠎　_0123sS'll'LL"


def odd_texts(n, seed=1):
    draw = random.Random(seed)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 60))) for _ in range(n)]
    return [*texts, "", "<|endoftext|> a <|endoftext|>", "a" * 700, " " * 500, "\n" * 77 + "x", "0" * 3000, "''" * 99, "\x00<unk> <s>"]


@pytest.fixture(scope="module")
def counter():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        return token_counts.PrefixCounter(source.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def coder():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as source:
        return byte_bpe.ByteBpe(byte_bpe.read_ranks(source.read()), P.PATTERN)


def test_counts_are_the_library_s(counter, library):
    texts = odd_texts(4000)
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_of_a_text(counter, library):
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in [*odd_texts(60, 2), "a  b  \n\n c 's it's <|endoftext|>  x"]:
        table = counter.boundaries(text)
        assert table[1][-1] == size(text) and table[0][-1] == len(text)
        for n in range(len(text) + 1):
            assert counter.count_prefix(text, table, n) == size(text[:n])
        for budget in range(0, table[1][-1] + 1, 3):
            cut = counter.cut_at(text, table, budget)
            assert size(text[:cut]) <= budget


def test_prefix_counts_within_a_word(counter, library):
    got = counter.prefix_counts(" internationalisation")
    assert got == [len(library.encode(" internationalisation"[:n]).ids) for n in range(len(got))]


def test_budgets_from_the_table_alone(spark, library):
    docs = spark.createDataFrame([(1, "one two three four"), (2, None)], "doc_id long, text string")
    table = token_counts.prefix_table(docs, P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.c for r in table.select("doc_id", token_counts.chars_within(2).alias("c")).collect()}
    assert got == {1: len("one two"), 2: 0}


def test_ids_are_the_library_s_and_decode_back(coder):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as source:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(4000, 3)
    for text, ids in zip(texts, coder.encode_batch(texts)):
        assert ids == library.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_written_ids_and_bytes_are_those_of_the_ids(coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_CHUNKS", 50)
    texts = odd_texts(900, 5)
    for start in range(0, len(texts), 40):
        part = texts[start : start + 40]
        for text, ids, (spelled, data) in zip(part, coder.encode_batch(part), coder.write_batch(part), strict=True):
            assert spelled.decode().split() == list(map(str, ids)) and spelled.count(b" ") == len(ids)
            assert data == text.encode()


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as source:
        own = byte_bpe.ByteBpe(byte_bpe.read_ranks(source.read()), P.PATTERN)
    monkeypatch.setattr(byte_bpe, "CACHED_CHUNKS", 4)
    inner, asked = own.encode_words, []
    monkeypatch.setattr(own, "encode_words", lambda words: asked.extend(words) or inner(words))
    first, second = ([*own.encode_batch([text])][0] for text in ("one two three", "one two three four five, six"))
    assert own.decode(first) == b"one two three" and own.decode(second) == b"one two three four five, six"
    assert sorted(asked) == sorted(["one", " two", " three", " four", " five", ",", " six"])


def test_encode_then_decode_as_tables(spark):
    docs = spark.createDataFrame([(1, "Grüße, 漢字!"), (2, None), (3, "")], "doc_id long, text string")
    ranks = P.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(docs, ranks, P.PATTERN)
    back = byte_bpe.decode(ids, ranks).select("doc_id", F.decode("text", "UTF-8").alias("t"))
    assert {r.doc_id: r.t for r in back.collect()} == {1: "Grüße, 漢字!", 2: "", 3: ""}


def test_chunks_never_cross_a_pre_token():
    split = pre_tokenizer(PRE_TOKEN)
    for text in odd_texts(3000, 4):
        assert [w for c in space_chunks(text, split) for w in split(c)] == split(text)


def test_gaps_in_the_ranks_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.sentencepiece_model({b"a": 0, b"b": 2})
