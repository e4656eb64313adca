"""Secrets without digits, and such that signs would split, outside the base patterns."""

import random

import pytest

from tidemark.llm import secrets
from tidemark.llm.texts import table

SF = "/root/testdata/sf0.01"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


@pytest.fixture(scope="module")
def learned(spark):
    docs = table(spark, SF, "documents")
    return secrets.learn(docs), [r.text for r in docs.where("n_chars between 500 and 3000").limit(200).collect()]


@pytest.mark.parametrize("kind", ["letters", "signs"])
def test_planted_values_without_digits_are_found(learned, kind):
    crf, texts = learned
    draw, found = random.Random(3), 0
    for text in texts:
        value = "".join(draw.choice(LETTERS) for _ in range(18))
        value = value[:6] + "$" + value[6:12] + "!" + value[12:] if kind == "signs" else value
        words = text.split(" ")
        start = " ".join([*words[: len(words) // 2], "Bearer "])
        found += (len(start), len(start) + len(value)) in crf.spans(start + value + " " + " ".join(words[len(words) // 2 :]))
    assert found >= 0.9 * len(texts)


def test_digit_free_base_values_are_learned_from():
    (_, tags), *_ = secrets.sequences(["one two password = kJhGfDsAq=WeRt three four"])
    assert tags.tolist() == [0, 0, 0, 0, 1, 2, 2, 0, 0]
