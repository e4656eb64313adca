"""Helpers the operators share: reading tables, cutting batches, pre-tokens."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import regex
from pyspark.sql import DataFrame, SparkSession

# The published pre-token pattern of the byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same pattern for text of ASCII and Latin letters only, where the standard
# library's classes agree with \p{L} and \p{N}; it scans about twice as fast.
LATIN_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
WIDE_SPACE = re.compile(r"  |\s (?:\s|\Z)").search
NOT_LATIN = re.compile(r"[^\t-\r -~À-ÖØ-öø-ſ]")


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import this package where it lies, beside what their path has.

    On a cluster whose workers don't see this folder, ship the package as usual (--py-files).
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class SharedFile:
    """A small file, such as a vocabulary, read on the driver and broadcast; named by its content."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as source:
            content = source.read()
        self.digest = sha256(content).hexdigest()
        self.content = spark.sparkContext.broadcast(content)

    @property
    def value(self) -> bytes:
        return self.content.value


@lru_cache(maxsize=4)
def pre_tokenizer(pattern: str):
    """A function from a text to its list of pre-tokens."""
    general = regex.compile(pattern).findall
    if pattern != PRE_TOKEN:
        return general
    latin, foreign = re.compile(LATIN_PRE_TOKEN).findall, NOT_LATIN.search
    return lambda text: general(text) if foreign(text) else latin(text)


def space_chunks(text: str, split) -> list[str]:
    """The text in parts that no pre-token of ``PRE_TOKEN`` crosses.

    A pre-token starts at any single space that has no longer white space around
    it. Texts with wider white space are cut by ``split`` into the pre-tokens.
    """
    if WIDE_SPACE(text):
        return split(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


def slices(texts: Iterable[str], chars: int) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``chars`` characters, each text whole."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
