"""The newest event and the number of keys of a table, kept beside it batch by batch.

Each batch leaves one small file with the greatest event time among its rows as written,
and how many keys it added. The greatest of all times and the sum of all added keys are the
table's, however often a batch runs and whatever has been merged, so freshness and size are
known without reading a row of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import Files

TIME = "event_time_ms"


def _folder(path: str) -> str:
    return f"{path}.newest"


def note(spark: SparkSession, path: str, name: str, folders: Sequence[str], added: int | None = None) -> None:
    """Keep the newest event under the folders that a batch has written, and how many keys it added, if that is known."""
    newest = None
    if folders:
        newest = spark.read.schema(f"{TIME} bigint").parquet(*folders).agg(F.max(TIME)).first()[0]
    Files(spark).write(f"{_folder(path)}/{name}.json", json.dumps({TIME: newest, "added": added}) + "\n")


def exists(spark: SparkSession, path: str) -> bool:
    return Files(spark).exists(_folder(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``event_time_ms`` of the newest events that batches have left."""
    return spark.read.schema(f"{TIME} bigint").json(_folder(path))


def _notes(files: Files, path: str) -> dict[str, dict]:
    return {name: json.loads(files.read(name)) for name in files.glob(f"{_folder(path)}/*.json")}


def _folded(kept: dict[str, dict]) -> set[str]:
    """Names of the notes that a folded one stands for."""
    return {f"{name.rsplit('/', 1)[0]}/{old}" for name, entry in kept.items() for old in entry.get("folded", ())}


def added(spark: SparkSession, path: str) -> int | None:
    """Keys of the table: the sum of what its batches added; None if a batch did not say."""
    kept = _notes(Files(spark), path)
    counts = [kept[name].get("added") for name in kept.keys() - _folded(kept)]
    return None if None in counts else sum(counts)


def fold(spark: SparkSession, path: str) -> int:
    """Fold the batches' files into one; returns how many.

    Files are deleted by the call after the one that folded them, when readers that
    listed them are done. The last two batches stay as they are: one that runs again
    replaces its own note.
    """
    files = Files(spark)
    kept = _notes(files, path)
    for old in _folded(kept):
        files.delete(old)
        kept.pop(old, None)
    late = sorted((n for n in kept if "/folded-" not in n), key=files.modified)[-2:]
    done = sorted(kept.keys() - set(late))
    if len(done) > 1:
        newest = max((kept[n][TIME] for n in done if kept[n][TIME] is not None), default=None)
        counts = [kept[n].get("added") for n in done]
        entry = {TIME: newest, "added": None if None in counts else sum(counts), "folded": [n.rsplit("/", 1)[1] for n in done]}
        files.write(f"{_folder(path)}/folded-{uuid.uuid4().hex}.json", json.dumps(entry) + "\n")
    return len(done)
