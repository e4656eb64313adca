"""Exact dedup that stays even when one text fills a third of the table.

Texts are equal when identical without white space (space, tab to carriage
return). Copies are combined in three steps, and each step groups by the digest
and the whole normalised text, so that content, not a digest, decides:

1. locally, before any exchange: each task keeps one row per text and salt;
2. per salt: the rows of one digest and salt meet, a hot digest in many places;
3. globally: the winners of the salts meet, at most one per salt and text.

Rows then learn their group over (digest, salt), so no place gets all copies of
a hot text. If a digest ever stood for two texts, its rows are joined by content.

Of equal texts the row with the most code points in its original text stays,
then the one with the smallest id, a null id last. Defined results: a null text
counts as empty, and empty texts are equal; rows that repeat an id within a group
all count in group_size, and one of them is marked kept; a table without rows
gives none; other columns, whatever their names, are carried through by
``keep_one`` and not read by ``classes`` and ``members``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

SALTS = 32
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """id, n_chars of the original text, norm, digest and a salt that depends on the id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.length(text).alias("n_chars"), normalised(text).alias("norm"))
    salt = F.pmod(F.xxhash64("id", "n_chars"), F.lit(SALTS)).cast("int")
    return rows.select("id", "n_chars", "norm", digest(F.col("norm")).alias("digest"), salt.alias("salt"))


def _strength() -> Column:
    """One number that orders rows by length, then smallest id, null ids last; of fixed width, so hashing suffices.

    Its last 20 digits are 2^63 less the id (0 for a null id), those before them the length.
    """
    rank = F.coalesce(F.lit(str(2**63)).cast("decimal(20,0)") - F.col("id").cast("decimal(20,0)"), F.lit(0))
    digits = F.concat(F.col("n_chars").cast("string"), F.lpad(rank.cast("decimal(20,0)").cast("string"), 20, "0"))
    return digits.cast("decimal(38,0)")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_of) -> DataFrame:
    """One row per distinct normalised text: digest, norm, keep_id, keep_chars, group_size, n_texts of the digest."""
    rows = _rows(docs, id_col, text_col, digest).withColumn("strength", _strength())
    salted = rows.groupBy("digest", "salt", "norm").agg(F.max("strength").alias("strength"), F.count("*").alias("n"))
    whole = salted.repartition("digest").groupBy("digest", "norm").agg(F.max("strength").alias("strength"), F.sum("n").alias("group_size"))
    digits = F.lpad(F.col("strength").cast("string"), 38, "0")
    rank = F.substring(digits, 19, 20).cast("decimal(20,0)")
    return whole.select(
        "digest",
        "norm",
        F.when(rank > 0, F.lit(str(2**63)).cast("decimal(20,0)") - rank).cast("long").alias("keep_id"),
        F.substring(digits, 1, 18).cast("int").alias("keep_chars"),
        "group_size",
        F.count("*").over(Window.partitionBy("digest")).alias("n_texts"),
    )


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_of) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and text_sha256."""
    found = classes(docs, id_col, text_col, digest)
    # Only texts that share their digest with another text are written out with it.
    norm = F.when(F.col("n_texts") > 1, F.col("norm")).alias("norm")
    found = stage(found.select("digest", norm, "keep_id", "keep_chars", "group_size", "n_texts"), "text-classes")
    rows = _rows(docs, id_col, text_col, digest).withColumn("text_sha256", sha256_of(F.col("norm")))
    narrow = rows.select("id", "n_chars", "digest", "salt", "text_sha256")
    single = found.where("n_texts = 1").drop("norm", "n_texts")
    places = narrow.select("digest", "salt").distinct().join(single, "digest")
    joined = narrow.join(places, ["digest", "salt"])
    if not found.where("n_texts > 1").isEmpty():
        shared = found.where("n_texts > 1").drop("n_texts")
        clash = rows.join(shared.select("digest").distinct(), "digest", "left_semi").join(shared, ["digest", "norm"])
        joined = joined.unionByName(clash.select(joined.columns))
    winner = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    # Only rows that may stay need an order among repeats of their id; the others are spread.
    spread = F.when(winner, F.lit(0)).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)))
    repeats = Window.partitionBy("id", "text_sha256", "spread").orderBy("salt")
    first = joined.withColumns({"winner": winner, "spread": spread}).withColumn("nth", F.row_number().over(repeats))
    return first.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("keep_id").cast(docs.schema[id_col].dataType).alias("keep_id"),
        "group_size",
        (F.col("winner") & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat id and text, one.

    Rows with an id of their own are found by it. Only rows without id, and those whose
    id stands more than once, are hashed again and told apart by text and length.
    """
    kept = members(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("kept_id"), F.col("text_sha256").alias("kept_digest"))
    kept = stage(kept, "kept")
    used = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("kept_id")).agg(F.count("*").alias("n"))
    several = stage(used.where("n > 1").select("kept_id"), "several")
    # The input row is one column, so that no name of its columns matters.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("own_id"), F.col(text_col).alias("own_text"))
    own = F.col("own_id") == F.col("kept_id")
    alone = kept.where("kept_id IS NOT NULL").join(several, "kept_id", "left_anti").select("kept_id")
    single = rows.join(alone, own, "left_semi").select("row")

    repeated = rows.where("own_id IS NULL").unionByName(rows.join(several, own, "left_semi"))
    digest = sha256_of(normalised(F.col("own_text")))
    order = F.struct((-F.length(F.coalesce(F.col("own_text"), F.lit("")))).alias("less"), F.xxhash64("row").alias("hash"))
    hashed = repeated.select("row", F.col("own_id"), digest.alias("digest"), order.alias("order"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    wanted = hashed.join(kept, same, "left_semi")
    one = wanted.groupBy("own_id", "digest").agg(F.min_by("row", "order").alias("row"))
    return single.unionByName(one.select("row")).select("row.*")
