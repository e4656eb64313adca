"""Mix sources to target weights: capped water-filling and seeded repetitions.

Each source asks for its weight's part of the budget. A source whose part is
above ``max_epochs`` times its size is clamped there, and what it leaves is dealt
out to the others by weight, round after round, until none is above. A round adds
up one small row per source; only two sums come to the driver.

A source's target is met by whole repetitions of all its documents and a
fractional one: documents in a seeded order, up to the point nearest the target.
The order is a hash of seed, id and text in 4,096 bins; each bin is summed by itself
and bins are added up over (source, bin) rows, so a hot source is never in one task.
Rows alike in id, text and source are counted before anything is moved, and stand in
the order as one row with a count, so a row that repeats a million times is one too.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a null id hashes as the empty string; of rows alike in id, text and
source as many are taken as come before the target, the same ones in each run, for
``mixed`` by a hash of all columns; documents without words are not taken; an empty
table gives none; other columns, whatever their names, are carried through by
``mixed`` only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096
KEY_DIGITS = 15  # hexadecimal digits of the seeded key, 60 bits
ROWS = 4096  # alike rows are written out in runs of so many


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_key(seed: int, doc_id: Column, text: Column) -> Column:
    """A number of 60 bits that orders documents; the text's part tells rows of one id or of none apart."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, KEY_DIGITS), 16, 10).cast("long")


def source_targets(groups: DataFrame, weights: Sequence[int], share_percent: int, max_epochs: int) -> DataFrame:
    """One row per source: source, source_size, weight and target. ``groups``: source, size and the number n of such rows.

    Sources are numbered by code point over ranges, so that many sources are no bottleneck either.
    """
    spark = groups.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    totals = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = totals.repartitionByRange(ranges, F.asc_nulls_last("source")).withColumn("range", F.spark_partition_id())
    ordered = stage(ordered, "mix-sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.asc_nulls_last("source"))) + F.col("offset") - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    sources = stage(ordered.join(F.broadcast(offsets), "range").select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")

    wide = "decimal(38,0)"
    whole = int(sources.agg(F.coalesce(F.sum(F.col("source_size").cast(wide)), F.lit(0))).first()[0])
    full, open_weight = 0, None
    while True:
        # The part of a source is weight * (share% of all - what full sources take) / open weight.
        left = share_percent * whole - 100 * max_epochs * full
        if open_weight is None:
            capped = F.lit(False)
        else:
            part = F.col("weight").cast(wide) * F.lit(left).cast(wide)
            capped = part > F.col("source_size").cast(wide) * F.lit(100 * max_epochs * open_weight).cast(wide)
        sums = sources.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size")).cast(wide)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight")).cast(wide)), F.lit(0)),
        ).first()
        found = int(sums[0]), int(sums[1])
        if found == (full, open_weight) or found[1] == 0:
            break
        full, open_weight = found
    if not open_weight:
        return sources.withColumn("target", F.lit(float(max_epochs)) * F.col("source_size"))
    # Up to here in whole numbers; one division gives the target.
    part = (F.col("weight") * F.lit(left)).cast("double") / F.lit(100.0 * open_weight)
    cap = (F.col("source_size") * F.lit(max_epochs)).cast("double")
    return sources.withColumn("target", F.when(capped, cap).otherwise(part))


def taken_rows(docs: DataFrame, weights: Sequence[int], share_percent: int, max_epochs: int, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per group of rows alike in id, text and source.

    Columns: source, bin, key, id, size, n (rows), source_size, target, epochs (copies that every row
    gets) and extra (how many of the n rows get one more).
    """
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"),
        seeded_key(seed, F.col(id_col), F.col(text_col)).alias("key"),
    )
    binned = narrow.withColumn("bin", F.shiftright("key", 4 * KEY_DIGITS - (BINS.bit_length() - 1)).cast("int"))
    groups = stage(binned.groupBy("source", "bin", "key", "id", "size").agg(F.count("*").alias("n")), "mix-groups")
    targets = source_targets(groups, weights, share_percent, max_epochs)
    bins = groups.groupBy("source", "bin").agg(F.sum(F.col("size") * F.col("n")).alias("bin_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before_bin", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)))
    bins = bins.join(targets.withColumnRenamed("source", "s"), bins["source"].eqNullSafe(F.col("s"))).drop("s", "bin_size", "weight")

    placed = groups.alias("d").join(
        bins.alias("b"), F.expr("d.source <=> b.source AND d.bin = b.bin")
    ).select("d.*", "b.before_bin", "b.source_size", "b.target")
    upto = Window.partitionBy("source", "bin").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before_bin") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(upto), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.withColumns({"before": before, "epochs": F.when(F.col("size") > 0, F.least(epochs, F.lit(max_epochs))).otherwise(0)})
    # A row belongs to the fractional repetition if its middle word does.
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    room = 2 * rest - (2 * F.col("before") + F.col("size")).cast("double")
    extra = F.floor(room / (2 * F.greatest("size", F.lit(1)))).cast("long") + 1
    extra = F.when((F.col("size") > 0) & (F.col("epochs") < max_epochs), F.greatest(F.lit(0), F.least("n", extra))).otherwise(0)
    return placed.withColumn("extra", extra.cast("long")).drop("before_bin", "before")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies and taken = copies * size.

    The i-th source in code-point order weighs ``weights[i % len(weights)]``.
    """
    groups = taken_rows(docs, weights, share_percent, max_epochs, seed, id_col, text_col, source_col)
    parts = F.array(
        F.struct((F.col("epochs") + 1).alias("copies"), F.col("extra").alias("rows")),
        F.struct(F.col("epochs").alias("copies"), (F.col("n") - F.col("extra")).alias("rows")),
    )
    parts = groups.withColumn("part", F.explode(F.filter(parts, lambda p: p["rows"] > 0)))
    # Alike rows stand again as often as they did, by runs, so that no array grows with their number.
    runs = parts.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part.rows") - 1, F.lit(ROWS).cast("long"))))
    length = F.least(F.lit(ROWS).cast("long"), F.col("part.rows") - F.col("run")).cast("int")
    rows = runs.withColumn("nth", F.explode(F.array_repeat(F.lit(True), length)))
    copies = F.col("part.copies")
    return rows.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with all its columns."""
    groups = taken_rows(docs, weights, share_percent, max_epochs, seed, id_col, text_col, source_col)
    groups = stage(groups.where("epochs + extra > 0").select("source", "key", "id", "n", "epochs", "extra"), "mix-taken")
    # The input row is one column, so that no name of its columns matters.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("own_id"),
        F.col(source_col).alias("own_source"),
        seeded_key(seed, F.col(id_col), F.col(text_col)).alias("own_key"),
    )
    same = (F.col("own_key") == F.col("key")) & F.col("own_id").eqNullSafe(F.col("id")) & F.col("own_source").eqNullSafe(F.col("source"))
    alike = groups.where("extra = 0 OR extra = n")
    copies = F.col("epochs") + F.when(F.col("extra") > 0, 1).otherwise(0)
    taken = rows.join(alike, same).select("row", copies.alias("copies"))
    # At most one group of a source is taken in part: the one its target falls into.
    cut = groups.where("extra > 0 AND extra < n")
    if not cut.isEmpty():
        order = Window.partitionBy("source", "key", "id").orderBy("hash")
        parted = rows.join(cut, same).withColumn("hash", F.xxhash64("row")).withColumn("nth", F.row_number().over(order))
        copies = F.col("epochs") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
        taken = taken.unionByName(parted.select("row", copies.alias("copies")).where("copies > 0"))
    return taken.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
