"""Tables with a log: replays, failures, compaction beside readers and streams, summaries, audits."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import tables
from tidemark.plans import reconcile
from tidemark.schemas import PRICES, bronze_schema, landing_schema
from tidemark.session import Files, list_folders
from tidemark.sources import landing
from tidemark.streaming import sinks

LANDING = landing_schema(PRICES)


def prices(spark, start, stop, day=date(2024, 1, 2), hour="03"):
    """Bronze rows by version."""
    made = spark.range(start, stop, numPartitions=3).withColumnRenamed("id", "lsn")
    amount = F.col("lsn").cast("decimal(38,18)")
    known = {
        "assetId": F.concat(F.lit("a"), (F.col("lsn") % 5).cast("string")), "price": amount, "marketCap": F.when(F.col("lsn") % 2 == 0, amount),
        "eventTimeMs": F.col("lsn") * 1000, "op": F.lit("u"), "lsn": F.col("lsn"), "ingestion_date": F.lit(day), "ingestion_hour": F.lit(hour),
    }
    return made.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in bronze_schema(PRICES)])


def globbed(spark, path):
    """Rows as a reader of the folder layout sees them, who knows of no log."""
    files = list_folders(spark, f"{path}/*/*/*.parquet")
    return spark.read.schema(LANDING).parquet(*files).count() if files else 0


def test_files_lie_right_under_their_hour(spark, folder):
    for n in range(2):
        sinks.lz_sink(prices(spark, n * 10, n * 10 + 10), folder, PRICES, n)
        sinks.lz_sink(prices(spark, n * 10, n * 10 + 10), folder, PRICES, n)
    path = landing.landing_path(folder, PRICES)
    assert list_folders(spark, f"{path}/*") == [f"file:{path}/ingestion_date=2024-01-02"]
    assert globbed(spark, path) == landing.lz_scan(spark, folder, PRICES).count() == 20
    assert sorted(r.lsn for r in landing.lz_scan(spark, folder, PRICES).collect()) == list(range(20))
    assert list_folders(spark, f"{path}.staging/*") == []


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_batch_that_died_while_its_files_moved(spark, folder, monkeypatch, moved):
    """The rows of the second try may fall into other files; those of the first are moved on instead."""
    path = landing.landing_path(folder, PRICES)
    sinks.lz_sink(prices(spark, 0, 10), folder, PRICES, 0)
    real, done = Files._move, []

    def failing(self, system, place, goal):
        if len(done) >= moved:
            raise OSError("lost")
        done.append(place)
        real(self, system, place, goal)

    with monkeypatch.context() as patched:
        patched.setattr(Files, "_move", failing)
        with pytest.raises(OSError, match="lost"):
            sinks.lz_sink(prices(spark, 10, 30), folder, PRICES, 1)
    assert landing.lz_scan(spark, folder, PRICES).count() == 10
    sinks.lz_sink(prices(spark, 10, 30).repartition(7), folder, PRICES, 1)
    assert sorted(r.lsn for r in landing.lz_scan(spark, folder, PRICES).collect()) == list(range(30))
    assert globbed(spark, path) == 30
    assert tables.audit(spark, path, PRICES, LANDING).count() == 0


def test_a_batch_that_failed_before_shows_nothing(spark, folder):
    path = landing.landing_path(folder, PRICES)
    sinks.lz_sink(prices(spark, 0, 10), folder, PRICES, 0)
    broken = prices(spark, 10, 20).withColumn("symbol", F.when(F.col("lsn") == 15, F.raise_error(F.lit("bad row"))).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        sinks.lz_sink(broken, folder, PRICES, 1)
    assert globbed(spark, path) == landing.lz_scan(spark, folder, PRICES).count() == 10
    sinks.lz_sink(prices(spark, 10, 20), folder, PRICES, 1)
    assert globbed(spark, path) == landing.lz_scan(spark, folder, PRICES).count() == 20


def test_an_empty_batch_is_committed(spark, folder):
    sinks.bronze_sink(prices(spark, 0, 0), f"{folder}/b", PRICES, 0)
    assert landing.bronze_scan(spark, f"{folder}/b", PRICES).count() == 0
    assert not tables.add_batch(prices(spark, 0, 5), f"{folder}/b", "0", PRICES, ["ingestion_date"])


# --- summaries --------------------------------------------------------------


def both_copies(spark, folder):
    for n in range(3):
        part = prices(spark, n * 20, n * 20 + 20, date(2024, 1, 2 + n // 2), f"0{n}")
        sinks.bronze_sink(part, f"{folder}/bronze", PRICES, n)
        sinks.lz_sink(part.repartition(2), folder, PRICES, n)
    return f"{folder}/bronze", landing.landing_path(folder, PRICES)


def reports(spark, bronze, lz, folder, **by):
    logged = (tables.entries(spark, bronze), tables.entries(spark, lz))
    held = (landing.bronze_scan(spark, bronze, PRICES), landing.lz_scan(spark, folder, PRICES))
    now = datetime(2024, 1, 4)
    for check in (reconcile.sink_validation, reconcile.sink_validation_partition):
        yield check(*logged, PRICES, now, summary=reconcile.logged_summary, **by), check(*held, PRICES, now, **by)


def test_summaries_say_what_the_rows_say(spark, folder):
    bronze, lz = both_copies(spark, folder)
    for logged, scanned in reports(spark, bronze, lz, folder):
        assert rows(logged) == rows(scanned) and {r.validation_status for r in logged.collect()} == {"HEALTHY"}
    # a batch that one copy has not got yet
    sinks.bronze_sink(prices(spark, 100, 110, hour="09"), bronze, PRICES, 9)
    whole, parts = reports(spark, bronze, lz, folder)
    assert [r.validation_status for r in whole[0].collect()] == ["MISMATCH"] and rows(whole[0]) == rows(whole[1])
    assert rows(parts[0]) == rows(parts[1]) and "MISSING_PARTITION" in {r.validation_status for r in parts[0].collect()}


def test_a_report_from_logs_opens_no_copy(spark, folder):
    bronze, lz = both_copies(spark, folder)
    for logged, _ in reports(spark, bronze, lz, folder):
        assert all(".log/" in name for name in logged.inputFiles())
    tables.roll(spark, bronze)
    for logged, scanned in reports(spark, bronze, lz, folder):
        assert all(".log/" in name for name in logged.inputFiles()) and rows(logged) == rows(scanned)


def test_an_audit_finds_what_the_log_cannot_know(spark, folder):
    bronze, lz = both_copies(spark, folder)
    assert tables.audit(spark, lz, PRICES, LANDING).count() == 0 == tables.audit(spark, bronze, PRICES, bronze_schema(PRICES)).count()
    files = list_folders(spark, f"{lz}/*/*/*.parquet")
    Files(spark).delete(files[0])
    changed = spark.read.schema(LANDING).option("basePath", lz).parquet(files[2]).withColumn("price", (F.col("price") + 1).cast("decimal(38,18)"))
    changed.drop("ingestion_date", "hour").coalesce(1).write.parquet(f"{folder}/other")
    spark.read.parquet(f"{folder}/other").coalesce(1).write.mode("append").parquet(files[3].rsplit("/", 1)[0])
    Files(spark).delete(files[2])
    Files(spark).move(list_folders(spark, f"{folder}/other/*.parquet")[0], files[2])
    logs = (tables.entries(spark, bronze), tables.entries(spark, lz))
    assert reconcile.sink_validation(*logs, PRICES, datetime(2024, 1, 4), summary=reconcile.logged_summary).first().validation_status == "HEALTHY"
    found = sorted((r.problem, r.file) for r in tables.audit(spark, lz, PRICES, LANDING).collect())
    assert [p for p, _ in found] == ["changed", "lost", "unlogged"]
    assert files[0].endswith(found[1][1]) and files[2].endswith(found[0][1])


# --- compaction -------------------------------------------------------------


def lsns(spark, path):
    return sorted(r.lsn for r in landing.bronze_scan(spark, path, PRICES).select("lsn").collect())


def test_compaction_beside_a_reader_and_a_stream(spark, folder):
    """A stream that is behind sees every row once, and so does each reader, from first to last."""
    path, seen, check = f"{folder}/bronze", f"{folder}/seen", f"{folder}/check"

    def catch_up(files):
        stream = spark.readStream.schema(bronze_schema(PRICES)).option("maxFilesPerTrigger", files).parquet(path)
        query = stream.select("lsn").writeStream.option("checkpointLocation", check).format("parquet").option("path", seen)
        query.trigger(availableNow=True).start().awaitTermination()

    for n in range(3):
        sinks.bronze_sink(prices(spark, n * 30, n * 30 + 30), path, PRICES, n)
    before = landing.bronze_scan(spark, path, PRICES)
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES)) == 9
    assert lsns(spark, path) == list(range(90)) and before.count() == 90
    assert tables.vacuum(spark, path, [check]) == 0
    tables.roll(spark, path)
    # the stream has read nothing yet, so nothing goes
    assert tables.vacuum(spark, path, [check]) == 0
    catch_up(2)
    sinks.bronze_sink(prices(spark, 90, 120), path, PRICES, 3)
    assert lsns(spark, path) == list(range(120))
    assert tables.vacuum(spark, path, [check]) == 9
    catch_up(1)
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES)) == 4
    tables.roll(spark, path)
    assert lsns(spark, path) == list(range(120))
    assert tables.vacuum(spark, path, [check]) == 4
    assert lsns(spark, path) == list(range(120))
    assert sorted(r.lsn for r in spark.read.parquet(seen).collect()) == list(range(120))
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES)) == 0
    assert tables.audit(spark, path, PRICES, bronze_schema(PRICES)).count() == 0


def test_only_chosen_days_are_rewritten_and_sorted(spark, folder):
    path = f"{folder}/bronze"
    for n in range(2):
        for day in (2, 3):
            sinks.bronze_sink(prices(spark, n * 30, n * 30 + 30, date(2024, 1, day)), path, PRICES, f"{day}-{n}")
    old = lambda e: e.where(F.col("ingestion_date") < F.lit(date(2024, 1, 3)))
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES), chosen=old) == 6
    live = tables.entries(spark, path)
    assert {(r.ingestion_date.day, r.rewritten) for r in live.collect()} == {(2, True), (3, False)}
    recent = landing.bronze_scan(spark, path, PRICES, datetime(2024, 1, 3), 0)
    assert recent.count() == 60 and all("2024-01-03" in f for f in recent.inputFiles())
    assert landing.bronze_scan(spark, path, PRICES).count() == 120


def test_a_large_sorted_day_is_left_alone(spark, folder):
    path = f"{folder}/bronze"
    add = lambda n, start, stop: sinks.bronze_sink(prices(spark, start, stop), path, PRICES, n)
    add(0, 0, 100)
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES)) == 3
    add(1, 100, 110)
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES)) == 3  # the new files only
    add(2, 110, 140)
    assert tables.compact_days(spark, path, PRICES, bronze_schema(PRICES), most_files=3) == 0
    add(3, 140, 170)
    replaced = tables.compact_days(spark, path, PRICES, bronze_schema(PRICES), most_files=3)
    assert replaced > 6 and lsns(spark, path) == list(range(170))


def test_a_rewrite_that_died_is_finished(spark, folder, monkeypatch):
    path = f"{folder}/bronze"
    for n in range(2):
        sinks.bronze_sink(prices(spark, n * 30, n * 30 + 30), path, PRICES, n)
    with monkeypatch.context() as patched:
        patched.setattr(Files, "_move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            tables.compact_days(spark, path, PRICES, bronze_schema(PRICES))
    assert lsns(spark, path) == list(range(60))
    assert len(tables.recover(spark, path)) == 1 and tables.recover(spark, path) == []
    assert lsns(spark, path) == list(range(60))
    assert {r.rewritten for r in tables.entries(spark, path).collect()} == {True}


# --- the log itself ---------------------------------------------------------


def test_rolling_changes_no_answer(spark, folder):
    path, stream = f"{folder}/bronze", "0b1c"
    for n in range(4):
        tables.add_batch(prices(spark, n * 10, n * 10 + 10), path, f"{stream}-{n}", PRICES, ["ingestion_date"])
    tables.add_batch(prices(spark, 90, 95), path, "by-hand", PRICES, ["ingestion_date"])
    before = rows(tables.entries(spark, path))
    assert tables.roll(spark, path) == 5 and tables.roll(spark, path) == 0
    assert rows(tables.entries(spark, path)) == before
    tables.add_batch(prices(spark, 40, 50), path, f"{stream}-4", PRICES, ["ingestion_date"])
    after = rows(tables.entries(spark, path))
    assert tables.roll(spark, path) == 1
    # commits that the earlier roll folded are gone, and their batches still known
    assert list_folders(spark, f"{path}.log/commits/*.json") == [f"file:{path}.log/commits/{stream}-4.json"]
    assert rows(tables.entries(spark, path)) == after
    for name in (f"{stream}-0", f"{stream}-3", "by-hand"):
        assert not tables.add_batch(prices(spark, 0, 10), path, name, PRICES, ["ingestion_date"])
    assert tables.add_batch(prices(spark, 50, 60), path, f"{stream}-5", PRICES, ["ingestion_date"])
    assert lsns(spark, path) == [*range(60), *range(90, 95)]


def test_days_past_their_time_go(spark, folder):
    path = f"{folder}/bronze"
    sinks.bronze_sink(prices(spark, 0, 10, date(2023, 1, 1)), path, PRICES, 0)
    sinks.bronze_sink(prices(spark, 10, 20), path, PRICES, 1)
    assert tables.drop_days(spark, path, datetime(2024, 1, 3), 12) == 3
    assert lsns(spark, path) == list(range(10, 20))
    assert tables.drop_days(spark, path, datetime(2024, 1, 3), 12) == 0


def test_a_folder_without_a_log_is_read_as_it_is(spark, folder):
    prices(spark, 0, 10).write.partitionBy("ingestion_date").parquet(f"{folder}/plain")
    assert lsns(spark, f"{folder}/plain") == list(range(10))
