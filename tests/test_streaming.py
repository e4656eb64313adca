"""The streaming job: same tables as a batch, and safe to run again."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import cdc, state
from tidemark.plans import activity, alerts, gold, silver
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import CAPS, PRICES, bronze_schema
from tidemark.session import list_folders, release, shared_root
from tidemark.sources import changes, landing
from tidemark.streaming import app, incremental, pipeline, progress, sinks
from test_cdc import CAP_IMAGE, IMAGE, SOURCE, envelope

EVENTS = [
    envelope(asset_id=f"a{i % 5}", event_time=f"2024-01-02T03:{i:02}:00Z", op="u", source={**SOURCE, "lsn": i}) for i in range(20)
] + [envelope(op=None), envelope(symbol=None, source={**SOURCE, "lsn": 99})]


def write_files(spark, path, events, files):
    lines = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    lines.repartition(files).write.mode("append").text(path)


def run(spark, folder, name, files, **options):
    source = f"{folder}/{name}/in"
    write_files(spark, source, EVENTS, files)
    targets = pipeline.Targets(
        landing=f"{folder}/{name}/lz",
        bronze=f"{folder}/{name}/bronze",
        topic={"path": f"{folder}/{name}/topic"},
        dead_letters={"path": f"{folder}/{name}/dlq"},
    )
    stream = changes.cdc_stream(spark, PRICES, source, maxFilesPerTrigger="1", **options)
    query = pipeline.start_bronze(stream, PRICES, targets, f"{folder}/{name}/checkpoint", available_now=True)
    query.awaitTermination()
    return query, targets


def stored(spark, targets):
    bare = [c for c in PRICES.bronze_columns if not c.startswith("ingestion")]
    return {
        "bronze": rows(landing.bronze_scan(spark, targets.bronze, PRICES).select(*bare)),
        "landing": rows(landing.lz_scan(spark, targets.landing, PRICES).select(*bare)),
        "topic": spark.read.schema("value string").text(targets.topic["path"]).count(),
        "dlq": rows(spark.read.schema("value string").text(targets.dead_letters["path"]).select("value")),
    }


def test_one_file_or_many_give_the_batch_result(spark, folder):
    _, one = run(spark, folder, "one", 1)
    query, many = run(spark, folder, "many", 4)
    first, second = stored(spark, one), stored(spark, many)
    assert first == second
    assert first["bronze"] == first["landing"] and len(first["bronze"]) == 20
    assert first["topic"] == 20 and len(first["dlq"]) == 2
    lines = changes.cdc_stream(spark, PRICES, f"{folder}/one/in", streaming=False)
    bare = [c for c in PRICES.bronze_columns if not c.startswith("ingestion")]
    assert rows(cdc.cdc_parse(lines, PRICES).select(*bare)) == first["bronze"]
    lines = spark.createDataFrame([(p.json,) for p in query.recentProgress], "value string")
    metrics = progress.progress_rows(lines)
    total = metrics.agg(F.sum("rows_in").alias("n"), F.sum("rejected").alias("bad")).first()
    assert (total.n, total.bad) == (22, 2)


def test_a_batch_that_failed_halfway_leaves_one_copy(spark, folder, monkeypatch):
    """The first try dies after the landing zone is written. The second, much
    later, repeats the batch with the same ingestion stamp."""
    source = f"{folder}/in"
    write_files(spark, source, EVENTS, 1)
    targets = pipeline.Targets(landing=f"{folder}/lz", bronze=f"{folder}/bronze", dead_letters={"path": f"{folder}/dlq"})
    stamps = []

    def start():
        stream = changes.cdc_stream(spark, PRICES, source)
        return pipeline.start_bronze(stream, PRICES, targets, f"{folder}/checkpoint", available_now=True, at=minute_stamp())

    def minute_stamp():
        # the batch clock scaled up, so that a second's difference would show as hours
        return F.timestamp_seconds(F.unix_seconds(F.current_timestamp()) * 3600 % 4_000_000_000)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "bronze_sink", fail)
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
    stamps.append(rows(landing.lz_scan(spark, targets.landing, PRICES).select("ingestion_date", "ingestion_hour").distinct()))
    spark.sparkContext._jvm.java.lang.Thread.sleep(1500)
    start().awaitTermination()
    stamps.append(rows(landing.lz_scan(spark, targets.landing, PRICES).select("ingestion_date", "ingestion_hour").distinct()))
    assert stamps[0] == stamps[1] and len(stamps[0]) == 1
    assert landing.lz_scan(spark, targets.landing, PRICES).count() == 20
    assert landing.bronze_scan(spark, targets.bronze, PRICES).count() == 20


def test_nothing_staged_is_left(spark, folder):
    run(spark, folder, "one", 1)
    app_folder = f"{shared_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    assert list_folders(spark, f"{app_folder}/batch-*") == []
    release(spark)
    assert list_folders(spark, app_folder) == []


def test_writing_a_batch_twice_changes_nothing(spark, folder):
    lines = spark.createDataFrame([(json.dumps(e),) for e in EVENTS], "value string")
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    good, bad = cdc.bronze(changes.envelope_from_json(lines, PRICES), PRICES, at)
    for _ in range(2):
        for batch in (0, 1):
            sinks.lz_sink(good.filter(F.col("lsn") % 2 == batch), f"{folder}/lz", PRICES, batch)
            sinks.dead_letter_sink(bad, {"path": f"{folder}/dlq"}, batch)
    assert landing.lz_scan(spark, f"{folder}/lz", PRICES).count() == 20
    assert spark.read.text(f"{folder}/dlq").count() == 4


def test_the_snapshot_is_loaded_once(spark, folder):
    source, out = f"{folder}/in", f"{folder}/bronze"
    write_files(spark, source, EVENTS[:5], 1)
    table = spark.createDataFrame([tuple(IMAGE.values())], ", ".join(f"{k} string" for k in IMAGE))
    snapshot = changes.snapshot_envelopes(table, PRICES, F.lit(0))
    for _ in range(2):
        pipeline.snapshot_then_stream(
            snapshot, changes.cdc_stream(spark, PRICES, source), PRICES, pipeline.Targets(bronze=out),
            f"{folder}/checkpoint", datetime(2024, 1, 1), available_now=True,
        ).awaitTermination()
    assert rows(landing.bronze_scan(spark, out, PRICES).groupBy("op").count()) == [("r", 1), ("u", 5)]


def test_streamed_state_is_the_batch_state(spark, folder):
    lines = spark.createDataFrame([(json.dumps(e),) for e in EVENTS], "value string")
    good, _ = cdc.bronze(changes.envelope_from_json(lines, PRICES), PRICES)
    good.repartition(6).write.parquet(f"{folder}/bronze")
    stream = spark.readStream.schema(good.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/bronze")
    payload = silver.state_payload(PRICES)
    incremental.latest_state_stream(stream, payload, f"{folder}/state", f"{folder}/check", available_now=True).awaitTermination()
    shape = good.select(*state.STATE_KEYS, *state.STATE_VERSION, *payload).schema
    merged = incremental.read_state(spark, f"{folder}/state", shape)
    whole = silver.latest_state(good, PRICES)
    assert rows(merged) == rows(whole) and merged.count() == 5
    incremental.compact_state(spark, f"{folder}/state", f"{folder}/compact", shape)
    assert rows(incremental.read_state(spark, f"{folder}/compact", shape)) == rows(whole)
    assert spark.read.parquet(f"{folder}/compact").count() == 5


def test_streamed_gold_is_the_batch_gold(spark, folder):
    """Versions of one fact and one asset arrive in different batches."""
    lines = spark.createDataFrame([(json.dumps(e),) for e in EVENTS], "value string")
    good, _ = cdc.bronze(changes.envelope_from_json(lines, PRICES), PRICES, F.lit("2024-01-02").cast("timestamp"))
    again = good.withColumns({"lsn": F.col("lsn") + 100, "marketCap": F.lit(7).cast("decimal(38,18)")}).filter("eventTimeMs % 120000 = 0")
    good.unionByName(again).repartition(5).write.parquet(f"{folder}/bronze")
    whole = spark.read.parquet(f"{folder}/bronze")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/bronze")
    incremental.fact_stream(stream, PRICES, f"{folder}/fct", f"{folder}/c1", available_now=True).awaitTermination()
    incremental.dim_asset_stream(stream, f"{folder}/dim", f"{folder}/c2", available_now=True).awaitTermination()
    streamed = incremental.read_facts(spark, f"{folder}/fct", PRICES)
    assert rows(streamed.drop("loaded_at")) == rows(gold.fct_market_prices(whole).drop("loaded_at"))
    assert streamed.count() == 20 and spark.read.parquet(f"{folder}/fct").count() > 20
    dim = gold.dim_asset(whole).drop("updated_at")
    assert rows(incremental.read_dim_asset(spark, f"{folder}/dim")) == rows(dim)


def test_broker_offsets_from_progress(spark):
    offsets = progress.offset_rows(spark.createDataFrame([(broker_report("bronze-market_prices", 0, 5),)], "value string"))
    assert offsets.count() == 3 and activity.consumer_lag(offsets).first().lag == 5


def broker_report(name, minute, behind, rejected=0):
    """What a query that reads a broker reports of one batch."""
    return json.dumps({
        "name": name, "runId": "r", "batchId": minute, "timestamp": f"2024-01-01T00:{minute:02}:00.000Z",
        "durationMs": {"triggerExecution": 10 + minute}, "observedMetrics": {"intake_x": {"rows_in": 9, "rejected": rejected}},
        "sources": [
            {"startOffset": None, "endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 4 + behind, "1": 7, "2": 1}}},
            {"startOffset": None, "endOffset": {"logOffset": 3}, "latestOffset": None},
        ],
    })


def test_every_batch_is_kept_and_alerts_fire(spark, folder):
    """More batches than a query remembers, under the name that the job itself gives its query."""
    write_files(spark, f"{folder}/in", EVENTS, 1)
    stream = changes.cdc_stream(spark, PRICES, f"{folder}/in")
    job = pipeline.start_bronze(stream, PRICES, pipeline.Targets(bronze=f"{folder}/bronze"), f"{folder}/check", available_now=True)
    job.awaitTermination()
    lake = Warehouse(spark, f"{folder}/lake")
    log = progress.ProgressLog(spark, f"{lake.monitoring}/progress")
    for n in range(130):
        report = json.loads(broker_report(job.name, n % 60, 5000 if n < 60 else 1, rejected=int(n == 30)))
        log.keep("run", n, json.dumps({**report, "batchId": n, "timestamp": f"2024-01-01T{n // 60:02}:{n % 60:02}:00.000Z"}))
        log.keep("run", n, json.dumps({**report, "batchId": n, "timestamp": f"2024-01-01T{n // 60:02}:{n % 60:02}:00.000Z"}))
    assert progress.progress_rows(lake.progress()).count() == 130
    assert lake.checkpoint_duration().first().max_ms == 69
    states = alerts.alerts(
        topic_offsets=progress.dead_letter_offsets(lake.progress()), consumer_offsets=progress.offset_rows(lake.progress())
    )
    fired = {(r.rule_uid, r.ts.hour * 60 + r.ts.minute) for r in states.filter("state = 'firing'").collect()}
    assert {m for uid, m in fired if uid == alerts.CONSUMER_LAG.uid} == set(range(10, 60))
    assert {m for uid, m in fired if uid == alerts.DEAD_LETTERS.uid} == set(range(30, 40))


def test_a_new_checkpoint_leaves_earlier_rows(spark, folder):
    """Ten rows through one checkpoint, three more through another, into the same targets."""
    targets = pipeline.Targets(
        landing=f"{folder}/lz", bronze=f"{folder}/bronze", topic={"path": f"{folder}/topic"}, dead_letters={"path": f"{folder}/dlq"}
    )
    for n, events in enumerate((EVENTS[:10] + EVENTS[20:21], EVENTS[10:13] + EVENTS[20:21])):
        write_files(spark, f"{folder}/in{n}", events, 1)
        stream = changes.cdc_stream(spark, PRICES, f"{folder}/in{n}")
        pipeline.start_bronze(stream, PRICES, targets, f"{folder}/check{n}", available_now=True).awaitTermination()
        bronze = spark.readStream.schema(bronze_schema(PRICES)).parquet(targets.bronze)
        payload = silver.state_payload(PRICES)
        incremental.latest_state_stream(bronze, payload, f"{folder}/state", f"{folder}/s{n}", available_now=True).awaitTermination()
        incremental.fact_stream(bronze, PRICES, f"{folder}/fct", f"{folder}/f{n}", available_now=True).awaitTermination()
    kept = stored(spark, targets)
    assert len(kept["bronze"]) == len(kept["landing"]) == kept["topic"] == 13 and len(kept["dlq"]) == 2
    whole = landing.bronze_scan(spark, targets.bronze, PRICES)
    assert incremental.read_facts(spark, f"{folder}/fct", PRICES).count() == gold.fct_market_prices(whole).count() == 13
    shape = whole.select(*state.STATE_KEYS, *state.STATE_VERSION, *payload).schema
    assert rows(incremental.read_state(spark, f"{folder}/state", shape)) == rows(silver.latest_state(whole, PRICES))


def test_the_job_and_the_warehouse_end_to_end(spark, folder):
    """Both feeds through the command line job, then every view by SQL."""
    caps = [
        envelope(after=CAP_IMAGE, asset_id=f"a{i}", event_time="2024-01-02T03:00:00Z", source={**SOURCE, "table": "market_caps", "lsn": i})
        for i in range(3)
    ]
    write_files(spark, f"{folder}/prices", EVENTS, 2)
    write_files(spark, f"{folder}/caps", caps, 1)
    for feed, source in (("market_prices", "prices"), ("market_caps", "caps")):
        app.main(["--feed", feed, "--root", f"{folder}/lake", "--format", "json", "--location", f"{folder}/{source}",
                  "--max-per-batch", "1", "--available-now"])
    lake = Warehouse(spark, f"{folder}/lake")
    lake.build_gold()
    assert lake.built_facts(PRICES).count() == 20 and lake.built_facts(CAPS).count() == 3
    assert rows(lake.market_overview(built=True)) == rows(lake.market_overview())
    views = lake.register()
    assert len(views) == 13
    for view in views:
        assert spark.sql(f"SELECT count(*) AS n FROM {view}").first().n > 0
    statuses = spark.sql("SELECT DISTINCT validation_status FROM omt_sink_validation").collect()
    assert [r[0] for r in statuses] == ["HEALTHY"]
    top = spark.sql("SELECT asset_id, max_supply, circulating_supply FROM gold_sem_market_overview WHERE asset_id = 'a1'").first()
    assert top.circulating_supply == 19 and top.max_supply is None
    assert {r.table_name: r["rows"] for r in lake.row_counts().collect()}["bronze.market_prices"] == 20
    assert lake.file_inventory(PRICES).first().objects >= 1
    assert {r.job_name for r in lake.checkpoint_duration().collect()} == {"bronze-market_prices", "bronze-market_caps"}
    live = Warehouse(spark, f"{folder}/lake", incremental=True)
    app.main(["--models", "--root", f"{folder}/lake", "--available-now"])
    for _ in range(2):  # merged, and once more with the replaced folders gone
        assert rows(live.silver(PRICES)) == rows(lake.silver(PRICES))
        assert rows(live.market_overview()) == rows(lake.market_overview())
        assert rows(live.dim_asset().drop("updated_at")) == rows(lake.dim_asset().drop("updated_at"))
        live.compact_models()
    assert len(list_folders(spark, live.model("state_market_prices/batch_id=*"))) == 1
    write_files(spark, f"{folder}/prices", [envelope(asset_id="new", source={**SOURCE, "lsn": 500})], 1)
    app.main(["--feed", "market_prices", "--root", f"{folder}/lake", "--format", "json", "--location", f"{folder}/prices", "--available-now"])
    app.main(["--models", "--root", f"{folder}/lake", "--available-now"])
    assert rows(live.silver(PRICES)) == rows(lake.silver(PRICES)) and live.silver(PRICES).filter("asset_id = 'new'").count() == 1
    lake.record_checks()
    assert lake.alerts().filter("rule_uid = 'sink-validation-mismatch'").first().state == "normal"
