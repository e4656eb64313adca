"""All layers under one root folder, as DataFrames and as views for SQL."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import tables
from tidemark.functions.clock import as_instant
from tidemark.operators.layout import KEEP_MONTHS, drop_expired
from tidemark.plans import activity, alerts, freshness, gold, overview, reconcile, silver
from tidemark.schemas import CAPS, FEEDS, PRICES, Feed, bronze_schema, landing_schema
from tidemark.session import Files, stage
from tidemark.sources.landing import bronze_scan, landing_path, lz_file_inventory, lz_scan
from tidemark.streaming import alerting, incremental, newest, pages, progress
from tidemark.streaming.pipeline import Targets
from tidemark.streaming.sinks import write_batch


class Warehouse:
    """Landing zone, bronze, silver, gold and reports of both feeds.

    Folders: ``lz/<feed>`` and ``bronze/<feed>`` hold what the streaming job
    writes, ``gold/<table>`` what :meth:`build_gold` writes, ``models/<table>``
    what the model streams keep up to date. With ``incremental`` silver and gold
    are read from those; else they are computed from bronze.
    """

    def __init__(self, spark: SparkSession, root: str, as_of: datetime | None = None, incremental: bool = False):
        self.spark, self.root, self.as_of, self.incremental = spark, root.rstrip("/"), as_of, incremental

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/models/{table}"

    def start_models(self, available_now: bool = False, files_per_batch: int | None = None) -> list[StreamingQuery]:
        """Keep silver state, facts and the dimension up to date from bronze as it is written.

        A model that begins late takes in first what has been rewritten beside bronze's folder.
        """
        limit = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
        started, files = [], Files(self.spark)
        for table, model in self.models().items():
            feed, bronze = model.feed, self.bronze_path(model.feed)
            files.make_folder(bronze)  # a stream over a folder needs it to be there
            if tables.Log(self.spark, bronze).exists() and not files.exists(self.checkpoint(table)):
                moved = lambda entries: entries.where("rewritten")
                if not moved(tables.entries(self.spark, bronze)).isEmpty():
                    model.begin(tables.read(self.spark, bronze, feed, bronze_schema(feed), moved), self.model(table))
            rows = self.spark.readStream.schema(bronze_schema(feed)).options(**limit).parquet(bronze)
            started.append(model.stream(rows, self.model(table), self.checkpoint(table), available_now, f"model-{table}"))
        return started

    def models(self) -> dict[str, incremental.Model]:
        """The tables kept up to date by streams."""
        found = {"dim_asset": incremental.dim_asset_model()}
        for name, feed in FEEDS.items():
            found[f"state_{name}"] = incremental.state_model(feed)
            found[f"fct_{name}"] = incremental.fact_model(feed, self.model(f"fct_{name}"))
        return found

    def compact_models(self, **limits: int) -> int:
        """Merge the model tables' partial results; run it on a schedule beside the streams.

        ``limits`` are those of :func:`incremental.compact`.
        """
        merged = incremental.compact_dim_asset(self.spark, self.model("dim_asset"), **limits)
        for name, feed in FEEDS.items():
            merged += incremental.compact_facts(self.spark, self.model(f"fct_{name}"), feed, **limits)
            merged += incremental.compact_silver(self.spark, self.model(f"state_{name}"), feed, **limits)
            newest.fold(self.spark, self.model(f"fct_{name}"))
        return merged

    def start_pages(self, location: str, available_now: bool = False, files_per_batch: int | None = None) -> StreamingQuery:
        """Bring page files of the remote API into the source tables as they arrive."""
        found = pages.page_files(self.spark, location, files_per_batch)
        return pages.page_stream(found, f"{self.root}/source", self.checkpoint("pages"), available_now)

    def source_table(self, feed: Feed) -> DataFrame:
        return pages.source_table(self.spark, f"{self.root}/source", feed.name)

    def targets(self, feed: Feed, topic: dict[str, str] | None = None, dead_letters: dict[str, str] | None = None) -> Targets:
        """Where the streaming job of a feed should write."""
        return Targets(
            landing=f"{self.root}/lz",
            bronze=self.bronze_path(feed),
            topic=topic or {},
            dead_letters=dead_letters or {"path": f"{self.root}/dlq/{feed.name}"},
        )

    def landing(self, feed: Feed) -> DataFrame:
        return lz_scan(self.spark, f"{self.root}/lz", feed)

    def bronze_path(self, feed: Feed) -> str:
        return f"{self.root}/bronze/{feed.name}"

    def landing_path(self, feed: Feed) -> str:
        return landing_path(f"{self.root}/lz", feed)

    def bronze(self, feed: Feed, days: int | None = None) -> DataFrame:
        return bronze_scan(self.spark, self.bronze_path(feed), feed, self.as_of, days)

    def logs(self, feed: Feed) -> tuple[DataFrame, DataFrame] | None:
        """Log entries of both copies, if both keep a log."""
        paths = (self.bronze_path(feed), self.landing_path(feed))
        if not all(tables.Log(self.spark, path).exists() for path in paths):
            return None
        return tuple(tables.entries(self.spark, path) for path in paths)

    def compact_bronze(self, feed: Feed, most_files: int = 1) -> int:
        """Rewrite the days that are spread over many files, in place, beside readers and running streams."""
        path = self.bronze_path(feed)
        tables.recover(self.spark, path)
        return tables.compact_days(self.spark, path, feed, bronze_schema(feed), most_files)

    def followers(self, feed: Feed) -> list[str]:
        """Checkpoints of the model streams that read a feed's bronze files, those that have begun."""
        mine = [self.checkpoint(table) for table, model in self.models().items() if model.feed is feed]
        return [path for path in mine if Files(self.spark).exists(path)]

    def tidy(self, most_files: int = 16) -> None:
        """What a maintenance job does now and then: compact, roll the logs, delete what nothing needs any more."""
        for feed in FEEDS.values():
            bronze = self.bronze_path(feed)
            if tables.Log(self.spark, bronze).exists():
                self.compact_bronze(feed, most_files)
                tables.vacuum(self.spark, bronze, self.followers(feed))
                tables.roll(self.spark, bronze)
            if tables.Log(self.spark, self.landing_path(feed)).exists():
                tables.roll(self.spark, self.landing_path(feed))
        now = self.as_of or datetime.now(timezone.utc)
        progress.roll_reports(self.spark, f"{self.monitoring}/progress", now.date())
        alerting.merge_days(self.spark, f"{self.monitoring}/alerts")

    def audit(self, feed: Feed, days: int | None = None) -> DataFrame:
        """Files of either copy that are not as its log says, by reading them all; for a schedule of days, not minutes."""
        found = []
        for copy, path, schema in (("bronze", self.bronze_path(feed), bronze_schema(feed)), ("landing", self.landing_path(feed), landing_schema(feed))):
            found.append(tables.audit(self.spark, path, feed, schema, self.as_of, days).withColumn("copy", F.lit(copy)))
        return found[0].unionByName(found[1])

    def silver(self, feed: Feed) -> DataFrame:
        if self.incremental:
            shape = incremental.state_shape(self.spark, feed)
            return silver.silver_view(incremental.read_state(self.spark, self.model(f"state_{feed.name}"), shape), feed)
        return silver.silver_prices(self.bronze(feed)) if feed is PRICES else silver.silver_caps(self.bronze(feed))

    def dim_asset(self) -> DataFrame:
        if self.incremental:
            rows = incremental.read_dim_asset(self.spark, self.model("dim_asset"))
            return rows.withColumn("updated_at", as_instant(self.as_of))
        return gold.dim_asset(self.bronze(PRICES), self.as_of)

    def facts(self, feed: Feed) -> DataFrame:
        if self.incremental:
            return incremental.read_facts(self.spark, self.model(f"fct_{feed.name}"), feed)
        return gold.fact_table(gold.fact_rows(self.bronze(feed), feed), self.as_of)

    def build_gold(self) -> None:
        """Write the dimension and both fact tables."""
        self.dim_asset().write.mode("overwrite").parquet(f"{self.root}/gold/dim_asset")
        for feed in FEEDS.values():
            path = self.facts_path(feed)
            gold.write_facts(self.facts(feed), path)
            newest.note(self.spark, path, "built", Files(self.spark).glob(f"{path}/event_month=*"))

    def facts_path(self, feed: Feed) -> str:
        return self.model(f"fct_{feed.name}") if self.incremental else f"{self.root}/gold/fct_{feed.name}"

    def built_facts(self, feed: Feed) -> DataFrame:
        """Facts as last written, by month; of an incremental warehouse, as they are now."""
        if self.incremental:
            return self.facts(feed)
        return self.spark.read.schema(self.facts(feed).schema).parquet(f"{self.root}/gold/fct_{feed.name}")

    def market_overview(self, built: bool = False) -> DataFrame:
        """From bronze as it is now, or from the fact tables as last built."""
        facts = self.built_facts if built else self.facts
        return overview.market_overview(facts(PRICES), facts(CAPS))

    def pipeline_health(self) -> DataFrame:
        """Of the facts as last built, by the newest events noted as they were written; no fact is read."""
        rows = {}
        for name, feed in FEEDS.items():
            noted = newest.exists(self.spark, self.facts_path(feed))
            rows[name] = newest.read(self.spark, self.facts_path(feed)) if noted else self.built_facts(feed)
        return freshness.pipeline_health(rows, self.as_of)

    def _validation(self, check) -> DataFrame:
        """A reconciliation from the logs of both copies, or from their rows where one has no log."""
        reports = []
        for feed in FEEDS.values():
            logs = self.logs(feed)
            if logs:
                reports.append(check(*logs, feed, self.as_of, summary=reconcile.logged_summary))
            else:
                reports.append(check(self.bronze(feed), self.landing(feed), feed, self.as_of))
        return reduce(DataFrame.unionByName, reports)

    def sink_validation(self) -> DataFrame:
        return self._validation(reconcile.sink_validation)

    def sink_validation_partition(self) -> DataFrame:
        return self._validation(reconcile.sink_validation_partition)

    @property
    def monitoring(self) -> str:
        return f"{self.root}/monitoring"

    def record_checks(self, at: datetime | None = None) -> None:
        """Write what the freshness and reconciliation reports say at a minute, and settle the alerts up to it.

        Run it each minute. It reads logs, notes and reports of two days, no row of any copy or
        fact and no older alert. A minute that is checked again replaces its rows.
        """
        at = at or self.as_of or datetime.now(timezone.utc)
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        minute = int(at.timestamp()) // 60
        lake = Warehouse(self.spark, self.root, at, self.incremental)
        day = F.lit(at.date())
        for name, report in (("health", lake.pipeline_health()), ("validation", lake.sink_validation())):
            write_batch(report.coalesce(1).withColumn("day", day), f"{self.monitoring}/{name}", minute, ["day"])
        mine = lambda name: self._history(name, at).where(F.floor(F.unix_seconds("checked_at") / 60) == minute)
        lines = stage(self.progress(at - timedelta(days=1)), "progress")
        found = alerts.rule_evaluations(
            health_history=mine("health"),
            validation_history=mine("validation"),
            dead_letters=progress.dead_letter_increase(lines),
            consumer_offsets=progress.offset_rows(lines),
        )
        # of the minute itself, what it has recorded; of the reports, minutes that are over
        over = F.col("rule_uid").isin(alerts.STALE.uid, alerts.MISMATCH.uid) | (F.col("ts") < F.timestamp_seconds(F.lit(minute * 60)))
        alerting.advance(stage(found.where(over), "evaluations"), f"{self.monitoring}/alerts", minute)

    def _history(self, name: str, since: datetime | None = None) -> DataFrame:
        """Recorded reports, of all days or from one on. None yet is no rows."""
        shape = {
            "health": "checked_at timestamp, table_name string, latest_event_time timestamp, minutes_lag bigint, pipeline_status string",
            "validation": "checked_at timestamp, table_name string, validation_status string",
        }[name]
        path = f"{self.monitoring}/{name}"
        if not Files(self.spark).exists(path):
            return self.spark.createDataFrame([], shape)
        rows = self.spark.read.schema(f"{shape}, day date").parquet(path)
        chosen = rows if since is None else rows.where(F.col("day") >= F.lit(since.date()))
        return chosen.drop("day")

    def progress(self, since: datetime | None = None) -> DataFrame:
        """Progress reports of the streaming jobs, as lines of JSON, of all kept days or from one on."""
        return progress.reports(self.spark, f"{self.monitoring}/progress", since.date() if since else None)

    def consumer_lag(self, since: datetime | None = None) -> DataFrame:
        return activity.consumer_lag(progress.offset_rows(self.progress(since)))

    def checkpoint_duration(self, since: datetime | None = None) -> DataFrame:
        return activity.checkpoint_duration(progress.progress_rows(self.progress(since)))

    def alerts(self) -> DataFrame:
        """State of the alert rules at every evaluation settled so far."""
        return alerting.states(self.spark, f"{self.monitoring}/alerts")

    def alerts_again(self) -> DataFrame:
        """The same worked out anew from all that has been recorded."""
        lines = stage(self.progress(), "progress")
        return alerts.alerts(
            health_history=self._history("health"),
            validation_history=self._history("validation"),
            dead_letters=progress.dead_letter_increase(lines),
            consumer_offsets=progress.offset_rows(lines),
        )

    def drop_expired(self, feed: Feed) -> list[str]:
        """Delete the bronze days past their time."""
        if tables.Log(self.spark, self.bronze_path(feed)).exists():
            tables.drop_days(self.spark, self.bronze_path(feed), self.as_of, KEEP_MONTHS)
        return drop_expired(self.spark, self.bronze_path(feed), self.as_of)

    def bronze_insert_rate(self, hours: int | None = 1) -> DataFrame:
        return activity.bronze_insert_rate({n: self.bronze(f) for n, f in FEEDS.items()}, self.as_of, hours)

    def row_counts(self) -> DataFrame:
        """Of bronze by its log and of streamed facts by the keys their batches added, where those are kept."""
        bronze = {}
        for name, feed in FEEDS.items():
            logged = tables.Log(self.spark, self.bronze_path(feed)).exists()
            bronze[f"bronze.{name}"] = tables.entries(self.spark, self.bronze_path(feed)) if logged else (self.bronze(feed), ())
        facts = {}
        for name, feed in FEEDS.items():
            noted = newest.added(self.spark, self.facts_path(feed)) if self.incremental and newest.exists(self.spark, self.facts_path(feed)) else None
            counted = self.spark.createDataFrame([(noted,)], "rows bigint") if noted is not None else (self.built_facts(feed), ())
            facts[f"gold.fct_{name}"] = counted
        return activity.row_counts({**bronze, **facts})

    def file_inventory(self, feed: Feed) -> DataFrame:
        return lz_file_inventory(self.spark, f"{self.root}/lz", feed)

    def register(self) -> list[str]:
        """Temporary views for SQL users, named ``<layer>_<table>``.

        Only the market overview is computed here, since it is staged; register
        again to refresh it.
        """
        views = {
            "gold_dim_asset": self.dim_asset(),
            "gold_sem_market_overview": self.market_overview(),
            "omt_pipeline_health": self.pipeline_health(),
            "omt_sink_validation": self.sink_validation(),
            "omt_sink_validation_partition": self.sink_validation_partition(),
        }
        for name, feed in FEEDS.items():
            views[f"lz_{name}"] = self.landing(feed)
            views[f"bronze_{name}"] = self.bronze(feed)
            views[f"silver_vw_{name}"] = self.silver(feed)
            views[f"gold_fct_{name}"] = self.facts(feed)
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return sorted(views)
