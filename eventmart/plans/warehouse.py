"""The whole pipeline: ingest files, classify once, write the marts, answer the reports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import classify, marts, quality
from eventmart.plans.reports import REPORTS
from eventmart.schemas import ACCOUNTS, AI_INTERACTIONS, CLASSIFIED, SESSIONS, USERS, column_names
from eventmart.session import configure, materialize
from eventmart.sources import bronze, jsonl, manifest, metadata
from eventmart.sources.jsonl import EVENT_FILES

# The table names.
RAW_TABLES = ("raw_events", "raw_ingest_rejections", "raw_accounts", "raw_users")
# Tables written in a folder per day: the date, the time it is of, and the full schema.
# Reading them with their schema works for a table without a single row, too.
PARTITIONED = {
    "fact_ai_interactions": ("event_date", "event_ts", AI_INTERACTIONS),
    "fact_sessions": ("session_date", "started_at", SESSIONS),
}
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's name of the folder for null
# Days that get a folder of their own; a broken clock's days share one.
FIRST_DAY, LAST_DAY = "2000-01-01", "2099-12-31"
CLEAN, REJECTED = "clean", "rejected"
# The table names.
BUILT_TABLES = (
    "stg_events",
    "rejected_events",
    "dim_accounts",
    "dim_users",
    "fact_ai_interactions",
    "fact_sessions",
    "daily_account_metrics",
)


def folder_day(date: Column) -> Column:
    """The date that names a row's folder; null for days that have none."""
    first, last = (F.lit(day).cast("date") for day in (FIRST_DAY, LAST_DAY))
    return F.when(date.between(first, last), date)


def _with_shared_folder(stored: DataFrame, date: str, time: str) -> DataFrame:
    """Rows by the folder of their day, and those of the shared folder by their time.

    Two parts, so that a filter on the date still chooses folders.
    """
    own, shared = F.col(date).isNotNull(), F.col(date).isNull()
    return stored.filter(own).unionByName(
        stored.filter(shared).withColumn(date, F.to_date(time))
    )


class ChecksFailed(Exception):
    """A build that violates data-quality checks; ``violated`` has their rows."""

    def __init__(self, violated: list):
        super().__init__("; ".join(" ".join(map(str, row)) for row in violated))
        self.violated = violated


class Warehouse:
    """Parquet tables below one folder that all executors can reach.

    Events are classified once per build, into a table split by outcome. The clean stream
    and the audit trail are views of that table, as the reports are of the marts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- raw layer -----------------------------------------------------------------

    def ingest(
        self,
        raw_dir: str,
        ingested_at: datetime | None = None,
        pattern: str | None = EVENT_FILES,
        event_names: str | None = None,
        accounts: str | None = "accounts.csv",
        users: str | None = "users.csv",
        line_breaks: bool = False,
    ) -> dict[str, int]:
        """Load event files, accounts and users from a folder; safe to repeat.

        ``pattern``, ``accounts`` and ``users`` choose the files, so that one new day can be
        loaded alone; what is None stays as it is and counts no rows. ``line_breaks`` allows
        them inside quotes of the metadata. ``event_names`` is a CSV file with the event-name
        contract, which replaces the stored one.
        """
        ingested_at = ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
        raw_dir = raw_dir.rstrip("/")
        if pattern is not None:
            files = jsonl.list_event_files(self.spark, raw_dir, pattern)
            bronze.ingest_events(
                self.spark, raw_dir, self.path("raw/lines"), ingested_at, pattern,
                self.path("raw/line_offsets"),
            )
            self._record(files, ingested_at)
        if event_names is not None:
            self._write(
                metadata.contract_seed(self.spark, event_names), "raw/expected_event_names"
            )
        loaded = {
            name: metadata.ingest_metadata(
                self.spark, f"{raw_dir}/{files}", self.path(f"raw/{name}"), schema, ingested_at,
                line_breaks,
            ) if files is not None else 0
            for name, files, schema in (("accounts", accounts, ACCOUNTS), ("users", users, USERS))
        }
        lines = self.ingest_stats().agg(
            F.sum("events_loaded").alias("events"), F.sum("lines_rejected").alias("rejected")
        ).first() if pattern is not None else {"events": 0, "rejected": 0}
        return {
            "events_loaded": lines["events"],
            "lines_rejected": lines["rejected"],
            "accounts_loaded": loaded["accounts"],
            "users_loaded": loaded["users"],
        }

    def ingest_changed(
        self, raw_dir: str, ingested_at: datetime | None = None, pattern: str = EVENT_FILES
    ) -> int:
        """Load the event files that are new or were changed since they were loaded.

        The manifest tells them by length and time of change. Returns how many they are.
        """
        files = jsonl.list_event_files(self.spark, raw_dir, pattern)
        changed = materialize(
            manifest.not_loaded(files, self._manifest()), "files", self.path("raw/changed_files")
        )
        self.load_files(
            changed, pattern, ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
        )
        return changed.count()

    def load_files(self, files: DataFrame, pattern: str, ingested_at: datetime) -> None:
        """Load files as ``list_event_files`` lists them, best a written table."""
        if files.isEmpty():
            return
        bronze.ingest_files(
            self.spark, files, self.path("raw/lines"), ingested_at, pattern,
            self.path("raw/line_offsets"),
        )
        self._record(files, ingested_at)

    def _record(self, files: DataFrame, ingested_at: datetime) -> None:
        """Enter loaded files into the index of users and then the manifest."""
        lines = self.path("raw/lines")
        manifest.record_users(self.spark, files, lines, self.path("raw/user_files"))
        manifest.record_files(self.spark, files, lines, self.path("raw/manifest"), ingested_at)

    def record_again(self, files: DataFrame) -> None:
        """Enter files whose lines were changed in the bronze table itself."""
        known = self._manifest().join(files, "source_file", "left_semi")
        loaded_at = known.agg(F.max("loaded_at")).first()[0]
        if loaded_at is not None:
            kept = known.select("source_file", "length", "modified")
            self._record(
                materialize(kept, "files", self.path("staging/erasure/manifest")), loaded_at
            )

    def _manifest(self) -> DataFrame:
        return manifest.read_manifest(self.spark, self.path("raw/manifest"))

    def loaded_files(self) -> DataFrame:
        """``source_file`` of every file in the bronze table."""
        lines = bronze.read_bronze(self.spark, self.path("raw/lines"))
        return lines.filter(F.col("ingest_reason") == bronze.FILE_MARKER).select("source_file")

    def ingest_stats(self) -> DataFrame:
        return bronze.ingest_stats(bronze.read_bronze(self.spark, self.path("raw/lines")))

    def _raw_tables(self) -> dict[str, DataFrame]:
        return {name: self._raw_table(name) for name in RAW_TABLES}

    def _raw_table(self, name: str) -> DataFrame:
        for stored, schema in (("accounts", ACCOUNTS), ("users", USERS)):
            if name == f"raw_{stored}":
                return metadata.read_metadata_table(self.spark, self.path(f"raw/{stored}"), schema)
        lines = bronze.read_bronze(self.spark, self.path("raw/lines"))
        of_lines = {"raw_events": bronze.raw_events, "raw_ingest_rejections": bronze.raw_ingest_rejections}
        return of_lines[name](lines)

    # -- build ---------------------------------------------------------------------

    def build(self, raw: dict[str, DataFrame] | None = None, check: bool = True) -> None:
        """Write the classified events and all marts from the raw tables.

        ``raw`` replaces the ingested tables, under the names in ``RAW_TABLES``. A build
        that violates a data-quality check raises ``ChecksFailed``, unless ``check`` is
        false; its tables stay for inspection.
        """
        self.record_build(None)
        as_loaded = raw is None
        raw = raw or self._raw_tables()
        accounts, users = raw["raw_accounts"], raw["raw_users"]
        self._require_unique_keys(accounts, users)
        # What needs no classified events, and later the sessions, runs beside the main line.
        with ThreadPoolExecutor(max_workers=4) as pool:
            inputs = pool.submit(self.build_inputs) if as_loaded else None
            beside = [
                pool.submit(
                    self._write, raw["raw_ingest_rejections"], "staging/ingest_rejections"
                ),
                pool.submit(self._write, marts.dim_accounts(accounts), "marts/dim_accounts"),
                pool.submit(self._write, marts.dim_users(users, accounts), "marts/dim_users"),
            ]
            classified = classify.classify_events(
                raw["raw_events"], accounts, users, self.event_names(),
                self.path("staging/classification"),
            )
            outcome = F.when(F.col("rejection_reason").isNull(), CLEAN).otherwise(REJECTED)
            day = F.when(F.col("outcome") == CLEAN, folder_day(F.to_date("event_ts")))
            dated = classified.withColumn("outcome", outcome).withColumn("event_date", day)
            self._write_partitioned(dated, "staging/events_classified", "outcome", "event_date")
            events = self.table("stg_events")
            beside.append(
                pool.submit(self._write_by_day, marts.fact_sessions(events), "fact_sessions")
            )
            self._write(marts.model_rates(marts.ai_calls(events)), "marts/model_rates")
            self._write_by_day(
                marts.fact_ai_interactions(events, self._read("marts/model_rates")),
                "fact_ai_interactions",
            )
            self._write(
                marts.daily_account_metrics(
                    events, self.table("fact_ai_interactions"), marts.dim_accounts(accounts)
                ),
                "marts/daily_account_metrics",
            )
            for job in beside:
                job.result()
            self.record_build(inputs.result() if inputs else None)
        if check:
            self.require_checks(raw)

    def require_checks(self, raw: dict[str, DataFrame] | None = None) -> None:
        violated = self.checks(raw).filter("violations > 0").collect()
        if violated:
            raise ChecksFailed(violated)

    def build_inputs(self) -> DataFrame:
        """``(kind, name, checksum)`` of what a build reads: event files, metadata, contract."""
        files = self._manifest().select(F.lit("file").alias("kind"), F.col("source_file").alias("name"), "checksum")
        others = [
            (name, self.table(name).drop("ingested_at", "source_file"))
            for name in ("raw_accounts", "raw_users", "expected_event_names")
        ]
        for name, rows in others:
            own = F.xxhash64(*rows.columns)
            checksum = F.concat_ws("-", F.hex(F.bit_xor(own)), F.count("*").cast("string"))
            files = files.unionByName(
                rows.agg(checksum.alias("checksum")).select(
                    F.lit("table").alias("kind"), F.lit(name).alias("name"), "checksum"
                )
            )
        return materialize(files, "build-inputs", self.path("staging/build_inputs_next"))

    def built_inputs(self) -> DataFrame | None:
        """The inputs of the tables as they are; None if a build has not been completed."""
        try:
            stored = self._read("staging/build_inputs")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if stored.isEmpty() else stored

    def refresh(self, check: bool = True) -> int | None:
        """Bring the tables up to date with the loaded files; see ``plans.refresh``."""
        from eventmart.plans.refresh import refresh

        return refresh(self, check)

    def record_build(self, inputs: DataFrame | None) -> None:
        """Note what the tables were built from; without it, that they are in the making."""
        if inputs is None:
            inputs = self.spark.createDataFrame([], "kind string, name string, checksum string")
        self._write(inputs, "staging/build_inputs")

    def event_names(self) -> list[str]:
        """The contract's names; a short list, which validation compares with."""
        return sorted(row[0] for row in self.table("expected_event_names").collect())

    def _require_unique_keys(self, accounts: DataFrame, users: DataFrame) -> None:
        """A repeated metadata key would multiply events; better no build than that."""
        repeated = [
            quality.unique(df, key).select(F.lit(key).alias("column"), F.col(key).alias("value"))
            for df, key in ((accounts, "account_id"), (users, "user_id"))
        ]
        found = repeated[0].unionAll(repeated[1]).first()
        if found is not None:
            raise ValueError(f"{found['column']} {found['value']!r} occurs more than once")

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(self.path(name))

    def _write_by_day(self, df: DataFrame, name: str) -> None:
        """One directory per day."""
        date = PARTITIONED[name][0]
        dated = df.withColumn(date, folder_day(F.col(date)))
        self._write_partitioned(dated, f"marts/{name}", date)

    def replace_folders(
        self, rows: DataFrame, folders: DataFrame, name: str, *columns: str
    ) -> None:
        """Give some folders of a partitioned table these rows, and remove those that get none.

        Both are best written tables; ``folders`` are collected, as their number is that of
        outcomes times days.
        """
        path = self.path(name)
        rows.hint("rebalance", *columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*columns).parquet(path)
        left = rows.select(*(F.col(c).cast("string") for c in columns)).distinct().collect()
        given = folders.select(*(F.col(c).cast("string") for c in columns)).distinct().collect()
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = hadoop_path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for row in {tuple(r) for r in given} - {tuple(r) for r in left}:
            parts = (f"{c}={NO_FOLDER if v is None else v}" for c, v in zip(columns, row))
            files.delete(hadoop_path("/".join((path, *parts))), True)

    def _write_partitioned(self, df: DataFrame, name: str, *columns: str) -> None:
        """The rebalance gives a large partition several files, and a small one just one. All
        of the table is replaced, whatever the session says of partitions."""
        (
            df.hint("rebalance", *columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*columns)
            .parquet(self.path(name))
        )

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    # -- tables --------------------------------------------------------------------

    def classified(self, *outcomes: str) -> DataFrame:
        """The classified events of the given outcomes; only their folders are read."""
        return self._classified(*outcomes).drop("event_date")

    def stored_rejections(self) -> DataFrame:
        """The refused lines as of the last build."""
        return self._read("staging/ingest_rejections")

    def stored_events(self) -> DataFrame:
        """The classified events with the ``outcome`` and ``event_date`` of their folders."""
        stored = f"{CLASSIFIED}, outcome string, event_date date"
        return self.spark.read.schema(stored).parquet(self.path("staging/events_classified"))

    def _classified(self, *outcomes: str) -> DataFrame:
        """With ``event_date``, the folder below the outcome; a filter on it prunes folders."""
        rows = self.stored_events()
        chosen = rows.filter(F.col("outcome").isin(*outcomes)).drop("outcome")
        return _with_shared_folder(chosen, "event_date", "event_ts")

    def table(self, name: str) -> DataFrame:
        """A staging view, a mart or a raw table by name."""
        if name in RAW_TABLES:
            return self._raw_table(name)
        if name == "int_events_classified":
            return self.classified(CLEAN, REJECTED)
        if name == "stg_events":
            return classify.stg_events(self._classified(CLEAN))
        if name == "rejected_events":
            return classify.rejected_events(self.stored_rejections(), self.classified(REJECTED))
        if name == "expected_event_names":
            return self._contract()
        if name in PARTITIONED:
            date, time, schema = PARTITIONED[name]
            stored = self.spark.read.schema(schema).parquet(self.path(f"marts/{name}"))
            return _with_shared_folder(stored, date, time).select(*column_names(schema))
        return self._read(f"marts/{name}")

    def _contract(self) -> DataFrame:
        """The stored event-name contract, or the built-in one if none was loaded."""
        try:
            return self._read("raw/expected_event_names")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return metadata.contract_seed(self.spark)

    def report(self, name: str) -> DataFrame:
        """One of the reports in ``REPORTS``, over the built tables."""
        build, tables = REPORTS[name]
        return build(*(self.table(table) for table in tables))

    def create_views(self) -> None:
        """Temporary views of every built table and report, for use from SQL."""
        for name in ("int_events_classified", *BUILT_TABLES):
            self.table(name).createOrReplaceTempView(name)
        for name in REPORTS:
            self.report(name).createOrReplaceTempView(f"report_{name}")

    # -- checks --------------------------------------------------------------------

    def checks(self, raw: dict[str, DataFrame] | None = None) -> DataFrame:
        """Violations of every data-quality check; all zero after a good build."""
        tables = dict(raw or self._raw_tables())
        tables["expected_event_names"] = self.table("expected_event_names")
        tables |= {name: self.table(name) for name in BUILT_TABLES}
        return quality.all_checks(tables)

    def table_counts(self, raw: dict[str, DataFrame] | None = None) -> DataFrame:
        tables = dict(raw or self._raw_tables())
        tables |= {name: self.table(name) for name in BUILT_TABLES}
        return quality.table_counts(tables)
