"""Bringing the marts up to date with changed event files, without building them anew.

The result is that of a full build. What can differ is found first, as small written tables:
the changed files, the ids whose copies compete anew, the days and sessions of their events.
Only folders that hold some of it are written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators import classify, marts
from eventmart.plans.warehouse import CLEAN, REJECTED, Warehouse, folder_day
from eventmart.session import materialize

FOLDER = ("outcome", "event_date")


def refresh(warehouse: Warehouse, check: bool = True) -> int | None:
    """Update the built tables; returns the number of changed files, None for a full build.

    Accounts, users and event names decide over every event, so a change of theirs, like a
    build or refresh that was not completed, leads to a full build. So does a warehouse whose
    files were loaded without a manifest.
    """
    before = warehouse.built_inputs()
    now = warehouse.build_inputs()
    changed = None if before is None else _changed_files(warehouse, before, now)
    if changed is None:
        warehouse.build(check=check)
        return None
    number = changed.count()
    if number:
        refresh_files(warehouse, changed)
    warehouse.record_build(now)
    if check:
        warehouse.require_checks()
    return number


def refresh_files(warehouse: Warehouse, changed: DataFrame) -> None:
    """Update the built tables for changed files, a table of their ``source_file``; the
    inputs are to be recorded afterwards."""
    warehouse.record_build(None)
    _Refresh(warehouse, changed).run()


def _changed_files(warehouse: Warehouse, before: DataFrame, now: DataFrame) -> DataFrame | None:
    """The files that differ from those built, or None if something else differs."""
    old = before.withColumnRenamed("checksum", "old")
    differing = now.join(old, ["kind", "name"], "full").filter(~F.col("checksum").eqNullSafe(F.col("old")))
    differing = materialize(differing, "differing", warehouse.path("staging/refresh/differing"))
    in_manifest = now.filter("kind = 'file'").count()
    if warehouse.loaded_files().count() != in_manifest or not differing.filter("kind <> 'file'").isEmpty():
        return None
    return differing.select(F.col("name").alias("source_file"))


def contested() -> Column:
    """Whether an event may become a duplicate, or cease to be one."""
    reason = F.col("rejection_reason")
    return reason.isNull() | (reason == classify.DUPLICATE)


class _Refresh:
    def __init__(self, warehouse: Warehouse, changed: DataFrame):
        self.warehouse, self.changed = warehouse, changed

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.warehouse.path(f"staging/refresh/{name}"))

    def run(self) -> None:
        days, sessions = self.events()
        self.rejections()
        events = self.warehouse.table("stg_events")
        self.sessions(events, days, sessions)
        days = self.interactions(events, days)
        self.daily(events, days)

    def in_changed(self, rows: DataFrame, how: str) -> DataFrame:
        return rows.join(self.changed, "source_file", how)

    def events(self) -> tuple[DataFrame, DataFrame]:
        """Replace the classified events; returns the days and sessions of clean events that
        came, went or were there in another version."""
        warehouse, stored = self.warehouse, self.warehouse.stored_events()
        validated = self.write(
            classify.validate_events(
                self.in_changed(warehouse.table("raw_events"), "left_semi"),
                warehouse.table("raw_accounts"),
                warehouse.table("raw_users"),
                warehouse.event_names(),
            ),
            "validated",
        )
        ids = self.write(
            validated.filter(F.col("rejection_reason").isNull())
            .select("event_id")
            .union(self.in_changed(stored, "left_semi").filter(contested()).select("event_id"))
            .distinct()
            .withColumn("competes", F.lit(True)),
            "ids",
        )

        def marked(rows: DataFrame) -> DataFrame:
            """With ``changed`` for rows of changed files, and ``competes`` for other rows
            whose duplicates are to be told anew."""
            own = self.changed.withColumn("changed", F.lit(True))
            key = F.when(contested(), F.col("event_id"))
            known = rows.join(own, "source_file", "left").withColumn("_key", key)
            return known.join(ids.withColumnRenamed("event_id", "_key"), "_key", "left").drop("_key")

        gone = F.col("changed") | F.col("competes")
        touched = marked(
            stored.select("source_file", "event_id", "rejection_reason", *FOLDER)
        ).filter(gone)
        old_folders = self.write(touched.select(*FOLDER).distinct(), "old_folders")
        inside = marked(_within(stored, old_folders, FOLDER))
        others = inside.filter(F.col("changed").isNull() & F.col("competes"))
        rivals = self.write(
            others.drop("changed", "competes", *FOLDER)
            .withColumn("rejection_reason", F.lit(None).cast("string"))
            .unionByName(validated),
            "rivals",
        )
        repeated = self.write(classify.repeated_events(rivals), "repeated")
        judged = classify.mark_duplicates(rivals, repeated)
        outcome = F.when(F.col("rejection_reason").isNull(), CLEAN).otherwise(REJECTED)
        day = F.when(F.col("outcome") == CLEAN, folder_day(F.to_date("event_ts")))
        judged = self.write(
            judged.withColumn("outcome", outcome).withColumn("event_date", day), "judged"
        )
        folders = self.write(
            old_folders.union(judged.select(*FOLDER)).distinct(), "folders"
        )
        left = marked(_within(stored, folders, FOLDER)).filter(
            F.col("changed").isNull() & F.col("competes").isNull()
        )
        final = self.write(left.drop("changed", "competes").unionByName(judged), "classified")
        moved = self.write(
            inside.filter(gone & (F.col("outcome") == CLEAN))
            .select("event_ts", "session_id")
            .union(judged.filter(F.col("outcome") == CLEAN).select("event_ts", "session_id"))
            .select(F.to_date("event_ts").alias("day"), "session_id")
            .distinct(),
            "moved",
        )
        warehouse.replace_folders(final, folders, "staging/events_classified", *FOLDER)
        sessions = moved.filter(F.col("session_id").isNotNull()).select("session_id").distinct()
        return moved.select("day").distinct(), sessions

    def rejections(self) -> None:
        warehouse = self.warehouse
        kept = self.in_changed(warehouse.stored_rejections(), "left_anti")
        new = self.in_changed(warehouse.table("raw_ingest_rejections"), "left_semi")
        self.replace(kept.unionByName(new), "rejections", "staging/ingest_rejections")

    def replace(self, rows: DataFrame, name: str, target: str) -> None:
        self.write(rows, name).write.mode("overwrite").parquet(self.warehouse.path(target))

    def sessions(self, events: DataFrame, days: DataFrame, sessions: DataFrame) -> None:
        """The sessions of moved events, from all of their events.

        A session may cross days. All its events lie between its old start and end or on one
        of the days that changed.
        """
        stored = self.warehouse.table("fact_sessions")
        old = self.write(
            stored.join(sessions, "session_id", "left_semi").select(
                "session_id", "session_date", F.to_date("ended_at").alias("last_day")
            ),
            "old_sessions",
        )
        spans = old.select(F.explode(F.sequence("session_date", "last_day")).alias("event_date"))
        read = self.write(spans.union(days).distinct(), "session_days")
        new = marts.fact_sessions(
            events.join(read, "event_date", "left_semi").join(sessions, "session_id", "left_semi")
        )
        new = self.write(new, "new_sessions")
        touched = old.select("session_date").union(new.select("session_date")).distinct()
        touched = self.write(_whole_folders(touched, stored, "session_date"), "session_folders")
        kept = stored.join(touched, "session_date", "left_semi").join(
            sessions, "session_id", "left_anti"
        )
        self.by_day(kept.unionByName(new), touched, "fact_sessions", "session_date")

    def by_day(self, rows: DataFrame, days: DataFrame, name: str, date: str) -> None:
        folder = folder_day(F.col(date))
        final = self.write(rows.withColumn(date, folder), name)
        self.warehouse.replace_folders(
            final, days.select(folder.alias(date)), f"marts/{name}", date
        )

    def interactions(self, events: DataFrame, days: DataFrame) -> DataFrame:
        """The calls of moved days, and of days with estimates by a rate that changed; returns
        those days."""
        warehouse = self.warehouse
        stored = warehouse.table("fact_ai_interactions")
        rates = self.write(marts.model_rates(marts.ai_calls(events)), "rates")
        old = warehouse.table("model_rates").withColumnRenamed("usd_per_token", "old")
        models = rates.join(old, "model", "full").filter(
            ~F.col("usd_per_token").eqNullSafe(F.col("old"))
        )
        models = self.write(models.select("model"), "models")
        estimated = stored.filter("is_cost_estimated").join(models, "model", "left_semi")
        every = days.withColumnRenamed("day", "event_date").union(estimated.select("event_date"))
        every = self.write(_whole_folders(every.distinct(), events, "event_date"), "call_days")
        new = marts.fact_ai_interactions(events.join(every, "event_date", "left_semi"), rates)
        self.by_day(new, every, "fact_ai_interactions", "event_date")
        rates.write.mode("overwrite").parquet(warehouse.path("marts/model_rates"))
        return every

    def daily(self, events: DataFrame, days: DataFrame) -> None:
        warehouse = self.warehouse
        new = marts.daily_account_metrics(
            events.join(days, "event_date", "left_semi"),
            warehouse.table("fact_ai_interactions").join(days, "event_date", "left_semi"),
            warehouse.table("dim_accounts"),
        )
        kept = warehouse.table("daily_account_metrics").join(days, "event_date", "left_anti")
        self.replace(kept.unionByName(new), "daily", "marts/daily_account_metrics")


def _within(stored: DataFrame, folders: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows in some folders; those without a day are told apart by their outcome alone."""
    dated = stored.join(folders.filter(F.col("event_date").isNotNull()), list(columns), "left_semi")
    shared = folders.filter(F.col("event_date").isNull()).select("outcome")
    return dated.unionByName(
        stored.filter(F.col("event_date").isNull()).join(shared, "outcome", "left_semi")
    )


def _whole_folders(days: DataFrame, stored: DataFrame, date: str) -> DataFrame:
    """Days, and if one of them has no folder of its own, all others of the shared folder."""
    outside = folder_day(F.col(date)).isNull()
    shared = days.filter(outside).limit(1).select(F.lit(True).alias("_shared"))
    others = stored.filter(outside).select(date).distinct().join(F.broadcast(shared))
    return days.select(date).union(others.select(date)).distinct()
