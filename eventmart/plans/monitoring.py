"""Alerts on a warehouse: unusual volumes, reject rates and costs against their recent past.

Baselines are computed in whole numbers (events, parts per million, millionths of a dollar),
so that a day on the edge is judged the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.functions.scalar import reason_bucket

MILLION = 1_000_000


def file_day() -> Column:
    """The day in an event file's name; null for a name without one."""
    return F.regexp_extract("source_file", r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def daily_signals(events: DataFrame, rejected: DataFrame) -> DataFrame:
    """``(signal, key, day, value)``: events per name, and per reason the rejected lines of a
    million, for each day that has some. The day is that of the file."""
    lines = (
        events.select(file_day().alias("day"), "event_name", F.lit(None).cast("string").alias("reason"))
        .unionByName(
            rejected.select(
                file_day().alias("day"), "event_name",
                reason_bucket(F.col("rejection_reason")).alias("reason"),
            )
        )
        .filter(F.col("day").isNotNull())
        .groupBy("day", "event_name", "reason")
        .agg(F.count("*").alias("n"))
    )
    volumes = (
        lines.filter(F.col("event_name").isNotNull())
        .groupBy(F.lit("volume").alias("signal"), F.col("event_name").alias("key"), "day")
        .agg(F.sum("n").alias("value"))
    )
    totals = lines.groupBy("day").agg(F.sum("n").alias("total"))
    refused = lines.filter(F.col("reason").isNotNull()).groupBy("reason", "day").agg(F.sum("n").alias("n"))
    rates = refused.join(totals, "day").select(
        F.lit("reject_rate").alias("signal"),
        F.col("reason").alias("key"),
        "day",
        F.expr(f"n * {MILLION} div total").alias("value"),
    )
    return volumes.unionByName(rates)


def gap_filled(series: DataFrame, keys: list[str], from_first: bool = False) -> DataFrame:
    """``series`` with a row, of value 0 if need be, for each key and day up to the last day.

    The days begin with the first of all keys, or with each key's own first.
    """
    span = series.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    begins = series.groupBy(*keys).agg(F.min("day").alias("own_first"))
    first = F.col("own_first") if from_first else F.col("first_day")
    days = begins.join(F.broadcast(span)).select(  # one row
        *keys, F.explode(F.sequence(first, F.col("last_day"))).alias("day")
    )
    return days.join(series, [*keys, "day"], "left").withColumn(
        "value", F.coalesce("value", F.lit(0)).cast("long")
    )


def signal_anomalies(
    signals: DataFrame, days: int = 7, deviations: int = 3, least_change: int = 20
) -> DataFrame:
    """Each signal's days with the mean of the ``days`` before, and whether they differ.

    A day is an anomaly if it lies more than ``deviations`` standard deviations of those days
    from their mean, and by more than ``least_change``. Days before a key's first are zeros;
    days without a full baseline are not judged.
    """
    before = Window.partitionBy("signal", "key").orderBy("day").rowsBetween(-days, -1)
    squares = F.sum(F.col("value").cast("decimal(38,0)") * F.col("value")).over(before)
    judged = gap_filled(signals, ["signal", "key"]).select(
        "*",
        F.count("*").over(before).alias("n"),
        F.sum("value").over(before).alias("total"),
        squares.alias("squares"),
    )
    # All times n: the difference from the mean, and the squared deviation times n squared.
    change = F.abs(F.col("value") * days - F.col("total")).cast("decimal(19,0)")
    spread = days * F.col("squares") - F.col("total").cast("decimal(19,0)") * F.col("total")
    return judged.filter(F.col("n") == days).select(
        "signal",
        "key",
        "day",
        "value",
        F.round(F.col("total") / days, 3).alias("baseline"),
        (
            (change > least_change * days)
            & (change * change > (deviations * deviations * spread).cast("decimal(38,0)"))
        ).alias("is_anomaly"),
    )


def volume_anomalies(events: DataFrame, rejected: DataFrame) -> DataFrame:
    """Event names and reject reasons on the days that their week before does not explain."""
    found = signal_anomalies(daily_signals(events, rejected)).filter("is_anomaly")
    return found.drop("is_anomaly").orderBy("day", "signal", "key")


def daily_costs(interactions: DataFrame) -> DataFrame:
    """Estimated cost per account, model and day, in millionths of a dollar."""
    cost = F.round(F.col("cost_usd_estimated").cast("decimal(38,18)") * MILLION).cast("long")
    return interactions.groupBy(
        "account_id", F.coalesce("model", F.lit("unknown")).alias("model"),
        F.col("event_date").alias("day"),
    ).agg(F.coalesce(F.sum(cost), F.lit(0)).alias("value"))


def _twice_median(values: Column) -> Column:
    """The sum of the two middle entries of an array, or twice its middle one."""
    ordered = F.sort_array(values)
    n = F.size(values)
    low, high = F.floor((n - 1) / 2), F.floor(n / 2)
    return F.get(ordered, low.cast("int")) + F.get(ordered, high.cast("int"))


def cost_baselines(
    costs: DataFrame, days: int = 14, least_days: int = 7, deviations: int = 5,
    least_change: int = 10_000,
) -> DataFrame:
    """Each account's and model's days with the median of up to ``days`` days before.

    A cost is an anomaly if it lies more than ``deviations`` median absolute deviations from
    that median, and by more than ``least_change`` millionths. One wild day moves neither
    much, unlike a mean. Days without calls cost nothing; a pair's days begin with its first,
    and are judged once ``least_days`` are behind them.
    """
    pair = ["account_id", "model"]
    before = Window.partitionBy(*pair).orderBy("day").rowsBetween(-days, -1)
    past = gap_filled(costs, pair, from_first=True).withColumn(
        "past", F.collect_list("value").over(before)  # of ``days`` entries at most
    )
    known = past.filter(F.size("past") >= least_days).withColumn("median2", _twice_median(F.col("past")))
    distances = F.transform("past", lambda x: F.abs(2 * x - F.col("median2")))
    judged = known.withColumn("spread4", _twice_median(distances))
    change2 = F.abs(2 * F.col("value") - F.col("median2"))
    return judged.select(
        *pair,
        F.col("day").alias("event_date"),
        F.round(F.col("value") / MILLION, 6).alias("cost_usd"),
        F.round(F.col("median2") / (2 * MILLION), 7).alias("median_usd"),
        F.round(F.col("spread4") / (4 * MILLION), 8).alias("deviation_usd"),
        ((change2 > 2 * least_change) & (2 * change2 > deviations * F.col("spread4"))).alias(
            "is_anomaly"
        ),
    )


def cost_anomalies(interactions: DataFrame) -> DataFrame:
    """The days on which an account's spending on a model is out of its usual range."""
    found = cost_baselines(daily_costs(interactions)).filter("is_anomaly")
    return found.drop("is_anomaly").orderBy("event_date", F.desc("cost_usd"), "account_id", "model")
