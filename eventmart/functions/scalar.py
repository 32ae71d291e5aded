"""Scalar expressions used by the models and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.schemas import LATE_AFTER_SECONDS


def utc_literal(moment: datetime) -> Column:
    """A naive UTC time as it is, whatever the time zones of Python and the session."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def lenient_timestamp(text: Column) -> Column:
    """UTC timestamp of a string, null when it is not a full date or date-time.

    A date alone, or a date and a time with hours and minutes at least; hyphens or slashes
    part a date, and its year has four digits. Spark by itself also accepts a bare year, a
    year-month, a time of day, a date with hours alone and longer years, but no slashes.
    A zone offset in the text is applied before the zone is dropped.
    """
    full = text.rlike(r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}([T ]\d{1,2}:\d{1,2}.*)?$")
    slashes = F.regexp_replace(text, r"^(\s*\d{4})/(\d{1,2})/", "$1-$2-")
    hyphened = F.when(text.contains("/"), slashes).otherwise(text)
    return F.when(full, hyphened.try_cast("timestamp")).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end`` (negative if reversed)."""
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def is_late(lateness: Column) -> Column:
    return lateness > LATE_AFTER_SECONDS


def masked_email(email: Column) -> Column:
    """Only the domain: ``***@domain``; an address without ``@`` keeps nothing."""
    return F.concat(F.lit("***@"), F.split_part(email, F.lit("@"), F.lit(2)))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; null for an empty base."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded share of ``whole`` in percent; null for an empty base."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def reason_bucket(reason: Column) -> Column:
    """Collapse parser detail so that all malformed lines count as one reason."""
    return F.when(reason.startswith("malformed_json"), F.lit("malformed_json")).otherwise(reason)


def count_event(event_name: Column, name: str) -> Column:
    """Number of rows of one event type."""
    return F.count_if(event_name == name)


def for_event(event_name: Column, name: str, value: Column) -> Column:
    """The value on rows of one event type, null elsewhere."""
    return F.when(event_name == name, value)


def money_sum(amount: Column) -> Column:
    """Sum of a money column as double, the same whatever the order of the rows.

    Doubles would add up to different last digits in every run, which rounding to cents can
    turn into different reports. Amounts are added as decimals; where one of them, or
    their sum, is too large for that (from 1e20), all are added as doubles.
    """
    exact = amount.try_cast("decimal(38,18)")
    as_decimal = F.try_sum(exact).cast("double")
    return F.when(
        (F.count(exact) == F.count(amount)) & (as_decimal.isNotNull() | (F.count(amount) == 0)),
        as_decimal,
    ).otherwise(F.sum(amount))
