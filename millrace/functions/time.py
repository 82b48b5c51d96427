"""Timestamp expressions. Tables carry zone-less timestamps; operators work in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc(ts: Column) -> Column:
    """Zone-less to UTC timestamp (the session zone is UTC); streams need this
    before a watermark."""
    return ts.cast("timestamp")


def from_epoch(seconds: Column) -> Column:
    """Fractional epoch seconds to a timestamp, to the microsecond."""
    return F.timestamp_micros(F.round(seconds * 1000000).cast("bigint"))


def to_epoch(ts: Column) -> Column:
    return F.unix_micros(utc(ts)) / F.lit(1000000.0)


def micros(ts: Column) -> Column:
    return F.unix_micros(utc(ts))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1000000.0)


def period_start(ts: Column, period: str, offset: str | None = None) -> Column:
    """Start of the tumbling period a timestamp falls in."""
    return F.window(utc(ts), period, startTime=offset)["start"]


def clock_label(ts: Column) -> Column:
    return F.date_format(utc(ts), "HH:mm")


def iso(ts: Column) -> Column:
    return F.date_format(utc(ts), "yyyy-MM-dd'T'HH:mm:ss")
