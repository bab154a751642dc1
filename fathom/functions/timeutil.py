"""Time scales and formats as column expressions. Sessions are expected to run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The GPS epoch 1980-01-06 and J2000 noon in Unix seconds, seconds of a week and of a day,
# GPS minus UTC, and the Modified Julian Date of the Unix epoch.
GPS_EPOCH = 315964800
J2000_NOON = 946728000
WEEK = 604800
DAY = 86400
LEAP_SECONDS = 18
MJD_UNIX = 40587


def seconds_to_timestamp(seconds: Column) -> Column:
    """Unix seconds (double) to a timestamp, rounded to microseconds."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("long"))


def to_seconds(ts: Column) -> Column:
    """A timestamp, with or without time zone, to Unix seconds as a double."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def millis_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis.cast("long"))


def gps_to_utc(week: Column, seconds: Column, leap: int = LEAP_SECONDS) -> Column:
    """GPS week and seconds of the week to a UTC timestamp."""
    micros = (F.lit(GPS_EPOCH - leap) + week.cast("long") * F.lit(WEEK)) * F.lit(1_000_000)
    return F.timestamp_micros((micros + F.round(seconds * F.lit(1e6))).cast("long"))


def utc_to_gps(ts: Column, leap: int = LEAP_SECONDS) -> tuple[Column, Column]:
    """A UTC timestamp to GPS week (long) and seconds of the week (double)."""
    micros = F.unix_micros(ts.cast("timestamp")) - F.lit((GPS_EPOCH - leap) * 1_000_000)
    week = F.floor(micros / F.lit(WEEK * 1_000_000)).cast("long")
    return week, F.pmod(micros, F.lit(WEEK * 1_000_000)) / F.lit(1e6)


def utc_to_j2000(ts: Column) -> Column:
    """Seconds since 2000-01-01 12:00 as a double."""
    return (F.unix_micros(ts.cast("timestamp")) - F.lit(J2000_NOON * 1_000_000)) / F.lit(1e6)


def to_mjd(ts: Column) -> Column:
    """Modified Julian Date as a double."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(DAY * 1e6) + F.lit(float(MJD_UNIX))


def seconds_to_date(seconds: Column) -> Column:
    return F.to_date(seconds_to_timestamp(seconds))


def day_key(ts: Column) -> Column:
    """YYYY-MM-DD."""
    return F.date_format(ts, "yyyy-MM-dd")


def day_file_name(marker: Column | str, ts: Column) -> Column:
    """<marker><day of year>0.<year>o, the usual name of a daily observation file."""
    marker = marker if isinstance(marker, Column) else F.lit(marker)
    return F.concat(marker, F.lpad(F.dayofyear(ts).cast("string"), 3, "0"), F.lit("0."), F.date_format(ts, "yy"), F.lit("o"))


def rinex_time(line: Column) -> Column:
    """The first six numbers of a RINEX date line as a timestamp; null if there is none."""
    n = F.regexp_extract_all(line, F.lit(r"\d+(?:\.\d+)?"), F.lit(0))
    year = F.get(n, 0).try_cast("int")
    year = F.when(year < 80, year + 2000).when(year < 100, year + 1900).otherwise(year)
    text = F.format_string("%04d-%02d-%02d %02d:%02d:", year, *[F.get(n, i).try_cast("int") for i in range(1, 5)])
    return F.when(F.size(n) >= 6, F.try_to_timestamp(text_and_seconds(text, F.get(n, 5))))


def text_and_seconds(prefix: Column, seconds: Column) -> Column:
    return F.concat(prefix, F.format_string("%09.6f", seconds.try_cast("double")))


def flexible_timestamp(text: Column) -> Column:
    """The first format that fits, else null."""
    formats = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy"]
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def day_of_year_time(year: Column, day: Column, seconds: Column) -> Column:
    """Year, day of the year (from 1) and seconds of the day to a timestamp."""
    start = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int")).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(start) + F.round(seconds * F.lit(1e6)).cast("long"))
