"""The given tables as domain tables, deterministically, and the same mapping as DuckDB SQL.

events are shots (and by event_type kinematic positions, inertial positions, residuals); lineitem and orders are replies
and pings; conversations are event-log lines; supplier and part are transponders and a cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.geo import E2, SEMI_MAJOR, geodetic_to_ecef
from fathom.functions.timeutil import to_seconds

CENTRE = (45.0, -125.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as shots; only the columns that a query uses are read."""
    e = table(spark, sf_dir, "events")
    lat = F.lit(44.95) + (F.col("user_id") % 100) / F.lit(1000.0)
    lon = F.lit(-125.05) + (F.col("event_id") % 100) / F.lit(1000.0)
    x, y, z = geodetic_to_ecef(lat, lon, F.col("value") % 10)
    e = e.select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), to_seconds(F.col("ts")).alias("pingTime"),
        F.concat(F.lit("IR"), (F.col("user_id") % 4).cast("string")).alias("transponderID"), (F.col("value") % 40).alias("snr"), (-(F.col("value") % 45)).alias("dbv"),
        F.get_json_object("props", "$.k").cast("long").alias("xc"), lat.alias("latitude"), lon.alias("longitude"), (F.col("value") % 10).alias("height"), x.alias("east0"), y.alias("north0"), z.alias("up0"),
    )
    return e.withColumn("returnTime", F.col("pingTime") + F.lit(1.0) + F.col("value") / 100)


def of_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("event_type") == kind)


def sql_ecef(lat: str, lon: str, height: str) -> tuple[str, str, str]:
    n = f"({SEMI_MAJOR!r}::DOUBLE / sqrt(1.0::DOUBLE - {E2!r}::DOUBLE * sin(radians({lat})) * sin(radians({lat}))))"
    return (
        f"(({n} + {height}) * cos(radians({lat})) * cos(radians({lon})))",
        f"(({n} + {height}) * cos(radians({lat})) * sin(radians({lon})))",
        f"(({n} * {1 - E2!r}::DOUBLE + {height}) * sin(radians({lat})))",
    )


def sql_enu(xyz: tuple[str, str, str], origin: tuple[str, str, str], lat: str, lon: str) -> tuple[str, str, str]:
    dx, dy, dz = (f"({a} - {b})" for a, b in zip(xyz, origin, strict=True))
    la, lo = f"radians({lat})", f"radians({lon})"
    return (
        f"(-sin({lo}) * {dx} + cos({lo}) * {dy})",
        f"(-sin({la}) * cos({lo}) * {dx} - sin({la}) * sin({lo}) * {dy} + cos({la}) * {dz})",
        f"(cos({la}) * cos({lo}) * {dx} + cos({la}) * sin({lo}) * {dy} + sin({la}) * {dz})",
    )


_LAT, _LON, _H = "(44.95::DOUBLE + (user_id % 100) / 1000.0::DOUBLE)", "(-125.05::DOUBLE + (event_id % 100) / 1000.0::DOUBLE)", "(value % 10)"
_X, _Y, _Z = sql_ecef(_LAT, _LON, _H)
SHOTS = f"""shots AS (
    SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) / 1e6 AS pingTime, 'IR' || (user_id % 4) AS transponderID,
           value % 40 AS snr, -(value % 45) AS dbv, CAST(json_extract_string(props, '$.k') AS BIGINT) AS xc,
           epoch_us(ts) / 1e6 + 1.0::DOUBLE + value / 100 AS returnTime,
           {_LAT} AS latitude, {_LON} AS longitude, {_H} AS height, {_X} AS east0, {_Y} AS north0, {_Z} AS up0
    FROM events)"""


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A survey per week of events, from Monday to Saturday midnight: survey_id, position (week), start, end."""
    o = table(spark, sf_dir, "events").select(F.date_trunc("week", F.col("ts").cast("timestamp")).alias("start")).distinct()
    return o.select(
        F.date_format("start", "yyyyMMdd").alias("survey_id"), F.weekofyear("start").alias("position"), "start", F.timestamp_micros(F.unix_micros("start") + F.lit(5 * 86_400_000_000)).alias("end")
    )


SURVEYS = """surveys AS (
    SELECT DISTINCT strftime(date_trunc('week', ts), '%Y%m%d') AS survey_id, CAST(weekofyear(date_trunc('week', ts)) AS INTEGER) AS position,
           CAST(date_trunc('week', ts) AS TIMESTAMP) AS s, CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 5 DAY AS e
    FROM events)"""
