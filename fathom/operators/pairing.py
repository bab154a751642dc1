"""From events to shots: pings, replies, their pairing and consistency; joins of inertial records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.geo import add_offset, geodetic_to_ecef
from fathom.functions.text import scalar_of
from fathom.functions.timeutil import LEAP_SECONDS

# Delays of the two trigger generations, in seconds.
TRIGGER_DELAY_OLD = 0.1
TRIGGER_DELAY = 0.13


def _vehicle(event: str, k: int) -> list[Column]:
    gnss, ahrs = f"{event}.observations.GNSS", f"{event}.observations.AHRS"
    xyz = geodetic_to_ecef(F.col(f"{gnss}.latitude"), F.col(f"{gnss}.longitude"), F.col(f"{gnss}.hae"))
    return [
        *[F.col(f"{ahrs}.{a}").alias(f"{b}{k}") for a, b in (("h", "head"), ("p", "pitch"), ("r", "roll"))],
        *[c.alias(f"{n}{k}") for c, n in zip(xyz, ("east", "north", "up"), strict=True)],
    ]


def ping_fields(event: str = "event") -> list[Column]:
    """Columns of an interrogation: pose at the ping and its time on the GPS scale."""
    return [*_vehicle(event, 0), (F.col(f"{event}.time.common") + F.lit(float(LEAP_SECONDS))).alias("pingTime")]


def reply_fields(event: str = "event") -> list[Column]:
    """Columns of a reply: pose at the reception, times in seconds, and signal quality."""
    r = f"{event}.range"
    tat = F.col(f"{r}.tat") / F.lit(1000.0)
    return [
        *_vehicle(event, 1),
        F.col(f"{r}.cn").alias("transponderID"),
        tat.alias("tat"),
        (F.col(f"{r}.range") - tat - F.lit(TRIGGER_DELAY)).alias("tt"),
        (F.col(f"{event}.time.common") + F.lit(float(LEAP_SECONDS))).alias("returnTime"),
        *[scalar_of(F.col(f"{r}.diag.{d}")).alias(d) for d in ("dbv", "snr", "xc")],
    ]


def pair_with_last(events: DataFrame, file: str, part: str, order: list[str], kind: str, ping_kind: str, reply_kind: str, ping: Column, ping_ok: Column) -> DataFrame:
    """Each reply with the latest ping before it in file order, as a struct column `ping` of (ok, value).

    A failed ping hides those before it: its replies are dropped. One ping may have many replies. A file is worked on in
    parts, which follow each other in the order of `part`: a window runs over one part only, and what a part needs of
    those before it, their last ping, is found on a row per part. The events are used twice, so they must come out alike.
    """
    one = F.when(F.col(kind) == ping_kind, F.struct(F.coalesce(ping_ok, F.lit(False)).alias("ok"), ping.alias("value")))
    events = events.withColumn("_ping", one)
    ends = events.groupBy(file, part).agg(F.max_by("_ping", F.when(F.col("_ping").isNotNull(), F.struct(*order))).alias("_end"))
    earlier = Window.partitionBy(file).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(file, part, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    within = Window.partitionBy(file, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = events.withColumn("_ping", F.last("_ping", ignorenulls=True).over(within)).where(F.col(kind) == reply_kind).join(carried, [file, part])
    return both.withColumn("ping", F.coalesce("_ping", "_carried")).where("ping.ok").drop("_ping", "_carried")


def pair_in_file(events: DataFrame, file: str, kind: str, ping_kind: str, reply_kind: str, ping: Column) -> DataFrame:
    """Each reply with the one ping of its file (the ping of the smallest value, if a file has several)."""
    pings = events.where(F.col(kind) == ping_kind).groupBy(file).agg(F.min(ping).alias("ping"))
    return events.where(F.col(kind) == reply_kind).join(pings, file)


def reply_consistency(shots: DataFrame, reported: Column | None = None) -> DataFrame:
    """Adds reject_reason, null for a good shot: the range must be no mere turn-around, the times near and consistent.

    reported is the range as it was logged, where that is known: its parts added up again may miss the limit by a rounding.
    """
    tt, tat, ping, back = (F.col(c) for c in ("tt", "tat", "pingTime", "returnTime"))
    return shots.withColumn(
        "reject_reason",
        F.when(F.abs(tt + tat + F.lit(TRIGGER_DELAY) if reported is None else reported) <= 1e-3, "no range")
        .when(F.abs(back - ping) > 15, "too far apart")
        .when(F.abs(ping + tt + tat - back) >= 1e-6, "inconsistent times")
        .when(tt.isNull() | tat.isNull() | ping.isNull() | back.isNull(), "missing value"),
    )


def merge_inertial(positions: DataFrame, deviations: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Positions left-joined with their deviations of equal time; a deviation of exactly 0 is null."""
    stds = deviations.select(*keys, *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in columns])
    return positions.join(stds, keys, "left")


def community_standard(shots: DataFrame, forward: float, right: float, down: float, keep: list[str] | None = None) -> DataFrame:
    """Shots as the community's acoustic table: transducer coordinates at both ends, behind the columns to keep."""
    send = add_offset(tuple(F.col(c) for c in ("east0", "north0", "up0")), forward, right, down)
    back = add_offset(tuple(F.col(c) for c in ("east1", "north1", "up1")), forward, right, down)
    return shots.select(
        *(keep or []), F.col("transponderID").alias("MT_ID"), F.col("tt").alias("TravelTime"), F.col("pingTime").alias("T_transmit"),
        *[c.alias(f"{n}_transmit") for c, n in zip(send, "XYZ", strict=True)],
        F.col("returnTime").alias("T_receive"),
        *[c.alias(f"{n}_receive") for c, n in zip(back, "XYZ", strict=True)],
    )
