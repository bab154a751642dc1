"""Filters of shots by signal, replies, distance and positioning quality."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fathom.functions.config import ACOUSTIC_LEVELS, DEFAULT_FILTERS, overlay
from fathom.functions.geo import ecef_to_enu, geodetic_to_ecef


def _number(c: str) -> Column:
    return F.when(~F.isnan(F.col(c).cast("double")), F.col(c))  # NaN passes no test


def by_snr(df: DataFrame, least: float = 12.0) -> DataFrame:
    return df.where(_number("snr") >= least)


def by_dbv(df: DataFrame, low: float = -36.0, high: float = -3.0) -> DataFrame:
    return df.where(_number("dbv").between(low, high))


def by_correlation(df: DataFrame, least: float = 45.0) -> DataFrame:
    return df.where(_number("xc") >= least)


def acoustic(df: DataFrame, level: str = "ok") -> DataFrame:
    """The three signal tests of a level; a test whose column is missing is left out."""
    snr, low, high, xc = ACOUSTIC_LEVELS[level]
    if "snr" in df.columns:
        df = by_snr(df, snr)
    if "dbv" in df.columns:
        df = by_dbv(df, low, high)
    return by_correlation(df, xc) if "xc" in df.columns else df


def least_replies(df: DataFrame, n: int = 3, keys: list[str] | None = None) -> DataFrame:
    """Rows whose ping has at least n replies, in one shuffle by ping."""
    w = Window.partitionBy(*(keys or ["pingTime"]))
    return df.withColumn("_n", F.count("*").over(w)).where(F.col("_n") >= n).drop("_n")


def near_centre(df: DataFrame, lat: float, lon: float, metres: float, mode: str = "xy") -> DataFrame:
    """Shots sent within a distance of the array's centre (at height 0), inclusive.

    mode xy measures in the Earth-centred X and Y alone, as such data has always been filtered; enu in the local plane.
    """
    centre = geodetic_to_ecef(lat, lon, 0.0)
    if mode == "xy":
        d = F.sqrt(F.pow(F.col("east0") - centre[0], 2) + F.pow(F.col("north0") - centre[1], 2))
    else:
        e, n, _ = ecef_to_enu((F.col("east0"), F.col("north0"), F.col("up0")), centre, lat, lon)
        d = F.sqrt(e * e + n * n)
    return df.where(d <= metres)


def merge_intervals(df: DataFrame, start: str, end: str, keys: list[str]) -> DataFrame:
    """Overlapping or touching intervals of each key joined to (keys, start, end)."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def outside_bad_times(df: DataFrame, residuals: DataFrame, time: str, bad_time: str, bad: Column, radius: float = 1.0, keys: list[str] | None = None) -> DataFrame:
    """Rows whose time lies in no [t - radius, t + radius] of a bad time t; null bad times don't count, null times stay.

    A range anti-join as an equi-join: times fall into bins of 2 * radius, a bad time reaches into three of them.
    """
    keys = keys or []
    width = 2 * radius
    spread = residuals.where(bad & F.col(bad_time).isNotNull()).select(*keys, F.col(bad_time).alias("_t")).distinct()
    spread = spread.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("_t") - radius) / width), F.floor((F.col("_t") + radius) / width))))
    left = df.withColumn("_bin", F.floor(F.col(time) / width))
    on = [left[k] == spread[k] for k in keys]
    cond = (left["_bin"] == spread["_bin"]) & left[time].between(spread["_t"] - radius, spread["_t"] + radius)
    for c in on:
        cond = cond & c
    return left.join(spread, cond, "left_anti").drop("_bin")


def around_medians(df: DataFrame, reference: DataFrame, columns: list[str], keys: list[str], radius: float = 5000.0) -> DataFrame:
    """Rows with each column within radius of the reference's exact median in the same group, inclusive."""
    middles = reference.groupBy(*keys).agg(*[F.median(c).alias(f"_m_{c}") for c in columns])
    out = df.join(middles, keys)
    for c in columns:
        out = out.where(F.col(c).between(F.col(f"_m_{c}") - radius, F.col(f"_m_{c}") + radius))
    return out.drop(*[f"_m_{c}" for c in columns])


def without_spikes(df: DataFrame, columns: list[str], keys: list[str], most: float = 4.0) -> DataFrame:
    """Rows whose absolute values have a z-score below `most` (population deviation) in every column.

    A group whose deviation is 0 keeps its rows.
    """
    w = Window.partitionBy(*keys)
    for c in columns:
        a = F.abs(F.col(c))
        mean, std = F.avg(a).over(w), F.stddev_pop(a).over(w)
        df = df.withColumn(f"_z_{c}", F.when(std == 0, F.lit(0.0)).otherwise((a - mean) / std))
    for c in columns:
        df = df.where(F.col(f"_z_{c}") < most)
    return df.drop(*[f"_z_{c}" for c in columns])


def residual_gate(df: DataFrame, limit: float) -> DataFrame:
    """Unflagged rows with a residual range below the limit."""
    return df.where((F.abs("ResiRange") < limit) & ~F.col("flag"))


def residual_gate_both(df: DataFrame, limit: float = 2.0) -> DataFrame:
    return df.where((F.abs("ResiRange") < limit) & (F.abs("ResiTT") < limit))


def with_satellites(epochs: DataFrame, observations: DataFrame, key: str, observation_key: str) -> DataFrame:
    """Epochs that have an observation; the others go before anything is exploded."""
    return epochs.join(observations.select(F.col(observation_key).alias(key)).distinct(), key, "left_semi")


class StageCounts:
    """Counts the rows that pass named points of a pipeline, in the pass that works the pipeline out.

    The counts are there when an action on a frame behind all of the points has run.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def __call__(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation()
        self._seen.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def rows(self) -> list[tuple[int, str, int]]:
        """(step, stage, n) of each point, in order."""
        return [(k, stage, seen.get["n"]) for k, (stage, seen) in enumerate(self._seen)]


def filter_shots(
    shots: DataFrame, survey_type: str, centre: tuple[float, float] | None, residuals: DataFrame | None, config: dict[str, Any] | None = None, keys: list[str] | None = None, counts: StageCounts | None = None
) -> DataFrame:
    """All filters in order: signal, replies, distance (surveys of type center only), positioning residuals.

    keys (by default station, where the shots have it) tell stations apart whose pings have the same time: replies are
    counted and bad times looked up within them; residuals without these columns hold for all. `counts` counts what is
    there at first and what each filter leaves.
    """
    c = overlay(DEFAULT_FILTERS, config)
    keys = [k for k in ("station",) if k in shots.columns] if keys is None else keys
    seen = counts or (lambda df, _: df)
    shots = seen(shots, "raw")
    if c["acoustic"]["enabled"]:
        shots = seen(acoustic(shots, c["acoustic"]["level"]), "acoustic")
    if c["ping_replies"]["enabled"]:
        shots = seen(least_replies(shots, c["ping_replies"]["min_replies"], [*keys, "pingTime"]), "replies")
    if c["max_distance"]["enabled"] and survey_type == "center" and centre is not None:
        shots = seen(near_centre(shots, *centre, c["max_distance"]["metres"]), "distance")
    if c["wrms"]["enabled"] and residuals is not None:
        bad = F.col("wrms") > c["wrms"]["max_wrms"]
        shots = seen(outside_bad_times(shots, residuals, "pingTime", "time", bad, c["wrms"]["radius_seconds"], [k for k in keys if k in residuals.columns]), "wrms")
    return shots


def stage_counts(df: DataFrame, counts: StageCounts) -> DataFrame:
    """(step, stage, n) of a pipeline's points, from one run of it."""
    df.write.format("noop").mode("overwrite").save()
    return df.sparkSession.createDataFrame(counts.rows(), "step int, stage string, n long")
