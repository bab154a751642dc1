"""Refinement of vehicle positions: preparation, smoothing per station and day, and update of the shots."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.geo import geodetic_to_ecef
from fathom.operators.filters import around_medians, without_spikes
from fathom.operators.report import offset_summary
from fathom.operators.smoothing import smooth_tracks
from fathom.operators.temporal import fill_both_ways, nearest_asof, radius_mean, velocities
from fathom.sources.workspace import stable

# The 19 columns of positions that go into the smoother, in order.
POSITION = [
    "time", "east", "north", "up", "ant_x", "ant_y", "ant_z", "ant_sigx", "ant_sigy", "ant_sigz", "rho_xy", "rho_xz", "rho_yz",
    "east_sig", "north_sig", "up_sig", "v_sden", "v_sdeu", "v_sdnu",
]
#: What the smoother reads: places, their deviations, velocities, their deviations.
SMOOTHED = (["ant_x", "ant_y", "ant_z"], ["ant_sigx", "ant_sigy", "ant_sigz"], ["east", "north", "up"], ["east_sig", "north_sig", "up_sig"])
PLACE = ["time", *SMOOTHED[0], *SMOOTHED[1]]
ZEROS = ["rho_xy", "rho_xz", "rho_yz", "v_sden", "v_sdeu", "v_sdnu"]
KEYS = ["station", "day"]


def constant_uncertainty(df: DataFrame, sigma: float = 0.1) -> DataFrame:
    return df.withColumns({c: F.lit(sigma) for c in ("ant_sigx", "ant_sigy", "ant_sigz", "east_sig", "north_sig", "up_sig")} | {c: F.lit(0.0) for c in ZEROS})


def prepare_inertial(imu: DataFrame, order: list[str]) -> DataFrame:
    """Inertial positions (station, day, time in seconds ...) as POSITION; deviations filled both ways per day."""
    stds = {"latitude_std": "ant_sigx", "longitude_std": "ant_sigy", "height_std": "ant_sigz", "eastVelocity_std": "east_sig", "northVelocity_std": "north_sig", "upVelocity_std": "up_sig"}
    filled = fill_both_ways(imu, KEYS, order, list(stds))
    xyz = geodetic_to_ecef(F.col("latitude"), F.col("longitude"), F.col("height"))
    velocity = {"eastVelocity": "east", "northVelocity": "north", "upVelocity": "up"}
    out = filled.select(*KEYS, "time", *[c.alias(n) for c, n in zip(xyz, ("ant_x", "ant_y", "ant_z"), strict=True)], *[F.col(a).alias(b) for a, b in (stds | velocity).items()], *[F.lit(0.0).alias(c) for c in ZEROS])
    return out.select(*KEYS, *POSITION)


def prepare_kinematic(kin: DataFrame, order: list[str], most: float = 4.0) -> DataFrame:
    """Kinematic positions (station, day, time, east, north, up as x, y, z) as POSITION, rows with velocity spikes gone."""
    axes = {"east": "ant_x", "north": "ant_y", "up": "ant_z"}
    base = kin.select(*KEYS, "time", *[F.col(a).alias(b) for a, b in axes.items()], *[c for c in order if c not in ("time", *KEYS, *axes)])
    moved = velocities(base, KEYS, order, "time", list(axes.values()))
    moved = without_spikes(moved, [f"v_{c}" for c in axes.values()], KEYS, most)
    moved = constant_uncertainty(moved).withColumns({a: F.col(f"v_{b}") for a, b in axes.items()})
    return moved.select(*KEYS, *POSITION)


def combine(inertial: DataFrame, kinematic: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Both tables' rows, in the position columns or those given, whatever their order."""
    columns = columns or [*KEYS, *POSITION]
    return inertial.select(*columns).unionByName(kinematic.select(*columns))


def shots_to_positions(shots: DataFrame, keys: list[str], shot_id: str, seconds: int | None = None) -> DataFrame:
    """Both ends of each shot as positions (time, x, y, z and deviations), deviations filled, with velocities per second.

    With `seconds`, a key's rows are worked on in parts of that length.
    """
    ends = []
    for k, t in ((0, "pingTime"), (1, "returnTime")):
        ends.append(shots.select(*keys, shot_id, F.lit(k).alias("end"), F.col(t).alias("time"), *[F.col(f"{a}{k}").alias(a) for a in ("east", "north", "up")], *[F.col(f"{a}_std{k}").alias(f"{a}_std") for a in ("east", "north", "up")]))
    order, part = ["time", shot_id, "end"], "_slice" if seconds else None
    both = ends[0].unionByName(ends[1])
    both = both.withColumn(part, F.floor(F.col("time") / seconds)) if part else both
    both = fill_both_ways(both, keys, order, ["east_std", "north_std", "up_std"], part)
    out = velocities(both, keys, order, "time", ["east", "north", "up"], part)
    return out.drop(part) if part else out


def prepare_shots(shots: DataFrame, shot_id: str) -> DataFrame:
    """Both ends of each shot as POSITION; velocities come from the positions themselves, so they have no deviation and add nothing."""
    p = shots_to_positions(shots, KEYS, shot_id)
    axes = list(zip(("east", "north", "up"), "xyz", strict=True))
    out = p.select(*KEYS, "time", *[F.col(a).alias(f"ant_{b}") for a, b in axes], *[F.col(f"{a}_std").alias(f"ant_sig{b}") for a, b in axes], *[F.col(f"v_{a}").alias(a) for a, _ in axes])
    out = out.withColumns({f"{a}_sig": F.lit(None).cast("double") for a, _ in axes} | {c: F.lit(0.0) for c in ZEROS})
    return out.select(*KEYS, *POSITION)


# ---------------------------------------------------------------- smoothing


def smooth(positions: DataFrame, noise: float = 0.1, needed: list[str] | None = None) -> DataFrame:
    """Smoothed positions and their deviations per station and day; rows with a null in a needed column (all, if none are given) are left out.

    Days of many rows are smoothed in blocks of time, so no task holds more than a block.
    """
    rows = positions.dropna(subset=needed or POSITION).select(*KEYS, *POSITION)
    track = smooth_tracks(rows, KEYS, POSITION, *SMOOTHED, noise)
    return track.select(*KEYS, "time", *[F.col(a).alias(f"ant_{a}") for a in "xyz"], *[f"sig_{a}" for a in "xyz"])


# ---------------------------------------------------------------- update of shots


def update_shots(shots: DataFrame, track: DataFrame, keys: list[str], shot_id: str, radius: float = 0.2, weighting: str = "distance", threshold: float | None = None) -> DataFrame:
    """Shots with both ends' positions replaced by means of the track's around their times.

    An end without any track point in the radius stays. isUpdated is set where an end was updated; with a threshold
    only where an axis moved by more.
    """
    out = shots
    changed = F.lit(False)
    for k, t in ((0, "pingTime"), (1, "returnTime")):
        near = radius_mean(shots, track, keys, t, "time", radius, shot_id, ["ant_x", "ant_y", "ant_z"], weighting).drop("n_neighbours")
        near = near.select(shot_id, *[F.col(f"ant_{a}").alias(f"_{a}{k}") for a in "xyz"])
        out = out.join(near, shot_id, "left")
        for a, b in zip(("east", "north", "up"), "xyz", strict=True):
            moved = F.col(f"_{b}{k}").isNotNull() if threshold is None else F.coalesce(F.abs(F.col(f"_{b}{k}") - F.col(f"{a}{k}")) > threshold, F.lit(False))
            changed = changed | moved
    replaced = {f"{a}{k}": F.coalesce(F.col(f"_{b}{k}"), F.col(f"{a}{k}")) for k in (0, 1) for a, b in zip(("east", "north", "up"), "xyz", strict=True)}
    flag = {"isUpdated": F.coalesce(F.col("isUpdated"), F.lit(False)) | changed}
    done = out.select(*[(replaced | flag)[c].alias(c) if c in replaced | flag else F.col(c) for c in shots.columns])
    return done


def compare_with_track(original: DataFrame, track: DataFrame, keys: list[str], id_: str, tolerance: float = 0.01) -> DataFrame:
    """Statistics of smoothed minus original positions at the nearest times within the tolerance."""
    both = nearest_asof(original, track.select(*keys, "time", *[F.col(f"ant_{a}").alias(f"s_{a}") for a in "xyz"]), keys, "time", "time", tolerance, id_, ["s_x", "s_y", "s_z"])
    return offset_summary(both.select(*[(F.col(f"s_{a}") - F.col(f"ant_{a}")).alias(f"d{a}") for a in "xyz"]), ["dx", "dy", "dz"])


def refine_day(shots: DataFrame, imu: DataFrame | None, kin: DataFrame, shot_id: str, order: list[str], gate: float = 5000.0, radius: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Whole refinement of all stations and days at once: (updated shots, smoothed track).

    With inertial data its medians gate both tables; without (quality control) the shots' own positions take its place,
    with deviations east_std0 ... up_std1, and nothing is gated.
    """
    kinematic = prepare_kinematic(kin, order)
    if imu is None:
        positions = combine(prepare_shots(shots, shot_id), kinematic)
    else:
        inertial = prepare_inertial(imu, order)
        axes = ["ant_x", "ant_y", "ant_z"]
        positions = combine(around_medians(inertial, inertial, axes, KEYS, gate), around_medians(kinematic, inertial, axes, KEYS, gate))
    # Shots' positions bring no deviations of velocities, so there their places are all that is needed.
    track = smooth(positions, needed=PLACE if imu is None else None)
    return update_shots(shots, track, KEYS, shot_id, radius), track


# ---------------------------------------------------------------- kernel interpolation


#: Samples of a block of the kernel interpolation, about.
BLOCK_SAMPLES = 500


#: Rows whose features are held at once.
FEATURE_ROWS = 8192
#: The Gaussian kernel and its spectrum are below 1e-17 beyond this many lengths, or inverse lengths.
REACH = 9.0


def kernel_features(u: np.ndarray, middle: float, span: float) -> np.ndarray:
    """Features whose products are the kernel exp(-(a - b)**2 / 2), for u within span / 2 of the middle.

    The trapezoid rule for the kernel's spectrum: waves that repeat after span + REACH. It is exact to 1e-17, below rounding,
    and takes about 3 features for each unit of span, whatever the number of samples.
    """
    step = 2 * np.pi / (span + REACH)
    wave = step * np.arange(math.ceil(REACH / step) + 1)
    weight = np.sqrt(2 * step / np.sqrt(2 * np.pi)) * np.exp(-(wave**2) / 4)
    weight[0] /= np.sqrt(2)
    angle = (u - middle)[:, None] * wave
    return np.hstack([weight * np.cos(angle), weight[1:] * np.sin(angle[:, 1:])])


def kernel_ridge(t: np.ndarray, y: np.ndarray, s: np.ndarray, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """Kernel ridge prediction at s from samples y at t (times in lengths), and its posterior deviation.

    Where there are more samples than the kernel has features over this span, it is a ridge regression on those: samples
    are reduced to a triangle of the features' size part by part, so the work grows with the samples, not with their cube.
    """
    low, high = min(t.min(), s.min()), max(t.max(), s.max())
    middle, span = (low + high) / 2, high - low
    if len(t) <= 2 * REACH * (span + REACH) / np.pi:  # twice the number of features
        kernel = lambda a, b: np.exp(-0.5 * (a[:, None] - b[None, :]) ** 2)
        cross = kernel(s, t)
        solved = np.linalg.solve(kernel(t, t) + noise * np.eye(len(t)), np.column_stack([y, cross.T]))
        return cross @ solved[:, :3], np.sqrt(np.maximum(1 - np.einsum("ij,ji->i", cross, solved[:, 3:]), 0))
    n = kernel_features(t[:1], middle, span).shape[1]
    triangle = np.hstack([np.sqrt(noise) * np.eye(n), np.zeros((n, 3))])
    for lo in range(0, len(t), FEATURE_ROWS):
        part = slice(lo, lo + FEATURE_ROWS)
        triangle = np.linalg.qr(np.vstack([triangle, np.hstack([kernel_features(t[part], middle, span), y[part]])]), mode="r")
    root, weights = triangle[:n, :n], np.linalg.solve(triangle[:n, :n], triangle[:n, n:])
    found, std = np.empty((len(s), 3)), np.empty(len(s))
    for lo in range(0, len(s), FEATURE_ROWS):
        part = slice(lo, lo + FEATURE_ROWS)
        at = kernel_features(s[part], middle, span)
        found[part] = at @ weights
        std[part] = np.sqrt(noise) * np.linalg.norm(np.linalg.solve(root.T, at.T), axis=0)
    return found, std


def kernel_interpolate(points: DataFrame, samples: DataFrame, keys: list[str], point_id: str, length: float = 0.5, alpha: float = 1.0, block_samples: int = BLOCK_SAMPLES) -> DataFrame:
    """Kernel ridge prediction of x, y, z at points' times: (point_id, x, y, z, std) for points with a sample within `length`.

    A radial kernel on time, mean-centred; alpha near 0 is Gaussian-process interpolation, std its posterior deviation.
    Time is cut into slices of 4 lengths, beyond which the kernel is nearly nothing, and slices into blocks of about
    block_samples samples. A task solves a block with the slices on both sides of it, whatever the rate of samples elsewhere;
    its work grows with the rows, also where a slice alone has many samples (kernel_ridge).
    """
    slice_ = F.floor(F.col("time") / F.lit(4 * length)).alias("slice")
    n = samples.select(*keys, slice_, F.lit(1).alias("n")).union(points.select(*keys, slice_, F.lit(0).alias("n"))).groupBy(*keys, "slice").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys).orderBy("slice")
    ahead = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = n.withColumn("block", F.floor(ahead / block_samples))
    beside = [F.when(f("slice").over(order) == F.col("slice") + d, f("block").over(order)) for f, d in ((F.lag, -1), (F.lead, 1))]
    cuts = stable(cuts.select(*keys, "slice", "block", F.array_distinct(F.array_compact(F.array("block", *beside))).alias("blocks")), "slices")
    at = [*keys, "slice"]
    left = points.select(*keys, slice_, F.col(point_id).alias("id"), "time").join(cuts, at)
    left = left.select(*keys, "block", "id", "time", *[F.lit(None).cast("double").alias(c) for c in "xyz"])
    right = samples.select(*keys, slice_, "time", *[F.col(c).cast("double").alias(c) for c in "xyz"]).join(cuts, at)
    right = right.select(*keys, F.explode("blocks").alias("block"), F.lit(None).cast(points.schema[point_id].dataType).alias("id"), "time", *"xyz")
    id_type = points.schema[point_id].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        train, ask = pdf[pdf["id"].isna()].groupby("time", as_index=False)[["x", "y", "z"]].mean(), pdf[pdf["id"].notna()]
        empty = pd.DataFrame({"id": pd.Series(dtype=pdf["id"].dtype), **{c: pd.Series(dtype=float) for c in ("x", "y", "z", "std")}})
        if train.empty or ask.empty:
            return empty
        t, s = train["time"].to_numpy(), ask["time"].to_numpy()
        at = np.searchsorted(t, s)
        gap = np.minimum(np.abs(s - t[np.minimum(at, len(t) - 1)]), np.abs(s - t[np.maximum(at - 1, 0)]))
        ask, s = ask[gap <= length], s[gap <= length]
        if ask.empty:
            return empty
        y = train[["x", "y", "z"]].to_numpy()
        mean = y.mean(axis=0)
        found, std = kernel_ridge((t - t[0]) / length, y - mean, (s - t[0]) / length, alpha + 1e-10)
        found += mean
        return pd.DataFrame({"id": ask["id"].to_numpy(), "x": found[:, 0], "y": found[:, 1], "z": found[:, 2], "std": std})

    out = left.unionByName(right).groupBy(*keys, "block").applyInPandas(run, f"id {id_type}, x double, y double, z double, std double")
    return out.withColumnRenamed("id", point_id)
