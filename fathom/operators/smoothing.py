"""Smoothing of tracks, parallel in time.

The filter is a constant-velocity Kalman filter with the Rauch-Tung-Striebel smoother, axis by axis. Its steps are
elements of an associative operation (Sarkka and Garcia-Fernandez, 2021), so a track is cut into blocks of time: each block
is reduced to one element, the blocks' elements are combined in order, and each block works on from what lies before
it; the smoother does the same backwards. Within a block a prefix scan combines whole arrays, in about twice as many
operations as a loop over rows has, but without one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathom.sources.workspace import fresh_path

#: Rows of a block, about: blocks are cut at whole slices of SLICE seconds.
BLOCK_ROWS, SLICE = 20_000, 60
#: Variances of the first position and velocity before anything is measured; the least variance of a measurement.
START, LEAST = (1e6, 1e4), 1e-12

Elements = tuple[np.ndarray, ...]


def _inverse(m: np.ndarray) -> np.ndarray:
    """Inverses of 2 x 2 matrices."""
    a, b, c, d = m[..., 0, 0], m[..., 0, 1], m[..., 1, 0], m[..., 1, 1]
    return np.stack([np.stack([d, -b], -1), np.stack([-c, a], -1)], -2) / (a * d - b * c)[..., None, None]


def _apply(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (m @ v[..., None])[..., 0]


def _t(m: np.ndarray) -> np.ndarray:
    return np.swapaxes(m, -1, -2)


def _motion(dt: np.ndarray, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """Transition and process noise over each step, for one axis."""
    one, zero = np.ones_like(dt), np.zeros_like(dt)
    f = np.stack([np.stack([one, dt], -1), np.stack([zero, one], -1)], -2)
    q = noise**2 * np.stack([np.stack([dt**3 / 3, dt**2 / 2], -1), np.stack([dt**2 / 2, dt], -1)], -2)
    return f[:, None], q[:, None]


def filter_elements(t: np.ndarray, before: float | None, y: np.ndarray, variance: np.ndarray, noise: float) -> Elements:
    """(A, b, C, eta, J) of each row: t is sorted, `before` the time ahead of the first row, None at a track's start.

    y and variance are n x 3 x 2 (position, velocity); what is NaN in either is not measured.
    """
    known = ~np.isnan(y) & ~np.isnan(variance)
    w = np.where(known, 1 / np.maximum(np.where(known, variance, 1.0), LEAST), 0.0)
    start = np.where(np.isnan(y[0]), 0.0, y[0])  # a first velocity without a deviation is where the filter begins, too
    y = np.where(known, y, 0.0)
    f, q = _motion(np.diff(t, prepend=t[0] if before is None else before), noise)
    eye = np.eye(2)
    m = _inverse(eye + q * w[..., None, :])
    a, c = m @ f, m @ q
    seen = _t(f) @ (w[..., :, None] * m)
    b, eta, j = _apply(c, w * y), _apply(seen, y), seen @ f
    if before is None:
        p = np.diag(START)
        c[0] = _inverse(eye + p * w[0][..., None, :]) @ p
        a[0], b[0], eta[0], j[0] = 0, start + _apply(c[0], w[0] * (y[0] - start)), 0, 0
    return a, b, c, eta, j


def both_filtered(x: Elements, y: Elements) -> Elements:
    """The element of x's steps and then y's."""
    a, b, c, eta, j = x
    a2, b2, c2, eta2, j2 = y
    d = _inverse(np.eye(2) + c @ j2)
    ahead, back = a2 @ d, _t(a) @ _t(d)
    return ahead @ a, _apply(ahead, b + _apply(c, eta2)) + b2, ahead @ c @ _t(a2) + c2, _apply(back, eta2 - _apply(j2, b)) + eta, back @ j2 @ a + j


def smoother_elements(mean: np.ndarray, cov: np.ndarray, t: np.ndarray, after: float | None, noise: float) -> Elements:
    """(E, g, L) of each row from its filtered state; `after` is the time behind the last row, None at a track's end."""
    f, q = _motion(np.diff(t, append=t[-1] if after is None else after), noise)
    ahead = f @ cov @ _t(f) + q
    e = cov @ _t(f) @ _inverse(ahead)
    g, low = mean - _apply(e @ f, mean), cov - e @ ahead @ _t(e)
    if after is None:
        e[-1], g[-1], low[-1] = 0, mean[-1], cov[-1]
    return e, g, low


def both_smoothed(x: Elements, y: Elements) -> Elements:
    """The element of x's rows and y's, which come after them."""
    e, g, low = x
    e2, g2, low2 = y
    return e @ e2, _apply(e, g2) + g, e @ low2 @ _t(e) + low


def scan(e: Elements, both: Callable[[Elements, Elements], Elements]) -> Elements:
    """Each element combined with all before it."""
    n = len(e[0])
    if n == 1:
        return e
    pairs = scan(both(tuple(x[0 : n - 1 : 2] for x in e), tuple(x[1::2] for x in e)), both)
    out = tuple(np.empty_like(x) for x in e)
    rest = both(tuple(x[: (n - 1) // 2] for x in pairs), tuple(x[2::2] for x in e)) if n > 2 else None
    for k, x in enumerate(out):
        x[0], x[1::2] = e[k][0], pairs[k]
        if rest:
            x[2::2] = rest[k]
    return out


def scan_back(e: Elements, both: Callable[[Elements, Elements], Elements]) -> Elements:
    """Each element combined with all after it."""
    return tuple(x[::-1] for x in scan(tuple(x[::-1] for x in e), lambda x, y: both(y, x)))


def _one(e: Elements, k: int) -> Elements:
    return tuple(x[k : k + 1] for x in e)


def filtered(t: np.ndarray, y: np.ndarray, variance: np.ndarray, noise: float, before: float | None = None, ahead: Elements | None = None) -> Elements:
    """Elements of all rows up to each one, `ahead` being what lies before them; their b and C are the filtered states."""
    e = scan(filter_elements(t, before, y, variance, noise), both_filtered)
    return e if ahead is None else both_filtered(ahead, e)


def smoothed(t: np.ndarray, y: np.ndarray, variance: np.ndarray, noise: float, before: float | None = None, after: float | None = None, ahead: Elements | None = None, behind: Elements | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (n x 3) and their variances of a track, or of a block of one with what lies before and behind it."""
    _, mean, cov, _, _ = filtered(t, y, variance, noise, before, ahead)
    e = scan_back(smoother_elements(mean, cov, t, after, noise), both_smoothed)
    if behind is not None:
        e = both_smoothed(e, behind)
    return e[1][..., 0], e[2][..., 0, 0]


# ---------------------------------------------------------------- over tasks

#: Shapes of the elements of one row.
FILTER, SMOOTHER = ((3, 2, 2), (3, 2), (3, 2, 2), (3, 2), (3, 2, 2)), ((3, 2, 2), (3, 2), (3, 2, 2))


def _flat(e: Elements, k: int) -> np.ndarray:
    return np.concatenate([x[k].reshape(-1) for x in e])


def _elements(rows: list[np.ndarray], shapes: tuple) -> Elements:
    flat, out, at = np.array([np.asarray(r, float) for r in rows]), [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[:, at : at + size].reshape(len(flat), *shape))
        at += size
    return tuple(out)


def cut(rows: DataFrame, keys: list[str], time: str, axes: list[str], block_rows: int) -> DataFrame:
    """(keys, slice, block, before, after, m_<axis>): the block of each slice of time, the times next to it, and the track's mean.

    Slices are counted first, so windows run over a row per slice that has rows, never over the rows themselves.
    """
    counts = rows.groupBy(*keys, F.floor(F.col(time) / SLICE).alias("slice")).agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"), *[F.sum(a).alias(f"s_{a}") for a in axes])
    track, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("slice")
    ahead = F.coalesce(F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"block": F.floor(ahead / block_rows).cast("int"), "before": F.lag("last").over(ordered), "after": F.lead("first").over(ordered)} | {f"m_{a}": F.sum(f"s_{a}").over(track) / F.sum("n").over(track) for a in axes})
    inside = Window.partitionBy(*keys, "block").orderBy("slice")
    everything = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = {"before": F.first("before").over(everything), "after": F.last("after").over(everything)}
    return counts.withColumns(ends).select(*keys, "slice", "block", "before", "after", *[f"m_{a}" for a in axes])


def smooth_tracks(rows: DataFrame, keys: list[str], order: list[str], place: list[str], place_sigma: list[str], speed: list[str], speed_sigma: list[str], noise: float = 0.1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, time, x, y, z, sig_x, sig_y, sig_z) of every row of tracks, the rows of equal keys in the order given (time first).

    A track of up to block_rows rows is smoothed by one task; longer ones are cut into blocks of time, of which a task holds
    one (a slice of SLICE seconds is never cut). Velocities and deviations may be null, places may not. Deviations below
    1e-6 count as that. The result is that of one pass over the whole track, but for rounding.
    """
    spark: SparkSession = rows.sparkSession
    path = fresh_path(spark, "cuts")
    cut(rows, keys, order[0], place, block_rows).write.parquet(path)
    cuts = spark.read.parquet(path)
    dealt = rows.withColumn("slice", F.floor(F.col(order[0]) / SLICE)).join(cuts, [*keys, "slice"])
    schema = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    key_types = ", ".join(f"{k} {schema[k]}" for k in keys)
    out = f"{key_types}, time double, x double, y double, z double, sig_x double, sig_y double, sig_z double"

    def arrays(pdf: pd.DataFrame) -> tuple:
        pdf = pdf.sort_values(order, ignore_index=True)
        get = lambda c: pdf[c].to_numpy(float)
        mean = pdf[[f"m_{a}" for a in place]].to_numpy(float)[0]
        y = np.stack([get(place) - mean, get(speed)], -1)
        variance = np.stack([get(place_sigma), get(speed_sigma)], -1) ** 2
        ends = [None if np.isnan(x) else float(x) for x in pdf[["before", "after"]].to_numpy(float)[0]]
        return get(order[0]), y, variance, mean, *ends

    def result(key: tuple, t: np.ndarray, mean: np.ndarray, x: np.ndarray, var: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({**dict(zip(keys, key, strict=False)), "time": t, **{a: x[:, i] + mean[i] for i, a in enumerate("xyz")}, **{f"sig_{a}": np.sqrt(np.maximum(var[:, i], 0)) for i, a in enumerate("xyz")}})

    def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, y, variance, mean, _, _ = arrays(pdf)
        return result(key, t, mean, *smoothed(t, y, variance, noise))

    many = cuts.where("block > 0").select(*keys).distinct()
    if many.isEmpty():
        return dealt.groupBy(*keys).applyInPandas(whole, out)
    short = dealt.join(many, keys, "left_anti").groupBy(*keys).applyInPandas(whole, out)
    path = fresh_path(spark, "blocks")
    dealt.join(many, keys, "left_semi").write.parquet(path)
    blocks = spark.read.parquet(path)
    element = f"{key_types}, block int, element array<double>"
    here = [*keys, "block"]

    def frame(key: tuple, numbers: list[int], elements: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({**{k: [v] * len(numbers) for k, v in zip(keys, key, strict=False)}, "block": np.array(numbers, np.int32), "element": elements})

    def total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, y, variance, _, before, _ = arrays(pdf)
        return frame(key, [key[-1]], [_flat(filtered(t, y, variance, noise, before), -1)])

    def ahead_of_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        e = scan(_elements(list(pdf["element"]), FILTER), both_filtered)
        return frame(key, list(pdf["block"])[1:], [_flat(e, i) for i in range(len(pdf) - 1)])

    def smoother_total(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        t, y, variance, _, before, after = arrays(pdf)
        ahead = _elements(list(known["element"]), FILTER) if len(known) else None
        _, mean, cov, _, _ = filtered(t, y, variance, noise, before, ahead)
        e = scan_back(smoother_elements(mean, cov, t, after, noise), both_smoothed)
        return frame(key, [key[-1]], [_flat(e, 0)])

    def behind_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        e = scan_back(_elements(list(pdf["element"]), SMOOTHER), both_smoothed)
        return frame(key, list(pdf["block"])[:-1], [_flat(e, i + 1) for i in range(len(pdf) - 1)])

    def block(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        t, y, variance, mean, before, after = arrays(pdf)
        ahead, behind = ([x for x in known[c] if x is not None] for c in ("ahead", "behind"))
        e = _elements(ahead, FILTER) if ahead else None
        return result(key, t, mean, *smoothed(t, y, variance, noise, before, after, e, _elements(behind, SMOOTHER) if behind else None))

    path = fresh_path(spark, "ahead")
    blocks.groupBy(*here).applyInPandas(total, element).groupBy(*keys).applyInPandas(ahead_of_blocks, element).write.parquet(path)
    ahead = spark.read.schema(element).parquet(path)
    behind = blocks.groupBy(*here).cogroup(ahead.groupBy(*here)).applyInPandas(smoother_total, element).groupBy(*keys).applyInPandas(behind_blocks, element)
    known = ahead.withColumnRenamed("element", "ahead").join(behind.withColumnRenamed("element", "behind"), here, "full")
    return short.unionByName(blocks.groupBy(*here).cogroup(known.groupBy(*here)).applyInPandas(block, out))
