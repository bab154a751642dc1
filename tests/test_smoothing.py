"""The smoother in blocks of time against a loop over rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import smoothing


def smooth_track(t, p, sigma, v, v_sigma, noise=0.1):
    """Positions and their variances of a constant-velocity Kalman filter with the Rauch-Tung-Striebel smoother.

    t is sorted; p, v and their deviations are n x 3, v may be NaN where no velocity is known. Axes are independent.
    """
    n = len(t)
    x, c = np.zeros((n, 3, 2)), np.zeros((n, 3, 2, 2))
    x_before, c_before = np.zeros_like(x), np.zeros_like(c)
    step = np.diff(t, prepend=t[:1])
    start_v = np.where(np.isnan(v[0]), 0.0, v[0])
    state, cov = np.stack([p[0], start_v], axis=1), np.tile(np.diag([1e6, 1e4]), (3, 1, 1)).astype(float)
    for i in range(n):
        dt = step[i]
        f = np.array([[1.0, dt], [0.0, 1.0]])
        q = noise**2 * np.array([[dt**3 / 3, dt**2 / 2], [dt**2 / 2, dt]])
        if i:
            state, cov = state @ f.T, f @ cov @ f.T + q
        x_before[i], c_before[i] = state, cov
        for k, z, r in ((0, p[i], sigma[i] ** 2), (1, v[i], v_sigma[i] ** 2)):
            use = ~np.isnan(z) & ~np.isnan(r)
            gain = cov[:, :, k] / (cov[:, k, k] + np.where(use, r, 1.0))[:, None] * use[:, None]
            state = state + gain * np.where(use, z - state[:, k], 0.0)[:, None]
            keep = np.eye(2) - gain[:, :, None] * np.eye(2)[k]  # this form loses no digits to the wide start
            cov = keep @ cov @ np.transpose(keep, (0, 2, 1)) + gain[:, :, None] * gain[:, None, :] * np.where(use, r, 0.0)[:, None, None]
        x[i], c[i] = state, cov
    for i in range(n - 2, -1, -1):
        f = np.array([[1.0, step[i + 1]], [0.0, 1.0]])
        g = c[i] @ f.T @ np.linalg.inv(c_before[i + 1])
        x[i] = x[i] + np.einsum("kab,kb->ka", g, x[i + 1] - x_before[i + 1])
        c[i] = c[i] + g @ (c[i + 1] - c_before[i + 1]) @ np.transpose(g, (0, 2, 1))
    return x[:, :, 0], c[:, :, 0, 0]


def a_track(n, seed):
    rng = np.random.default_rng(seed)
    t = np.sort(np.round(rng.random(n) * n * 0.7, 1))  # with equal times
    p = 4e6 + np.cumsum(rng.normal(size=(n, 3)), 0)
    v = rng.normal(size=(n, 3))
    v[rng.random((n, 3)) < 0.3] = np.nan
    v_sigma = rng.random((n, 3)) + 0.01
    v_sigma[rng.random((n, 3)) < 0.2] = np.nan
    return t, p, rng.random((n, 3)) + 0.05, v, v_sigma


@pytest.mark.parametrize("n", [1, 3, 8, 1000])
def test_scan_equals_loop(n):
    t, p, sigma, v, v_sigma = a_track(n, n)
    x, var = smooth_track(t, p, sigma, v, v_sigma)
    mean = p.mean(axis=0)
    y, variance = np.stack([p - mean, v], -1), np.stack([sigma, v_sigma], -1) ** 2
    got, got_var = smoothing.smoothed(t, y, variance, 0.1)
    assert np.abs(got + mean - x).max() < 1e-7 and np.abs(got_var - var).max() < 1e-7
    # In three blocks, each knowing the other ones' elements alone.
    if n > 8:
        parts = [slice(0, 300), slice(300, 301), slice(301, n)]
        before, after = [None, t[299], t[300]], [t[300], t[301], None]
        totals = [smoothing.filtered(t[s], y[s], variance[s], 0.1, b) for s, b in zip(parts, before, strict=True)]
        ahead = smoothing.scan(tuple(np.concatenate([e[i][-1:] for e in totals]) for i in range(5)), smoothing.both_filtered)
        one = lambda e, k: tuple(x[k : k + 1] for x in e)
        found = []
        for k, s in enumerate(parts):
            _, m, c, _, _ = smoothing.filtered(t[s], y[s], variance[s], 0.1, before[k], one(ahead, k - 1) if k else None)
            found.append(smoothing.scan_back(smoothing.smoother_elements(m, c, t[s], after[k], 0.1), smoothing.both_smoothed))
        behind = smoothing.scan_back(tuple(np.concatenate([e[i][:1] for e in found]) for i in range(3)), smoothing.both_smoothed)
        for k, s in enumerate(parts):
            got, got_var = smoothing.smoothed(t[s], y[s], variance[s], 0.1, before[k], after[k], one(ahead, k - 1) if k else None, one(behind, k + 1) if k < 2 else None)
            assert np.abs(got + mean - x[s]).max() < 1e-7 and np.abs(got_var - var[s]).max() < 1e-7


def test_long_tracks_in_blocks(spark):
    """Three tracks, of 4000, 900 and 1 rows, in blocks of about 500 rows: no task has a whole long track."""
    rows, want = [], {}
    for key, n in (("a", 4000), ("b", 900), ("c", 1)):
        t, p, sigma, v, v_sigma = a_track(n, n)
        order = np.lexsort((p[:, 0], t))
        t, p, sigma, v, v_sigma = (z[order] for z in (t, p, sigma, v, v_sigma))
        x, var = smooth_track(t, p, sigma, v, v_sigma)
        want[key] = np.column_stack([t, x, np.sqrt(var)])
        rows += [(key, *map(float, r)) for r in np.column_stack([t, p, sigma, v, v_sigma])]
    names = [f"{c}{i}" for c in ("p", "s", "v", "w") for i in range(3)]
    df = spark.createDataFrame(rows, "k string, t double, " + ", ".join(f"{c} double" for c in names)).repartition(5)
    df = df.select("k", "t", *[F.nanvl(c, F.lit(None)).alias(c) for c in names])
    sides = [names[i : i + 3] for i in (0, 3, 6, 9)]
    cuts = smoothing.cut(df, ["k"], "t", sides[0], 500)
    assert cuts.where("k = 'a'").select("block").distinct().count() >= 7
    got = smoothing.smooth_tracks(df, ["k"], ["t", "p0"], *sides, 0.1, 500).collect()
    assert len(got) == 4901
    for key, expected in want.items():
        mine = np.array(sorted(tuple(r)[1:] for r in got if r["k"] == key))
        assert np.abs(mine - expected[np.lexsort(expected.T[::-1])]).max() < 1e-6
    assert smoothing.smooth_tracks(df.limit(0), ["k"], ["t", "p0"], *sides).count() == 0
