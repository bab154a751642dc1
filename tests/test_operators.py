"""Operators on tiny frames with answers worked out by hand."""

import datetime as dt
import json
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.functions import config, geo, text, timeutil
from fathom.operators import catalog, filters, pairing, refine, report, smoothing, surveys, temporal, validate
from fathom.plans import jobs
from fathom.sources import readers, sinks
from fathom.streaming import ingest


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_geodetic_round_trip(spark):
    df = spark.createDataFrame([(45.1, -124.9, 12.0), (-30.0, 170.0, -50.0), (0.0, 0.0, 0.0)], "lat double, lon double, h double")
    xyz = geo.geodetic_to_ecef(F.col("lat"), F.col("lon"), F.col("h"))
    origin = geo.geodetic_to_ecef(45.0, -125.0, 0.0)
    back = geo.enu_to_ecef(geo.ecef_to_enu(xyz, origin, 45.0, -125.0), origin, 45.0, -125.0)
    for r in df.select(*[F.abs(a - b).alias(n) for a, b, n in zip(xyz, back, "xyz", strict=True)]).collect():
        assert max(r) < 1e-6
    x, y, z = spark.range(1).select(*geo.geodetic_to_ecef(0.0, 0.0, 0.0)).first()
    assert (x, y, z) == (6378137.0, 0.0, 0.0)


def test_filters_at_limits_and_nan(spark):
    df = spark.createDataFrame([(1, 12.0, -36.0, 45), (2, math.nan, -10.0, 90), (3, 11.9, -10.0, 90), (4, 20.0, None, 90), (5, 20.0, -3.0, 45)], "id int, snr double, dbv double, xc int")
    assert rows(filters.acoustic(df), "id") == [(1,), (5,)]
    assert rows(filters.acoustic(df.drop("dbv", "xc")), "id") == [(1,), (4,), (5,)]


def test_bad_times_are_inclusive_and_null_safe(spark):
    shots = spark.createDataFrame([(1, 9.0), (2, 8.999), (3, 11.0), (4, 11.001), (5, None), (6, -1.0)], "id int, t double")
    bad = spark.createDataFrame([(10.0, 20.0), (None, 20.0), (30.0, 5.0), (-2.0, 99.0)], "time double, wrms double")
    assert rows(filters.outside_bad_times(shots, bad, "t", "time", F.col("wrms") > 15), "id") == [(2,), (4,), (5,)]
    assert filters.outside_bad_times(shots, bad.limit(0), "t", "time", F.col("wrms") > 15).count() == 6


def test_spikes_in_a_constant_group_stay(spark):
    df = spark.createDataFrame([("a", 1.0)] * 3 + [("b", 1.0)] * 30 + [("b", 99.0)], "k string, v double")
    assert rows(filters.without_spikes(df, ["v"], ["k"]).groupBy("k").count(), "k", "count") == [("a", 3), ("b", 30)]


def test_intervals_that_touch_are_merged(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (1, 5.0, 6.0), (1, 2.0, 3.0), (1, 7.0, 8.0), (2, 0.0, 1.0), (2, None, 3.0)], "k int, a double, b double")
    assert rows(filters.merge_intervals(df, "a", "b", ["k"]), "k", "a", "b") == [(1, 0.0, 6.0), (1, 7.0, 8.0), (2, 0.0, 1.0)]


def test_failed_ping_hides_older_ones(spark):
    e = spark.createDataFrame([("f", 0, "interrogation", 1), ("f", 1, "range", None), ("f", 2, "interrogation", None), ("f", 3, "range", None), ("f", 4, "interrogation", 7), ("f", 5, "range", None), ("f", 6, "range", None), ("g", 0, "range", None)], "file string, line int, kind string, v int")
    for size in (100, 3, 2, 1):  # in parts, the last ping of the parts before is carried on
        parts = e.withColumn("part", F.floor(F.col("line") / size))
        p = pairing.pair_with_last(parts, "file", "part", ["line"], "kind", "interrogation", "range", F.col("v"), F.col("v").isNotNull())
        assert rows(p.select("file", "line", "ping.value"), "file", "line", "value") == [("f", 1, 1), ("f", 5, 7), ("f", 6, 7)]


def test_logs_in_splits_give_the_rows_of_whole_files(spark, tmp_path):
    """Two logs of 300 kB and small ones, read in splits of 10 kB: the lines, their numbers and the shots are those of whole files."""
    event = lambda kind, i, t: '{"event": "%s", "event_id": %d, "time": {"common": %.1f}, "range": {"cn": "IR1", "range": 1.5, "tat": 320.0}}' % (kind, i, t)
    rng = np.random.default_rng(6)
    for name, n in (("a", 2500), ("b", 2500), ("c", 3), ("d", 1), ("e", 0)):
        kinds = [("interrogation" if x < 0.02 else "range" if x < 0.9 else "status" if x < 0.95 else None) for x in rng.random(n)]
        lines = ["broken {" if k is None else "" if k == "status" and i % 2 else event(k, i, i / 10) for i, k in enumerate(kinds)]
        (tmp_path / f"{name}.log").write_bytes(("\r\n" if name == "b" else "\n").join(lines).encode() + b"\n" * (n > 3))
    want_lines, want_shots = [], []
    for f in sorted(tmp_path.glob("*.log")):
        ping = None
        for i, text in enumerate(f.read_text().replace("\r\n", "\n").split("\n")):
            if text:
                want_lines.append((f.name, i, text))
            e = json.loads(text) if text.startswith("{") else {}
            if e.get("event") == "interrogation":
                ping = e["event_id"]
            if e.get("event") == "range" and ping is not None:
                want_shots.append((f.name, e["event_id"], ping / 10 + 18))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        lines = readers.read_lines(spark, str(tmp_path))
        assert lines.select("file", "part").distinct().count() > 50
        name = F.regexp_extract("file", "[^/]+$", 0).alias("file")
        assert rows(readers.numbered_lines(lines).where("text != ''").select(name, "line", "text"), "file", "line", "text") == sorted(want_lines, key=str)
        shots = jobs.shots_from_logs(spark, str(tmp_path)).select(name, "event_id", F.round("pingTime", 6).alias("pingTime"))
        assert rows(shots, "file", "event_id", "pingTime") == sorted(((f, i, round(p, 6)) for f, i, p in want_shots), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ranks_need_no_window_over_a_key(spark):
    """Nine tenths of the rows have one key, some keys are null; places are those of a window."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(None if k == 3 else "hot" if k else "cold", float(x), i) for i, (k, x) in enumerate(zip(rng.integers(0, 20, 3000), rng.integers(0, 50, 3000), strict=True))], "k string, x double, i long")
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("x", "i")))
    got = temporal.ranked(df, ["k"], ["x", "i"])
    assert rows(got, "i", "position") == rows(want, "i", "position")
    everything = temporal.ranked(df, [], ["x", "i"])
    assert rows(everything, "i", "position") == rows(df.withColumn("position", F.row_number().over(Window.orderBy("x", "i"))), "i", "position")


def test_reply_without_range_is_rejected(spark):
    df = spark.createDataFrame([(-0.319939, 0.52, 1.0, 1.2000608), (0.5, 0.32, 0.0, 0.82), (0.5, 0.32, 0.0, 16.0), (-0.45, 0.32, 0.0, 0.0)], "tt double, tat double, pingTime double, returnTime double")
    assert [r["reject_reason"] for r in pairing.reply_consistency(df).collect()] == [None, None, "too far apart", "no range"]


def test_nearest_prefers_the_earlier_one_at_equal_distance(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 10.02), (3, -0.01), (4, 50.0)], "id int, t double")
    right = spark.createDataFrame([(9.99, "a"), (10.01, "b"), (0.0, "c"), (None, "d")], "t double, v string")
    got = temporal.nearest_asof(left, right, [], "t", "t", 0.0101, "id", ["v"])
    assert rows(got, "id", "v") == [(1, "a"), (2, "b"), (3, "c"), (4, None)]


def test_radius_mean_uses_exact_hits_alone(spark):
    points = spark.createDataFrame([(1, 10.0), (2, 10.1), (3, 99.0)], "id int, t double")
    samples = spark.createDataFrame([(10.0, 1.0), (10.0, 3.0), (10.15, 9.0)], "t double, v double")
    got = {r["id"]: (r["n_neighbours"], r["v"]) for r in temporal.radius_mean(points, samples, [], "t", "t", 0.2, "id", ["v"]).collect()}
    assert got[1] == (3, 2.0) and 3 not in got
    assert got[2][1] == pytest.approx((1 / 0.1 * 1 + 1 / 0.1 * 3 + 1 / 0.05 * 9) / (1 / 0.1 * 2 + 1 / 0.05), rel=1e-6)


def test_interpolation_stays_inside_the_span(spark):
    left = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 2.5), (4, 10.0), (5, 10.1)], "id int, t double")
    right = spark.createDataFrame([(0.0, 0.0), (10.0, 100.0)], "t double, v double")
    assert rows(temporal.interpolate(left, right, [], "t", "t", ["v"]), "id", "v") == [(2, 0.0), (3, 25.0), (4, 100.0)]


def test_fill_and_velocity(spark):
    df = spark.createDataFrame([("k", 0.0, None, 0.0), ("k", 2.0, 5.0, 4.0), ("k", 3.0, None, 4.0), ("j", 0.0, None, 1.0)], "k string, t double, s double, x double")
    assert rows(temporal.fill_both_ways(df, ["k"], ["t"], ["s"]), "k", "t", "s") == [("j", 0.0, None), ("k", 0.0, 5.0), ("k", 2.0, 5.0), ("k", 3.0, 5.0)]
    assert rows(temporal.velocities(df, ["k"], ["t"], "t", ["x"]), "k", "t", "v_x") == [("j", 0.0, None), ("k", 0.0, 2.0), ("k", 2.0, 2.0), ("k", 3.0, 0.0)]


def test_decimation_carries_flags_to_the_next_kept_epoch(spark):
    df = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (2, 1, 2), (2, 2, 4), (4, 1, 8), (5, 2, 1), (9, 1, 1)], "ms long, sat int, f long")
    got = temporal.decimate(df, [], "ms", 4, ["sat"], "f")
    assert rows(got, "ms", "sat", "f") == [(0, 1, 0), (4, 1, 11)]
    assert temporal.decimate(df, [], "ms", 0, ["sat"], "f").count() == 7


def test_survey_windows_and_validity(spark):
    ts = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    df = spark.createDataFrame([(1, ts(0)), (2, ts(10)), (3, ts(30)), (4, None)], "id int, ts timestamp")
    sv = spark.createDataFrame([("a", 0, ts(0), ts(10)), ("b", 1, ts(10), ts(20)), ("c", 2, ts(40), ts(50))], "survey_id string, position int, start timestamp, end timestamp")
    assert rows(surveys.assign_surveys(df, sv, "ts", ["survey_id"]), "id", "survey_id") == [(1, "a"), (2, "a"), (2, "b")]
    assert rows(surveys.empty_surveys(df, sv, "ts", "survey_id"), "survey_id") == [("c",)]
    assert rows(surveys.survey_at(df, sv, "ts", "id", "survey_id", "position"), "id", "survey_id") == [(1, "a"), (2, "a"), (3, None), (4, None)]
    entries = spark.createDataFrame([(1, "x", ts(0), ts(5)), (2, "y", ts(5), None)], "position int, value string, start timestamp, end timestamp").withColumn("k", F.lit(1))
    assert rows(surveys.valid_at(df.withColumn("k", F.lit(1)), entries, ["k"], "ts", "position", "value", "id"), "id", "value") == [(1, "x"), (2, "y"), (3, "y"), (4, None)]
    single = entries.where("position = 1")
    assert {r["value"] for r in surveys.valid_at(df.withColumn("k", F.lit(1)), single, ["k"], "ts", "position", "value", "id").collect()} == {"x"}


def test_rates_fill_empty_bins(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 1)), ("a", dt.datetime(2024, 1, 1, 0, 35)), ("b", dt.datetime(2024, 1, 1, 0, 1))], "k string, ts timestamp")
    got = report.reply_rates(df, ["k"], "ts").groupBy("k").agg(F.count("*").alias("bins"), F.sum("n").alias("n"))
    assert rows(got, "k", "bins", "n") == [("a", 4, 2), ("b", 1, 1)]


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.2,), (0.21,), (-0.05,)], "x double")
    assert rows(report.residual_histogram(df, "x", 0.25), "bin", "n") == [(0, 1), (1, 2), (3, 1)]


def test_validation_quarantines_with_reasons(spark):
    df = spark.createDataFrame([(1e9, "a", 1e9, 1.0, "7"), (0.0, None, 1e9, 700.0, "x")], "pingTime double, transponderID string, returnTime double, tt double, xc string")
    good, bad = validate.validate(validate.coerce(df, "shot"), "shot")
    assert good.count() == 1
    assert sorted(bad.first()["reasons"]) == ["pingTime out of range", "transponderID missing", "tt out of range"]
    assert rows(validate.reason_counts(bad), "n") == [(1,)] * 3


def test_range_messages(spark):
    obs = "3,0,1.5,0.1,-2.5,0.01,5.0,45.0,100.0,1810dc04"
    texts = [f"#RANGEA,USB2,0,73.5,FINESTEERING,2379,414835.000,0,5103,1;2,{obs},{obs.replace('3,0', '7,4', 1).replace('1810dc04', '08119f24')}*ab", f"#RANGEA,USB2,0,73.5,FINESTEERING,2379,414835.000,0,5103,1;29,{obs},7,4,1*ab", "#RANGEA,no,body*00", f"#RANGEA,USB2,0,73.5,FINESTEERING,99,1.0,0,5103,1;1,{obs}*ab", None]
    got = readers.range_observations(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, message string"), "message")
    assert rows(got, "id", "sys", "sat", "fcn") == [(0, 0, 3, 0), (0, 1, 7, 4), (1, 0, 3, 0)]
    assert got.first()["time"] == dt.datetime(1980, 1, 6) + dt.timedelta(weeks=2379, seconds=414835 - 18)


def test_file_kinds_follow_the_order_of_patterns(spark):
    names = ["a.23O", "novatel.pin", "Novatel1.bin", "x_kin_NOV770", "a.res", "._x.pin", "q.pin", "seabird", "other"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(text.classify_file(F.col("n"), F.lit(1)).alias("k")).collect()
    assert [r["k"] for r in got] == ["rinex2", "novatel", "novatelpin", "kin", "kinresiduals", None, "qcpin", "seabird", None]


def test_config_overlay_ignores_nulls_and_unknown_keys():
    base = {"a": {"x": 1, "y": 2}, "b": 3}
    assert config.overlay(base, {"a": {"x": 9, "z": 1}, "b": None, "c": 1}) == {"a": {"x": 9, "y": 2}, "b": 3}
    assert base == {"a": {"x": 1, "y": 2}, "b": 3}


def test_upsert_and_append_are_idempotent(spark, tmp_path):
    old = spark.createDataFrame([("p", 1, "a"), ("q", 1, "b")], "path string, at int, v string")
    new = spark.createDataFrame([("q", 2, "c"), ("r", 2, "d")], "path string, at int, v string")
    once = catalog.upsert(old, new, "path", "at")
    assert rows(once, "path", "v") == rows(catalog.upsert(once, new, "path", "at"), "path", "v") == [("p", "a"), ("q", "c"), ("r", "d")]
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(1, "d1", "x"), (1, "d1", "y"), (2, "d2", "z")], "k int, day string, v string")
    for _ in range(2):
        sinks.append_unique(df, path, ["k"], ["day"], ["v"])
    sinks.append_unique(spark.createDataFrame([(1, "d1", "late"), (3, "d1", "w")], "k int, day string, v string"), path, ["k"], ["day"], ["v"])
    assert rows(spark.read.parquet(path), "k", "day", "v") == [(1, "d1", "x"), (2, "d2", "z"), (3, "d1", "w")]


def test_smoother_recovers_a_constant_velocity_track():
    rng = np.random.default_rng(1)
    t = np.arange(200.0)
    true = np.column_stack([t * 2, -t, np.full(200, 5.0)])
    noisy = true + rng.normal(0, 1, true.shape)
    none = np.full_like(noisy, np.nan)
    x, var = smoothing.smoothed(t, np.stack([noisy, none], -1), np.stack([np.ones_like(noisy), none], -1), 0.01)
    assert np.abs(x - true).mean() < 0.35 * np.abs(noisy - true).mean() and (var[5:-5] < 0.2).all()


def test_smoother_equals_one_dense_least_squares_solve():
    """The smoothed states are the mean of one joint normal distribution; its inverse covariance is solved at once."""
    rng = np.random.default_rng(2)
    n, noise = 12, 0.3
    t = np.cumsum(rng.uniform(0.2, 2.0, n))
    p, sigma = rng.normal(0, 5, (n, 3)), rng.uniform(0.2, 1.5, (n, 3))
    v, v_sigma = rng.normal(0, 1, (n, 3)), rng.uniform(0.3, 2.0, (n, 3))
    v[[0, 4, 7]] = np.nan
    x, var = smoothing.smoothed(t, np.stack([p, v], -1), np.stack([sigma, v_sigma], -1) ** 2, noise)
    for axis in range(3):
        lam, eta = np.zeros((2 * n, 2 * n)), np.zeros(2 * n)
        lam[:2, :2] += np.diag([1e-6, 1e-4])
        eta[:2] += [p[0, axis] * 1e-6, 0.0]
        for i in range(n):
            lam[2 * i, 2 * i] += sigma[i, axis] ** -2
            eta[2 * i] += p[i, axis] * sigma[i, axis] ** -2
            if not np.isnan(v[i, axis]):
                lam[2 * i + 1, 2 * i + 1] += v_sigma[i, axis] ** -2
                eta[2 * i + 1] += v[i, axis] * v_sigma[i, axis] ** -2
            if i:
                d = t[i] - t[i - 1]
                q = noise**2 * np.array([[d**3 / 3, d**2 / 2], [d**2 / 2, d]])
                step = np.hstack([-np.array([[1.0, d], [0.0, 1.0]]), np.eye(2)])
                lam[2 * i - 2 : 2 * i + 2, 2 * i - 2 : 2 * i + 2] += step.T @ np.linalg.inv(q) @ step
        cov = np.linalg.inv(lam)
        assert np.allclose(x[:, axis], (cov @ eta)[::2], atol=1e-6) and np.allclose(var[:, axis], np.diag(cov)[::2], atol=1e-6)


@pytest.mark.parametrize("alpha", [1.0, 1e-10])
def test_kernel_interpolation_equals_its_closed_form(spark, alpha):
    length, t = 2.0, [1.0, 2.5, 4.0]
    y = [3.0, 5.0, 4.0]
    samples = spark.createDataFrame([("s", a, b, -b, 0.0) for a, b in zip(t, y)], "station string, time double, x double, y double, z double")  # noqa: B905
    points = spark.createDataFrame([("s", 1, 2.0), ("s", 2, 2.5), ("s", 3, 20.0)], "station string, id long, time double")
    got = {r["id"]: r for r in refine.kernel_interpolate(points, samples, ["station"], "id", length, alpha).collect()}
    k = lambda a, b: math.exp(-0.5 * ((a - b) / length) ** 2)
    gram = np.array([[k(a, b) for b in t] for a in t]) + (alpha + 1e-10) * np.eye(3)
    assert set(got) == {1, 2}  # nothing is near enough to the last one
    for i, at in ((1, 2.0), (2, 2.5)):
        c = np.array([k(at, b) for b in t])
        want = c @ np.linalg.solve(gram, np.array(y) - 4.0) + 4.0
        assert abs(got[i]["x"] - want) < 1e-5 and abs(got[i]["y"] + want) < 1e-5
        assert abs(got[i]["std"] - math.sqrt(max(0.0, 1 - c @ np.linalg.solve(gram, c)))) < 1e-3
    if alpha < 1e-6:
        assert abs(got[2]["x"] - 5.0) < 1e-4  # goes through the samples


def test_kernel_interpolation_in_blocks_equals_one_dense_solve(spark):
    """300 samples in blocks of 20 with their neighbouring slices against one matrix of all of them."""
    rng = np.random.default_rng(4)
    length, t = 1.0, np.cumsum(rng.uniform(0.2, 1.2, 300))
    y = np.sin(t / 3)
    samples = spark.createDataFrame([("s", float(a), float(b), float(2 * b), 0.0) for a, b in zip(t, y, strict=True)], "station string, time double, x double, y double, z double")
    at = np.sort(rng.uniform(0, t[-1] + 5, 80))
    points = spark.createDataFrame([("s", i, float(a)) for i, a in enumerate(at)], "station string, id long, time double")
    got = {r["id"]: r for r in refine.kernel_interpolate(points, samples, ["station"], "id", length, 1.0, 20).collect()}
    k = lambda a, b: np.exp(-0.5 * ((a[:, None] - b[None, :]) / length) ** 2)
    near = np.abs(at[:, None] - t[None, :]).min(axis=1) <= length
    assert set(got) == set(np.flatnonzero(near).tolist())
    # Blocks have means of their own, so the same mean is taken out first.
    flat = {r["id"]: r for r in refine.kernel_interpolate(points, samples.withColumn("x", F.lit(3.0)), ["station"], "id", length, 1.0, 20).collect()}
    assert all(abs(r["x"] - 3.0) < 1e-9 for r in flat.values())
    std = np.sqrt(1 - np.einsum("ij,ji->i", k(at, t), np.linalg.solve(k(t, t) + np.eye(300), k(t, at))))
    assert all(abs(got[i]["std"] - std[i]) < 1e-3 for i in got)


def extended_solve(a, b):
    """a x = b for a positive definite a, by Cholesky in extended precision."""
    a, x = a.copy(), b.copy()
    for j in range(len(a)):
        a[j:, j] /= np.sqrt(a[j, j])
        a[j + 1 :, j + 1 :] -= a[j + 1 :, j : j + 1] * a[j + 1 :, j][None, :]
    for j in range(len(a)):
        x[j] /= a[j, j]
        x[j + 1 :] -= a[j + 1 :, j : j + 1] * x[j][None, :]
    for j in reversed(range(len(a))):
        x[j] /= a[j, j]
        x[:j] -= a[j, :j][:, None] * x[j][None, :]
    return x


def test_kernel_interpolation_of_a_dense_slice(spark):
    """400 scattered samples in 12 lengths: the dense solve of before was off by 1e-3, this one is not."""
    rng = np.random.default_rng(1)
    t, s, y = np.sort(rng.uniform(0, 12, 400)), np.sort(rng.uniform(4.1, 7.9, 30)), rng.uniform(0, 300, 400)
    samples = spark.createDataFrame([("s", float(a), float(b), float(-b), 1.0) for a, b in zip(t, y, strict=True)], "station string, time double, x double, y double, z double")
    points = spark.createDataFrame([("s", i, float(a)) for i, a in enumerate(s)], "station string, id long, time double")
    got = {r["id"]: r for r in refine.kernel_interpolate(points, samples, ["station"], "id", 1.0, 1e-10).collect()}
    e = lambda x: x.astype(np.longdouble)
    k = lambda a, b: np.exp(-(e(a)[:, None] - e(b)[None, :]) ** 2 / 2)
    solved = extended_solve(k(t, t) + np.longdouble(1e-10 + 1e-10) * np.eye(400, dtype=np.longdouble), np.column_stack([e(y) - e(y).mean(), k(t, s)]))
    want, var = k(s, t) @ solved[:, 0] + e(y).mean(), 1 - np.einsum("ij,ji->i", k(s, t), solved[:, 1:])
    for i in range(30):
        assert abs(got[i]["x"] - float(want[i])) < 2e-5 and abs(got[i]["y"] + float(want[i])) < 2e-5 and abs(got[i]["z"] - 1.0) < 1e-9
        assert abs(got[i]["std"] - math.sqrt(float(var[i]))) < 1e-10


def test_kernel_ridge_holds_no_matrix_of_all_samples():
    """Memory grows with the samples, not with their square (200 MB for 5000); several parts give what one gives."""
    rng = np.random.default_rng(2)
    t, s, y = np.sort(rng.uniform(0, 12, 20000)), rng.uniform(4, 8, 5000), rng.normal(size=(20000, 3))
    tracemalloc.start()
    found, std = refine.kernel_ridge(t, y, s, 1.0)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    f = refine.kernel_features(t, 6.0, 12.0)
    gram = f.T @ f + np.eye(f.shape[1])
    at = refine.kernel_features(s, 6.0, 12.0)
    assert np.allclose(found, at @ np.linalg.solve(gram, f.T @ y), atol=1e-8)
    assert np.allclose(std**2, np.einsum("ij,ji->i", at, np.linalg.solve(gram, at.T)), atol=1e-10)


def test_quantiles_by_ranges_are_exact(spark, monkeypatch):
    monkeypatch.setattr(report, "BUCKETS", 7)
    monkeypatch.setattr(report, "SORTED", 3)
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=501), "b": rng.integers(0, 4, 300).astype(float), "c": np.array([2.0]), "d": np.array([1.0, 2.0]), "f": np.array([0.0] * 450 + list(rng.normal(size=50))), "g": np.array([-1.7e308, 1e-300, 2e-300, 1e300, 1.7e308])}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v] + [("a", None), ("a", math.nan), ("e", None)], "k string, x double")
    names = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.9, "q4": 1.0}
    got = {r["k"]: r for r in report.exact_quantiles(df, "x", names, ["k"]).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        for n, q in names.items():
            assert np.isclose(got[k][n], np.quantile(v, q), rtol=1e-12, atol=1e-12)
    alone = report.exact_quantiles(df.where("k = 'f'"), "x", names, []).collect()
    assert [alone[0][n] for n in names] == [got["f"][n] for n in names]
    assert report.exact_quantiles(df.limit(0), "x", names, ["k"]).count() == 0
    assert set(report.exact_quantiles(df.limit(0), "x", names, []).first()) == {None}  # of all values, a row anyway


def test_stations_do_not_mix(spark):
    day = dt.datetime(2024, 1, 1)
    shots = spark.createDataFrame([("A", 1, day), ("B", 2, day)], "station string, id int, ts timestamp")
    own = spark.createDataFrame([("A", "S1", 0, day, day + dt.timedelta(1)), ("B", "S2", 0, day, day + dt.timedelta(1))], "station string, survey_id string, position int, start timestamp, end timestamp")
    assert rows(surveys.assign_surveys(shots, own, "ts", ["survey_id"], ["station"]), "id", "survey_id") == [(1, "S1"), (2, "S2")]
    assert surveys.empty_surveys(shots.where("id = 1"), own, "ts", "survey_id", ["station"]).first()["survey_id"] == "S2"
    assert rows(surveys.survey_at(shots, own, "ts", "id", "survey_id", "position", ["station"]), "id", "survey_id") == [(1, "S1"), (2, "S2")]
    pings = spark.createDataFrame([("A", 1, 10.0, 50), ("A", 2, 10.0, 50), ("B", 3, 10.0, 50), ("B", 4, 20.0, 50), ("B", 5, 20.0, 50)], "station string, id int, pingTime double, snr int")
    bad = spark.createDataFrame([("A", 20.0, 99.0)], "station string, time double, wrms double")
    config = {"ping_replies": {"min_replies": 2}}
    assert rows(filters.filter_shots(pings, "circle", None, bad, config), "id") == [(1,), (2,), (4,), (5,)]
    assert rows(filters.filter_shots(pings, "circle", None, bad.drop("station"), config), "id") == [(1,), (2,)]


def test_decimation_looks_over_midnight(spark):
    day = 86_400_000
    df = spark.createDataFrame([(0, 1, 1), (day - 400, 1, 2), (day + 200, 1, 4), (2 * day, 1, 8), (2 * day + 5, 1, 16)], "ms long, sat int, flags long")
    assert rows(temporal.decimate(df, [], "ms", 1000, ["sat"], "flags"), "ms", "flags") == [(0, 1), (2 * day, 8 | 2 | 4)]


def test_smoothing_handles_nulls_and_single_rows(spark):
    base = {c: 0.0 for c in refine.POSITION}
    data = [("s", dt.date(2024, 1, 1), *({**base, "time": float(i), "ant_x": float(i), "ant_sigx": 0.1, "ant_sigy": 0.1, "ant_sigz": 0.1} | ({"ant_y": None} if i == 3 else {})).values()) for i in range(5)] + [("t", dt.date(2024, 1, 1), *base.values())]
    df = spark.createDataFrame(data, "station string, day date, " + ", ".join(f"{c} double" for c in refine.POSITION))
    assert rows(refine.smooth(df).groupBy("station").count(), "station", "count") == [("s", 4), ("t", 1)]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 2, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i)) for i in range(60)], "id int, k int, ts timestamp")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    counts = ingest.streaming_reply_counts(stream, "k", "ts", delay="0 seconds")
    counts.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    batch = df.groupBy(F.window("ts", "10 minutes").start.alias("bin"), "k").agg(F.count("*").alias("n")).where(F.col("bin") + F.expr("interval 10 minutes") <= dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * 59))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "bin", "k", "n") == rows(batch, "bin", "k", "n")


def test_times(spark):
    one = spark.range(1)
    t = one.select(timeutil.gps_to_utc(F.lit(2379), F.lit(414835.0)).alias("t")).first()["t"]
    w, s = one.select(*timeutil.utc_to_gps(F.lit(t))).first()
    assert (w, s) == (2379, 414835.0)
    assert one.select(timeutil.to_mjd(F.lit(dt.datetime(2000, 1, 1, 12)))).first()[0] == 51544.5
    assert one.select(timeutil.utc_to_j2000(F.lit(dt.datetime(2000, 1, 1, 12)))).first()[0] == 0
