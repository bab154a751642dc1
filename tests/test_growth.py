"""What fails on larger or emptier tables than the given ones: empty hand-offs, ranges at a limit, single tasks, many intervals."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fathom.operators import model_io, surveys
from fathom.plans import jobs, source_queries
from fathom.plans.queries import QUERIES
from fathom.sources import sinks
from fathom.sources.workspace import text_files

SF = "/root/testdata/sf0.001"


def test_handoff_without_any_row(spark, tmp_path):
    """of events with a bad time in every hour no shot is left; the hand-off is then empty, not an error."""
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.withColumns({"event_type": F.lit("error"), "value": F.lit(70.0)}).write.parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["R15_filtered_handoff"](spark, str(tmp_path)).collect() == []


def test_range_at_the_limit_is_judged_as_logged(spark, tmp_path):
    """F2: a range of 0.001 is no range, whatever its parts add up to; one of 0.00101 is one."""
    event = lambda kind, t, r: json.dumps({"event": kind, "event_id": int(t), "time": {"common": t}, "range": {"cn": "IR1", "range": r, "tat": 320.0}})
    (tmp_path / "a.log").write_text("\n".join([event("interrogation", 1.0, 0), event("range", 50.0, 0.001), event("range", 60.0, 0.00101)]))
    found = {r["event_id"]: r["reject_reason"] for r in jobs.shots_from_logs(spark, str(tmp_path)).collect()}
    assert found == {50: "no range", 60: "too far apart"}


def test_handoff_of_one_survey_is_written_by_several_tasks(spark, tmp_path):
    """the rows of one survey are cut into ranges of the order, files follow it, and all are read back."""
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("double").alias("pingTime"), F.lit("IR1").alias("transponderID"), F.lit("A").alias("survey_id"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_survey_csv(df, str(tmp_path / "out"), ["pingTime"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = sorted((tmp_path / "out" / "survey_id=A").glob("*.csv"))
    lines = [[float(x.split(",")[0]) for x in f.read_text().splitlines()[1:]] for f in files]
    assert len(files) == 4 and max(map(len, lines)) < 2500
    assert [x for part in lines for x in part] == [float(i) for i in range(5000)]


def test_valid_entries_of_many_overlapping_intervals(spark):
    """random intervals that overlap, end before they start or have no end, keys with one entry and without any, null keys and times."""
    rng = random.Random(5)
    at = lambda k: None if k is None else f"2024-01-{1 + k // 24:02d} {k % 24:02d}:00:00"
    entries = [(rng.choice([0, 0, 1]), p, float(p), rng.choice([None, *range(200)]) if p % 50 == 0 else rng.randrange(200), rng.choice([None, *range(200), *range(200)])) for p in range(300)]
    entries = [(k, p, v, s, None if e is None else max(s + e // 10 - 1, 0) if s is not None and p % 2 else e) for k, p, v, s, e in entries] + [(2, 0, 5.0, 50, 60)]
    asked = [(i, rng.choice([0, 1, 2, 3, None]), rng.choice([None, *range(240)])) for i in range(600)]
    want = {}
    for i, k, t in asked:
        own = [x for x in entries if x[0] == k]
        hit = own if len(own) == 1 else [x for x in own if t is not None and x[3] is not None and x[3] <= t and (x[4] is None or x[4] >= t)]
        want[i] = min(hit, key=lambda x: x[1])[2] if hit else None
    iv = spark.createDataFrame([(k, p, v, at(s), at(e)) for k, p, v, s, e in entries], "k int, position int, value double, start string, end string")
    iv = iv.withColumns({"start": F.col("start").cast("timestamp"), "end": F.col("end").cast("timestamp")})
    df = spark.createDataFrame([(i, k, at(t)) for i, k, t in asked], "id int, k int, t string").withColumn("t", F.col("t").cast("timestamp"))
    found = surveys.valid_at(df, iv, ["k"], "t", "position", "value", "id").collect()
    assert len(found) == len(asked) and {r["id"]: r["value"] for r in found} == want
    assert len({v for v in want.values()}) > 10


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("users"))
    spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.col("event_id") % 700).write.parquet(f"{folder}/events.parquet")
    return folder


def test_number_of_logs_does_not_grow_with_the_users(spark, many_users):
    """the logs of 700 users are a few files of twenty folders, with a line for each event."""
    path = Path(source_queries.event_log_files(spark, many_users).removeprefix("file://").removesuffix("/*"))
    files = list(path.rglob("part-*.txt"))
    assert len(list(path.glob("f=*"))) == 20 and len(files) <= 80
    assert sum(len(f.read_text().splitlines()) for f in files) == spark.read.parquet(f"{many_users}/events.parquet").count()


def test_cut_files_keep_lines_together(spark):
    """a folder's lines are cut into several files, never between lines that are equal in the columns of the cut."""
    df = spark.range(4000).select((F.col("id") % 2).alias("f"), F.floor(F.col("id") / 4).alias("at"), (F.col("id") % 4).alias("k"), F.concat_ws(",", F.floor(F.col("id") / 4), F.col("id") % 4).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = Path(text_files(df, "f", "value", ["at", "k"], "cut", ["at"]).removeprefix("file://").removesuffix("/*"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for f in (0, 1):
        parts = [x.read_text().splitlines() for x in sorted(path.glob(f"f={f}/part-*.txt"))]
        assert len(parts) > 1 and [x for p in parts for x in p] == [f"{i // 4},{i % 4}" for i in range(4000) if i % 2 == f]
        ats = [{x.split(",")[0] for x in p} for p in parts]
        assert sum(map(len, ats)) == len(set().union(*ats)) == 1000


def test_pin_files_are_one_folder_and_read_once(spark, many_users, tmp_path):
    """F14, F15, F16: pin files are listed with one folder; replies take the ping of their own file, with or without an event."""
    folder = Path(source_queries.pin_files(spark, many_users).removeprefix("file://"))
    users = spark.read.parquet(f"{many_users}/events.parquet").where("event_type in ('view', 'click')").select("user_id").distinct().count()
    assert len(list(folder.glob("*.pin"))) == users and not any(p.is_dir() for p in folder.iterdir())
    reply = '"uid0": {"event": "range", "event_id": 7, "time": {"common": 5.0}, "range": {"cn": "IR1", "range": 1.5, "tat": 320.0}}'
    for name, text in {"a": '{"interrogation": {"event": "interrogation", "time": {"common": 4.0}}, %s}' % reply, "b": '{"interrogation": null, %s}' % reply, "c": "{%s}" % reply, "d": "broken {"}.items():
        (tmp_path / f"{name}.pin").write_text(text)
    found = sorted((r["file"][-5:], r["pingTime"], r["event_id"]) for r in jobs.shots_from_pins(spark, str(tmp_path)).collect())
    assert found == [("a.pin", 22.0, 7), ("b.pin", None, 7)]


def test_appended_rows_are_worked_out_once(spark, tmp_path):
    """F8: rows that go to a table with rows are worked out once, though they are looked at to find partitions, and merged."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    for first in (0, 5):
        before = seen.value
        df = spark.range(first, first + 10).select(F.udf(count, "long")("id").alias("k"), F.lit("p").alias("part"))
        sinks.append_unique(df, str(tmp_path / "t"), ["k"], ["part"], ["k"])
        assert seen.value - before == 10
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(15))


def test_pairs_of_one_time_are_made_by_several_tasks(spark):
    """1,000 x 900 rows of one key: no task makes most of their pairs, and none is lost or made twice."""
    side = lambda n, c: spark.range(n).select(F.floor(F.col("id") / 5000).alias("k"), F.col("id").alias(c))
    left, right, limit = side(1000, "a"), side(900, "b"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = model_io.join_on_time(left, right, "k")
        found = pairs.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
        assert pairs.distinct().count() == sum(r["n"] for r in found) == 900_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(found) >= 4 and max(r["n"] for r in found) < 450_000


@pytest.mark.parametrize("size,parts", [(1, 1), (2, 1), (3, 4), (256, 8)])
def test_pairs_of_a_time_as_a_plain_join(spark, size, parts):
    """null keys have no pairs; null values, equal rows, several columns and a side without more than the key have."""
    left = spark.createDataFrame([(None, 1, "x"), (1, 1, "x"), (1, 1, "x"), (1, None, None), (2, 5, None), (3, 6, "y")] + [(4, i, "z") for i in range(9)], "k int, a int, t string")
    right = spark.createDataFrame([(None, 1.0), (1, 1.0), (1, None), (1, 1.0), (2, 2.0), (5, 3.0)] + [(4, i / 2) for i in range(7)], "k int, b double")
    in_order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    for a, b in [(left, right), (left, right.select("k")), (left.select("k"), right), (left, right.limit(0))]:
        found = model_io.join_on_time(a, b, "k", size, parts)
        assert found.columns == a.join(b, "k").columns and in_order(found) == in_order(a.join(b, "k"))
