"""Stored tables, streams with late rows and replayed batches, and windows in parts, against plain Python."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.operators import catalog, filters, temporal
from fathom.plans import jobs
from fathom.sources import readers, sinks
from fathom.sources.catalog_table import CatalogTable
from fathom.sources.workspace import named_files
from fathom.streaming import ingest


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_catalogue_keeps_what_a_plain_dictionary_would(spark, tmp_path):
    """Random inserts, upserts, deletions and moves over one stored table; nulls and odd characters in the partition's column."""
    rng = random.Random(3)
    stored = CatalogTable(spark, f"file://{tmp_path}/catalogue", "local_path string, type string, v long, at long")
    assert stored.read().count() == 0
    known = {}
    for at in range(1, 7):
        new = {f"p{rng.randrange(12)}": (rng.choice(["kin", "a/b=c", None, "x y"]), rng.randrange(100), at) for _ in range(5)}
        df = spark.createDataFrame([(p, *v) for p, v in new.items()], "local_path string, type string, v long, at long")
        if at % 2:
            stored.insert(df)
            known = {**new, **known}
        else:
            stored.upsert(df, "at")
            known = {**known, **new}
        if at == 4:
            stored.delete(F.col("v") < 40)
            known = {p: v for p, v in known.items() if v[1] >= 40}
            stored.move(F.col("type") == "kin", "local_path", F.concat(F.lit("moved/"), F.col("local_path")))
            known = {f"moved/{p}" if v[0] == "kin" else p: v for p, v in known.items()}
        assert rows(stored.read(), "local_path", "type", "v", "at") == sorted(((p, *v) for p, v in known.items()), key=str)
    files = {p for p in (tmp_path / "catalogue").rglob("*.parquet")}
    stored.upsert(spark.createDataFrame([("only", "kin", 1, 99)], "local_path string, type string, v long, at long"), "at")
    left = {p for p in (tmp_path / "catalogue").rglob("*.parquet")}
    assert {p for p in files if "type=kin" not in str(p)} <= left  # other partitions are not written again
    stored.delete(F.col("type") == "kin")
    assert not [p for p in (tmp_path / "catalogue").glob("type=kin")]


def test_appends_keep_rows_of_a_null_partition(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for part in ([(1, None, 1), (2, "d", 1)], [(3, None, 1), (1, None, 2)]):
        sinks.append_unique(spark.createDataFrame(part, "k long, day string, v long"), path, ["k"], ["day"], ["v"])
    assert rows(spark.read.parquet(path), "k", "day", "v") == [(1, None, 1), (2, "d", 1), (3, None, 1)]


def test_ingest_job_enters_each_file_once(spark, tmp_path):
    stored = CatalogTable(spark, f"file://{tmp_path}/catalogue", "network string, station string, campaign string, type string, local_path string")
    names = spark.createDataFrame([("a.23o", "x"), ("kin_1", "x"), ("kin_2", ""), ("notes.md", "x"), ("._kin", "x")], "name string, text string")
    named_files(names, f"file://{tmp_path}/raw")
    for _ in range(2):
        found = jobs.ingest_catalog(spark, f"file://{tmp_path}/raw", stored, "N", "S", "C")
    assert rows(found.select("type", F.regexp_extract("local_path", "[^/]+$", 0).alias("name")), "type", "name") == [("kin", "kin_1"), ("rinex2", "a.23o")]


def test_rows_late_by_59_and_61_minutes(spark, tmp_path):
    """One row in time sets the watermark an hour back; of two that come later only the one behind it is dropped, and counted."""
    top = dt.datetime(2024, 1, 1, 14)
    batches = [[(1, top - dt.timedelta(minutes=5)), (1, top)], [(2, top + dt.timedelta(seconds=1))], [(1, top - dt.timedelta(minutes=59)), (2, top - dt.timedelta(minutes=61)), (3, top - dt.timedelta(minutes=62))], [(1, top + dt.timedelta(hours=3))]]
    for b in batches:
        spark.createDataFrame(b, "k long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    counts = ingest.streaming_reply_counts(stream, "k", "ts")
    query = counts.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    report = ingest.batch_report(query)
    assert [r["rows"] for r in report if r["rows"]] == [2, 1, 3, 1]
    assert sum(r["late"] for r in report) == 2  # 61 and 62 minutes: their windows ended by 13:00
    got = {(r["bin"].strftime("%H:%M"), r["k"]): r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("13:50", 1): 1, ("14:00", 1): 1, ("14:00", 2): 1, ("13:00", 1): 1}


def test_replayed_batches_add_nothing(spark, tmp_path):
    """A batch that is lost between its two tables is written again as a whole; one in the ledger is not touched any more."""
    ledger, a, b = (f"file://{tmp_path}/{x}" for x in ("ledger", "a", "b"))
    tries = []

    def write(df, number):
        tries.append(number)
        sinks.append_unique(df, a, ["id"], ["day"], ["v"])
        if len(tries) == 1:
            raise RuntimeError("lost")
        sinks.append_unique(df, b, ["id"], ["day"], ["v"])

    once = ingest.once(ledger, "q", write)
    df = spark.createDataFrame([(1, "d", 1), (2, "d", 2)], "id long, day string, v long")
    with pytest.raises(RuntimeError):
        once(df, 0)
    for number in (0, 0, 1, 0):
        once(df, number)
    assert tries == [0, 0, 1] and rows(spark.read.parquet(ledger), "query", "batch") == [("q", 0), ("q", 1)]
    assert rows(spark.read.parquet(a), "id", "v") == rows(spark.read.parquet(b), "id", "v") == [(1, 1), (2, 2)]
    ingest.once(ledger, "other", write)(df, 0)
    assert tries == [0, 0, 1, 0]


def test_windows_in_parts_are_those_of_whole_keys(spark):
    rng = np.random.default_rng(5)
    data = [(None if k == 2 else f"s{k}", float(t), i, None if x < 0.4 else float(x), int(t // 10)) for i, (k, t, x) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 300, 400), rng.random(400), strict=True))]
    df = spark.createDataFrame([(*r, r[4] if r[4] != 7 else 7) for r in data], "k string, t double, i long, x double, part long, p2 long").drop("p2")
    order = ["t", "i"]
    for f in (lambda p: temporal.differences(df, ["k"], order, ["x", "t"], p), lambda p: temporal.velocities(df, ["k"], order, "t", ["x"], p), lambda p: temporal.fill_both_ways(df, ["k"], order, ["x"], p)):
        assert rows(f("part"), *f(None).columns) == rows(f(None), *f(None).columns)
    for f in (lambda p: temporal.gap_summary(df, ["k"], "t", 1.0, p), lambda p: temporal.gap_histogram(df, ["k"], "t", part=p)):
        assert rows(f("part"), *f(None).columns) == rows(f(None), *f(None).columns)
    w = Window.partitionBy("k")
    want = df.withColumn("z_x", (F.col("x") - F.avg("x").over(w)) / F.stddev_pop("x").over(w))
    got = {r["i"]: r["z_x"] for r in temporal.standard_scores(df, ["k"], ["x"]).collect()}
    for r in want.collect():
        assert got[r["i"]] == pytest.approx(r["z_x"], abs=1e-12) if r["z_x"] is not None else got[r["i"]] is None


def test_counts_come_from_the_pass_itself(spark):
    counts = filters.StageCounts()
    df = counts(spark.range(1000), "raw")
    df = counts(df.where("id % 2 = 0"), "even")
    df = counts(df.groupBy((F.col("id") % 10).alias("k")).count(), "groups")
    assert rows(filters.stage_counts(df, counts), "step", "stage", "n") == [(0, "raw", 1000), (1, "even", 500), (2, "groups", 5)]


def test_pages_list_every_path_once(spark):
    paths = [(("kin", "ctd", None)[i % 3], f"/d/{i:04d}") for i in range(250)]
    got = catalog.files_by_type(spark.createDataFrame(paths, "kind string, path string"), "path", "kind", 20).collect()
    assert all(r["n"] == len(r["paths"]) <= 20 for r in got)
    for kind in ("kin", "ctd", None):
        pages = sorted((r["page"], r["paths"]) for r in got if r["kind"] == kind)
        assert [p for _, page in pages for p in page] == sorted(p for k, p in paths if k == kind)


def test_dispatch_parses_once(spark, tmp_path):
    texts = [("#INSPVAA,COM1,0,55.5,FINESTEERING,2200,1.0,0,a,1;1,2*00",), ("#RANGEA,COM1,0,55.5,FINESTEERING,2200,1.0,0,a,1;0*00",), ("#RANGEA,short;1*00",), ("#OTHERA,COM1,0,55.5,FINESTEERING,2200,1.0,0,a,1;0*00",)]
    m = readers.framed_messages(spark.createDataFrame(texts, "text string"), "text")
    found = readers.dispatch(m, f"file://{tmp_path}/logs")
    assert {n: df.count() for n, df in found.items()} == {"RANGEA": 1, "INSPVAA": 1, "INSSTDEVA": 0, "other": 2}
    assert found["RANGEA"].columns == m.columns
    plan = found["RANGEA"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log" in plan
