"""Queries on tables that have what the given small ones lack: many users, large keys."""

import duckdb
import pytest
from pyspark.sql import functions as F

from fathom.plans import jobs
from fathom.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def same_rows(spark, folder, name, table):
    """The number of rows of a query and of its SQL over one changed table, which must be the same rows."""
    db = duckdb.connect()
    db.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    cursor = db.execute(SQL[name])
    columns = [x[0] for x in cursor.description]
    want = sorted(cursor.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, folder).collect()) == want
    return len(want)


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("users"))
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.where("event_type in ('view', 'click')").withColumn("user_id", F.col("event_id") % 700).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["R2_pin_files", "R3_pin_messages"])
def test_pin_files_of_many_users(spark, many_users, name):
    assert same_rows(spark, many_users, name, "events") > 50


@pytest.mark.parametrize("name", ["R9_profile_text", "R10_ctd_csv", "R11_ctd_text"])
def test_parts_of_large_keys(spark, tmp_path, name):
    p = spark.read.parquet(f"{SF}/part.parquet")
    p.unionByName(p.withColumn("p_partkey", F.col("p_partkey") + 1_000_000)).write.parquet(f"{tmp_path}/part.parquet")
    assert same_rows(spark, str(tmp_path), name, "part") == 2 * p.count()


def test_quality_control_smooths_the_shots_themselves(spark):
    """K3: shots on a line with an error of 1 m by turns; without any kinematic position they come nearer to the line."""
    x = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    s = spark.range(60).select(F.lit("a").alias("station"), F.to_date(F.lit("2024-05-01")).alias("day"), F.col("id").alias("shot"), (F.col("id") * 10.0).alias("pingTime"), (F.col("id") * 10.0 + 2).alias("returnTime"), F.lit(False).alias("isUpdated"),
        *[(x + a * 10 + F.col("id") * 10.0 + 2 * k).alias(f"{c}{k}") for a, c in enumerate(("east", "north", "up")) for k in (0, 1)], *[F.when(F.col("id") > 5, 1.0).alias(f"{c}_std{k}") for c in ("east", "north", "up") for k in (0, 1)])
    kin = spark.createDataFrame([], "station string, day date, event_id long, time double, east double, north double, up double")
    done, track = jobs.quality_days(s, kin, "shot", ["time", "event_id"])
    found = done.collect()
    assert done.columns == s.columns and len(found) == 60 and track.count() == 120
    assert all(r["isUpdated"] for r in found)
    off = [abs(r[f"{c}{k}"] - (a * 10 + r["shot"] * 10.0 + 2 * k)) for r in found if 5 < r["shot"] < 55 for a, c in enumerate(("east", "north", "up")) for k in (0, 1)]
    assert max(off) < 0.9


def test_k3_returns_updated_shots(spark):
    shots = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'view'")
    done = QUERIES["K3_quality_refinement"](spark, SF)
    assert done.count() == shots.count() and 0 < done.where("isUpdated").count()
