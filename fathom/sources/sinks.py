"""Writers. Tables are Parquet, partitioned by day (and what else is given); keys stay unique."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.timeutil import day_file_name
from fathom.operators.temporal import decimate, first_by, hour_slice, of_year
from fathom.sources.workspace import stable


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _aside(path: str) -> str:
    """A new folder beside a table's, of no other writer."""
    return f"{path.rstrip('/')}__{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table's folder, or one of its partitions'."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append_unique(df: DataFrame, path: str, keys: list[str], partition: list[str], order: list[str]) -> None:
    """Adds rows to a table without a key standing twice: a row that is there already stays, of new ones the first by order.

    Only the partitions that new rows touch are read and written again; running it twice changes nothing. A partition
    with many rows is written by several tasks, small ones together. One writer at a time: what is touched stands in a
    folder beside the table until its partitions are replaced, so a job that is lost there can be finished by hand.
    """
    spark = df.sparkSession
    new, aside = first_by(df, keys, order), None
    if exists(spark, path):
        new = stable(new, "new")  # read three times below
        old = spark.read.schema(df.schema).parquet(path)
        touched = new.select(*[F.col(c).alias(f"_t_{c}") for c in partition]).distinct()
        match = F.lit(True)
        for c in partition:
            match = match & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
        same = old.join(F.broadcast(touched) if len(touched.limit(10_001).collect()) <= 10_000 else touched, match, "left_semi")
        # The old rows are read from the files that are about to be replaced, so the union is written aside first.
        new = same.unionByName(new.join(same.select(*keys), keys, "left_anti"))
        aside = _aside(path)
        new.write.partitionBy(*partition).parquet(aside)
        new = spark.read.schema(df.schema).parquet(aside)
    new.hint("rebalance", *partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    if aside:
        remove(spark, aside)


def replace_partitions(spark: SparkSession, path: str, partition: str, touched: DataFrame, rows: DataFrame) -> None:
    """Puts `rows` in the place of all rows of the touched partitions of a table; those that get none are removed.

    The rows may be read from the table itself, so they are written beside it first.
    """
    aside = _aside(path)
    rows.write.partitionBy(partition).parquet(f"{aside}/rows")
    touched.select(partition).distinct().write.parquet(f"{aside}/touched")
    new = spark.read.schema(rows.schema).parquet(f"{aside}/rows")
    full = new.select(F.col(partition).alias("_full")).distinct()
    empty = spark.read.parquet(f"{aside}/touched").join(full, F.col(partition).eqNullSafe(F.col("_full")), "left_anti")
    new.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for r in empty.toLocalIterator():
        name = "__HIVE_DEFAULT_PARTITION__" if r[0] is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(r[0]))
        remove(spark, f"{path}/{partition}={name}")
    remove(spark, aside)


def compact(spark: SparkSession, path: str, partition: list[str]) -> None:
    """Writes each partition's rows again into few files, of about the size that Spark aims at for its partitions."""
    df = spark.read.parquet(path)
    aside = _aside(path)
    df.hint("rebalance", *partition).write.partitionBy(*partition).parquet(aside)
    spark.read.schema(df.schema).parquet(aside).hint("rebalance", *partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    remove(spark, aside)


def daily_observations(obs: DataFrame, marker: str, ts: str, year: int = 0, every_millis: int = 0, hours: int = 24) -> DataFrame:
    """Observations for the daily export: of a year, decimated, with their day, slice and file name.

    Decimation runs over the whole table before it is cut into slices, so no flag is lost at a slice's edge.
    """
    obs = of_year(obs, ts, year)
    millis = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / 1000).cast("long")
    obs = decimate(obs.withColumn("_ms", millis), [], "_ms", every_millis, ["sys", "sat", "obs"], "flags").drop("_ms") if every_millis > 0 else obs
    return obs.select("*", F.to_date(ts).alias("day"), hour_slice(F.col(ts), hours).alias("slice"), day_file_name(marker, F.col(ts)).alias("file_name"))


def write_daily(obs: DataFrame, path: str, ts: str) -> None:
    """One exchange by day, sorted by time within the files."""
    obs.repartition("day", "slice").sortWithinPartitions("day", "slice", ts).write.mode("overwrite").partitionBy("day").parquet(path)


def write_survey_csv(df: DataFrame, path: str, order: list[str], survey: str = "survey_id") -> None:
    """A folder of CSV for each survey, rows in order over its files too: a survey with many rows is cut into ranges of the order, so no task holds all of it."""
    df.repartitionByRange(survey, *order).sortWithinPartitions(survey, *order).write.mode("overwrite").option("header", True).partitionBy(survey).csv(path)


def write_range_text(messages: DataFrame, path: str, message: str, order: list[str]) -> None:
    """Messages as lines in time order; the files of the folder follow the order too."""
    messages.orderBy(*order).select(message).write.mode("overwrite").text(path)
