"""A catalogue of files and jobs kept in Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathom.functions.text import classify_file
from fathom.operators.temporal import ranked

IDENTITY = ["local_path", "network", "station", "campaign", "type"]


def discovered(files: DataFrame, network: str, station: str, campaign: str) -> DataFrame:
    """Catalogue rows of the files (path, length) whose kind is known."""
    kind = classify_file(F.col("path"), F.col("length"))
    return files.withColumn("type", kind).where("type is not null").select(F.lit(network).alias("network"), F.lit(station).alias("station"), F.lit(campaign).alias("campaign"), "type", F.col("path").alias("local_path"))


def missing_from(new: DataFrame, catalog: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """New rows, each once, that the catalogue does not have yet."""
    keys = keys or IDENTITY
    return new.dropDuplicates(keys).join(catalog.select(*keys).distinct(), keys, "left_anti")


def upsert(catalog: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The catalogue with new rows laid over it: one row per key, the newest by `order` wins."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc(), F.col("_new").desc())
    both = catalog.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_new")


def pending(parents: DataFrame, children: DataFrame, parent_id: str, child_parent_id: str) -> DataFrame:
    """Parents that no child names."""
    ids = children.where(F.col(child_parent_id).isNotNull()).select(F.col(child_parent_id).alias(parent_id)).distinct()
    return parents.join(ids, parent_id, "left_anti")


def common_days(a: DataFrame, a_ts: str, b: DataFrame, b_ts: str) -> DataFrame:
    return a.where(F.col(a_ts).isNotNull()).select(F.to_date(a_ts).alias("day")).intersect(b.where(F.col(b_ts).isNotNull()).select(F.to_date(b_ts).alias("day")))


def signatures(df: DataFrame, key: str, id_: str) -> DataFrame:
    """The sorted distinct ids of each key, joined by '-': what a merge job is known by."""
    return df.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_set(id_)), lambda x: x.cast("string")), "-").alias("signature"))


def not_done(jobs: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return jobs.join(ledger.select(*keys).distinct(), keys, "left_anti")


def type_counts(df: DataFrame, type_: str, path: str) -> DataFrame:
    return df.where(F.col(path).isNotNull()).groupBy(type_).agg(F.count("*").alias("n"))


def files_by_type(files: DataFrame, path: str, kind: str, page_size: int = 1000) -> DataFrame:
    """(kind, page, n, paths): the paths of each kind in order, page by page, so no list is longer than a page."""
    placed = ranked(files.select(kind, path), [kind], [path], "_place")
    pages = placed.groupBy(kind, F.floor((F.col("_place") - 1) / page_size).alias("page"))
    return pages.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(path)).alias("paths"))


def lookup(files: DataFrame, types: list[str], type_: str = "type", **equal: str) -> DataFrame:
    """Files of any of the types whose other columns have the given values."""
    df = files.where(F.col(type_).isin(*types))
    for column, value in equal.items():
        df = df.where(F.col(column) == value)
    return df


def name_contains(files: DataFrame, column: str, part: str) -> DataFrame:
    """Files whose name contains a text as it is, without patterns."""
    return files.where(F.col(column).contains(part))


def without(catalog: DataFrame, gone: Column) -> DataFrame:
    """The catalogue without the rows that a condition names; rows for which it is unknown stay."""
    return catalog.where(~F.coalesce(gone, F.lit(False)))


def moved(catalog: DataFrame, which: Column, path: str, to: Column) -> DataFrame:
    """The catalogue with the path of some rows replaced."""
    return catalog.withColumn(path, F.when(which, to).otherwise(F.col(path)))


def latest_file(files: DataFrame, keys: list[str], path: str, pattern: str = r"(\d+)") -> DataFrame:
    """Of each key's files the one with the largest number in its path: keys, path, iteration; paths without a number don't count."""
    numbered = files.select(*keys, path, F.regexp_extract(path, pattern, 1).try_cast("long").alias("iteration")).where("iteration is not null")
    best = F.max(F.struct("iteration", path)).alias("best")
    return numbered.groupBy(*keys).agg(best).select(*keys, f"best.{path}", "best.iteration")


def preferred(files: DataFrame, keys: list[str], rank: Column, order: str) -> DataFrame:
    """Of each key's files the one of the least rank, of equal ones the first by order: keys, order."""
    return files.groupBy(*keys).agg(F.min(F.struct(rank.alias("k"), F.col(order))).alias("best")).select(*keys, f"best.{order}")


def by_first_epoch(observations: DataFrame, file: str, ts: str) -> DataFrame:
    """Files in the order of their first epoch: file, first, position from 1; the window runs over the files, not the rows."""
    files = observations.where(F.col(ts).isNotNull()).groupBy(file).agg(F.min(ts).alias("first"))
    return files.withColumn("position", F.row_number().over(Window.orderBy("first", file)).cast("long"))


def query(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """A query in SQL over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
