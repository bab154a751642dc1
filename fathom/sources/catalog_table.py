"""The catalogue of files as a stored table. A change writes only the partitions that it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import catalog
from fathom.sources.sinks import exists, remove, replace_partitions


class CatalogTable:
    """Rows at `path`, partitioned by type and unique by `key`, with the columns of `schema` (type among them).

    One writer at a time. What a change leaves of the partitions that it touches is written beside the table first and
    replaces them then; partitions that lose their last row are removed.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "local_path", partition: str = "type"):
        self.spark, self.path, self.schema, self.key, self.partition = spark, path, schema, key, partition

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _rows(self, df: DataFrame) -> DataFrame:
        """The table's columns of any frame, in order and type; what it lacks is null."""
        fields = self.spark.createDataFrame([], self.schema).schema.fields
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    def _touched(self, old: DataFrame, touched: DataFrame) -> DataFrame:
        """The rows of the touched partitions, that of a null type among them."""
        t = touched.select(F.col(self.partition).alias("_touched"))
        return old.join(t, F.col(self.partition).eqNullSafe(F.col("_touched")), "left_semi")

    def _replace(self, touched: DataFrame, new: DataFrame) -> None:
        replace_partitions(self.spark, self.path, self.partition, touched, new)

    def insert(self, new: DataFrame) -> None:
        """Adds the rows whose key the table does not have, each key once; others change nothing."""
        old = self.read()
        more = catalog.missing_from(self._rows(new), old, [self.key])
        more.write.mode("append").partitionBy(self.partition).parquet(self.path)

    def upsert(self, new: DataFrame, order: str) -> None:
        """Lays new rows over those of the same key: the newest by `order` stays, wherever its key stood before."""
        old, new = self.read(), self._rows(new)
        known = old.join(new.select(self.key).distinct(), self.key, "left_semi")
        touched = new.select(self.partition).union(known.select(self.partition)).distinct()
        same = self._touched(old, touched)
        self._replace(touched, catalog.upsert(self._rows(same), new, self.key, order))

    def delete(self, gone: Column) -> None:
        """Removes the rows for which the condition is true."""
        old = self.read()
        touched = old.where(gone).select(self.partition).distinct()
        self._replace(touched, catalog.without(self._touched(old, touched), gone))

    def move(self, which: Column, column: str, to: Column) -> None:
        """Gives a column of some rows another value, such as a new path."""
        old = self.read()
        touched = old.where(which).select(self.partition).distinct()
        self._replace(touched, catalog.moved(self._touched(old, touched), which, column, to))

    def drop(self) -> None:
        remove(self.spark, self.path)
