"""Where jobs put intermediate files: the shared folder of the cluster, or a temporary one in tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir, which all executors share; under a temporary folder where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        app = spark.sparkContext.applicationId
        base = _own.setdefault(app, "") or _own.update({app: "file://" + tempfile.mkdtemp(prefix="fathom-")}) or _own[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_files(df: DataFrame, file: str, text: str, order: list[str], name: str, cut: list[str] | None = None) -> str:
    """Writes a text file per value of `file`, lines in order; returns the folder's pattern.

    With `cut` the lines of a value may stand in several files of its folder, as many as their size asks for: lines that are
    equal in these first columns of the order stay in one file. An empty list lets Spark cut anywhere.
    """
    path = fresh_path(df.sparkSession, name)
    dealt = df.repartition(file) if cut is None else df.repartitionByRange(file, *cut) if cut else df.hint("rebalance", file)
    dealt.sortWithinPartitions(file, *order).select(file, text).write.partitionBy(file).text(path)
    return f"{path}/*"


def stable(df: DataFrame, name: str) -> DataFrame:
    """The rows written once and read from there: for what must not come out otherwise when it is worked out again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named_files(df: DataFrame, folder: str) -> None:
    """Writes a file of each row (name, text) into a folder, from the tasks. The folder must be of a kind that Arrow can open."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_output_stream(f"{root}/{name}") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["name"])

    # Files cost time, not bytes, by which Spark would join partitions to few tasks.
    df.repartition(df.sparkSession.sparkContext.defaultParallelism, df.columns[0]).mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()
