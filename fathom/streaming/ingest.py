"""Incremental ingest: new files are read once, keys stay unique, reply counts follow the stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathom.schemas import EVENT
from fathom.sources.readers import last_of_message, range_observations
from fathom.sources.sinks import append_unique, exists


def stream_event_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, event) of event logs that arrive in a folder, each file once; a file is read in splits."""
    lines = spark.readStream.format("text").option("lineSep", "\n").load(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.regexp_replace("value", r"\r$", "").alias("text"))
    return lines.where(F.trim("text") != "").select("file", "part", F.from_json("text", EVENT).alias("event"))


def run_available(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Works on all that is there, batch by batch, and stops."""
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_observations(events: DataFrame) -> DataFrame:
    """The observations in the range messages that events carry, with their day; of repeats within a message the last one."""
    raw = F.col("event.observations.NOV_RANGE.raw")
    messages = events.where(raw.isNotNull()).select("file", raw.alias("message"), raw.alias("text"))
    obs = last_of_message(range_observations(messages, "text"), ["file", "message"])
    return obs.withColumn("day", F.to_date("time"))


def two_tables(shots_of: Callable[[DataFrame], DataFrame], observations_of: Callable[[DataFrame], DataFrame], shots_path: str, observations_path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer to the shot and observation tables; a batch that is run again adds nothing."""

    def batch(df: DataFrame, _: int) -> None:
        df.persist()  # both tables are made from lines that are read and parsed once
        append_unique(shots_of(df), shots_path, ["pingTime", "transponderID"], ["day"], ["returnTime"])
        append_unique(observations_of(df), observations_path, ["time", "sys", "sat", "obs"], ["day"], ["file", "message", "position"])
        df.unpersist()

    return batch


LEDGER = "query string, batch long"


def once(ledger: str, query: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A batch writer that leaves out the batches which the ledger has for the query, and enters those it has written.

    A batch is entered when all its tables are written. One that is lost before is written again, which must change
    nothing (as append_unique does); one that is replayed after is not even read.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        if exists(spark, ledger) and not spark.read.schema(LEDGER).parquet(ledger).where((F.col("query") == query) & (F.col("batch") == number)).isEmpty():
            return
        write(df, number)
        spark.createDataFrame([(query, number)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)

    return batch


def batch_report(query: StreamingQuery) -> list[dict[str, object]]:
    """Of each batch that had rows or dropped some: its number, its rows, its watermark, and the rows that came too late for the state.

    Spark keeps the last batches alone (spark.sql.streaming.numRecentProgressUpdates). Counted rows are what reaches the
    operator with the state: behind a partial aggregation, a row for each group and task.
    """
    out = []
    for p in query.recentProgress:
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        if p.numInputRows or late:
            out.append({"batch": p.batchId, "rows": p.numInputRows, "watermark": p.eventTime.get("watermark"), "late": late})
    return out


def unique_within(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Rows whose key has not been seen within the delay; the state is as large as that delay's rows."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def streaming_reply_counts(stream: DataFrame, key: str, ts: str, width: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Replies per key and tumbling window, emitted once the watermark has passed; later rows are dropped."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("bin"), key, "n")
