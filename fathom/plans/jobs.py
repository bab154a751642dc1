"""Jobs from raw files to tables and reports, composed of the operators."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.geo import geodetic_to_ecef
from fathom.functions.timeutil import seconds_to_timestamp
from fathom.operators import catalog, filters, model_io, pairing, refine, report, surveys, validate
from fathom.sources import readers, sinks
from fathom.sources.catalog_table import CatalogTable
from fathom.sources.workspace import stable


def ingest_catalog(spark: SparkSession, path: str, stored: CatalogTable, network: str, station: str, campaign: str) -> DataFrame:
    """Enters a folder's files of known kinds in the stored catalogue; files that it has already stay as they are. Returns the catalogue."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")  # contents are not read
    stored.insert(catalog.discovered(files, network, station, campaign))
    return stored.read()


def shots_from_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Paired replies of event logs in the shot columns, with file, event_id and reject_reason; logs of any size, read in splits."""
    events = stable(readers.read_event_logs(spark, path).where("status = 'ok'"), "events").withColumn("kind", F.col("event.event"))
    ping = F.struct(*pairing.ping_fields())
    paired = pairing.pair_with_last(events, "file", "part", ["line"], "kind", "interrogation", "range", ping, F.col("event.time.common").isNotNull())
    shots = paired.select("file", "line", F.col("event.event_id").cast("long").alias("event_id"), "ping.value.*", *pairing.reply_fields(), F.col("event.range.range").alias("_range"))
    return pairing.reply_consistency(shots, F.col("_range")).drop("_range")


def shots_from_pins(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Paired replies of pin files, one ping per file."""
    events = readers.read_pin_replies(spark, path)
    shots = events.select("file", F.col("event.event_id").cast("long").alias("event_id"), *pairing.ping_fields("ping"), *pairing.reply_fields(), F.col("event.range.range").alias("_range"))
    return pairing.reply_consistency(shots, F.col("_range")).drop("_range")


def preprocess(spark: SparkSession, logs: str | list[str], shots_path: str, station: str) -> tuple[DataFrame, DataFrame]:
    """Event logs to the validated shot table (written, keys unique); returns (table, rejected rows with reasons)."""
    paired = shots_from_logs(spark, logs)
    good, rejected = validate.validate(validate.coerce(paired.where("reject_reason is null"), "shot"), "shot")
    good = good.withColumns({"station": F.lit(station), "day": F.to_date(seconds_to_timestamp(F.col("pingTime")))})
    sinks.append_unique(good, shots_path, ["station", "pingTime", "transponderID"], ["station", "day"], ["returnTime"])
    return spark.read.parquet(shots_path), rejected


def write_range_strings(messages: DataFrame, path: str, keys: list[str]) -> None:
    """Range messages (message, station, and keys that tell them apart) to the observation table, partitioned by station and day.

    Of an observation that a message repeats the last one counts, of one that several messages of a station have the first by keys.
    """
    obs = readers.last_of_message(readers.range_observations(messages, "message"), ["station", *keys])
    sinks.append_unique(obs.withColumn("day", F.to_date("time")), path, ["station", "time", "sys", "sat", "obs"], ["station", "day"], keys)


def survey_input(shots: DataFrame, survey_rows: DataFrame, survey_type: str, centre: tuple[float, float], residuals: DataFrame | None, transponders: DataFrame, config: dict[str, Any] | None = None) -> DataFrame:
    """Shots of the surveys, filtered and turned to the model's columns, with their survey_id."""
    timed = shots.withColumn("ts", seconds_to_timestamp(F.col("pingTime")))
    keys = [k for k in ("network", "station") if k in shots.columns and k in survey_rows.columns]
    assigned = surveys.assign_surveys(timed, survey_rows, "ts", ["survey_id"], keys)
    good = filters.filter_shots(assigned, survey_type, centre, residuals, config)
    out = model_io.rectify(good.withColumn("transponderID", F.concat_ws("\x1f", "survey_id", "transponderID")), geodetic_to_ecef(*centre, 0.0), *centre)
    key = F.split("MT", "\x1f")
    return model_io.finalise(out.withColumns({"survey_id": F.get(key, 0), "MT": F.get(key, 1)}), transponders)


def quality_days(shots: DataFrame, kin: DataFrame, shot_id: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Quality control: refinement of shots from their own and kinematic positions, without inertial data; (updated shots, track)."""
    return refine.refine_day(shots, None, kin, shot_id, order)


def residual_report(output: DataFrame, cast: DataFrame, below: float = 50.0, keys: list[str] | None = None) -> dict[str, DataFrame]:
    """Statistics of a model's output: quartiles (of all, or by keys), rows inside the limit, histogram, shares and directions per transponder."""
    ranged = model_io.residual_range(output, cast)
    return {
        "quartiles": report.residual_quartiles(ranged, "ResiRange", below, keys),
        "inside": ranged.where(F.abs("ResiRange") < below).groupBy("MT").agg(F.count("*").alias("n")),
        "histogram": report.residual_histogram(ranged, "ResiRange", below),
        "shares": report.unflagged_share(ranged, "MT", F.col("flag")),
        "directions": model_io.mean_directions(ranged),
    }
