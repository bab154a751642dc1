"""Readers of raw files. Malformed records become rows with a status, never errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fathom.functions.text import GLONASS, GPS, SYSTEMS, hex_to_long, tracking_word
from fathom.functions.timeutil import gps_to_utc, rinex_time
from fathom.schemas import EVENT, SCHEMAS
from fathom.sources.workspace import stable

# ---------------------------------------------------------------- events

#: A pin file's object: an event by entry name.
PIN_ENTRIES = f"map<string, {EVENT}>"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, part, line, text) of text files, which are read in splits: within a file, (part, line) is the order of the lines.

    part is the byte at which a split begins; line counts the lines of a task, so it orders those of one part, but may be
    another number when the files are read again. numbered_lines() gives numbers that stay.
    """
    text = F.regexp_replace("value", r"\r$", "")
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("line"), text.alias("text"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(file, line, text) of read_lines(), lines numbered from 0 in each file: those of each part are counted, and added up part by part.

    The lines must be all lines of the files, as they are numbered without gaps.
    """
    kept = stable(lines, "lines")
    counts = kept.groupBy("file", "part").agg(F.min("line").alias("_first"), F.count("*").alias("_n"))
    ahead = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "part", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"))
    return kept.join(starts, ["file", "part"]).select("file", (F.col("line") + F.col("_shift")).alias("line"), "text")


def parsed_events(lines: DataFrame) -> DataFrame:
    """Lines with one JSON event each as (file, part, line, event, status): status ok, failed or ignored (other events)."""
    parsed = lines.where(F.trim("text") != "").withColumn("event", F.from_json("text", EVENT, {"mode": "PERMISSIVE"}))
    kind = F.col("event.event")
    status = F.when(kind.isNull(), "failed").when(~kind.isin("interrogation", "range"), "ignored").otherwise("ok")
    return parsed.select("file", "part", "line", "event", status.alias("status"))


def read_event_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The events of logs, with (file, part, line) as read_lines() has them."""
    return parsed_events(read_lines(spark, path))


def _pin_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, entries) of pin files, entries by name; bytes that are no UTF-8 are read as Latin-1."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    utf8 = F.expr("if(is_valid_utf8(cast(content as string)), cast(content as string), decode(content, 'ISO-8859-1'))")
    return raw.select("file", F.from_json(utf8, PIN_ENTRIES).alias("entries"))


def read_pin_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, name, event) of files with one JSON object each: `interrogation` and an event per transponder uid.

    Entries that are no range event (or the interrogation) are left out.
    """
    events = _pin_entries(spark, path).select("file", F.explode("entries").alias("name", "event"))
    return events.where((F.col("name") == "interrogation") | (F.col("event.event") == "range"))


def read_pin_replies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, ping, event): the range events of pin files with the interrogation of their file, which has one; a file is read once."""
    files = _pin_entries(spark, path).where(F.map_contains_key("entries", F.lit("interrogation")))
    events = files.select("file", F.col("entries")["interrogation"].alias("ping"), F.explode("entries").alias("name", "event"))
    return events.where("name != 'interrogation' and event.event = 'range'").select("file", "ping", "event")


def pin_messages(events: DataFrame) -> DataFrame:
    """The distinct range messages that events carry."""
    raw = F.col("event.observations.NOV_RANGE.raw")
    return events.where(raw.contains("#RANGEA")).select(raw.alias("message")).distinct()


# ---------------------------------------------------------------- receiver messages


def framed_messages(df: DataFrame, text: str) -> DataFrame:
    """Splits texts into messages: from # or % to *, with a header of ten fields or more before a semicolon.

    Adds message, name, header (array), body and status (ok or bad); what stands between messages is dropped.
    """
    found = df.withColumn("message", F.explode(F.regexp_extract_all(text, F.lit(r"[#%][^#%*]*\*[0-9a-fA-F]*"), F.lit(0))))
    inner = F.regexp_replace(F.regexp_replace("message", r"^[#%]", ""), r"\*[0-9a-fA-F]*$", "")
    found = found.withColumn("_head", F.split(F.split_part(inner, F.lit(";"), F.lit(1)), ","))
    body = F.when(inner.contains(";"), F.split_part(inner, F.lit(";"), F.lit(2)))
    h = lambda i: F.get("_head", F.lit(i))
    ok = body.isNotNull() & (F.size("_head") >= 10) & h(2).try_cast("int").isNotNull() & h(3).try_cast("double").isNotNull() & h(5).try_cast("int").isNotNull() & h(6).try_cast("double").isNotNull()
    return found.select(*df.columns, "message", h(0).alias("name"), F.col("_head").alias("header"), body.alias("body"), F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("bad").alias("status"))


#: Logs that are told apart, and the place of messages that are none of them or are malformed.
LOGS, OTHER = ("RANGEA", "INSPVAA", "INSSTDEVA"), "other"


def dispatch(messages: DataFrame, path: str) -> dict[str, DataFrame]:
    """Framed messages written once, a folder for each log name, and a table of each from there: RANGEA, INSPVAA, INSSTDEVA and other.

    The texts are parsed once, and who reads one log reads its folder alone.
    """
    known = F.when((F.col("status") == "ok") & F.col("name").isin(*LOGS), F.col("name")).otherwise(F.lit(OTHER))
    messages.withColumn("log", known).write.partitionBy("log").parquet(path)
    found = messages.sparkSession.read.schema(messages.withColumn("log", known).schema).parquet(path)
    return {n: found.where(F.col("log") == n).drop("log") for n in (*LOGS, OTHER)}


def _doubles(body: str, first: int, names: list[str]) -> list[Column]:
    parts = F.split(body, ",")
    return [F.trim(F.get(parts, F.lit(first + i))).try_cast("double").alias(n) for i, n in enumerate(names)]


INS_POSITION = ["latitude", "longitude", "height", "northVelocity", "eastVelocity", "upVelocity", "roll", "pitch", "azimuth"]
INS_DEVIATION = [f"{n}_std" for n in INS_POSITION]


def ins_positions(messages: DataFrame, body: str = "body") -> DataFrame:
    """Inertial positions: week, seconds of the week, then nine values; rows with a missing number are dropped."""
    parts = F.split(body, ",")
    week, sow = F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("double")
    out = messages.where(F.size(parts) >= 12).select(*[c for c in messages.columns if c != body], gps_to_utc(week, sow).alias("time"), *_doubles(body, 2, INS_POSITION))
    return out.dropna(subset=["time", *INS_POSITION])


def ins_deviations(messages: DataFrame, time: Column, body: str = "body") -> DataFrame:
    """Inertial deviations: nine values; the time is the message header's."""
    out = messages.where(F.size(F.split(body, ",")) >= 9).select(*[c for c in messages.columns if c != body], time.alias("time"), *_doubles(body, 0, INS_DEVIATION))
    return out.dropna(subset=["time", *INS_DEVIATION])


def range_header(header: Column) -> tuple[Column, Column, Column]:
    """GPS week, seconds and receiver status: the first field of digits in 2000..3000 that a number follows."""
    is_week = lambda x, i: x.rlike(r"^\d+$") & x.try_cast("long").between(2000, 3000) & F.get(header, i + 1).try_cast("double").isNotNull()
    marked = F.transform(header, lambda x, i: F.struct(i.alias("i"), F.coalesce(is_week(x, i), F.lit(False)).alias("ok")))
    at = F.get(F.filter(marked, lambda y: y["ok"]), F.lit(0))["i"]
    return F.get(header, at).try_cast("int"), F.get(header, at + 1).try_cast("double"), F.get(header, at + 2)


def range_observations(messages: DataFrame, message: str, system_mask: int = 7) -> DataFrame:
    """One row per observation of range messages; other columns stay.

    The checksum goes; the number of observations comes first in the body, then groups of ten fields; a truncated last
    group and malformed ones are left out. Within a message the last of a repeated (system, satellite, signal) wins.
    An unknown system counts as GPS; the frequency number is GLONASS's alone. All is done on arrays, before exploding.
    """
    text = F.split_part(F.col(message), F.lit("*"), F.lit(1))
    rows = messages.where(F.col(message).contains("#RANGEA") & (F.size(F.split(text, ";")) == 2))
    week, seconds, receiver = range_header(F.split(F.split_part(text, F.lit(";"), F.lit(1)), ","))
    rows = rows.select("*", week.alias("week"), seconds.alias("seconds"), receiver.alias("receiver_status"), F.split(F.split_part(text, F.lit(";"), F.lit(2)), ",").alias("_f"))
    rows = rows.where("week is not null").withColumn("n_observations", F.get("_f", F.lit(0)).try_cast("int")).where("n_observations is not null")
    n = F.least(F.col("n_observations"), F.floor((F.size("_f") - 1) / 10).cast("int"))
    groups = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice("_f", i * 10 + 2, F.lit(10))))
    kept = [c for c in messages.columns if c != message]
    base = rows.select(*kept, "week", "seconds", "receiver_status", "n_observations", F.posexplode(groups).alias("position", "_g"))
    g = lambda i: F.get("_g", F.lit(i))
    numbers = {"sat": ("int", 0), "glo_freq": ("int", 1), "range": ("double", 2), "range_std": ("double", 3), "phase": ("double", 4), "phase_std": ("double", 5), "doppler": ("double", 6), "snr": ("double", 7), "locktime": ("double", 8)}
    base = base.select(*kept, "week", "seconds", "receiver_status", "n_observations", "position", *[F.trim(g(i)).try_cast(t).alias(k) for k, (t, i) in numbers.items()], hex_to_long(F.trim(g(9))).alias("flags"))
    base = base.dropna(subset=[*numbers, "flags"])
    word = tracking_word(F.col("flags"), system_mask)
    system = F.when(word["system"].isin(*SYSTEMS), word["system"]).otherwise(F.lit(GPS)).cast("int")
    out = base.select(
        *kept, gps_to_utc(F.col("week"), F.col("seconds")).alias("time"), "week", "seconds", "receiver_status", "n_observations", "position", system.alias("sys"), "sat", word["signal"].cast("int").alias("obs"),
        "range", "range_std", "phase", "phase_std", "doppler", "snr", "locktime", "flags", F.when(system == GLONASS, F.col("glo_freq")).otherwise(0).alias("fcn"),
        word["half_cycle"].alias("half_cycle"), (word["phase_lock"] >= 3).alias("phase_lock"), word["code_lock"].alias("code_lock"), word["parity_known"].alias("parity_known"),
    )
    return out


def last_of_message(obs: DataFrame, message_keys: list[str]) -> DataFrame:
    """Of repeated (system, satellite, signal) in one message the last one."""
    keys = [*message_keys, "sys", "sat", "obs"]
    others = [c for c in obs.columns if c not in keys]
    return obs.groupBy(*keys).agg(F.max_by(F.struct(*others), "position").alias("_r")).select(*keys, "_r.*")


# ---------------------------------------------------------------- casts, results, tables


def read_profile_text(spark: SparkSession, path: str | list[str], depth: int = 0, speed: int = 5) -> DataFrame:
    """Sound-speed rows (file, depth, speed) of texts whose data follow a line that starts with *END*."""
    lines = stable(read_lines(spark, path), "profile").withColumn("at", F.struct("part", "line"))
    ends = lines.where(F.col("text").startswith("*END*")).groupBy("file").agg(F.min("at").alias("_end"))
    parts = F.split(F.trim("text"), r"\s+")
    out = lines.join(ends, "file").where("at > _end").select("file", "part", "line", F.get(parts, F.lit(depth)).try_cast("double").alias("depth"), F.get(parts, F.lit(speed)).try_cast("double").alias("speed"))
    return out.dropna()


def read_ctd_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Two columns, depth (negative downward) and speed."""
    df = spark.read.schema("depth double, speed double").csv(path)
    return df.dropna().select((-F.col("depth")).alias("depth"), "speed")


def read_ctd_text(spark: SparkSession, path: str | list[str], jitter_seed: int | None = None) -> DataFrame:
    """As read_ctd_csv, separated by white space; with a seed speeds get a jitter of 1e-6 that makes them distinct."""
    parts = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(path).select((-F.get(parts, F.lit(0)).try_cast("double")).alias("depth"), F.get(parts, F.lit(1)).try_cast("double").alias("speed")).dropna()
    return df if jitter_seed is None else df.withColumn("speed", F.col("speed") + F.randn(jitter_seed) * 1e-6)


def first_usable_cast(casts: list[tuple[str, DataFrame]]) -> DataFrame:
    """The first of the named casts that has rows, without looking on the driver: (source, depth, speed)."""
    out = None
    for k, (name, df) in enumerate(casts):
        one = df.select(F.lit(k).alias("_rank"), F.lit(name).alias("source"), "depth", "speed")
        out = one if out is None else out.unionByName(one)
    best = out.agg(F.min("_rank").alias("_best"))
    return out.join(F.broadcast(best), out["_rank"] == best["_best"]).select("source", "depth", "speed")


#: Places of the values in an iteration line, split at white space.
_ITERATION = {"inv_type": (1, "int"), "iteration": (4, "int"), "rms_tt": (7, "double"), "used_percent": (11, "double"), "reject": (14, "int"), "max_dx": (17, "double"), "hgt": (20, "double")}


def read_iterations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The iteration lines of model logs: file, line, inv_type, iteration, rms_tt, used_percent, reject, max_dx, hgt."""
    parts = F.split(F.trim("text"), r"\s+")
    lines = numbered_lines(read_lines(spark, path)).where(F.col("text").startswith("#Inversion-type"))
    out = lines.select("file", "line", *[F.regexp_replace(F.get(parts, F.lit(i)), "[%,]", "").try_cast(t).alias(n) for n, (i, t) in _ITERATION.items()])
    return out.dropna(subset=["inv_type", "iteration"])


def read_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The summary lines of model logs, one row per file: abic, misfit, lambda_0_squared, grad_lambda_squared, mu_t, mu_mt."""
    parts = F.split(F.trim("text"), r"\s+")
    value = lambda start, i: F.max(F.when(F.col("text").startswith(start), F.get(parts, F.lit(i)).try_cast("double")))
    return read_lines(spark, path).groupBy("file").agg(
        value("#  ABIC", 3).alias("abic"), value("#  ABIC", 6).alias("misfit"), value("# lambda_0^2", 3).alias("lambda_0_squared"),
        value("# lambda_g^2", 3).alias("grad_lambda_squared"), value("# mu_t", 3).alias("mu_t"), value("# mu_MT", 3).alias("mu_mt"),
    )


def read_rinex_span(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """First and last observation time per file: from the header, the last one else from the epoch lines."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("text"))
    time = rinex_time(F.col("text"))
    epoch = F.when(F.col("text").rlike(r"^\s\d{2}(\s+\d+){4}\s+\d+\.\d+\s+\d"), time)
    spans = lines.groupBy("file").agg(F.min(F.when(F.col("text").contains("TIME OF FIRST OBS"), time)).alias("first"), F.max(F.when(F.col("text").contains("TIME OF LAST OBS"), time)).alias("header_last"), F.max(epoch).alias("epoch_last"))
    return spans.select("file", "first", F.coalesce("header_last", "epoch_last").alias("last"))


def read_table_csv(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """A CSV hand-off with a header, in the types of a table."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(SCHEMAS[table]).csv(path)


def read_survey_csv(spark: SparkSession, path: str, table: str, survey: str) -> DataFrame:
    """The rows of one survey in a folder that sinks.write_survey_csv() has written; none, if the survey has no rows and so no files."""
    schema = StructType([*SCHEMAS[table].fields, StructField("survey_id", StringType())])
    found = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return found.where(F.col("survey_id") == survey).drop("survey_id")


def read_model_output(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Model output: a line to skip, a header, rows; columns by their names in the header."""
    lines = numbered_lines(read_lines(spark, path)).where(F.trim("text") != "")
    head = lines.where("line = 1").select("file", F.split("text", ",").alias("_names"))
    rows = lines.where("line > 1").join(head, "file").select("file", F.map_from_arrays(F.transform("_names", lambda x: F.trim(x)), F.split("text", ",")).alias("_v"))
    return rows.select("file", *[F.trim(F.col("_v")[f.name]).try_cast(f.dataType).alias(f.name) for f in SCHEMAS["model_output"].fields])


SITE = "names array<string>, networks array<string>, benchmarks array<struct<name: string, benchmarkID: string, aPrioriLocation: struct<latitude: double, longitude: double, elevation: double>, start: string, `end`: string, transponders array<struct<address: string, tat: array<struct<value: double, start: string, `end`: string>>, start: string, `end`: string>>>>, campaigns array<struct<name: string, start: string, `end`: string, surveys: array<struct<id: string, type: string, benchmarkIDs: array<string>, start: string, `end`: string>>>>"


def read_sites(spark: SparkSession, path: str | list[str]) -> DataFrame:
    schema = SITE.replace("transponders array<struct<", "transponders: array<struct<")
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.get("names", F.lit(0)).alias("site"), "networks", "benchmarks", "campaigns")


def turn_around_entries(sites: DataFrame) -> DataFrame:
    """(site, benchmark, transponder, position, value, start, end) of sites, an entry per row."""
    b = sites.select("site", F.explode("benchmarks").alias("b"))
    t = b.select("site", F.col("b.name").alias("benchmark"), F.explode("b.transponders").alias("t"))
    e = t.select("site", "benchmark", F.col("t.address").alias("transponder"), F.posexplode("t.tat").alias("position", "e"))
    return e.select("site", "benchmark", "transponder", "position", F.col("e.value").alias("value"), F.try_to_timestamp("e.start").alias("start"), F.try_to_timestamp("e.end").alias("end"))


def time_range(df: DataFrame, ts: str, start: Column, end: Column | None = None, inclusive: bool = False) -> DataFrame:
    """Rows from start to end; without an end to the end of the start's day. With a day column only those days are read.

    The end is exclusive unless `inclusive`.
    """
    end = F.date_add(F.to_date(start), 1).cast("timestamp") if end is None else end
    c = F.col(ts)
    out = df.where((c >= start) & ((c <= end) if inclusive else (c < end)))
    return out.where(F.col("day").between(F.to_date(start), F.to_date(end))) if "day" in df.columns else out


# ---------------------------------------------------------------- nested epochs


def nested_epochs(obs: DataFrame, epoch: str, satellite: str, fields: list[str]) -> DataFrame:
    """An epoch per row: (epoch, satellites), satellites sorted, each with its observations sorted by their fields."""
    per_satellite = obs.groupBy(epoch, satellite).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("observations"))
    return per_satellite.groupBy(epoch).agg(F.array_sort(F.collect_list(F.struct(F.col(satellite).alias("sat"), "observations"))).alias("satellites"))


def epoch_text(nested: DataFrame, epoch: str) -> DataFrame:
    """(epoch, satellites, observations, text): counts of nested epochs, and satellites with their counts as text."""
    size = F.aggregate("satellites", F.lit(0).cast("long"), lambda a, x: a + F.size(x["observations"]))
    text = F.array_join(F.transform("satellites", lambda x: F.concat(x["sat"].cast("string"), F.lit(":"), F.size(x["observations"]).cast("string"))), ",")
    return nested.select(epoch, F.size("satellites").cast("long").alias("satellites"), size.alias("observations"), text.alias("text"))


def flattened_epochs(nested: DataFrame, epoch: str) -> DataFrame:
    """An observation per row (epoch, sat, its fields); epochs and satellites without any are gone."""
    one = nested.select(epoch, F.explode("satellites").alias("s")).select(epoch, "s.sat", F.explode("s.observations").alias("o"))
    return one.select(epoch, "sat", "o.*")
