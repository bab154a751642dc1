"""Queries of readers, writers, time and text functions, numeric jobs and streams.

Raw files are written from the given tables first, so the whole path from file to table is run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions import text as X
from fathom.functions import timeutil as T
from fathom.functions.geo import geodetic_to_ecef
from fathom.operators import model_io, pairing, refine, report, surveys, temporal, validate
from fathom.plans import jobs
from fathom.plans.domain import CENTRE, SHOTS, of_type, shots, sql_ecef, sql_enu, table
from fathom.plans.registry import query
from fathom.schemas import EVENT
from fathom.sources import readers, sinks
from fathom.sources.catalog_table import CatalogTable
from fathom.sources.workspace import fresh_path, named_files, text_files
from fathom.streaming import ingest

# ---------------------------------------------------------------- event logs and pin files

#: events as logged events: view pings, click and purchase reply, signup is another event, error a broken line.

def event_json(e: DataFrame, observed: bool = False) -> Column:
    """A logged event in JSON from columns of shots(); every fourth has a range message, without observations or with one."""
    kind = F.when(F.col("event_type") == "view", "interrogation").when(F.col("event_type").isin("click", "purchase"), "range").otherwise("status")
    place = F.struct(F.col("height").alias("hae"), "latitude", "longitude")
    pose = F.struct((F.col("value") % 360).alias("h"), (F.col("value") % 5).alias("p"), (F.col("value") % 3).alias("r"))
    one = F.concat_ws(",", F.lit("1"), (F.col("user_id") % 32).cast("string"), F.lit("0"), F.format_string("%.3f", "value"), *[F.lit(x) for x in ("0.1", "2.5", "0.01", "0.5", "40.0", "10.0", "1810dc04")])
    raw = F.concat(F.lit("#RANGEA,USB1,0,90.0,FINESTEERING,2300,"), F.col("event_id").cast("string"), F.lit(".5,0000,5103,1000;"), one if observed else F.lit("0"), F.lit("*00"))
    diag = F.struct(F.concat(F.lit("["), F.col("dbv").cast("string"), F.lit("]")).alias("dbv"), F.col("snr").cast("string").alias("snr"), F.col("xc").cast("string").alias("xc"))
    rng = F.struct(F.col("transponderID").alias("cn"), (F.col("value") / 100).alias("range"), F.lit(320.0).alias("tat"), diag.alias("diag"))
    event = F.struct(
        kind.alias("event"), F.col("event_id").cast("int").alias("event_id"), F.struct(F.col("pingTime").alias("common")).alias("time"),
        F.struct(pose.alias("AHRS"), place.alias("GNSS"), F.when(F.col("event_id") % 4 == 0, F.struct(raw.alias("raw"))).alias("NOV_RANGE")).alias("observations"), rng.alias("range"),
    )
    return F.when(F.col("event_type") == "error", F.lit('{"event": "interrog')).otherwise(F.to_json(event))


def event_log_files(s: SparkSession, d: str, whole: bool = False, observed: bool = False) -> str:
    """A folder of logs for each twentieth of the users; in one log each where a result depends on the order within all of it."""
    e = shots(s, d)
    lines = e.select((F.col("user_id") % 20).alias("f"), "pingTime", "event_id", event_json(e, observed).alias("value"))
    return text_files(lines, "f", "value", ["pingTime", "event_id"], "events", None if whole else [])


_KINDS = "CASE event_type WHEN 'view' THEN 'interrogation' WHEN 'click' THEN 'range' WHEN 'purchase' THEN 'range' WHEN 'error' THEN NULL ELSE 'status' END"


@query("R1_event_logs", f"WITH e AS (SELECT user_id % 20 AS file, {_KINDS} AS k FROM events) SELECT file, CASE WHEN k IS NULL THEN 'failed' WHEN k = 'status' THEN 'ignored' ELSE 'ok' END AS status, count(*) AS n FROM e GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    r = readers.read_event_logs(s, event_log_files(s, d))
    return r.groupBy(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("file"), "status").agg(F.count("*").alias("n"))


_PX, _PY, _PZ = sql_ecef("latitude", "longitude", "height")


@query("P1_ping_rows", f"WITH {SHOTS} SELECT event_id, round(value % 360, 6) AS head0, round({_PX}, 4) AS east0, round(pingTime + 18, 6) AS pingTime FROM shots WHERE event_type = 'view'")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).where("event_type != 'error'")
    p = e.select(F.from_json(event_json(e), EVENT).alias("event")).where("event.event = 'interrogation'").select(F.col("event.event_id").cast("long").alias("event_id"), *pairing.ping_fields())
    return p.select("event_id", F.round("head0", 6).alias("head0"), F.round("east0", 4).alias("east0"), F.round("pingTime", 6).alias("pingTime"))


@query("P2_reply_rows", f"WITH {SHOTS} SELECT event_id, transponderID, round(value / 100 - 0.32::DOUBLE - 0.13::DOUBLE, 6) AS tt, 0.32::DOUBLE AS tat, round(pingTime + 18, 6) AS returnTime, round(dbv, 6) AS dbv, round(snr, 6) AS snr, xc::DOUBLE AS xc FROM shots WHERE event_type IN ('click', 'purchase')")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).where("event_type != 'error'")
    p = e.select(F.from_json(event_json(e), EVENT).alias("event")).where("event.event = 'range'").select(F.col("event.event_id").cast("long").alias("event_id"), *pairing.reply_fields())
    return p.select("event_id", "transponderID", F.round("tt", 6).alias("tt"), "tat", F.round("returnTime", 6).alias("returnTime"), F.round("dbv", 6).alias("dbv"), F.round("snr", 6).alias("snr"), "xc")


@query("job_event_logs_to_shots", f"""WITH {SHOTS}, w AS (SELECT *, user_id % 20 AS file, last_value(CASE WHEN event_type = 'view' THEN pingTime END IGNORE NULLS) OVER (PARTITION BY user_id % 20 ORDER BY pingTime, event_id ROWS UNBOUNDED PRECEDING) AS ping FROM shots)
    SELECT file, event_id, round(ping + 18, 6) AS pingTime, round(pingTime + 18, 6) AS returnTime, transponderID,
    CASE WHEN value / 100 <= 1e-3 THEN 'no range' WHEN abs(pingTime - ping) > 15 THEN 'too far apart' ELSE 'inconsistent times' END AS reject_reason FROM w WHERE event_type IN ('click', 'purchase') AND ping IS NOT NULL""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Raw logs to paired shots with their verdicts: these made-up replies fail the time checks, which shows that each is judged."""
    r = jobs.shots_from_logs(s, event_log_files(s, d, whole=True))
    return r.select(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("file"), "event_id", F.round("pingTime", 6).alias("pingTime"), F.round("returnTime", 6).alias("returnTime"), "transponderID", "reject_reason")


def pin_files(s: SparkSession, d: str) -> str:
    """A pin file per user with a ping: the first ping, and the first reply per transponder."""
    e = shots(s, d).where("event_type in ('view', 'click')")
    name = F.when(F.col("event_type") == "view", "interrogation").otherwise(F.concat(F.lit("uid"), (F.col("event_id") % 3).cast("string")))
    first = temporal.first_by(e.withColumn("name", name), ["user_id", "name"], ["pingTime", "event_id"])
    entry = first.select(F.col("user_id").alias("f"), "name", event_json(first).alias("json"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "json"))), lambda x: F.concat(F.lit('"'), x["name"], F.lit('": '), x["json"])), ", ")
    files = entry.groupBy("f").agg(F.concat(F.lit("{"), body, F.lit(', "junk": {"event": "other"}}\n')).alias("text"))
    folder = fresh_path(s, "pins")
    named_files(files.select(F.concat(F.lit("f="), F.col("f").cast("string"), F.lit(".pin")).alias("name"), "text"), folder)
    return folder


_PINS = f"""pin AS (SELECT user_id % 500 AS f, CASE WHEN event_type = 'view' THEN 'interrogation' ELSE 'uid' || (event_id % 3) END AS name, event_id, pingTime,
    row_number() OVER (PARTITION BY user_id, CASE WHEN event_type = 'view' THEN 'interrogation' ELSE 'uid' || (event_id % 3) END ORDER BY pingTime, event_id) AS rn FROM shots WHERE event_type IN ('view', 'click')),
    pins AS (SELECT * FROM pin WHERE rn = 1)"""


@query("R2_pin_files", f"WITH {SHOTS}, {_PINS} SELECT f, name, event_id FROM pins")
def _(s: SparkSession, d: str) -> DataFrame:
    p = readers.read_pin_files(s, pin_files(s, d))
    return p.select((F.regexp_extract("file", r"f=(\d+)", 1).cast("long") % 500).alias("f"), "name", F.col("event.event_id").cast("long").alias("event_id"))


@query("R3_pin_messages", f"WITH {SHOTS}, {_PINS} SELECT DISTINCT '#RANGEA,USB1,0,90.0,FINESTEERING,2300,' || event_id || '.5,0000,5103,1000;0*00' AS message FROM pins WHERE event_id % 4 = 0")
def _(s: SparkSession, d: str) -> DataFrame:
    return readers.pin_messages(readers.read_pin_files(s, pin_files(s, d)))


# ---------------------------------------------------------------- receiver messages

#: Words of the tracking status as hexadecimal text, by lineitem's supplier: GPS, GLONASS and another system.
_WORDS = [("1810dc04", 0, 0), ("08119f24", 1, 0), ("13356c25", 5, 25)]


def range_messages(s: SparkSession, d: str) -> DataFrame:
    """A range message per order: its lineitems are the observations, the last one cut off in every seventh message."""
    li = table(s, d, "lineitem")
    word = F.element_at(F.array(*[F.lit(w) for w, _, _ in _WORDS]), (F.col("l_suppkey") % 3 + 1).cast("int"))
    num = lambda c: F.coalesce(F.round(F.col(c).cast("double"), 3).cast("string"), F.lit("null"))
    obs = F.concat_ws(",", F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 7).cast("string"), num("l_extendedprice"), F.lit("0.1"), num("l_quantity"), F.lit("0.01"), num("l_discount"), num("l_tax"), F.lit("10.0"), word)
    m = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", obs.alias("o")))).alias("os"))
    body = F.concat_ws(",", F.size("os").cast("string"), F.array_join(F.transform("os", lambda x: x["o"]), ","))
    body = F.when(F.col("l_orderkey") % 7 == 0, F.regexp_replace(body, r",[^,]*$", "")).otherwise(body)
    head = F.concat(F.lit("#RANGEA,USB1,0,90.0,FINESTEERING,"), (F.lit(2000) + F.col("l_orderkey") % 9).cast("string"), F.lit(","), (F.col("l_orderkey") % 604800).cast("string"), F.lit(".250,00000000,5103,16809;"))
    return m.select("l_orderkey", F.concat(head, body, F.lit("*1a2b3c4d")).alias("message"))


_OBS = """o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity) AS rn, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
    k AS (SELECT *, CASE l_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END AS sys, CASE l_suppkey % 3 WHEN 2 THEN 25 ELSE 0 END AS obs FROM o WHERE NOT (l_orderkey % 7 = 0 AND rn = n))"""


@query("R4_range_observations", f"""WITH {_OBS} SELECT l_orderkey, rn - 1 AS position, sys, CAST(l_linenumber AS BIGINT) AS sat, obs, round(l_extendedprice, 3) AS range, round(l_quantity, 3) AS phase,
    CASE WHEN sys = 1 THEN l_partkey % 7 ELSE 0 END AS fcn, 315964782000000 + (2000 + l_orderkey % 9) * 604800000000 + (l_orderkey % 604800) * 1000000 + 250000 AS time_us, n AS n_observations FROM k""")
def _(s: SparkSession, d: str) -> DataFrame:
    o = readers.range_observations(range_messages(s, d), "message")
    return o.select("l_orderkey", F.col("position").cast("long").alias("position"), F.col("sys").cast("long").alias("sys"), F.col("sat").cast("long").alias("sat"), F.col("obs").cast("long").alias("obs"), "range", "phase", F.col("fcn").cast("long").alias("fcn"), F.unix_micros("time").alias("time_us"), F.col("n_observations").cast("long").alias("n_observations"))


@query("F9_tracking_word", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, (w >> 5) & 31 AS channel, (w >> 10) & 7 AS phase_lock, (w >> 16) & 31 AS system, (w >> 21) & 31 AS signal, ((w >> 31) & 1) = 1 AS prn_lock FROM (SELECT *, (l_partkey * 7919 + l_suppkey * 104729) % 4294967296 AS w FROM lineitem)")
def _(s: SparkSession, d: str) -> DataFrame:
    w = X.tracking_word((F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % F.lit(4294967296), 31)
    return table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *[w[k].alias(k) for k in ("channel", "phase_lock", "system", "signal", "prn_lock")])


def _of_stations(messages: DataFrame) -> DataFrame:
    """Messages with their station; equal times belong to one station here."""
    return messages.withColumn("station", F.concat(F.lit("S"), (F.col("l_orderkey") % 3).cast("string")))


@query("W2_observation_table", f"""WITH {_OBS}, m AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, sys, l_linenumber, obs ORDER BY rn DESC) AS r1 FROM k),
    t AS (SELECT *, (2000 + l_orderkey % 9) * 604800000 + (l_orderkey % 604800) * 1000 AS ms FROM m WHERE r1 = 1),
    u AS (SELECT *, row_number() OVER (PARTITION BY ms, sys, l_linenumber, obs ORDER BY l_orderkey) AS r2 FROM t)
    SELECT l_orderkey, sys, CAST(l_linenumber AS BIGINT) AS sat, obs, round(l_extendedprice, 3) AS range FROM u WHERE r2 = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    """From raw strings to the table: the last of repeats within a message, the first of repeats between messages."""
    path = fresh_path(s, "observations")
    jobs.write_range_strings(_of_stations(range_messages(s, d)), path, ["l_orderkey"])
    t = s.read.parquet(path)
    return t.select("l_orderkey", F.col("sys").cast("long").alias("sys"), F.col("sat").cast("long").alias("sat"), F.col("obs").cast("long").alias("obs"), "range")


@query("W3_bulk_messages", f"""WITH {_OBS}, m AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, sys, l_linenumber, obs ORDER BY rn DESC) AS r1 FROM k),
    t AS (SELECT *, (2000 + l_orderkey % 9) * 604800000 + (l_orderkey % 604800) * 1000 AS ms FROM m WHERE r1 = 1),
    u AS (SELECT *, row_number() OVER (PARTITION BY ms, sys, l_linenumber, obs ORDER BY l_orderkey) AS r2 FROM t)
    SELECT sys, CAST(l_linenumber AS BIGINT) AS sat, count(*) AS n, round(sum(round(l_extendedprice, 3)), 2) AS total FROM u WHERE r2 = 1 GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Two batches of raw strings, the second with all of them again: what is there already stays."""
    path, m = fresh_path(s, "observations"), _of_stations(range_messages(s, d))
    for batch in (m.where("l_orderkey % 2 = 0"), m):
        jobs.write_range_strings(batch, path, ["l_orderkey"])
    t = s.read.parquet(path)
    return t.groupBy(F.col("sys").cast("long").alias("sys"), F.col("sat").cast("long").alias("sat")).agg(F.count("*").alias("n"), F.round(F.sum("range"), 2).alias("total"))


def framed_texts(s: SparkSession, d: str) -> DataFrame:
    """Texts with junk, good and bad messages, from events."""
    e = shots(s, d)
    head = F.concat(F.lit(",COM1,0,55.5,FINESTEERING,2200,"), F.col("event_id").cast("string"), F.lit(".000,0000,abcd,1;"))
    pos = F.concat(F.lit("2200,"), F.col("event_id").cast("string"), F.lit(".5,"), F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"), F.col("value").cast("string"), *[F.lit(str(k)) for k in (0.1, 0.2, 0.3, 1.0, 2.0, 3.0)]), F.lit(",INS"))
    dev = F.concat_ws(",", *[F.lit(str(k)) for k in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)], (F.col("event_id") % 3).cast("string"))
    name = F.when(F.col("event_type") == "view", "INSPVAA").when(F.col("event_type") == "click", "INSSTDEVA").otherwise("RANGEA")
    body = F.when(F.col("event_type") == "view", pos).when(F.col("event_type") == "click", dev).otherwise(F.lit("0"))
    good = F.concat(F.lit("junk,1#"), name, head, body, F.lit("*0badcafe"))
    return e.select("event_id", F.when(F.col("event_type") == "error", F.lit("noise#RANGEA,too,short;1*00")).otherwise(good).alias("text"))


_FRAMED = "CASE event_type WHEN 'view' THEN 'INSPVAA' WHEN 'click' THEN 'INSSTDEVA' ELSE 'RANGEA' END"


@query("R7_framed_messages", f"SELECT event_id, {_FRAMED} AS name, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'ok' END AS status FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return readers.framed_messages(framed_texts(s, d), "text").select("event_id", "name", "status")


@query("R8_message_dispatch", f"SELECT {_FRAMED} AS name, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    """Texts parsed once into a table for each log and one for failures, and what each table holds."""
    logs = readers.dispatch(readers.framed_messages(framed_texts(s, d), "text"), fresh_path(s, "logs"))
    return model_io.merged([df.groupBy("name", "status").agg(F.count("*").alias("n")) for df in logs.values()])


@query("R5_ins_positions", f"WITH {SHOTS} SELECT event_id, 315964782000000 + 2200 * 604800000000 + event_id * 1000000 + 500000 AS time_us, round(latitude, 6) AS latitude, value AS height, 3.0::DOUBLE AS azimuth FROM shots WHERE event_type = 'view'")
def _(s: SparkSession, d: str) -> DataFrame:
    m = readers.framed_messages(framed_texts(s, d), "text").where("status = 'ok' and name = 'INSPVAA'")
    p = readers.ins_positions(m)
    return p.select("event_id", F.unix_micros("time").alias("time_us"), F.round("latitude", 6).alias("latitude"), "height", "azimuth")


@query("R6_ins_deviations", "SELECT event_id, 315964782000000 + 2200 * 604800000000 + event_id * 1000000 AS time_us, 0.1::DOUBLE AS latitude_std, (event_id % 3)::DOUBLE AS azimuth_std FROM events WHERE event_type = 'click'")
def _(s: SparkSession, d: str) -> DataFrame:
    m = readers.framed_messages(framed_texts(s, d), "text").where("status = 'ok' and name = 'INSSTDEVA'")
    p = readers.ins_deviations(m, T.gps_to_utc(F.get("header", 5).try_cast("int"), F.get("header", 6).try_cast("double")))
    return p.select("event_id", F.unix_micros("time").alias("time_us"), "latitude_std", "azimuth_std")


# ---------------------------------------------------------------- casts, results, metadata


def _part_lines(s: SparkSession, d: str, line: Column, before: list[str], name: str) -> str:
    p = table(s, d, "part").select((F.col("p_partkey") % 5).alias("f"), F.col("p_partkey").alias("k"), line.alias("value"))
    heads = s.range(5).select(F.col("id").alias("f"), F.posexplode(F.array(*[F.lit(x) for x in before])).alias("i", "value")).select("f", (F.col("i") - 1000).cast("long").alias("k"), "value") if before else None
    return text_files(p if heads is None else p.unionByName(heads), "f", "value", ["k"], name)


@query("R9_profile_text", "SELECT CAST(p_size AS DOUBLE) AS depth, p_retailprice AS speed FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws("  ", F.col("p_size").cast("string"), F.lit("1"), F.lit("2"), F.lit("3"), F.lit("4"), F.col("p_retailprice").cast("string"))
    path = _part_lines(s, d, line, ["* header 1 2 3 4 5 6", "*END* of header", "no numbers in this line"], "profile")
    return readers.read_profile_text(s, path).select("depth", "speed")


@query("R10_ctd_csv", "SELECT -CAST(p_size AS DOUBLE) AS depth, p_retailprice AS speed FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return readers.read_ctd_csv(s, _part_lines(s, d, F.concat_ws(",", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")), [], "ctd"))


@query("R11_ctd_text", "SELECT CAST(p_size AS DOUBLE) AS depth, p_retailprice AS speed FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return readers.read_ctd_text(s, _part_lines(s, d, F.concat_ws("   ", (-F.col("p_size")).cast("string"), F.col("p_retailprice").cast("string")), [], "ctd"))


@query("O3_first_usable_cast", "SELECT 'ctd' AS source, CAST(p_size AS DOUBLE) AS depth, p_retailprice AS speed FROM part WHERE p_size > 10")
def _(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "part").select(F.col("p_size").cast("double").alias("depth"), F.col("p_retailprice").alias("speed"))
    return readers.first_usable_cast([("empty", p.where("depth < 0")), ("ctd", p.where("depth > 10")), ("profile", p)])


@query("R13_iteration_log", "SELECT o_orderkey % 20 AS f, CAST(o_orderkey AS BIGINT) AS iteration, 2 AS inv_type, round(o_totalprice, 2) AS rms_tt, 95.5::DOUBLE AS used_percent, CAST(o_custkey AS BIGINT) AS reject FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    line = F.concat(F.lit("#Inversion-type 2 Loop "), F.lit("= "), F.col("o_orderkey").cast("string"), F.lit(", RMS(TT) = "), F.format_string("%.2f", "o_totalprice"), F.lit(" ms, used_shot = 95.5%, reject = "), F.col("o_custkey").cast("string"), F.lit(", Max(dX) = 0.01, Hgt = -3.5"))
    path = text_files(o.select((F.col("o_orderkey") % 20).alias("f"), F.col("o_orderkey").alias("k"), line.alias("value")), "f", "value", ["k"], "log")
    r = readers.read_iterations(s, path)
    return r.select(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("f"), F.col("iteration").cast("long").alias("iteration"), "inv_type", "rms_tt", "used_percent", F.col("reject").cast("long").alias("reject"))


@query("R13_summary", "SELECT o_orderkey % 20 AS f, round(max(o_totalprice), 2) AS abic, 0.5::DOUBLE AS misfit, 1.5::DOUBLE AS mu_t FROM orders GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders").groupBy((F.col("o_orderkey") % 20).alias("f")).agg(F.max("o_totalprice").alias("m"))
    lines = F.array(F.concat(F.lit("#  ABIC = "), F.format_string("%.2f", "m"), F.lit(" misfit = 0.5")), F.lit("# lambda_0^2 = 0.1"), F.lit("# mu_t = 1.5 sec"), F.lit("# mu_MT = 0.25"))
    r = readers.read_summary(s, text_files(o.select("f", F.posexplode(lines).alias("k", "value")), "f", "value", ["k"], "log"))
    return r.select(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("f"), "abic", "misfit", "mu_t")


@query("R14_observation_span", "SELECT user_id % 10 AS f, epoch_us(date_trunc('second', min(ts))) AS first_us, epoch_us(date_trunc('second', max(ts))) AS last_us FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    """Half of the files have their last time in the header, the others in the epoch lines."""
    e = table(s, d, "events").select((F.col("user_id") % 10).alias("f"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"))
    head = e.groupBy("f").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    fields = lambda c: F.date_format(c, "  yyyy    MM    dd    HH    mm   ss.0000000")
    lines = F.array(F.concat(fields("a"), F.lit("     GPS         TIME OF FIRST OBS")), F.when(F.col("f") % 2 == 0, F.concat(fields("b"), F.lit("     GPS         TIME OF LAST OBS"))))
    head = head.select("f", F.posexplode(F.array_compact(lines)).alias("k", "value")).select("f", (F.col("k") - 10).cast("long").alias("k"), "value")
    epochs = e.select("f", F.unix_seconds("t").alias("k"), F.concat(F.lit(" "), F.date_format("t", "yy MM dd HH mm ss.0000000"), F.lit("  0 12G01G02")).alias("value"))
    r = readers.read_rinex_span(s, text_files(head.unionByName(epochs), "f", "value", ["k"], "rinex"))
    return r.select(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("f"), F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"))


@query("R15_model_output", "SELECT event_id % 20 AS f, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select((F.col("event_id") % 20).alias("f"), F.col("event_id").alias("k"), F.concat_ws(",", F.col("event_id").cast("string"), F.concat(F.lit("M"), (F.col("user_id") % 4).cast("string")), F.col("value").cast("string"), F.lit("False")).alias("value"))
    heads = s.range(20).select(F.col("id").alias("f"), F.posexplode(F.array(F.lit("# cfgfile"), F.lit(",MT,TT,flag"))).alias("i", "value")).select("f", (F.col("i") - 10).cast("long").alias("k"), "value")
    r = readers.read_model_output(s, text_files(e.unionByName(heads), "f", "value", ["k"], "output"))
    return r.where("not flag").groupBy(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("f")).agg(F.count("*").alias("n"), F.round(F.sum("TT"), 2).alias("total"))


@query("R15_shot_handoff", f"WITH {SHOTS} SELECT transponderID, count(*) AS n, round(sum(value), 2) AS tt, count(*) FILTER (xc IS NOT NULL) AS n_xc FROM shots GROUP BY transponderID")
def _(s: SparkSession, d: str) -> DataFrame:
    """Shots of each transponder as CSV, and read back in the shot table's types."""
    path = fresh_path(s, "shots")
    e = shots(s, d).select("event_id", "pingTime", "transponderID", "returnTime", F.col("value").alias("tt"), "xc", "snr")
    sinks.write_survey_csv(validate.coerce(e, "shot").withColumn("survey_id", F.lit("A")), path, ["pingTime"])
    r = readers.read_survey_csv(s, path, "shot", "A")
    return r.groupBy("transponderID").agg(F.count("*").alias("n"), F.round(F.sum("tt"), 2).alias("tt"), F.count("xc").alias("n_xc"))


_RECTIFIED = sql_enu(("east0", "north0", "up0"), sql_ecef("45.0::DOUBLE", "-125.0::DOUBLE", "0.0::DOUBLE"), "45.0::DOUBLE", "-125.0::DOUBLE")


@query("R15_rectified_handoff", f"""WITH {SHOTS} SELECT transponderID AS MT, count(*) AS n, round(sum(value), 2) AS tt, round(avg({_RECTIFIED[0]}), 2) AS mean_e0, count(*) FILTER (pingTime >= 1.704e9) AS late FROM shots GROUP BY transponderID""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Shots turned to the model's columns, handed on as a CSV for each survey, and read back in the model's types."""
    path = fresh_path(s, "model")
    e = shots(s, d).withColumns({f"{a}1": F.col(f"{a}0") for a in ("east", "north", "up")} | {f"{a}{k}": F.lit(0.0) for a in ("head", "pitch", "roll") for k in (0, 1)} | {"tt": F.col("value")})
    model = model_io.rectify(e, geodetic_to_ecef(*CENTRE, 0.0), *CENTRE)
    sinks.write_survey_csv(validate.coerce(model, "model_input").withColumn("survey_id", F.lit("A")), path, ["ST"])
    r = readers.read_survey_csv(s, path, "model_input", "A").where("SET = 'S01' and not flag")
    return r.groupBy("MT").agg(F.count("*").alias("n"), F.round(F.sum("TT"), 2).alias("tt"), F.round(F.avg("ant_e0"), 2).alias("mean_e0"), F.count(F.when(F.col("ST") >= 1.704e9, 1)).alias("late"))


@query("R15_cast_handoff", "SELECT CAST(p_size AS DOUBLE) AS depth, count(*) AS n, round(sum(p_retailprice), 2) AS speed FROM part GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    """A sound-speed cast handed on as CSV, and read back."""
    path = fresh_path(s, "cast")
    cast = table(s, d, "part").select(F.col("p_size").alias("depth"), F.col("p_retailprice").alias("speed"))
    sinks.write_survey_csv(validate.coerce(cast, "svp").withColumn("survey_id", F.lit("A")), path, ["depth", "speed"])
    r = readers.read_survey_csv(s, path, "svp", "A")
    return r.groupBy("depth").agg(F.count("*").alias("n"), F.round(F.sum("speed"), 2).alias("speed"))


@query("R16_site_metadata", "SELECT 'SITE' || n_regionkey AS site, n_name AS benchmark, 'T' || k AS transponder, n_nationkey * 10.0::DOUBLE + k AS value FROM nation, range(0, 2) r(k)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = lambda k: F.struct(F.lit(f"T{k}").alias("address"), F.array(F.struct((F.col("n_nationkey") * F.lit(10.0) + k).alias("value"), F.lit("2020-01-01T00:00:00").alias("start"))).alias("tat"))
    b = table(s, d, "nation").select("n_regionkey", F.struct(F.col("n_name").alias("name"), F.array(t(0), t(1)).alias("transponders")).alias("b"))
    site = b.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("b"), lambda x, y: F.when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0)).alias("benchmarks"))
    js = F.to_json(F.struct(F.array(F.concat(F.lit("SITE"), F.col("n_regionkey").cast("string"))).alias("names"), "benchmarks"))
    path = text_files(site.select(F.col("n_regionkey").alias("f"), js.alias("value")), "f", "value", [], "sites")
    return readers.turn_around_entries(readers.read_sites(s, path)).select("site", "benchmark", "transponder", "value")


@query("T12_incomplete_metadata", "SELECT 'R' || r_regionkey AS site, 'site' AS part, 'R' || r_regionkey AS name, 'no benchmarks' AS problem FROM region WHERE r_regionkey % 3 = 0 UNION ALL SELECT 'R' || n_regionkey, 'benchmark', n_name, 'no transponders' FROM nation WHERE n_regionkey % 3 != 0 AND n_nationkey % 4 = 0 UNION ALL SELECT 'R' || r_regionkey, 'campaign', r_name, 'no surveys' FROM region WHERE r_regionkey % 2 = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    b = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("T"))).alias("transponders"))
    bs = table(s, d, "nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.collect_list(b).alias("benchmarks"))
    r = table(s, d, "region").join(bs, F.col("r_regionkey") == F.col("r"), "left")
    c = F.array(F.struct(F.col("r_name").alias("name"), F.when(F.col("r_regionkey") % 2 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("S"))).alias("surveys")))
    none = F.array().cast("array<struct<name:string,transponders:array<string>>>")
    sites = r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("site"), F.when(F.col("r_regionkey") % 3 == 0, none).otherwise(F.col("benchmarks")).alias("benchmarks"), c.alias("campaigns"))
    return surveys.incomplete(sites)


# ---------------------------------------------------------------- sinks


@query("W4_daily_export", f"""WITH e AS (SELECT event_id, ts, user_id % 3 AS sys, (epoch_us(ts) // 1000) AS ms FROM events WHERE year(ts) = 2024)
    SELECT strftime(ts, '%Y-%m-%d') AS day, 'SITE' || lpad(dayofyear(ts)::VARCHAR, 3, '0') || '0.' || strftime(ts, '%y') || 'o' AS file_name, CAST(floor(hour(ts) / 6) AS INTEGER) AS slice, count(*) AS n FROM e WHERE ms % 5 = 0 GROUP BY ALL""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("time"), (F.col("user_id") % 3).alias("sys"), F.lit(1).alias("sat"), F.lit(1).alias("obs"), F.col("event_id").alias("flags"))
    path = fresh_path(s, "daily")
    sinks.write_daily(sinks.daily_observations(e, "SITE", "time", 2024, 5, 6), path, "time")
    return s.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"), "file_name", "slice").agg(F.count("*").alias("n"))


@query("W5_survey_csv", "SELECT user_id % 4 AS survey_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    path = fresh_path(s, "csv")
    sinks.write_survey_csv(table(s, d, "events").select((F.col("user_id") % 4).alias("survey_id"), "event_id", "value"), path, ["event_id"])
    r = s.read.option("header", True).schema("event_id long, value double, survey_id long").csv(path)
    return r.groupBy("survey_id").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


@query("W7_range_text", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position, o_orderkey FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    """Lines in time order over the files of the folder; the position is that of the line in all files."""
    from pyspark.sql import Window

    path = fresh_path(s, "text")
    o = table(s, d, "orders").select("o_orderdate", "o_orderkey", F.col("o_orderkey").cast("string").alias("m"))
    sinks.write_range_text(o, path, "m", ["o_orderdate", "o_orderkey"])
    lines = readers.numbered_lines(readers.read_lines(s, path))
    sizes = lines.groupBy("file").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(sizes.select("file", before.alias("before")), "file").select((F.col("line") + 1 + F.col("before")).alias("position"), F.col("text").cast("long").alias("o_orderkey"))


# ---------------------------------------------------------------- time functions


def _ts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("T1_gps_to_utc", "SELECT event_id, 315964782000000 + (2000 + event_id % 300) * 604800000000 + (event_id % 604800) * 1000000 + 250000 AS us FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    t = T.gps_to_utc(F.lit(2000) + F.col("event_id") % 300, F.col("event_id") % 604800 + F.lit(0.25))
    return table(s, d, "events").select("event_id", F.unix_micros(t).alias("us"))


@query("T2_utc_to_gps", "SELECT event_id, (epoch_us(ts) - 315964782000000) // 604800000000 AS week, round(((epoch_us(ts) - 315964782000000) % 604800000000) / 1e6, 6) AS seconds FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    w, sow = T.utc_to_gps(F.col("ts"))
    return _ts(s, d).select("event_id", w.alias("week"), F.round(sow, 6).alias("seconds"))


@query("T3_seconds_since_j2000", "SELECT event_id, round((epoch_us(ts) - 946728000000000) / 1e6, 6) AS x FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ts(s, d).select("event_id", F.round(T.utc_to_j2000(F.col("ts")), 6).alias("x"))


@query("T4_modified_julian_date", "SELECT event_id, round(epoch_us(ts) / 86400000000.0::DOUBLE + 40587, 7) AS mjd FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ts(s, d).select("event_id", F.round(T.to_mjd(F.col("ts")), 7).alias("mjd"))


@query("T5_epoch_seconds", "SELECT event_id, epoch_us(ts) AS us, round(epoch_us(ts) / 1e6, 6) AS s FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    x = T.to_seconds(F.col("ts"))
    return _ts(s, d).select("event_id", F.unix_micros(T.seconds_to_timestamp(x)).alias("us"), F.round(x, 6).alias("s"))


@query("T6_millis", "SELECT event_id, (epoch_us(ts) // 1000) * 1000 AS us FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ts(s, d).select("event_id", F.unix_micros(T.millis_to_timestamp(F.unix_millis("ts"))).alias("us"))


@query("T7_T8_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, dayofyear(ts) AS doy, 'A' || lpad(dayofyear(ts)::VARCHAR, 3, '0') || '0.' || strftime(ts, '%y') || 'o' AS name FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ts(s, d).select("event_id", T.seconds_to_date(T.to_seconds(F.col("ts"))).cast("string").alias("day"), F.dayofyear("ts").cast("long").alias("doy"), T.day_file_name("A", F.col("ts")).alias("name"))


@query("T9_rinex_time", "SELECT o_orderkey, epoch_us(o_orderdate) + 12345678 AS us FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy     M    d"), F.lit("    0    0   12.3456780     GPS         TIME OF FIRST OBS"))
    return table(s, d, "orders").select("o_orderkey", F.unix_micros(T.rinex_time(line)).alias("us"))


@query("T10_flexible_time", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE epoch_us(o_orderdate) END AS us FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("no date"))
    return table(s, d, "orders").select("o_orderkey", F.unix_micros(T.flexible_timestamp(text)).alias("us"))


@query("T11_day_of_year_time", "SELECT event_id, epoch_us(date_trunc('year', ts)::TIMESTAMP) + (dayofyear(ts) - 1) * 86400000000 + 1500000 AS us FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ts(s, d).select("event_id", F.unix_micros(T.day_of_year_time(F.year("ts"), F.dayofyear("ts"), F.lit(1.5))).alias("us"))


# ---------------------------------------------------------------- text functions


@query("F10_F11_header", "SELECT o_orderkey, 2000 + o_orderkey % 500 AS week, round(o_totalprice, 2) AS seconds, '00ff' AS receiver, 255 AS status FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    head = F.concat(F.lit("#RANGEA,COM1,0,73.5,FINESTEERING,"), (F.lit(2000) + F.col("o_orderkey") % 500).cast("string"), F.lit(","), F.format_string("%.2f", "o_totalprice"), F.lit(",00ff,5103,16248"))
    w, sec, rx = readers.range_header(F.split(head, ","))
    return table(s, d, "orders").select("o_orderkey", w.cast("long").alias("week"), sec.alias("seconds"), rx.alias("receiver"), X.hex_to_long(rx).alias("status"))


@query("F13_transponder_code", "SELECT s_suppkey, 'M' || lpad(s_suppkey::VARCHAR, 9, '0') AS code FROM supplier")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "supplier").select("s_suppkey", X.transponder_code(F.col("s_name")).alias("code"))


@query("F14_scalar_of_list", "SELECT event_id, value FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), F.col("value").cast("string"), F.lit("]"))).otherwise(F.col("value").cast("string"))
    return table(s, d, "events").select("event_id", X.scalar_of(text).alias("value"))


@query("F15_survey_type", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'circle' WHEN '2-HIGH' THEN 'fixed_point' WHEN '5-LOW' THEN 'movearound' ELSE 'other' END AS kind FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    name = F.when(p == "1-URGENT", "Circle Drive").when(p == "2-HIGH", "FixedPoint").when(p == "5-LOW", "MOVE AROUND").otherwise("circles")
    return table(s, d, "orders").select("o_orderkey", X.survey_type(name).alias("kind"))


@query("F16_file_classifier", "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'sonardyne' WHEN 1 THEN 'novatelpin' WHEN 2 THEN 'dfop00' WHEN 3 THEN 'kinresiduals' WHEN 4 THEN 'seabird' END AS kind FROM documents")
def _(s: SparkSession, d: str) -> DataFrame:
    names = ["sonardyne.pin", "Novatel_x.bin", "123_DFOP00.raw", "x.res", "svpavg.txt", "readme.md"]
    name = F.concat(F.lit("/a/novatel/"), F.col("source"), F.lit("/"), F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("doc_id") % 6 + 1).cast("int")))
    return table(s, d, "documents").select("doc_id", X.classify_file(name, F.lit(10)).alias("kind"))


@query("F18_json_paths", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("F19_F21_campaign_names", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate) END AS year, 'archive/net/' || year(o_orderdate) || '/sta/' || year(o_orderdate) || CASE WHEN o_orderkey % 5 = 0 THEN '_bad' ELSE '_A_WVGL' END || '/raw' AS path FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.year("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 5 == 0, "_bad").otherwise("_A_WVGL"))
    return table(s, d, "orders").select("o_orderkey", X.campaign_year(name).cast("long").alias("year"), X.archive_path(F.lit("net"), F.lit("sta"), name).alias("path"))


# ---------------------------------------------------------------- numeric jobs


def _positions(s: SparkSession, d: str) -> DataFrame:
    e = of_type(shots(s, d), "click").withColumns({"station": (F.col("user_id") % 5).cast("string"), "day": F.to_date("ts")})
    return e.select("station", "day", "event_id", F.col("pingTime").alias("time"), F.col("east0").alias("east"), F.col("north0").alias("north"), F.col("up0").alias("up"))


_UPDATED = """station, day, axis, i, t, m0, m1, p00, p01, p11, CASE WHEN v IS NULL OR w IS NULL THEN 0 ELSE 1 END AS k, p00 + r AS s0, m0 + p00 / s0 * (p - m0) AS n0, m1 + p01 / s0 * (p - m0) AS n1,
    p00 * r / s0 AS b00, p01 * r / s0 AS b01, p11 - p01 * p01 / s0 AS b11, b11 + coalesce(w, 1) AS s1, coalesce(v - n1, 0) AS e, n0 + k * b01 / s1 * e AS f0, n1 + k * b11 / s1 * e AS f1, b00 - k * b01 * b01 / s1 AS c00,
    CASE k WHEN 1 THEN b01 * w / s1 ELSE b01 END AS c01, CASE k WHEN 1 THEN b11 * w / s1 ELSE b11 END AS c11"""
_STATE = "station, day, axis, i, t, f0, f1, c00, c01, c11"
_CHANGES = "PARTITION BY station, day ORDER BY t, event_id"


def _speeds(name: str, source: str, order: str = _CHANGES) -> str:
    """CTE `name`: the rows of source (station, day, t, x, y, z ...) with vx, vy, vz, changes per second."""
    lag = ", ".join(f"({a} - lag({a}) OVER o) / nullif(t - lag(t) OVER o, 0) AS d{a}" for a in "xyz")
    first = ", ".join(f"CASE WHEN pt IS NULL THEN lead(d{a}) OVER o ELSE d{a} END AS v{a}" for a in "xyz")
    return f"{name} AS (SELECT *, {first} FROM (SELECT *, lag(t) OVER o AS pt, {lag} FROM {source} WINDOW o AS ({order})) WINDOW o AS ({order}))"


_KINEMATIC = f"""c AS (SELECT CAST(user_id % 5 AS VARCHAR) AS station, CAST(ts AS DATE) AS day, event_id, pingTime AS t, east0 AS x, north0 AS y, up0 AS z FROM shots WHERE event_type = 'click'), {_speeds("u", "c")},
    g AS (SELECT *, abs(vx) - avg(abs(vx)) OVER k AS dx, stddev_pop(abs(vx)) OVER k AS sx, abs(vy) - avg(abs(vy)) OVER k AS dy, stddev_pop(abs(vy)) OVER k AS sy, abs(vz) - avg(abs(vz)) OVER k AS dz, stddev_pop(abs(vz)) OVER k AS sz
          FROM (SELECT station, day, t, x, y, z, vx, vy, vz FROM u) WINDOW k AS (PARTITION BY station, day)),
    kin AS (SELECT station, day, t, x, y, z, vx, vy, vz, 0.01::DOUBLE AS rx, 0.01::DOUBLE AS ry, 0.01::DOUBLE AS rz, 0.01::DOUBLE AS wx, 0.01::DOUBLE AS wy, 0.01::DOUBLE AS wz FROM g
            WHERE CASE WHEN sx = 0 THEN 0 ELSE dx / sx END < 4 AND CASE WHEN sy = 0 THEN 0 ELSE dy / sy END < 4 AND CASE WHEN sz = 0 THEN 0 ELSE dz / sz END < 4)"""


def _smoother(source: str, condition: str) -> str:
    """CTEs up to bw and track: the smoother row by row, on source (station, day, t, places, velocities, variances r of places and w of velocities)."""
    axes = " UNION ALL ".join(f"SELECT station, day, '{a}' AS axis, i, t, {a} AS p, v{a} AS v, r{a} AS r, w{a} AS w FROM f" for a in "xyz")
    return f"""f AS (SELECT *, row_number() OVER (PARTITION BY station, day ORDER BY t, vx NULLS LAST, vy NULLS LAST, vz NULLS LAST, x, y, z) AS i FROM {source} WHERE {condition}), a AS ({axes}),
    fw AS (
        SELECT {_STATE} FROM (SELECT {_UPDATED} FROM (SELECT *, p AS m0, coalesce(v, 0) AS m1, 1e6::DOUBLE AS p00, 0.0::DOUBLE AS p01, 1e4::DOUBLE AS p11 FROM a WHERE i = 1))
        UNION ALL
        SELECT {_STATE} FROM (SELECT {_UPDATED} FROM (
            SELECT a.*, a.t - fw.t AS h, f0 + h * f1 AS m0, f1 AS m1, c00 + 2 * h * c01 + h * h * c11 + 0.01 * h * h * h / 3 AS p00, c01 + h * c11 + 0.01 * h * h / 2 AS p01, c11 + 0.01 * h AS p11
            FROM fw JOIN a ON a.station = fw.station AND a.day = fw.day AND a.axis = fw.axis AND a.i = fw.i + 1))),
    ends AS (SELECT station, day, max(i) AS n FROM f GROUP BY station, day),
    bw AS (
        SELECT fw.*, f0 AS x0, f1 AS x1, c00 AS v00, c01 AS v01, c11 AS v11 FROM fw JOIN ends ON fw.station = ends.station AND fw.day = ends.day AND fw.i = ends.n
        UNION ALL
        SELECT station, day, axis, i, t, f0, f1, c00, c01, c11, f0 + g00 * (y0 - m0) + g01 * (y1 - f1), f1 + g10 * (y0 - m0) + g11 * (y1 - f1),
               c00 + g00 * g00 * d00 + 2 * g00 * g01 * d01 + g01 * g01 * d11, c01 + g00 * g10 * d00 + (g00 * g11 + g01 * g10) * d01 + g01 * g11 * d11, c11 + g10 * g10 * d00 + 2 * g10 * g11 * d01 + g11 * g11 * d11
        FROM (
            SELECT fw.*, bw.x0 AS y0, bw.x1 AS y1, bw.t - fw.t AS h, fw.f0 + h * fw.f1 AS m0, fw.c00 + 2 * h * fw.c01 + h * h * fw.c11 + 0.01 * h * h * h / 3 AS p00, fw.c01 + h * fw.c11 + 0.01 * h * h / 2 AS p01,
                   fw.c11 + 0.01 * h AS p11, p00 * p11 - p01 * p01 AS det, bw.v00 - p00 AS d00, bw.v01 - p01 AS d01, bw.v11 - p11 AS d11,
                   ((fw.c00 + h * fw.c01) * p11 - fw.c01 * p01) / det AS g00, (fw.c01 * p00 - (fw.c00 + h * fw.c01) * p01) / det AS g01,
                   ((fw.c01 + h * fw.c11) * p11 - fw.c11 * p01) / det AS g10, (fw.c11 * p00 - (fw.c01 + h * fw.c11) * p01) / det AS g11
            FROM bw JOIN fw ON fw.station = bw.station AND fw.day = bw.day AND fw.axis = bw.axis AND fw.i = bw.i - 1)),
    track AS (SELECT station, day, i, t, max(CASE axis WHEN 'x' THEN x0 END) AS x, max(CASE axis WHEN 'y' THEN x0 END) AS y, max(CASE axis WHEN 'z' THEN x0 END) AS z FROM bw GROUP BY station, day, i, t)"""


def _updated(radius: float) -> str:
    """CTEs and the query of the shots (sh) with both ends replaced by the track's means around their times, weighed by inverse distance."""
    mean = lambda a: f"coalesce(avg(CASE WHEN d = 0 THEN {a} END), sum(CASE WHEN d > 0 THEN {a} / d END) / sum(CASE WHEN d > 0 THEN 1 / d END)) AS {a}"
    near = lambda k, t: f"n{k} AS (SELECT event_id, {', '.join(map(mean, 'xyz'))} FROM (SELECT event_id, abs(sh.{t} - track.t) AS d, x, y, z FROM sh JOIN track USING (station, day)) WHERE d <= {radius} GROUP BY event_id)"
    places = ", ".join(f"round(coalesce(n{k}.{b}, sh.{a}0), 3) AS {a}{k}" for k in (0, 1) for a, b in (("east", "x"), ("north", "y"), ("up", "z")))
    return f"""sh AS (SELECT CAST(user_id % 5 AS VARCHAR) AS station, CAST(ts AS DATE) AS day, event_id, pingTime, returnTime, east0, north0, up0 FROM shots WHERE event_type = 'view'), {near(0, "pingTime")}, {near(1, "returnTime")}
    SELECT sh.event_id, n0.x IS NOT NULL OR n1.x IS NOT NULL AS isUpdated, {places} FROM sh LEFT JOIN n0 ON n0.event_id = sh.event_id LEFT JOIN n1 ON n1.event_id = sh.event_id"""


_KNOWN = "vx IS NOT NULL AND vy IS NOT NULL AND vz IS NOT NULL"
_SMOOTHED = f"WITH RECURSIVE {SHOTS}, {_KINEMATIC}, {_smoother('kin', _KNOWN)}"
_IMU = f"""i0 AS (SELECT CAST(user_id % 5 AS VARCHAR) AS station, CAST(ts AS DATE) AS day, event_id, pingTime AS t, east0 AS x, north0 AS y, up0 AS z, nullif(xc % 7, 0)::DOUBLE AS sd FROM shots WHERE event_type = 'purchase'),
    imu AS (SELECT station, day, t, x, y, z, power(coalesce(first_value(sd IGNORE NULLS) OVER ({_CHANGES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(sd IGNORE NULLS) OVER ({_CHANGES} ROWS UNBOUNDED PRECEDING)), 2) AS r FROM i0),
    mid AS (SELECT station, day, median(x) AS mx, median(y) AS my, median(z) AS mz FROM imu GROUP BY station, day),
    joint AS (SELECT station, day, t, x, y, z, vx, vy, vz, rx, ry, rz, wx, wy, wz FROM kin WHERE {_KNOWN} UNION ALL SELECT station, day, t, x, y, z, 0, 0, 0, r, r, r, r, r, r FROM imu WHERE r IS NOT NULL),
    gated AS (SELECT joint.* FROM joint JOIN mid USING (station, day) WHERE abs(x - mx) <= 20000 AND abs(y - my) <= 20000 AND abs(z - mz) <= 20000)"""
_ENDS_ORDER = 'PARTITION BY station, day ORDER BY t, event_id, "end"'
_OWN = f"""e0 AS (SELECT CAST(user_id % 5 AS VARCHAR) AS station, CAST(ts AS DATE) AS day, event_id, 0 AS "end", pingTime AS t, east0 AS x, north0 AS y, up0 AS z, nullif(xc % 3, 0)::DOUBLE AS sd FROM shots WHERE event_type = 'view'
    UNION ALL SELECT CAST(user_id % 5 AS VARCHAR), CAST(ts AS DATE), event_id, 1, returnTime, east0, north0, up0, nullif(xc % 5, 0)::DOUBLE FROM shots WHERE event_type = 'view'),
    e1 AS (SELECT *, power(coalesce(first_value(sd IGNORE NULLS) OVER ({_ENDS_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(sd IGNORE NULLS) OVER ({_ENDS_ORDER} ROWS UNBOUNDED PRECEDING)), 2) AS r FROM e0),
    {_speeds("e2", "e1", _ENDS_ORDER)},
    joint AS (SELECT station, day, t, x, y, z, vx, vy, vz, rx, ry, rz, wx, wy, wz FROM kin UNION ALL SELECT station, day, t, x, y, z, vx, vy, vz, r, r, r, NULL, NULL, NULL FROM e2 WHERE r IS NOT NULL)"""


def _ends_rounded(df: DataFrame) -> DataFrame:
    return df.select("event_id", "isUpdated", *[F.round(f"{a}{k}", 3).alias(f"{a}{k}") for k in (0, 1) for a in ("east", "north", "up")])


@query("K1_smoothed_positions", f"""{_SMOOTHED} SELECT station, day::VARCHAR AS day, round(t, 3) AS time, round(max(CASE axis WHEN 'x' THEN x0 END), 3) AS ant_x, round(max(CASE axis WHEN 'y' THEN x0 END), 3) AS ant_y, round(max(CASE axis WHEN 'z' THEN x0 END), 3) AS ant_z,
    round(max(CASE axis WHEN 'x' THEN sqrt(v00) END), 6) AS sig_x, round(max(CASE axis WHEN 'y' THEN sqrt(v00) END), 6) AS sig_y, round(max(CASE axis WHEN 'z' THEN sqrt(v00) END), 6) AS sig_z FROM bw GROUP BY station, day, i, t""")
def _(s: SparkSession, d: str) -> DataFrame:
    r = refine.smooth(refine.prepare_kinematic(_positions(s, d), ["time", "event_id"]))
    places = [F.round(f"ant_{a}", 3).alias(f"ant_{a}") for a in "xyz"]
    return r.select("station", F.col("day").cast("string").alias("day"), F.round("time", 3).alias("time"), *places, *[F.round(f"sig_{a}", 6).alias(f"sig_{a}") for a in "xyz"])


@query("J15_smoothed_with_deviations", f"""{_SMOOTHED} SELECT axis, count(*) AS n, round(avg(sqrt(v00)), 5) AS mean_sig, round(max(sqrt(v00)), 5) AS max_sig, round(avg(x0), 2) AS mean_place FROM bw GROUP BY axis""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Smoothed states and their deviations, side by side in one row."""
    r = refine.smooth(refine.prepare_kinematic(_positions(s, d), ["time", "event_id"]))
    axes = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(f"ant_{a}").alias("x"), F.col(f"sig_{a}").alias("sig")) for a in "xyz"])).alias("a")
    return r.select(axes).groupBy("a.axis").agg(F.count("*").alias("n"), F.round(F.avg("a.sig"), 5).alias("mean_sig"), F.round(F.max("a.sig"), 5).alias("max_sig"), F.round(F.avg("a.x"), 2).alias("mean_place"))


@query("K2_refined_shots", f"WITH RECURSIVE {SHOTS}, {_KINEMATIC}, {_IMU}, {_smoother('gated', 'true')}, {_updated(600.0)}")
def _(s: SparkSession, d: str) -> DataFrame:
    """Whole refinement with inertial positions, on all stations and days."""
    e = shots(s, d).withColumns({"station": (F.col("user_id") % 5).cast("string"), "day": F.to_date("ts")})
    stds = {f"{c}_std": F.nullif(F.col("xc") % 7, F.lit(0)).cast("double") for c in ("latitude", "longitude", "height", "eastVelocity", "northVelocity", "upVelocity")}
    imu = of_type(e, "purchase").withColumns(stds | {c: F.lit(0.0) for c in ("eastVelocity", "northVelocity", "upVelocity")}).withColumn("time", F.col("pingTime"))
    left = of_type(e, "view").withColumns({"east1": F.col("east0"), "north1": F.col("north0"), "up1": F.col("up0"), "isUpdated": F.lit(False)})
    left = left.select("station", "day", "event_id", "pingTime", "returnTime", *[f"{a}{k}" for a in ("east", "north", "up") for k in (0, 1)], "isUpdated")
    done, _track = refine.refine_day(left, imu, _positions(s, d), "event_id", ["time", "event_id"], 20000.0, 600.0)
    return _ends_rounded(done)


@query("K3_quality_refinement", f"WITH RECURSIVE {SHOTS}, {_KINEMATIC}, {_OWN}, {_smoother('joint', 'true')}, {_updated(0.2)}")
def _(s: SparkSession, d: str) -> DataFrame:
    """The variant without inertial data: shots updated from their own positions and kinematic ones, smoothed without a gate."""
    e = of_type(shots(s, d), "view").withColumns({"station": (F.col("user_id") % 5).cast("string"), "day": F.to_date("ts")})
    ends = {f"{a}1": F.col(f"{a}0") for a in ("east", "north", "up")} | {"isUpdated": F.lit(False)}
    stds = {f"{a}_std{k}": F.nullif(F.col("xc") % n, F.lit(0)).cast("double") for a in ("east", "north", "up") for k, n in ((0, 3), (1, 5))}
    e = e.withColumns(ends | stds).select("station", "day", "event_id", "pingTime", "returnTime", *ends, *[f"{a}0" for a in ("east", "north", "up")], *stds)
    done, _track = jobs.quality_days(e, _positions(s, d), "event_id", ["time", "event_id"])
    return _ends_rounded(done)


@query("K4_kernel_ridge")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("station", (F.col("user_id") % 5).cast("string"))
    points = of_type(e, "view").select("station", "event_id", F.col("pingTime").alias("time"))
    samples = of_type(e, "click").select("station", F.col("pingTime").alias("time"), F.col("value").alias("x"), F.col("snr").alias("y"), F.col("dbv").alias("z"))
    return refine.kernel_interpolate(points, samples, ["station"], "event_id", 600.0, 1.0)


@query("K5_gaussian_process")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("station", (F.col("user_id") % 5).cast("string"))
    points = of_type(e, "view").select("station", "event_id", F.col("pingTime").alias("time"))
    samples = of_type(e, "click").select("station", F.col("pingTime").alias("time"), F.col("value").alias("x"), F.col("snr").alias("y"), F.col("dbv").alias("z"))
    return refine.kernel_interpolate(points, samples, ["station"], "event_id", 1200.0, 1e-10)


# ---------------------------------------------------------------- streams


@query("Z1_stream_ingest", f"WITH e AS (SELECT user_id % 20 AS file, {_KINDS} AS k FROM events) SELECT file, count(*) AS n, count(*) FILTER (k = 'interrogation') AS pings FROM e GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    """Files are read by a stream into a table; a second run finds nothing new."""
    files, out, state = event_log_files(s, d), fresh_path(s, "stream"), fresh_path(s, "state")
    for _run in range(2):
        stream = ingest.stream_event_files(s, files).select("file", F.col("event.event").alias("kind"))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    r = s.read.schema("file string, kind string").parquet(out)
    return r.groupBy(F.regexp_extract("file", r"f=(\d+)", 1).cast("long").alias("file")).agg(F.count("*").alias("n"), F.count(F.when(F.col("kind") == "interrogation", 1)).alias("pings"))


@query("Z2_two_tables", f"""WITH {SHOTS} SELECT (SELECT count(*) FROM shots WHERE event_type IN ('click', 'purchase')) AS shots, count(*) AS observations,
    round(sum(round(value, 3)), 2) AS total_range, CAST(sum(user_id % 32) AS BIGINT) AS satellites, 0 AS batches_again FROM shots WHERE event_type != 'error' AND event_id % 4 = 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    """A stream of event files feeds two tables with unique keys, shots and the decoded observations; then it runs again from the start."""
    files, shot_path, obs_path, ledger = event_log_files(s, d, observed=True), fresh_path(s, "shots"), fresh_path(s, "observations"), fresh_path(s, "ledger")

    def replies(df: DataFrame) -> DataFrame:
        r = df.where("event.event = 'range'").select(*pairing.reply_fields(), F.col("event.event_id").alias("pingTime"))
        return r.select("pingTime", "transponderID", "returnTime", "tt", F.to_date(T.seconds_to_timestamp(F.col("returnTime"))).alias("day"))

    batches = []
    for _run in range(2):  # the second run has lost its checkpoint, so it gets all files again
        write = ingest.two_tables(replies, ingest.event_observations, shot_path, obs_path)
        written = ingest.once(ledger, "events", write)
        ingest.run_available(ingest.stream_event_files(s, files), fresh_path(s, "state"), written).awaitTermination()
        batches.append(s.read.parquet(ledger).count())
    a = s.read.parquet(shot_path).agg(F.count("*").alias("shots"))
    b = s.read.parquet(obs_path).agg(F.count("*").alias("observations"), F.round(F.sum("range"), 2).alias("total_range"), F.sum("sat").alias("satellites"))
    return a.crossJoin(b).withColumn("batches_again", F.lit(batches[1] - batches[0]))


def _event_stream(s: SparkSession, d: str) -> DataFrame:
    """events as a stream of four files, one batch each, that arrive in the order of their times."""
    path = fresh_path(s, "events")
    e = table(s, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    span = e.agg(F.min(F.unix_seconds("ts")).alias("lo"), F.max(F.unix_seconds("ts")).alias("hi"))
    cut = e.crossJoin(F.broadcast(span)).withColumn("quarter", F.floor((F.unix_seconds("ts") - F.col("lo")) * 4 / (F.col("hi") - F.col("lo") + 1)))
    for k in range(4):  # files are read in the order in which they were written
        cut.where(F.col("quarter") == k).select(e.columns).repartition(1).write.mode("append").parquet(path)
    return s.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)


@query("Z3_stream_unique", "SELECT count(DISTINCT user_id) AS users, true AS within FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    """Keys that come again within the delay go: each user once, as the delay is longer than the stream."""
    out, state = fresh_path(s, "unique"), fresh_path(s, "state")
    u = ingest.unique_within(_event_stream(s, d), ["user_id"], "ts", "400 days")
    u.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    r = s.read.schema("event_id long, user_id long, ts timestamp").parquet(out)
    return r.agg(F.countDistinct("user_id").alias("users"), (F.count("*") == F.countDistinct("user_id")).alias("within"))


@query("Z4_stream_reply_counts", """WITH c AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS b, user_id % 4 AS k, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT epoch_us(b) AS bin_us, k, n FROM c WHERE b + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Closed windows of the whole stream: those that the watermark has passed."""
    out, state = fresh_path(s, "counts"), fresh_path(s, "state")
    c = ingest.streaming_reply_counts(_event_stream(s, d).withColumn("k", F.col("user_id") % 4), "k", "ts")
    c.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return s.read.schema("bin timestamp, k long, n long").parquet(out).select(F.unix_micros("bin").alias("bin_us"), "k", "n")


@query("job_residual_report", f"WITH {SHOTS} SELECT transponderID, count(*) AS n, round(quantile_cont(abs(value), 0.5), 6) AS median FROM shots WHERE abs(value) < 50 GROUP BY transponderID")
def _(s: SparkSession, d: str) -> DataFrame:
    """The report job's tables by transponder: shares of rows below the limit, and their medians."""
    e = shots(s, d).select(F.col("transponderID").alias("MT"), F.lit(False).alias("flag"), F.col("value").alias("ResiTT"), F.col("snr").alias("TakeOff"), F.col("value").alias("head1"))
    r = jobs.residual_report(e, s.createDataFrame([(2.0,)], "speed double"), keys=["MT"])  # at that speed the range is the time
    return r["inside"].join(r["quartiles"], "MT").select(F.col("MT").alias("transponderID"), "n", F.round("median", 6).alias("median"))


@query("job_ingest_catalog", """WITH f AS (SELECT s_suppkey AS k, CASE s_suppkey % 6 WHEN 0 THEN 'rinex2' WHEN 1 THEN 'novatel770' WHEN 2 THEN 'qcpin' WHEN 3 THEN 'ctd' WHEN 4 THEN 'kin' END AS type FROM supplier)
    SELECT type, count(*) AS n, min(k) AS first_file, max(k) AS last_file, 'NET' AS network FROM f WHERE type IS NOT NULL AND k % 7 != 0 GROUP BY type""")
def _(s: SparkSession, d: str) -> DataFrame:
    """A folder's files of known kinds, entered in the stored catalogue; more files arrive, and it is entered again."""
    name = F.element_at(F.array(*[F.lit(x) for x in ("site%d.23o", "a_NOV770_%d", "pings%d.pin", "CTD_%d.txt", "kin_%d", "notes%d.md")]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    files = table(s, d, "supplier").select("s_suppkey", F.regexp_replace(name, "%d", F.col("s_suppkey").cast("string")).alias("name"), F.when(F.col("s_suppkey") % 7 == 0, "").otherwise("data").alias("text"))
    folder, stored = fresh_path(s, "raw"), CatalogTable(s, fresh_path(s, "catalogue"), "network string, station string, campaign string, type string, local_path string")
    for part in (files.where("s_suppkey % 2 = 0"), files.where("s_suppkey % 2 = 1")):
        named_files(part.select("name", "text"), folder)
        found = jobs.ingest_catalog(s, folder, stored, "NET", "STA", "2023_A_TEST")
    k = F.regexp_extract("local_path", r"(\d+)(\.\w+)?$", 1).cast("long")
    return found.groupBy("type", "network").agg(F.count("*").alias("n"), F.min(k).alias("first_file"), F.max(k).alias("last_file"))


@query("job_pin_files_to_shots", f"""WITH {SHOTS}, q AS (SELECT *, CASE WHEN event_type = 'view' THEN 'interrogation' ELSE 'uid' || (event_id % 3) END AS name FROM shots WHERE event_type IN ('view', 'click')),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, name ORDER BY pingTime, event_id) AS rn FROM q), p AS (SELECT user_id, pingTime AS ping FROM r WHERE rn = 1 AND name = 'interrogation')
    SELECT event_id, round(ping + 18, 6) AS pingTime, round(pingTime + 18, 6) AS returnTime, transponderID,
    CASE WHEN value / 100 <= 1e-3 THEN 'no range' WHEN abs(pingTime - ping) > 15 THEN 'too far apart' ELSE 'inconsistent times' END AS reject_reason FROM r JOIN p USING (user_id) WHERE rn = 1 AND name != 'interrogation'""")
def _(s: SparkSession, d: str) -> DataFrame:
    r = jobs.shots_from_pins(s, pin_files(s, d))
    return r.select("event_id", F.round("pingTime", 6).alias("pingTime"), F.round("returnTime", 6).alias("returnTime"), "transponderID", "reject_reason")


@query("job_preprocess", f"""WITH {SHOTS} SELECT transponderID, count(DISTINCT pingTime) AS n FROM shots
    WHERE event_type IN ('click', 'purchase') AND value / 100 > 1e-3 AND value / 100 - 0.32::DOUBLE - 0.13::DOUBLE >= 0 AND (xc IS NULL OR xc BETWEEN 0 AND 100) GROUP BY transponderID""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Event logs with a ping and a consistent reply for each click and purchase, to the validated shot table; a ping and its reply stand in one log."""
    e = of_type(shots(s, d), "click").union(of_type(shots(s, d), "purchase"))
    back = F.col("pingTime") + F.col("value") / 100 - F.lit(pairing.TRIGGER_DELAY)
    lines = e.withColumn("event_type", F.lit("view")).withColumn("at", F.col("pingTime")).union(e.withColumn("at", F.col("pingTime")).withColumn("pingTime", back))
    logs = text_files(lines.select((F.col("user_id") % 20).alias("f"), "at", "user_id", "event_id", F.col("event_type").alias("kind"), event_json(lines).alias("value")), "f", "value", ["at", "user_id", "event_id", F.desc("kind")], "logs", ["at", "user_id", "event_id"])
    good, _rejected = jobs.preprocess(s, logs, fresh_path(s, "shots"), "STA1")
    return good.groupBy("transponderID").agg(F.count("*").alias("n"))


@query("job_model_report", f"""WITH {SHOTS} SELECT transponderID AS MT, count(*) AS n_raw, count(*) FILTER (event_type != 'error') AS n_unflagged, round(count(*) FILTER (event_type != 'error') * 100.0::DOUBLE / count(*), 1) AS percent,
    round(avg(sin(radians(value))), 6) AS delta_z, (SELECT round(max(abs(r)), 6) FROM (SELECT value / 1000 * (SELECT count(p_retailprice) / sum(1 / p_retailprice) FROM part) / 2 AS r FROM events) WHERE abs(r) < 50) AS largest FROM shots GROUP BY transponderID""")
def _(s: SparkSession, d: str) -> DataFrame:
    """What the report of a model's output says of each transponder, and the largest residual range below 50 m."""
    e = shots(s, d).select(F.col("transponderID").alias("MT"), (F.col("event_type") == "error").alias("flag"), (F.col("value") / 1000).alias("ResiTT"), F.col("snr").alias("TakeOff"), F.col("value").alias("head1"))
    r = jobs.residual_report(e, table(s, d, "part").select(F.col("p_retailprice").alias("speed")))
    rows = r["shares"].join(r["directions"].select("MT", F.round("delta_z", 6).alias("delta_z")), "MT")
    return rows.crossJoin(r["quartiles"].select(F.round("max", 6).alias("largest")))
