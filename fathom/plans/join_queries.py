"""Queries of joins, windows, deduplication, surveys, set operations and the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import catalog, model_io, pairing, refine, report, surveys, temporal
from fathom.plans.domain import SHOTS, SURVEYS, of_type, shots, table
from fathom.plans.domain import surveys as survey_table
from fathom.plans.registry import query
from fathom.sources import readers, sinks
from fathom.sources.catalog_table import CatalogTable
from fathom.sources.workspace import fresh_path

_STATION = "user_id % 5"
_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LI_SQL = ", ".join(_LI)


# ---------------------------------------------------------------- pairing


@query("J1_pair_with_last_ping", """WITH e AS (SELECT *, CASE WHEN role = 'user' THEN struct_pack(ok := coalesce(length(text) > 40, false), t := turn) END AS ping FROM conversations),
    w AS (SELECT *, last_value(ping IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS p FROM e)
    SELECT conv_id, turn, p.t AS ping_turn FROM w WHERE role = 'assistant' AND p.ok""")
def _(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "conversations")
    c = c.withColumn("part", F.floor(F.col("turn") / 1000))  # a long conversation is worked on in parts
    p = pairing.pair_with_last(c, "conv_id", "part", ["turn"], "role", "user", "assistant", F.col("turn"), F.length("text") > 40)
    return p.select("conv_id", "turn", F.col("ping.value").alias("ping_turn"))


@query("J2_pair_in_file", "SELECT c.conv_id, c.turn, p.ping FROM conversations c JOIN (SELECT conv_id, min(turn) AS ping FROM conversations WHERE role = 'user' GROUP BY conv_id) p USING (conv_id) WHERE c.role = 'assistant'")
def _(s: SparkSession, d: str) -> DataFrame:
    return pairing.pair_in_file(table(s, d, "conversations"), "conv_id", "role", "user", "assistant", F.col("turn")).select("conv_id", "turn", "ping")


@query("J3_inertial_merge", """WITH p AS (SELECT user_id, epoch_us(ts) // 600000000 AS b, min(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL),
    q AS (SELECT user_id, epoch_us(ts) // 600000000 AS b, floor(min(value) / 20) AS sd FROM events WHERE event_type = 'click' GROUP BY ALL)
    SELECT p.user_id, p.b, p.v, nullif(q.sd, 0) AS sd FROM p LEFT JOIN q ON p.user_id = q.user_id AND p.b = q.b""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("b", F.floor(F.unix_micros("ts") / 600_000_000))
    p = of_type(e, "view").groupBy("user_id", "b").agg(F.min("value").alias("v"))
    q = of_type(e, "click").groupBy("user_id", "b").agg(F.floor(F.min("value") / 20).cast("double").alias("sd"))
    return pairing.merge_inertial(p, q, ["user_id", "b"], ["sd"])


# ---------------------------------------------------------------- joins over time

_SIDES = f"l AS (SELECT event_id, {_STATION} AS station, pingTime FROM shots WHERE event_type = 'view'), r AS (SELECT {_STATION} AS station, pingTime AS t, value AS v FROM shots WHERE event_type = 'click')"


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = shots(s, d).withColumn("station", F.col("user_id") % 5)
    return of_type(e, "view").select("event_id", "station", "pingTime"), of_type(e, "click").select("station", "pingTime", F.col("value").alias("v"))


@query("J5_nearest_asof", f"""WITH {SHOTS}, {_SIDES}, n AS (SELECT event_id, t, v, row_number() OVER (PARTITION BY event_id ORDER BY abs(pingTime - t), t, v) AS rn FROM l JOIN r ON l.station = r.station AND abs(pingTime - t) <= 900)
    SELECT l.event_id, round(n.t, 6) AS match_time, n.v FROM l LEFT JOIN n ON l.event_id = n.event_id AND rn = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    left, right = _sides(s, d)
    j = temporal.nearest_asof(left, right, ["station"], "pingTime", "pingTime", 900.0, "event_id", ["v"])
    return j.select("event_id", F.round("match_time", 6).alias("match_time"), "v")


_NEAR = "n AS (SELECT event_id, abs(pingTime - t) AS dist, v FROM l JOIN r ON l.station = r.station AND abs(pingTime - t) <= 1800)"


@query("J6_radius_inverse_distance", f"""WITH {SHOTS}, {_SIDES}, {_NEAR}
    SELECT event_id, count(*) AS n_neighbours, round(coalesce(avg(v) FILTER (dist = 0), sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0))), 6) AS v FROM n GROUP BY event_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    left, right = _sides(s, d)
    return temporal.radius_mean(left, right, ["station"], "pingTime", "pingTime", 1800.0, "event_id", ["v"]).withColumn("v", F.round("v", 6))


@query("J7_radius_uniform", f"WITH {SHOTS}, {_SIDES}, {_NEAR} SELECT event_id, count(*) AS n_neighbours, round(avg(v), 6) AS v FROM n GROUP BY event_id")
def _(s: SparkSession, d: str) -> DataFrame:
    left, right = _sides(s, d)
    return temporal.radius_mean(left, right, ["station"], "pingTime", "pingTime", 1800.0, "event_id", ["v"], "uniform").withColumn("v", F.round("v", 6))


_TRACK = f"t AS (SELECT {_STATION} AS station, pingTime AS time, value AS x FROM shots WHERE event_type = 'click')"
_MOVED = """m0 AS (SELECT event_id, avg(t.x) AS x FROM a JOIN t ON a.station = t.station AND abs(a.pingTime - t.time) <= 600 GROUP BY event_id),
    m1 AS (SELECT event_id, avg(t.x) AS x FROM a JOIN t ON a.station = t.station AND abs(a.returnTime - t.time) <= 600 GROUP BY event_id)"""


@query("J7_shots_updated", f"""WITH {SHOTS}, {_TRACK}, a AS (SELECT *, {_STATION} AS station FROM shots WHERE event_type = 'view'), {_MOVED}
    SELECT a.event_id, round(coalesce(m0.x, a.value), 6) AS east0, round(coalesce(m1.x, a.value), 6) AS east1,
           coalesce(abs(m0.x - a.value) > 1, false) OR coalesce(abs(m1.x - a.value) > 1, false) AS isUpdated
    FROM a LEFT JOIN m0 ON m0.event_id = a.event_id LEFT JOIN m1 ON m1.event_id = a.event_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Both ends of each shot moved to the mean of the track around them, and whether one moved by more than a metre."""
    e = shots(s, d).withColumn("station", F.col("user_id") % 5)
    place = {f"{a}{k}": F.col("value") for a in ("east", "north", "up") for k in (0, 1)}
    left = of_type(e, "view").withColumns(place | {"isUpdated": F.lit(False)}).select("event_id", "station", "pingTime", "returnTime", *place, "isUpdated")
    track = of_type(e, "click").select("station", F.col("pingTime").alias("time"), *[F.col("value").alias(f"ant_{a}") for a in "xyz"])
    u = refine.update_shots(left, track, ["station"], "event_id", 600.0, "uniform", 1.0)
    return u.select("event_id", F.round("east0", 6).alias("east0"), F.round("east1", 6).alias("east1"), "isUpdated")


@query("J17_interpolation", f"""WITH {SHOTS}, {_SIDES}, r1 AS (SELECT station, t, min(v) AS v FROM r GROUP BY station, t),
    p AS (SELECT l.*, a.t AS t0, a.v AS v0 FROM l ASOF JOIN r1 a ON l.station = a.station AND l.pingTime >= a.t),
    q AS (SELECT p.*, b.t AS t1, b.v AS v1 FROM p ASOF JOIN r1 b ON p.station = b.station AND p.pingTime <= b.t)
    SELECT event_id, round(CASE WHEN t1 > t0 THEN v0 + (pingTime - t0) / (t1 - t0) * (v1 - v0) ELSE v0 END, 6) AS v FROM q""")
def _(s: SparkSession, d: str) -> DataFrame:
    left, right = _sides(s, d)
    return temporal.interpolate(left, right, ["station"], "pingTime", "pingTime", ["v"]).select("event_id", F.round("v", 6).alias("v"))


@query("J8_survey_assignment", f"WITH {SURVEYS} SELECT event_id, survey_id FROM events JOIN surveys ON ts BETWEEN s AND e")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return surveys.assign_surveys(e, survey_table(s, d), "ts", ["survey_id"]).select("event_id", "survey_id")


@query("J8_empty_surveys", f"WITH {SURVEYS} SELECT survey_id FROM surveys WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND value > 250 AND ts BETWEEN s AND e)")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").where("event_type = 'error' and value > 250").select(F.col("ts").cast("timestamp").alias("ts"))
    return surveys.empty_surveys(e, survey_table(s, d), "ts", "survey_id").select("survey_id")


_INTERVALS = """i AS (SELECT s_suppkey % 4 AS t, s_suppkey AS position, s_acctbal AS tat, TIMESTAMP '2024-01-01' + INTERVAL (s_suppkey % 25) DAY AS s,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + INTERVAL (s_suppkey % 25 + 3) DAY END AS e FROM supplier WHERE s_suppkey % 4 != 3 OR s_suppkey = 3),
    c AS (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM i)"""


@query("J9_valid_entry", f"""WITH {_INTERVALS} SELECT event_id, (SELECT arg_min(tat, position) FROM c WHERE c.t = user_id % 4 AND (n = 1 OR (s <= ts AND (e IS NULL OR e >= ts)))) AS tat FROM events""")
def _(s: SparkSession, d: str) -> DataFrame:
    base = F.lit("2024-01-01").cast("timestamp")
    days = F.col("s_suppkey") % 25
    at = lambda n: F.timestamp_micros(F.unix_micros(base) + n * F.lit(86_400_000_000))
    i = table(s, d, "supplier").where("s_suppkey % 4 != 3 or s_suppkey = 3").select(
        (F.col("s_suppkey") % 4).alias("t"), F.col("s_suppkey").alias("position"), F.col("s_acctbal").alias("tat"), at(days).alias("start"), F.when(F.col("s_suppkey") % 3 != 0, at(days + 3)).alias("end")
    )
    e = table(s, d, "events").select("event_id", (F.col("user_id") % 4).alias("t"), F.col("ts").cast("timestamp").alias("ts"))
    return surveys.valid_at(e, i, ["t"], "ts", "position", "tat", "event_id").select("event_id", "tat")


@query("J10_active_benchmarks", """WITH v AS (SELECT r_regionkey AS survey_id, TIMESTAMP '1996-01-01' + INTERVAL (r_regionkey) YEAR AS s, list_value('NATION_' || r_regionkey) AS ids FROM region),
    b AS (SELECT n_name, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE TIMESTAMP '1996-01-01' + INTERVAL (n_nationkey % 5) YEAR END AS e FROM nation)
    SELECT survey_id, n_name AS benchmark_id FROM v JOIN b ON list_contains(ids, n_name) OR e IS NULL OR e >= s""")
def _(s: SparkSession, d: str) -> DataFrame:
    year = lambda n: F.make_timestamp(F.lit(1996) + n.cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    site = lambda c: (F.col(c) * 0).alias("site")  # noqa: E731  all of one site
    v = table(s, d, "region").select(site("r_regionkey"), F.col("r_regionkey").alias("survey_id"), year(F.col("r_regionkey")).alias("start"), F.array(F.concat(F.lit("NATION_"), F.col("r_regionkey").cast("string"))).alias("benchmark_ids"))
    b = table(s, d, "nation").select(site("n_regionkey"), F.col("n_name").alias("benchmark_id"), F.when(F.col("n_nationkey") % 5 != 0, year(F.col("n_nationkey") % 5)).alias("end"))
    return surveys.active_benchmarks(v, b)


@query("J11_turn_around_times", """WITH b AS (SELECT n_regionkey AS benchmark, 'T' || (n_nationkey % 2) AS transponder, n_nationkey AS position, n_nationkey * 10.0::DOUBLE AS value, TIMESTAMP '1995-01-01' + INTERVAL (n_nationkey % 7) YEAR AS s FROM nation),
    c AS (SELECT *, count(*) OVER (PARTITION BY benchmark, transponder) AS n FROM b), k AS (SELECT r_regionkey AS campaign, TIMESTAMP '1996-06-01' + INTERVAL (r_regionkey) YEAR AS began FROM region)
    SELECT campaign, p.benchmark, p.transponder, (SELECT arg_min(value, position) FROM c WHERE c.benchmark = p.benchmark AND c.transponder = p.transponder AND (n = 1 OR s <= began)) AS tat
    FROM k, (SELECT DISTINCT benchmark, transponder FROM b) p""")
def _(s: SparkSession, d: str) -> DataFrame:
    year = lambda y, m, n: F.make_timestamp(F.lit(y) + n.cast("int"), F.lit(m), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    n = F.col("n_nationkey")
    site = lambda c: (F.col(c) * 0).alias("site")  # noqa: E731  all of one site
    b = table(s, d, "nation").select(site("n_regionkey"), F.col("n_regionkey").alias("benchmark"), F.concat(F.lit("T"), (n % 2).cast("string")).alias("transponder"), n.alias("position"), (n * F.lit(10.0)).alias("value"), year(1995, 1, n % 7).alias("start"), F.lit(None).cast("timestamp").alias("end"))
    k = table(s, d, "region").select(site("r_regionkey"), F.col("r_regionkey").alias("campaign"), year(1996, 6, F.col("r_regionkey")).alias("start"))
    return surveys.turn_around_times(b, k)


@query("J12_common_days", "SELECT DISTINCT strftime(ts, '%m-%d') AS day FROM events WHERE strftime(ts, '%m-%d') IN (SELECT strftime(o_orderdate, '%m-%d') FROM orders WHERE o_orderstatus = 'P')")
def _(s: SparkSession, d: str) -> DataFrame:
    """Days as days of 2024, since the two tables are of other years."""
    to_2024 = lambda c: F.make_timestamp(F.lit(2024), F.month(c), F.dayofmonth(c), F.lit(0), F.lit(0), F.lit(0))
    a = table(s, d, "events").select(to_2024(F.col("ts")).alias("t"))
    b = table(s, d, "orders").where("o_orderstatus = 'P' and not (month(o_orderdate) = 2 and day(o_orderdate) = 29)").select(to_2024(F.col("o_orderdate")).alias("t"))
    return catalog.common_days(a, "t", b, "t").select(F.date_format("day", "MM-dd").alias("day"))


@query("J13_transponder_semi_join", f"SELECT {_LI_SQL} FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 30)")
def _(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "part").where("p_size > 30").select(F.col("p_partkey").alias("l_partkey"))
    return table(s, d, "lineitem").select(*_LI).join(p, "l_partkey", "left_semi").select(*_LI)


@query("J14_pending", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 20)")
def _(s: SparkSession, d: str) -> DataFrame:
    return catalog.pending(table(s, d, "orders").select("o_orderkey"), table(s, d, "lineitem").where("l_quantity > 20"), "o_orderkey", "l_orderkey")


@query("J16_residuals_by_time", "SELECT event_id, o_orderkey FROM events JOIN orders ON strftime(ts, '%m%d') || (user_id % 100) = strftime(o_orderdate, '%m%d') || (o_custkey % 100)")
def _(s: SparkSession, d: str) -> DataFrame:
    key = lambda t, n: F.month(t) * 100_000 + F.dayofmonth(t) * 1000 + F.col(n) % 100
    e = table(s, d, "events").select("event_id", key("ts", "user_id").alias("k"))
    return model_io.join_on_time(e, table(s, d, "orders").select("o_orderkey", key("o_orderdate", "o_custkey").alias("k")), "k").select("event_id", "o_orderkey")


@query("J18_survey_at", f"WITH {SURVEYS} SELECT event_id, (SELECT arg_min(survey_id, position) FROM surveys WHERE ts BETWEEN s AND e) AS survey_id FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return surveys.survey_at(e, survey_table(s, d), "ts", "event_id", "survey_id", "position").select("event_id", "survey_id")


# ---------------------------------------------------------------- windows

_W = f"(PARTITION BY {_STATION} ORDER BY pingTime, event_id)"


def _station(s: SparkSession, d: str) -> DataFrame:
    return shots(s, d).select("event_id", "event_type", "value", "pingTime", "ts", (F.col("user_id") % 5).alias("station"), F.to_date("ts").alias("day"))


@query("N2_differences", f"WITH {SHOTS} SELECT event_id, round(value - lag(value) OVER {_W}, 6) AS d_value FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.differences(_station(s, d), ["station"], ["pingTime", "event_id"], ["value"], "day").select("event_id", F.round("d_value", 6).alias("d_value"))


@query("N3_velocities", f"""WITH {SHOTS}, v AS (SELECT event_id, pingTime, {_STATION} AS station, lag(pingTime) OVER {_W} AS p, (value - lag(value) OVER {_W}) / nullif(pingTime - lag(pingTime) OVER {_W}, 0) AS v FROM shots)
    SELECT event_id, round(CASE WHEN p IS NULL THEN lead(v) OVER (PARTITION BY station ORDER BY pingTime, event_id) ELSE v END, 6) AS v_value FROM v""")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.velocities(_station(s, d), ["station"], ["pingTime", "event_id"], "pingTime", ["value"], "day").select("event_id", F.round("v_value", 6).alias("v_value"))


@query("N4_fill_both_ways", f"""WITH {SHOTS}, n AS (SELECT event_id, pingTime, user_id, CASE WHEN event_type = 'view' THEN value END AS v FROM shots)
    SELECT event_id, coalesce(first_value(v IGNORE NULLS) OVER (PARTITION BY {_STATION} ORDER BY pingTime, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(v IGNORE NULLS) OVER (PARTITION BY {_STATION} ORDER BY pingTime, event_id ROWS UNBOUNDED PRECEDING)) AS v FROM n""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = _station(s, d).withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    return temporal.fill_both_ways(e, ["station"], ["pingTime", "event_id"], ["v"], "day").select("event_id", "v")


@query("N6_first_by_key", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.first_by(table(s, d, "lineitem").select(*_LI), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("N9_overlapping_surveys", """WITH o AS (SELECT DISTINCT o_custkey, o_orderdate AS s, o_orderdate + INTERVAL 60 DAY AS e, o_orderkey FROM orders)
    SELECT o_orderkey, coalesce(e > lead(s) OVER (PARTITION BY o_custkey ORDER BY s, o_orderkey), false) AS overlaps FROM o""")
def _(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("start"))
    o = o.withColumn("end", F.timestamp_micros(F.unix_micros("start") + F.lit(60 * 86_400_000_000)))
    return surveys.overlapping(o, ["o_custkey"], "o_orderkey").select("o_orderkey", "overlaps")


@query("D8_pseudo_surveys", """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE year(ts) = 2024)
    SELECT year(day) || '_' || month(day) || '_' || day(day) || '_' || row_number() OVER (ORDER BY day) AS survey_id, epoch_us(CAST(day AS TIMESTAMP)) AS start_us, epoch_us(CAST(day AS TIMESTAMP)) + 86399999999 AS end_us FROM d""")
def _(s: SparkSession, d: str) -> DataFrame:
    p = surveys.pseudo_surveys(table(s, d, "events").select(F.col("ts").cast("timestamp").alias("ts")), "ts", 2024)
    return p.select("survey_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"))


# ---------------------------------------------------------------- deduplication, decimation, slices


@query("D1_append_unique", "SELECT user_id, CAST(ts AS DATE)::VARCHAR AS day, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    """Three appends to a table with the key (user_id, day): old rows stay, and appending again changes nothing."""
    e = table(s, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    path = fresh_path(s, "unique")
    half = F.percentile_approx("event_id", 0.5)
    mid = e.agg(half.alias("mid"))
    first = e.crossJoin(F.broadcast(mid)).where("event_id <= mid").drop("mid")
    for part in (first, e, e):
        sinks.append_unique(part, path, ["user_id", "day"], ["day"], ["event_id"])
    return s.read.parquet(path).select("user_id", F.col("day").cast("string").alias("day"), "event_id")


@query("W6_compaction", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    path = fresh_path(s, "compact")
    table(s, d, "events").select("event_id", F.to_date("ts").alias("day")).repartition(8).write.partitionBy("day").parquet(path)
    sinks.compact(s, path, ["day"])
    return s.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


@query("D2_first_observation", f"SELECT {_LI_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 4, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select(*_LI, (F.col("l_suppkey") % 4).alias("sys"))
    return temporal.first_by(li, ["l_orderkey", "sys", "l_linenumber"], ["l_partkey", "l_suppkey"]).select(*_LI)


@query("D3_first_epoch", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY epoch_us(ts) // 60000000 ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).alias("m"))
    return temporal.first_by(e, ["m"], ["event_id"]).select("event_id")


@query("D4_decimation", """WITH e AS (SELECT user_id % 3 AS sat, (epoch_us(ts) // 300000000) * 300000 AS ms, bit_or(CAST(value AS BIGINT) % 8) AS flags FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
    x AS (SELECT ms, first_value(CASE WHEN ms % 900000 = 0 THEN ms END IGNORE NULLS) OVER (ORDER BY ms ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt FROM (SELECT DISTINCT ms FROM e)),
    c AS (SELECT sat, nxt AS ms, bit_or(flags) AS bits FROM e JOIN x USING (ms) WHERE ms % 900000 != 0 AND nxt IS NOT NULL GROUP BY 1, 2)
    SELECT e.sat, e.ms, e.flags | coalesce(c.bits, 0) AS flags FROM e LEFT JOIN c ON e.sat = c.sat AND e.ms = c.ms WHERE e.ms % 900000 = 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select((F.col("user_id") % 3).alias("sat"), (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 300_000_000) * 300_000).alias("ms"), (F.rint("value").cast("long") % 8).alias("f"))
    e = e.groupBy("sat", "ms").agg(F.bit_or("f").alias("flags"))
    return temporal.decimate(e, [], "ms", 900_000, ["sat"], "flags").select("sat", "ms", "flags")


@query("D5_day_batches", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.day_batches(table(s, d, "events"), "ts")


@query("D6_hour_slices", "SELECT CAST(floor(hour(ts) / 5) AS INTEGER) AS slice, count(*) AS n FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy(temporal.hour_slice(F.col("ts"), 5).alias("slice")).agg(F.count("*").alias("n"))


@query("D7_days_of_year", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.of_year(table(s, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 1997).select("o_orderkey")


@query("O2_files_by_first_epoch", "SELECT l_suppkey % 20 AS file, epoch_us(min(l_shipdate)) AS first_us, row_number() OVER (ORDER BY min(l_shipdate), l_suppkey % 20) AS position FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select((F.col("l_suppkey") % 20).alias("file"), F.col("l_shipdate").cast("timestamp").alias("t"))
    return catalog.by_first_epoch(li, "file", "t").select("file", F.unix_micros("first").alias("first_us"), "position")


@query("O1_sorted_for_model", f"WITH {SHOTS} SELECT event_id, row_number() OVER (PARTITION BY transponderID ORDER BY pingTime, event_id) AS position FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).select("event_id", "transponderID", "pingTime")
    return temporal.model_order(e, ["transponderID"], ["pingTime", "event_id"]).select("event_id", "position")


@query("O4_latest_result_file", "SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, max(CAST(regexp_extract(url, '([0-9]+)', 1) AS BIGINT)) AS iteration FROM pages WHERE regexp_extract(url, '([0-9]+)', 1) != '' GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").select(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), "url")
    return catalog.latest_file(p, ["host"], "url").select("host", "iteration")


@query("O5_preferred_product", """WITH p AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, page_id, CASE WHEN url LIKE '%/en/%' THEN 0 WHEN url LIKE '%/de/%' THEN 1 ELSE 2 END AS k FROM pages)
    SELECT host, page_id FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY k, page_id) AS rn FROM p) WHERE rn = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").select(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), "page_id", "url")
    rank = F.when(F.col("url").contains("/en/"), 0).when(F.col("url").contains("/de/"), 1).otherwise(2)
    return catalog.preferred(p, ["host"], rank, "page_id")


# ---------------------------------------------------------------- set operations and reshaping


@query("U1_combined_positions", "SELECT o_orderkey AS id, 'imu' AS source, epoch_us(o_orderdate) AS t FROM orders UNION ALL SELECT l_orderkey, 'kin', epoch_us(l_shipdate) FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    t = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias("t")
    a = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("imu").alias("source"), t("o_orderdate"))
    return refine.combine(a, table(s, d, "lineitem").select(t("l_shipdate"), F.lit("kin").alias("source"), F.col("l_orderkey").alias("id")), ["id", "source", "t"])


_UNPIVOT = f"""b AS (SELECT event_id, {_STATION} AS station, 0 AS "end", pingTime AS time, value AS east, nullif(xc % 3, 0)::DOUBLE AS sd FROM shots
    UNION ALL SELECT event_id, {_STATION}, 1, returnTime, value + 1, nullif(xc % 5, 0)::DOUBLE FROM shots)"""
_BW = 'PARTITION BY station ORDER BY time, event_id, "end"'


@query("U4_shot_positions", f"""WITH {SHOTS}, {_UNPIVOT}, f AS (SELECT *, coalesce(first_value(sd IGNORE NULLS) OVER ({_BW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(sd IGNORE NULLS) OVER ({_BW} ROWS UNBOUNDED PRECEDING)) AS east_std,
    lag(time) OVER ({_BW}) AS p, (east - lag(east) OVER ({_BW})) / nullif(time - lag(time) OVER ({_BW}), 0) AS v FROM b)
    SELECT event_id, "end", east_std, round(CASE WHEN p IS NULL THEN lead(v) OVER ({_BW}) ELSE v END, 5) AS v_east FROM f""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("station", F.col("user_id") % 5)
    cols = {f"{a}{k}": F.col("value") + k for a in ("east", "north", "up") for k in (0, 1)}
    stds = {f"{a}_std0": F.nullif(F.col("xc") % 3, F.lit(0)).cast("double") for a in ("east", "north", "up")} | {f"{a}_std1": F.nullif(F.col("xc") % 5, F.lit(0)).cast("double") for a in ("east", "north", "up")}
    p = refine.shots_to_positions(e.withColumns(cols | stds), ["station"], "event_id", 86_400)
    return p.select("event_id", "end", "east_std", F.round("v_east", 5).alias("v_east"))


@query("U5_nested_epochs", """SELECT l_orderkey, count(*) AS satellites, CAST(sum(n) AS BIGINT) AS observations, string_agg(sat || ':' || n, ',' ORDER BY sat) AS text
    FROM (SELECT l_orderkey, l_suppkey % 4 AS sat, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_orderkey""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Observations nested in satellites nested in epochs, and what the nested document says."""
    li = table(s, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 4).alias("sat"), "l_linenumber", "l_partkey", "l_quantity")
    return readers.epoch_text(readers.nested_epochs(li, "l_orderkey", "sat", ["l_linenumber", "l_partkey", "l_quantity"]), "l_orderkey")


@query("U6_flattened_epochs", "SELECT l_orderkey, l_suppkey % 4 AS sat, l_linenumber, l_partkey FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 4).alias("sat"), "l_linenumber", "l_partkey")
    return readers.flattened_epochs(readers.nested_epochs(li, "l_orderkey", "sat", ["l_linenumber", "l_partkey"]), "l_orderkey")


_CAST = "c AS (SELECT p_size AS depth, min(p_retailprice) AS speed FROM part GROUP BY 1)"


@query("U7_extended_cast", f"WITH {_CAST}, m AS (SELECT max(depth) AS d, arg_max(speed, depth) AS speed FROM c) SELECT depth, speed FROM c UNION ALL SELECT d + k, speed FROM m, range(1, 200) r(k)")
def _(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "part").groupBy(F.col("p_size").cast("long").alias("depth")).agg(F.min("p_retailprice").alias("speed"))
    return model_io.extend_cast(c, 200)


@query("U8_merged_residuals", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN hour(ts) < 8 THEN value END AS early, CASE WHEN hour(ts) >= 16 THEN value END AS late FROM events WHERE ts IS NOT NULL")
def _(s: SparkSession, d: str) -> DataFrame:
    """The frames of three shifts of all days, two of which have a column that the others lack."""
    e = table(s, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", F.hour("ts").alias("h"))
    early, late = e.where("h < 8").withColumnRenamed("value", "early"), e.where("h >= 16").withColumnRenamed("value", "late")
    return model_io.merged([x.drop("h") for x in (early, e.where("h >= 8 and h < 16").drop("value"), late)])


# ---------------------------------------------------------------- catalogue


_FILES = """f AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'a' || page_id || '.23o' WHEN 1 THEN 'x_NOV770_' || page_id WHEN 2 THEN 'novatel_' || page_id || '.pin' WHEN 3 THEN 'q' || page_id || '.pin' WHEN 4 THEN 'kin_' || page_id WHEN 5 THEN '._kin' || page_id WHEN 6 THEN 'CTD' || page_id ELSE 'other' || page_id END AS name, page_id % 11 AS length FROM pages),
    k AS (SELECT page_id, '/data/' || name AS path, CASE page_id % 8 WHEN 0 THEN 'rinex2' WHEN 1 THEN 'novatel770' WHEN 2 THEN 'novatel' WHEN 3 THEN 'qcpin' WHEN 4 THEN 'kin' WHEN 6 THEN 'ctd' END AS type FROM f WHERE length > 0 AND page_id % 8 NOT IN (5, 7))"""


def _files(s: SparkSession, d: str) -> DataFrame:
    """A file of one of eight kinds of names for each page: path, length."""
    i = F.col("page_id").cast("string")
    k = F.col("page_id") % 8
    name = (
        F.when(k == 0, F.concat(F.lit("a"), i, F.lit(".23o"))).when(k == 1, F.concat(F.lit("x_NOV770_"), i)).when(k == 2, F.concat(F.lit("novatel_"), i, F.lit(".pin"))).when(k == 3, F.concat(F.lit("q"), i, F.lit(".pin")))
        .when(k == 4, F.concat(F.lit("kin_"), i)).when(k == 5, F.concat(F.lit("._kin"), i)).when(k == 6, F.concat(F.lit("CTD"), i)).otherwise(F.concat(F.lit("other"), i))
    )
    return table(s, d, "pages").select(F.concat(F.lit("/data/"), name).alias("path"), (F.col("page_id") % 11).alias("length"))


@query("C1_discovered", f"WITH {_FILES} SELECT page_id, type FROM k")
def _(s: SparkSession, d: str) -> DataFrame:
    found = catalog.discovered(_files(s, d), "net", "sta", "2023_A_TEST")
    return found.select(F.regexp_extract("local_path", r"(\d+)(?:\.\d\do|\.pin)?$", 1).cast("long").alias("page_id"), "type")


_A = "(SELECT c_custkey AS id, c_mktsegment AS type, c_name AS path, c_acctbal AS v FROM customer WHERE c_custkey % 3 != 0)"
_B = "(SELECT c_custkey AS id, c_mktsegment AS type, c_name AS path, c_acctbal + 1 AS v FROM customer WHERE c_custkey % 2 = 0)"


def _ab(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"), F.col("c_name").alias("path"), F.col("c_acctbal").alias("v"))
    return c.where("id % 3 != 0"), c.where("id % 2 = 0").withColumn("v", F.col("v") + 1)


@query("C2_insert_missing", f"SELECT id, v FROM {_B} b WHERE NOT EXISTS (SELECT 1 FROM {_A} a WHERE a.path = b.path AND a.type = b.type)")
def _(s: SparkSession, d: str) -> DataFrame:
    a, b = _ab(s, d)
    return catalog.missing_from(b, a, ["path", "type"]).select("id", "v")


@query("C3_upsert", f"SELECT coalesce(b.id, a.id) AS id, round(coalesce(b.v, a.v), 4) AS v FROM {_A} a FULL JOIN {_B} b ON a.path = b.path")
def _(s: SparkSession, d: str) -> DataFrame:
    a, b = _ab(s, d)
    return catalog.upsert(a.withColumn("at", F.lit(1)), b.withColumn("at", F.lit(2)), "path", "at").select("id", F.round("v", 4).alias("v"))


@query("C4_lookup", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus = 'F'")
def _(s: SparkSession, d: str) -> DataFrame:
    return catalog.lookup(table(s, d, "orders"), ["1-URGENT", "2-HIGH", "5-LOW"], "o_orderpriority", o_orderstatus="F").select("o_orderkey")


@query("C5_name_contains", "SELECT p_partkey FROM part WHERE contains(p_name, 'red')")
def _(s: SparkSession, d: str) -> DataFrame:
    return catalog.name_contains(table(s, d, "part"), "p_name", "red").select("p_partkey")


@query("C6_delete_and_move", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'moved' ELSE o_orderpriority END AS path FROM orders WHERE o_orderstatus != 'P'")
def _(s: SparkSession, d: str) -> DataFrame:
    left = catalog.without(table(s, d, "orders"), F.col("o_orderstatus") == "P").withColumnRenamed("o_orderpriority", "path")
    return catalog.moved(left, F.col("o_orderkey") % 10 == 0, "path", F.lit("moved")).select("o_orderkey", "path")


@query("C7_job_signatures", "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_partkey))), '-') AS signature FROM lineitem GROUP BY l_orderkey HAVING l_orderkey % 2 = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    jobs = catalog.signatures(table(s, d, "lineitem"), "l_orderkey", "l_partkey")
    return catalog.not_done(jobs, jobs.where("l_orderkey % 2 = 0"), ["l_orderkey", "signature"])


@query("C8_ad_hoc_sql", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(s: SparkSession, d: str) -> DataFrame:
    return catalog.query(s, {"assets_view": table(s, d, "orders")}, "SELECT o_orderstatus, count(*) AS n FROM assets_view GROUP BY o_orderstatus")


@query("A14_files_by_type", f"""WITH {_FILES}, r AS (SELECT *, (row_number() OVER (PARTITION BY type ORDER BY path) - 1) // 100 AS page FROM k)
    SELECT type, page, count(*) AS n, string_agg(path, ',' ORDER BY path) AS paths FROM r GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The lists of files of each kind, in pages of a hundred."""
    found = catalog.discovered(_files(s, d), "net", "sta", "2023_A_TEST")
    return catalog.files_by_type(found, "local_path", "type", 100).select("type", "page", "n", F.array_join("paths", ",").alias("paths"))


@query("C9_stored_catalogue", f"""WITH m AS (SELECT coalesce(b.id, a.id) AS id, coalesce(b.type, a.type) AS type, coalesce(b.path, a.path) AS path, coalesce(b.v, a.v) AS v FROM {_A} a FULL JOIN {_B} b ON a.path = b.path)
    SELECT id, CASE WHEN id % 6 = 0 THEN 'MACHINERY' ELSE type END AS type, CASE WHEN id % 10 = 0 THEN 'moved/' || path ELSE path END AS path, round(v, 4) AS v
    FROM m WHERE id % 5 != 1 AND NOT (id % 6 != 0 AND type = 'BUILDING')""")
def _(s: SparkSession, d: str) -> DataFrame:
    """One stored table through inserts, an upsert that moves rows between partitions, deletions that empty one, and moved paths."""
    a, b = _ab(s, d)
    stored = CatalogTable(s, fresh_path(s, "catalogue"), "id long, type string, path string, v double, at int", key="path")
    stored.insert(a.withColumn("at", F.lit(1)))
    stored.insert(b.withColumn("at", F.lit(2)))  # only those that are missing
    stored.upsert(b.withColumn("at", F.lit(3)), "at")
    other = stored.read().where("id % 6 = 0").withColumns({"type": F.lit("MACHINERY"), "at": F.lit(4)})
    stored.upsert(other, "at")
    stored.delete(F.col("id") % 5 == 1)
    stored.delete(F.col("type") == "BUILDING")
    stored.move(F.col("id") % 10 == 0, "path", F.concat(F.lit("moved/"), F.col("path")))
    return stored.read().select("id", "type", "path", F.round("v", 4).alias("v"))


@query("R12_time_range", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-07 18:30:00'")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return readers.time_range(e, "ts", F.lit("2024-01-05 06:00:00").cast("timestamp"), F.lit("2024-01-07 18:30:00").cast("timestamp"), True).select("event_id")


@query("N5_group_statistics", f"WITH {SHOTS} SELECT event_id, round((value - avg(value) OVER (PARTITION BY {_STATION})) / stddev_pop(value) OVER (PARTITION BY {_STATION}), 6) AS z FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.standard_scores(_station(s, d), ["station"], ["value"]).select("event_id", F.round("z_value", 6).alias("z"))


@query("A8_counts_by_day", "SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.status_counts(table(s, d, "orders").withColumn("y", F.date_format("o_orderdate", "yyyy")), "y", F.lit("ok")).select(F.col("y").alias("year"), "n")
