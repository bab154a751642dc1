"""Queries of projections, predicates, aggregations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions import text as X
from fathom.functions.geo import add_offset, ecef_to_enu, enu_to_ecef, geodetic_to_ecef, geodetic_to_enu
from fathom.operators import filters, model_io, pairing, refine, report, surveys, temporal, validate
from fathom.plans import jobs
from fathom.plans.domain import CENTRE, SHOTS, SURVEYS, of_type, shots, sql_ecef, sql_enu, table
from fathom.plans.domain import surveys as survey_table
from fathom.plans.registry import query
from fathom.schemas import rules
from fathom.sources import readers, sinks
from fathom.sources.workspace import fresh_path

_ID = "SELECT event_id FROM shots WHERE"
_CENTRE_XYZ = sql_ecef("45.0::DOUBLE", "-125.0::DOUBLE", "0.0::DOUBLE")


def _ids(df: DataFrame) -> DataFrame:
    return df.select("event_id")


# ---------------------------------------------------------------- filters


@query("P7_snr", f"WITH {SHOTS} {_ID} snr >= 12")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ids(filters.by_snr(shots(s, d)))


@query("P8_dbv", f"WITH {SHOTS} {_ID} dbv BETWEEN -36 AND -3")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ids(filters.by_dbv(shots(s, d)))


@query("P9_correlation", f"WITH {SHOTS} {_ID} xc >= 45")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ids(filters.by_correlation(shots(s, d)))


_OK = "snr >= 12 AND dbv BETWEEN -36 AND -3 AND xc >= 45"


@query("P10_acoustic_levels", f"""WITH {SHOTS} SELECT 'good' AS level, event_id FROM shots WHERE snr >= 20 AND dbv BETWEEN -26 AND -3 AND xc >= 60
    UNION ALL SELECT 'ok', event_id FROM shots WHERE {_OK} UNION ALL SELECT 'difficult', event_id FROM shots WHERE {_OK}""")
def _(s: SparkSession, d: str) -> DataFrame:
    one = lambda level: filters.acoustic(shots(s, d), level).select(F.lit(level).alias("level"), "event_id")
    return one("good").unionByName(one("ok")).unionByName(one("difficult"))


@query("P11_centre_distance", f"WITH {SHOTS} {_ID} sqrt(power(east0 - {_CENTRE_XYZ[0]}, 2) + power(north0 - {_CENTRE_XYZ[1]}, 2)) <= 3000")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ids(filters.near_centre(shots(s, d), *CENTRE, 3000.0))


_BAD = "bad AS (SELECT pingTime AS t FROM shots WHERE event_type = 'error' AND value > 60)"


@query("J4_bad_time_anti_join", f"WITH {SHOTS}, {_BAD} {_ID} event_type != 'error' AND NOT EXISTS (SELECT 1 FROM bad WHERE pingTime BETWEEN t - 300 AND t + 300)")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d)
    bad = of_type(e, "error").select("pingTime", "value")
    return _ids(filters.outside_bad_times(e.where("event_type != 'error'"), bad, "pingTime", "pingTime", F.col("value") > 60, 300.0))


_PIPELINE = f"""WITH {SHOTS}, {_BAD}, a AS (SELECT * FROM shots WHERE event_type != 'error' AND {_OK}),
    b AS (SELECT *, count(*) OVER (PARTITION BY floor(pingTime / 3600)) AS n FROM a),
    c AS (SELECT * FROM b WHERE n >= 3 AND sqrt(power(east0 - {_CENTRE_XYZ[0]}, 2) + power(north0 - {_CENTRE_XYZ[1]}, 2)) <= 4000),
    w AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM bad WHERE floor(c.pingTime / 3600) * 3600 BETWEEN t - 300 AND t + 300))"""


def _filtered(s: SparkSession, d: str, counts: filters.StageCounts | None = None) -> DataFrame:
    """All filters; the pings of an hour count as one, so that replies share pings."""
    e = shots(s, d)
    bad = of_type(e, "error").select(F.col("pingTime").alias("time"), F.col("value").alias("wrms"))
    hourly = e.where("event_type != 'error'").withColumn("pingTime", F.floor(F.col("pingTime") / 3600).cast("double") * 3600)
    config = {"max_distance": {"metres": 4000.0}, "wrms": {"max_wrms": 60.0, "radius_seconds": 300.0}}
    return filters.filter_shots(hourly, "center", CENTRE, bad, config, counts=counts)


@query("P12_filter_pipeline", f"{_PIPELINE} SELECT event_id FROM w")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ids(_filtered(s, d))


@query("R15_filtered_handoff", f"{_PIPELINE} SELECT transponderID, count(*) AS n, round(sum(value), 2) AS tt FROM w GROUP BY transponderID")
def _(s: SparkSession, d: str) -> DataFrame:
    """Filtered shots handed on as CSV, and read back in the shot table's types."""
    path = fresh_path(s, "filtered")
    good = validate.coerce(_filtered(s, d).withColumn("tt", F.col("value")), "shot")
    sinks.write_survey_csv(good.withColumn("survey_id", F.lit("A")), path, ["pingTime", "returnTime"])
    r = readers.read_survey_csv(s, path, "shot", "A")
    return r.groupBy("transponderID").agg(F.count("*").alias("n"), F.round(F.sum("tt"), 2).alias("tt"))


@query("P12_filter_counts", f"""{_PIPELINE} SELECT 0 AS step, 'raw' AS stage, count(*) AS n FROM shots WHERE event_type != 'error' UNION ALL SELECT 1, 'acoustic', count(*) FROM a
    UNION ALL SELECT 2, 'replies', count(*) FROM b WHERE n >= 3 UNION ALL SELECT 3, 'distance', count(*) FROM c UNION ALL SELECT 4, 'wrms', count(*) FROM w""")
def _(s: SparkSession, d: str) -> DataFrame:
    """What each filter of the pipeline leaves, counted while it runs once."""
    counts = filters.StageCounts()
    return filters.stage_counts(_filtered(s, d, counts), counts)


@query("F17_config_overlay", f"""WITH {SHOTS}, a AS (SELECT * FROM shots WHERE event_type != 'error' AND snr >= 20 AND dbv BETWEEN -26 AND -3 AND xc >= 60),
    b AS (SELECT *, count(*) OVER (PARTITION BY floor(pingTime / 3600)) AS n FROM a) SELECT event_id FROM b WHERE n >= 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    """A configuration laid over the default one: a deep value, a null and an unknown key, which change nothing, and a filter turned off."""
    hourly = shots(s, d).where("event_type != 'error'").withColumn("pingTime", F.floor(F.col("pingTime") / 3600).cast("double") * 3600)
    config = {"acoustic": {"level": "good", "enabled": None, "unknown": 1}, "ping_replies": {"min_replies": 2}, "max_distance": {"enabled": False}, "wrms": None, "bogus": {"enabled": False}}
    return _ids(filters.filter_shots(hourly, "center", CENTRE, None, config))


@query("A22_filter_counts", f"""WITH {SHOTS} SELECT 0 AS step, 'raw' AS stage, count(*) AS n FROM shots UNION ALL SELECT 1, 'acoustic', count(*) FROM shots WHERE {_OK}
    UNION ALL SELECT 2, 'snr', count(*) FROM shots WHERE {_OK} AND snr >= 30""")
def _(s: SparkSession, d: str) -> DataFrame:
    counts = filters.StageCounts()
    a = counts(filters.acoustic(counts(shots(s, d), "raw")), "acoustic")
    return filters.stage_counts(counts(filters.by_snr(a, 30.0), "snr"), counts)


@query("P13_median_gate", f"""WITH {SHOTS}, imu AS (SELECT *, user_id % 5 AS station, CAST(ts AS DATE) AS day FROM shots WHERE event_type = 'view'),
    m AS (SELECT station, day, median(east0) AS mx, median(north0) AS my, median(up0) AS mz FROM imu GROUP BY station, day)
    SELECT event_id FROM (SELECT *, user_id % 5 AS station, CAST(ts AS DATE) AS day FROM shots WHERE event_type = 'click') k JOIN m USING (station, day)
    WHERE abs(east0 - mx) <= 3000 AND abs(north0 - my) <= 3000 AND abs(up0 - mz) <= 3000""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumns({"station": F.col("user_id") % 5, "day": F.to_date("ts")})
    return _ids(filters.around_medians(of_type(e, "click"), of_type(e, "view"), ["east0", "north0", "up0"], ["station", "day"], 3000.0))


@query("P14_spike_gate", f"""WITH {SHOTS}, z AS (SELECT event_id, abs(value) AS a, avg(abs(value)) OVER w AS m, stddev_pop(abs(value)) OVER w AS sd FROM shots
    WINDOW w AS (PARTITION BY user_id % 5, CAST(ts AS DATE))) SELECT event_id FROM z WHERE CASE WHEN sd = 0 THEN 0 ELSE (a - m) / sd END < 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumns({"station": F.col("user_id") % 5, "day": F.to_date("ts")})
    return _ids(filters.without_spikes(e, ["value"], ["station", "day"], 2.0))


@query("P15_residual_gate", "SELECT event_id FROM events WHERE abs(value - 100) < 50 AND NOT event_type = 'error'")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumns({"ResiRange": F.col("value") - 100, "flag": F.col("event_type") == "error"})
    return _ids(filters.residual_gate(e, 50.0))


@query("P15_residual_gate_both", f"WITH {SHOTS} {_ID} abs(snr - 20) < 2 AND abs(value - 100) < 2")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumns({"ResiRange": F.col("snr") - 20, "ResiTT": F.col("value") - 100})
    return _ids(filters.residual_gate_both(e))


@query("M1_merged_intervals", """WITH i AS (SELECT user_id, epoch_us(ts) / 1e6 AS a, epoch_us(ts) / 1e6 + value * 60 AS b FROM events WHERE event_type = 'error'),
    o AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM o)
    SELECT user_id, round(min(a), 3) AS start_s, round(max(b), 3) AS end_s FROM g GROUP BY user_id, k""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = of_type(shots(s, d), "error").select("user_id", F.col("pingTime").alias("a"), (F.col("pingTime") + F.col("value") * 60).alias("b"))
    return filters.merge_intervals(e, "a", "b", ["user_id"]).select("user_id", F.round("a", 3).alias("start_s"), F.round("b", 3).alias("end_s"))


@query("P16_high_rate_files", "SELECT page_id, lower(url) NOT LIKE '%1hz%' AS high_rate FROM pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", X.high_rate(F.col("url")).alias("high_rate"))


@query("P17_uncertainty", "SELECT event_id, 0.1::DOUBLE AS ant_sigx, 0.1::DOUBLE AS up_sig, 0.0::DOUBLE AS rho_xy FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return refine.constant_uncertainty(shots(s, d)).select("event_id", "ant_sigx", "up_sig", "rho_xy")


@query("P20_epochs_with_satellites", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def _(s: SparkSession, d: str) -> DataFrame:
    return filters.with_satellites(table(s, d, "orders").select("o_orderkey"), table(s, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("P18_validated", f"WITH {SHOTS} SELECT event_id, 'tt out of range' AS reason FROM shots WHERE NOT value BETWEEN 0 AND 600 UNION ALL SELECT event_id, 'snr out of range' FROM shots WHERE NOT (snr * 4 - 20) BETWEEN -100 AND 100 UNION ALL SELECT event_id, 'xc out of range' FROM shots WHERE NOT (xc + 20) BETWEEN 0 AND 100")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).select("event_id", "pingTime", "transponderID", "returnTime", F.col("value").alias("tt"), (F.col("xc") + 20).alias("xc"), (F.col("snr") * 4 - 20).alias("snr"), F.lit(0.5).alias("tat"))
    return validate.with_reasons(e, rules("shot")).select("event_id", F.explode("reasons").alias("reason"))


@query("P18_reason_counts", "SELECT 'height out of range' AS reason, count(*) AS n FROM events WHERE NOT value BETWEEN -101 AND 100 HAVING count(*) > 0")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).select("event_id", F.col("ts").alias("time"), F.col("value").alias("height"))
    return validate.reason_counts(validate.validate(validate.coerce(e, "kin"), "kin")[1])


# ---------------------------------------------------------------- projections


@query("P3_reply_consistency", """WITH r AS (SELECT event_id, value / 100 AS tt, (event_id % 3) * 0.5::DOUBLE - 0.13::DOUBLE AS tat, 1000.0::DOUBLE + event_id AS p FROM events),
    q AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN p + 20 WHEN event_id % 5 = 0 THEN p + tt + tat + 0.01::DOUBLE ELSE p + tt + tat END AS b FROM r)
    SELECT event_id, CASE WHEN abs(tt + tat + 0.13::DOUBLE) <= 1e-3 THEN 'no range' WHEN abs(b - p) > 15 THEN 'too far apart' WHEN abs(p + tt + tat - b) >= 1e-6 THEN 'inconsistent times' END AS reject_reason FROM q""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", (F.col("value") / 100).alias("tt"), ((F.col("event_id") % 3) * F.lit(0.5) - F.lit(0.13)).alias("tat"), (F.lit(1000.0) + F.col("event_id")).alias("pingTime"))
    back = F.col("pingTime") + F.col("tt") + F.col("tat")
    e = e.withColumn("returnTime", F.when(F.col("event_id") % 7 == 0, F.col("pingTime") + 20).when(F.col("event_id") % 5 == 0, back + F.lit(0.01)).otherwise(back))
    return pairing.reply_consistency(e).select("event_id", "reject_reason")


@query("P4_community_standard", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'IR' || (l_suppkey % 4) AS MT_ID, l_tax AS TravelTime, round(l_quantity + 1.5, 6) AS X_transmit, round(l_discount - 0.5, 6) AS Y_transmit,
    round(l_extendedprice + 2.0, 6) AS Z_transmit, round(l_quantity + 2.5, 6) AS X_receive FROM lineitem""")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem")
    ids = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    x = li.select(
        *ids, F.concat(F.lit("IR"), (F.col("l_suppkey") % 4).cast("string")).alias("transponderID"), F.col("l_tax").alias("tt"), F.lit(0.0).alias("pingTime"), F.lit(1.0).alias("returnTime"),
        F.col("l_quantity").alias("east0"), F.col("l_discount").alias("north0"), F.col("l_extendedprice").alias("up0"), (F.col("l_quantity") + 1).alias("east1"), F.col("l_discount").alias("north1"), F.col("l_extendedprice").alias("up1"),
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    c = pairing.community_standard(x, 1.5, -0.5, 2.0, keep)
    return c.select(*keep, "MT_ID", "TravelTime", *[F.round(n, 6).alias(n) for n in ("X_transmit", "Y_transmit", "Z_transmit", "X_receive")])


_E = sql_enu(("east0", "north0", "up0"), _CENTRE_XYZ, "45.0::DOUBLE", "-125.0::DOUBLE")


@query("P5_rectified", f"""WITH {SHOTS} SELECT event_id, 'S01' AS "SET", 'L01' AS LN, transponderID AS MT, value AS TT, false AS flag, round(pingTime, 6) AS ST, round(returnTime, 6) AS RT,
    round({_E[0]}, 4) AS ant_e0, round({_E[1]}, 4) AS ant_n0, round({_E[2]}, 4) AS ant_u0 FROM shots""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumns({"tt": F.col("value"), "east1": F.col("east0"), "north1": F.col("north0"), "up1": F.col("up0")} | {f"{a}{k}": F.lit(0.0) for a in ("head", "pitch", "roll") for k in (0, 1)})
    r = model_io.rectify(e.withColumn("transponderID", F.concat_ws("|", "transponderID", "event_id")), geodetic_to_ecef(*CENTRE, 0.0), *CENTRE)
    key = F.split("MT", r"\|")
    return r.select(F.get(key, 1).cast("long").alias("event_id"), "SET", "LN", F.get(key, 0).alias("MT"), "TT", "flag", F.round("ST", 6).alias("ST"), F.round("RT", 6).alias("RT"), *[F.round(c, 4).alias(c) for c in ("ant_e0", "ant_n0", "ant_u0")])


@query("P6_final_input", "SELECT event_id, 'M' || (user_id % 4) AS MT FROM events WHERE user_id % 4 IN (0, 2)")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("MT", F.col("transponderID"))
    known = e.where("user_id % 4 in (0, 2)").select("MT").distinct()
    return model_io.finalise(e, known).select("event_id", "MT")


@query("P19_transponder_positions", """WITH t AS (SELECT s_suppkey, 45.0::DOUBLE + (s_suppkey % 50) / 1000.0::DOUBLE AS la, -125.0::DOUBLE + (s_suppkey % 30) / 1000.0::DOUBLE AS lo, -s_acctbal / 10 AS h FROM supplier)
    SELECT s_suppkey, """ + ", ".join(f"round({e}, 4) AS {n}" for e, n in zip((*sql_ecef("la", "lo", "h"), *sql_enu(sql_ecef("la", "lo", "h"), _CENTRE_XYZ, "45.0::DOUBLE", "-125.0::DOUBLE")), ("x", "y", "z", "east", "north", "up"), strict=True)) + " FROM t")
def _(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "supplier").select("s_suppkey", (F.lit(45.0) + (F.col("s_suppkey") % 50) / F.lit(1000.0)).alias("la"), (F.lit(-125.0) + (F.col("s_suppkey") % 30) / F.lit(1000.0)).alias("lo"), (-F.col("s_acctbal") / 10).alias("h"))
    p = surveys.transponder_positions(t, "s_suppkey", "la", "lo", "h", (*CENTRE, 0.0))
    return p.select("s_suppkey", *[F.round(c, 4).alias(c) for c in ("x", "y", "z", "east", "north", "up")])


@query("F1_geodetic_to_ecef", f"WITH {SHOTS} SELECT event_id, round(east0, 4) AS x, round(north0, 4) AS y, round(up0, 4) AS z FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    return shots(s, d).select("event_id", *[F.round(c, 4).alias(n) for c, n in (("east0", "x"), ("north0", "y"), ("up0", "z"))])


@query("F2_ecef_to_enu", f"WITH {SHOTS} SELECT event_id, round({_E[0]}, 4) AS e, round({_E[1]}, 4) AS n, round({_E[2]}, 4) AS u FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    enu = ecef_to_enu(tuple(F.col(c) for c in ("east0", "north0", "up0")), geodetic_to_ecef(*CENTRE, 0.0), *CENTRE)
    return shots(s, d).select("event_id", *[F.round(c, 4).alias(n) for c, n in zip(enu, "enu", strict=True)])


@query("F3_geodetic_to_enu", f"WITH {SHOTS} SELECT event_id, round({_E[0]}, 4) AS e, round({_E[1]}, 4) AS n, round({_E[2]}, 4) AS u FROM shots WHERE event_type = 'view'")
def _(s: SparkSession, d: str) -> DataFrame:
    enu = geodetic_to_enu((F.col("latitude"), F.col("longitude"), F.col("height")), (*CENTRE, 0.0))
    return of_type(shots(s, d), "view").select("event_id", *[F.round(c, 4).alias(n) for c, n in zip(enu, "enu", strict=True)])


@query("F4_enu_round_trip", f"WITH {SHOTS} SELECT event_id, round(east0, 4) AS x, round(north0, 4) AS y, round(up0, 4) AS z FROM shots WHERE event_type = 'click'")
def _(s: SparkSession, d: str) -> DataFrame:
    origin = geodetic_to_ecef(*CENTRE, 0.0)
    enu = ecef_to_enu(tuple(F.col(c) for c in ("east0", "north0", "up0")), origin, *CENTRE)
    return of_type(shots(s, d), "click").select("event_id", *[F.round(c, 4).alias(n) for c, n in zip(enu_to_ecef(enu, origin, *CENTRE), "xyz", strict=True)])


# ---------------------------------------------------------------- aggregations


@query("A1_least_replies", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n >= 5")
def _(s: SparkSession, d: str) -> DataFrame:
    return filters.least_replies(table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), 5, ["l_orderkey"])


_RATES = """SELECT g.transponderID, g.b * 1000000 AS bin_us, coalesce(n, 0) AS n, round(coalesce(n, 0) / 40.0::DOUBLE * 100, 6) AS rate
    FROM (SELECT transponderID, unnest(range(lo, hi + 600, 600)) AS b FROM (SELECT transponderID, min(b) AS lo, max(b) AS hi FROM c GROUP BY transponderID)) g
    LEFT JOIN c ON c.transponderID = g.transponderID AND c.b = g.b"""


@query("A2_reply_rates", f"WITH {SHOTS}, c AS (SELECT transponderID, (epoch_us(ts) // 600000000) * 600 AS b, count(*) AS n FROM shots GROUP BY ALL) {_RATES}")
def _(s: SparkSession, d: str) -> DataFrame:
    r = report.reply_rates(shots(s, d), ["transponderID"], "ts")
    return r.select("transponderID", F.unix_micros("bin").alias("bin_us"), "n", F.round("rate", 6).alias("rate"))


@query("flagship_survey_reply_counts", f"""WITH {SHOTS}, {SURVEYS}, a AS (SELECT *, count(*) OVER (PARTITION BY transponderID, floor(pingTime / 3600)) AS k FROM shots WHERE {_OK}),
    c AS (SELECT survey_id, transponderID, (epoch_us(ts) // 600000000) * 600 AS b, count(*) AS n FROM a JOIN surveys ON ts BETWEEN s AND e WHERE k >= 2 GROUP BY ALL),
    g AS (SELECT survey_id, transponderID, unnest(range(lo, hi + 600, 600)) AS b FROM (SELECT survey_id, transponderID, min(b) AS lo, max(b) AS hi FROM c GROUP BY survey_id, transponderID))
    SELECT g.survey_id, g.transponderID, g.b * 1000000 AS bin_us, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (survey_id, transponderID, b)""")
def flagship(s: SparkSession, d: str) -> DataFrame:
    """10-minute reply counts per transponder and survey after quality filtering: filter, count, range join, window aggregate."""
    good = filters.acoustic(shots(s, d).select("ts", "pingTime", "transponderID", "snr", "dbv", "xc"))
    good = good.withColumn("hour", F.floor(F.col("pingTime") / 3600))
    good = filters.least_replies(good, 2, ["transponderID", "hour"])
    r = report.reply_rates(surveys.assign_surveys(good, survey_table(s, d), "ts", ["survey_id"]), ["survey_id", "transponderID"], "ts")
    return r.select("survey_id", "transponderID", F.unix_micros("bin").alias("bin_us"), "n")


@query("A3_survey_totals", """SELECT count(DISTINCT l_orderkey) AS pings, count(*) AS replies, count(DISTINCT l_orderkey) FILTER (l_quantity > 25) AS filtered_pings, count(*) FILTER (l_quantity > 25) AS filtered_replies,
    round(count(DISTINCT l_orderkey) FILTER (l_quantity > 25) * 100.0::DOUBLE / count(DISTINCT l_orderkey), 4) AS filtered_percent FROM lineitem""")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select("l_orderkey", "l_quantity")
    return report.survey_totals(li, li.where("l_quantity > 25"), "l_orderkey")


@query("A4_unflagged_share", f"""WITH {SHOTS} SELECT transponderID, count(*) AS n_raw, count(*) FILTER (event_type != 'error') AS n_unflagged,
    round(count(*) FILTER (event_type != 'error') * 100.0::DOUBLE / count(*), 1) AS percent FROM shots GROUP BY transponderID""")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.unflagged_share(shots(s, d), "transponderID", F.col("event_type") == "error")


@query("A5_remaining_counts", f"WITH {SHOTS} SELECT transponderID, count(*) AS n FROM shots WHERE event_type != 'error' GROUP BY transponderID")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.remaining_counts(shots(s, d), "transponderID", F.col("event_type") == "error")


@query("A6_residual_quartiles", """SELECT round(quantile_cont(abs(value), 0.25), 6) AS q1, round(quantile_cont(abs(value), 0.5), 6) AS median, round(quantile_cont(abs(value), 0.75), 6) AS q3, round(max(abs(value)), 6) AS max
    FROM events WHERE abs(value) < 50""")
def _(s: SparkSession, d: str) -> DataFrame:
    r = report.residual_quartiles(shots(s, d), "value", 50.0)
    return r.select(*[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "max")])


@query("A7_residual_histogram", """WITH c AS (SELECT CAST(least(floor(abs(value) / 0.5::DOUBLE), 98) AS INTEGER) AS bin, count(*) AS n FROM events WHERE abs(value) <= 99 * 0.5::DOUBLE GROUP BY 1)
    SELECT bin, n, round(n / (sum(n) OVER () * 0.5::DOUBLE), 6) AS density FROM c""")
def _(s: SparkSession, d: str) -> DataFrame:
    r = report.residual_histogram(shots(s, d), "value", 50.0, 0.5)
    return r.select("bin", "n", F.round("density", 6).alias("density"))


@query("A8_offset_summary", " UNION ALL ".join(f"""SELECT '{c}' AS axis, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
    round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem""" for c in ("l_quantity", "l_discount", "l_tax")))
def _(s: SparkSession, d: str) -> DataFrame:
    return report.offset_summary(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], 4)


@query("A9_harmonic_mean", "SELECT round(count(p_retailprice) / sum(1 / p_retailprice), 6) AS harmonic_mean FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return model_io.harmonic_mean(table(s, d, "part"), "p_retailprice").select(F.round("harmonic_mean", 6).alias("harmonic_mean"))


@query("A9_residual_range", "SELECT event_id, round(value / 1000 * (SELECT count(p_retailprice) / sum(1 / p_retailprice) FROM part) / 2, 6) AS ResiRange FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("ResiTT", F.col("value") / 1000)
    return model_io.residual_range(e, table(s, d, "part"), "p_retailprice").select("event_id", F.round("ResiRange", 6).alias("ResiRange"))


@query("A10_mean_directions", f"""WITH {SHOTS} SELECT transponderID AS MT, round(avg(cos(radians(snr)) * cos(radians(value))), 6) AS delta_x, round(avg(cos(radians(snr)) * sin(radians(value))), 6) AS delta_y,
    round(avg(sin(radians(value))), 6) AS delta_z FROM shots GROUP BY transponderID""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).select(F.col("transponderID").alias("MT"), F.col("snr").alias("TakeOff"), F.col("value").alias("head1"))
    return model_io.mean_directions(e).select("MT", *[F.round(c, 6).alias(c) for c in ("delta_x", "delta_y", "delta_z")])


@query("A11_array_centre", "SELECT round(avg(s_acctbal), 4) AS s_acctbal, round(avg(s_suppkey), 4) AS s_suppkey FROM supplier")
def _(s: SparkSession, d: str) -> DataFrame:
    c = model_io.array_centre(table(s, d, "supplier"), ["s_acctbal", "s_suppkey"])
    return c.select(*[F.round(x, 4).alias(x) for x in c.columns])


@query("A12_unique_dates", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.unique_dates(table(s, d, "events"), "ts").select(F.col("day").cast("string").alias("day"))


@query("A13_type_counts", "SELECT source, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY source")
def _(s: SparkSession, d: str) -> DataFrame:
    from fathom.operators import catalog

    return catalog.type_counts(table(s, d, "documents").select("source", "text"), "source", "text")


@query("A15_epoch_counts", """SELECT l_orderkey, count(DISTINCT (l_suppkey % 4, l_partkey)) AS n_satellites,
    array_to_string(list_sort(list_distinct(list(l_suppkey % 4))), ',') AS systems, count(*) AS n_observations FROM lineitem GROUP BY l_orderkey""")
def _(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_suppkey") % 4).alias("sys"))
    return report.epoch_counts(li, "l_orderkey", "sys", "l_partkey")


def _by_day(s: SparkSession, d: str) -> DataFrame:
    return shots(s, d).select("pingTime", (F.col("user_id") % 5).alias("station"), F.to_date("ts").alias("day"))


_DIFF = "d AS (SELECT user_id % 5 AS station, pingTime - lag(pingTime) OVER (PARTITION BY user_id % 5 ORDER BY pingTime) AS g FROM shots)"


@query("A16_gap_summary", f"WITH {SHOTS}, {_DIFF} SELECT station, round(min(g), 6) AS min_gap, count(*) FILTER (g < 600) AS n_short, round(coalesce(avg(g) FILTER (g < 600), 0), 6) AS mean_short FROM d WHERE g IS NOT NULL GROUP BY station")
def _(s: SparkSession, d: str) -> DataFrame:
    g = temporal.gap_summary(_by_day(s, d), ["station"], "pingTime", 600.0, "day")
    return g.select("station", F.round("min_gap", 6).alias("min_gap"), "n_short", F.round("mean_short", 6).alias("mean_short"))


@query("A17_gap_histogram", f"WITH {SHOTS}, {_DIFF}, k AS (SELECT g * 10 / 2000.0::DOUBLE - 0.5::DOUBLE AS k FROM d WHERE g IS NOT NULL) SELECT CAST(least(floor(k), 48) AS INTEGER) AS bin, count(*) AS n FROM k WHERE k >= 0 AND k <= 49 GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return temporal.gap_histogram(_by_day(s, d), ["station"], "pingTime", 2000.0, part="day")


@query("A18_coverage", "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, epoch_us(min(o_orderdate)) AS first_us, epoch_us(max(o_orderdate)) AS last_us FROM orders GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    c = report.coverage(table(s, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("t")), "t")
    return c.select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "days", F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"))


@query("A19_cast_extremes", "SELECT min(p_size) AS min_depth, max(p_size) AS max_depth, min(p_retailprice) AS min_speed, max(p_retailprice) AS max_speed FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.cast_extremes(table(s, d, "part"), "p_size", "p_retailprice")


@query("A20_r_squared", "SELECT round(((1 - sum(power(value - value * 0.9::DOUBLE, 2)) / (var_pop(value) * count(value))) + (1 - sum(power(value - (value + 1), 2)) / (var_pop(value) * count(value)))) / 2, 6) AS r2 FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).select("value", (F.col("value") * F.lit(0.9)).alias("p"), (F.col("value") + 1).alias("q"))
    return temporal.r_squared(e, [("value", "p"), ("value", "q")]).select(F.round("r2", 6).alias("r2"))


@query("A21_largest_offsets", f"WITH {SHOTS} SELECT 'snr' AS axis, round(max(abs(snr - value)), 6) AS max_offset, max(abs(snr - value)) > 1 AS \"over\" FROM shots UNION ALL SELECT 'dbv', round(max(abs(dbv + value % 45)), 6), max(abs(dbv + value % 45)) > 1 FROM shots")
def _(s: SparkSession, d: str) -> DataFrame:
    e = shots(s, d).withColumn("m", -(F.col("value") % 45))
    return report.largest_offsets(e, {"snr": ("snr", "value"), "dbv": ("dbv", "m")}).withColumn("max_offset", F.round("max_offset", 6))


@query("A23_survey_descriptors", f"""WITH {SHOTS}, {SURVEYS}, a AS (SELECT * FROM shots JOIN surveys ON ts BETWEEN s AND e) SELECT survey_id, count(event_id) AS n_shots,
    array_to_string(list_sort(list_distinct(list(transponderID))), ',') AS transponders, count(DISTINCT transponderID) AS n_transponders FROM a GROUP BY survey_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    own = survey_table(s, d)
    a = surveys.assign_surveys(shots(s, d).select("ts", F.col("transponderID").alias("MT")), own, "ts", ["survey_id"])
    return model_io.survey_descriptors(a, own, a, ["survey_id"]).select("survey_id", "n_shots", "transponders", "n_transponders")


@query("A24_final_position", "SELECT s_nationkey AS run, round(avg(s_acctbal) + min(n_regionkey), 4) AS x FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_nationkey")
def _(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("run")).agg(F.avg("s_acctbal").alias("x"))
    o = table(s, d, "nation").select(F.col("n_nationkey").alias("run"), F.col("n_regionkey").cast("double").alias("x"))
    return model_io.final_position(c, o, "run", ["x"]).select("run", F.round("x", 4).alias("x"))


@query("A22_status_counts", "SELECT user_id % 10 AS file, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return report.status_counts(shots(s, d).withColumn("file", F.col("user_id") % 10), "file", F.when(F.col("event_type") == "error", "failed").otherwise("ok"))


@query("job_survey_input", f"""WITH {SHOTS}, {SURVEYS}, a AS (SELECT * FROM shots JOIN surveys ON ts BETWEEN s AND e WHERE event_type != 'error' AND {_OK})
    SELECT survey_id, 'M' || (user_id % 4) AS MT, count(*) AS n, round(max(value), 6) AS longest FROM a
    WHERE sqrt(power(east0 - {_CENTRE_XYZ[0]}, 2) + power(north0 - {_CENTRE_XYZ[1]}, 2)) <= 4000 AND user_id % 4 IN (0, 2) GROUP BY ALL""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Shots of surveys, filtered, in the model's columns, of two of the four transponders."""
    e = shots(s, d).where("event_type != 'error'")
    e = e.withColumns({"tt": F.col("value"), "east1": F.col("east0"), "north1": F.col("north0"), "up1": F.col("up0")} | {f"{a}{k}": F.lit(0.0) for a in ("head", "pitch", "roll") for k in (0, 1)})
    known = e.where("user_id % 4 in (0, 2)").select(F.col("transponderID").alias("MT")).distinct()
    config = {"ping_replies": {"enabled": False}, "max_distance": {"metres": 4000.0}}
    out = jobs.survey_input(e, survey_table(s, d), "center", CENTRE, None, known, config)
    return out.groupBy("survey_id", "MT").agg(F.count("*").alias("n"), F.round(F.max("TT"), 6).alias("longest"))
