"""Surveys, validity intervals and site metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.geo import geodetic_to_ecef, geodetic_to_enu

def assign_surveys(df: DataFrame, surveys: DataFrame, ts: str, survey_columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows with each survey whose [start, end] holds their time, both ends inclusive; overlapping surveys each get a copy.

    keys are columns of both sides (network, station) in which rows and surveys must agree. The equi-join over them and
    days makes it scale with both sides: a survey is spread over its days, and a row meets only the surveys of its own day.
    """
    keys = keys or []
    days = surveys.select(*keys, *survey_columns, F.col("start").alias("_s"), F.col("end").alias("_e"), F.explode(F.sequence(F.to_date("start"), F.to_date("end"))).alias("_day"))
    left = df.withColumn("_day", F.to_date(ts))
    return left.join(days, [*keys, "_day"]).where(F.col(ts).between(F.col("_s"), F.col("_e"))).drop("_day", "_s", "_e")


def empty_surveys(df: DataFrame, surveys: DataFrame, ts: str, survey_id: str, keys: list[str] | None = None) -> DataFrame:
    """Surveys without any row."""
    own = [*(keys or []), survey_id]
    return surveys.join(assign_surveys(df, surveys, ts, [survey_id], keys).select(*own).distinct(), own, "left_anti")


def valid_from(intervals: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """(keys, _at, _found) of intervals (keys, start, end): from the microsecond _at on, up to the key's next row, the entry that is first by position.

    _found is (position, value) or null where no entry holds. A key's starts and ends are numbered, and an interval is laid
    out in blocks of 2^level numbers, two of each level at most; a place takes the first of the blocks that hold it. So the
    work grows with the entries and the logarithm of their number, however many of them overlap.
    """
    at = F.unix_micros("start")
    spans = intervals.where(F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("end") >= F.col("start"))))
    spans = spans.groupBy(*keys, at.alias("_from"), (F.unix_micros("end") + 1).alias("_to")).agg(F.min(F.struct(position, value)).alias("_first"))
    cuts = spans.select(*keys, F.explode(F.array_distinct(F.array("_from", F.coalesce("_to", "_from")))).alias("_at")).distinct()
    cuts = cuts.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_at")))
    last = cuts.groupBy(*keys).agg((F.max("_n") + 1).alias("_last"))
    ends = spans.join(cuts.select(*keys, F.col("_at").alias("_from"), F.col("_n").alias("_a")), [*keys, "_from"])
    ends = ends.join(cuts.select(*keys, F.col("_at").alias("_to"), F.col("_n").alias("_b")), [*keys, "_to"], "left").join(last, keys)
    levels = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int")))
    ends = ends.select(*keys, "_first", "_a", F.coalesce("_b", "_last").alias("_b")).select("*", levels(F.col("_b") - F.col("_a")).alias("_level"))
    size = F.pow(F.lit(2.0), F.col("_level"))
    ends = ends.withColumns({"_a": F.ceil(F.col("_a") / size), "_b": F.floor(F.col("_b") / size)}).where("_a < _b")
    blocks = F.array_compact(F.array(F.when(F.col("_a") % 2 == 1, F.col("_a")), F.when(F.col("_b") % 2 == 1, F.col("_b") - 1)))
    blocks = ends.select(*keys, "_level", F.explode(blocks).alias("_block"), "_first").groupBy(*keys, "_level", "_block").agg(F.min("_first").alias("_first"))
    places = cuts.join(last, keys).select(*keys, "_at", "_n", levels(F.col("_last")).alias("_level")).withColumn("_block", F.floor(F.col("_n") / size))
    return places.join(blocks, [*keys, "_level", "_block"], "left").groupBy(*keys, "_at").agg(F.min("_first").alias("_found"))


def valid_at(df: DataFrame, intervals: DataFrame, keys: list[str], ts: str, position: str, value: str, row_id: str) -> DataFrame:
    """Each row with the value valid at its time: of a key with one entry that one, else the first by position with start <= t and (end null or end >= t).

    Rows without a valid entry get null. Rows and changes of the valid entry are merged in time order per key and day; what
    a day takes over from those before is found on a row per key and day..
    """
    entries = intervals.select(*keys, "start", "end", position, value)
    single = entries.groupBy(*keys).agg(F.count("*").alias("_entries"), F.min(F.struct(position, value)).alias("_single")).where("_entries = 1").drop("_entries")
    day = F.floor(F.col("_at") / 86_400_000_000).alias("_day")
    rows = df.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), F.struct(*df.columns).alias("_row")).select("*", day)
    # A change to no entry is a struct that holds null, which ends the entry before.
    change = F.struct(F.col("_found"))
    changes = valid_from(entries, keys, position, value).select(*keys, "_at", change.alias("_change"), day)
    days = rows.select(*keys, "_day").distinct().select("*", F.lit(None).cast(changes.schema["_change"].dataType).alias("_last"))
    days = days.unionByName(changes.groupBy(*keys, "_day").agg(F.max_by("_change", "_at").alias("_last"))).groupBy(*keys, "_day").agg(F.first("_last", ignorenulls=True).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).join(single, keys, "left")
    taken = F.coalesce(F.when(F.col("_single").isNotNull(), F.struct(F.col("_single").alias("_found"))), "_carried")
    row_type = rows.schema["_row"].dataType
    no_row = F.lit(None).cast(row_type).alias("_row")
    # What is taken over stands before all of the day; the only entry of a key holds at every time.
    edges = days.select(*keys, F.lit(-(2**63)).alias("_at"), no_row, taken.alias("_change"), "_day").where("_change is not null")
    both = rows.select(*keys, "_at", "_row", F.lit(None).cast(changes.schema["_change"].dataType).alias("_change"), "_day")
    both = both.unionByName(changes.join(single, keys, "left_anti").select(*keys, "_at", no_row, "_change", "_day")).unionByName(edges)
    now = F.last("_change", ignorenulls=True).over(Window.partitionBy(*keys, "_day").orderBy(F.asc_nulls_last("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return both.select("_row", now.alias("_now")).where("_row is not null").select("_row.*", F.col(f"_now._found.{value}").alias(value))


def survey_at(df: DataFrame, surveys: DataFrame, ts: str, row_id: str, survey_id: str, position: str, keys: list[str] | None = None) -> DataFrame:
    """Each row with the first survey in list order that holds its time, or null."""
    hit = assign_surveys(df.select(row_id, ts, *(keys or [])), surveys, ts, [survey_id, position], keys)
    return df.join(hit.groupBy(row_id).agg(F.min_by(survey_id, position).alias(survey_id)), row_id, "left")


def active_benchmarks(surveys: DataFrame, benchmarks: DataFrame, site: str = "site") -> DataFrame:
    """(survey_id, benchmark_id): a benchmark of the survey's site that it lists, or that has no end or one at or after its start.

    An equi-join by site, of which a few benchmarks and surveys exist each.
    """
    b = benchmarks.select(F.col(site).alias("_site"), "benchmark_id", F.col("end").alias("_end"))
    listed = F.coalesce(F.array_contains("benchmark_ids", F.col("benchmark_id")), F.lit(False))
    open_ = F.col("_end").isNull() | (F.col("_end") >= F.col("start"))
    return surveys.join(b, F.col(site) == F.col("_site")).where(listed | open_).select("survey_id", "benchmark_id")


def turn_around_times(benchmarks: DataFrame, campaigns: DataFrame, site: str = "site") -> DataFrame:
    """(campaign, benchmark, transponder, tat): the entry of each transponder of the campaign's site valid at its start.

    benchmarks has one row per entry (site, benchmark, transponder, position, value, start, end).
    """
    rows = campaigns.select(site, "campaign", F.col("start").alias("_at")).join(benchmarks.select(site, "benchmark", "transponder").distinct(), site)
    rows = rows.withColumn("row", F.concat_ws("|", "campaign", "benchmark", "transponder"))
    return valid_at(rows, benchmarks.withColumnRenamed("value", "tat"), ["benchmark", "transponder"], "_at", "position", "tat", "row").select("campaign", "benchmark", "transponder", "tat")


def overlapping(surveys: DataFrame, keys: list[str], survey_id: str) -> DataFrame:
    """Adds overlaps: whether a survey ends after the next one of its key starts (strictly)."""
    nxt = F.lead("start").over(Window.partitionBy(*keys).orderBy("start", survey_id))
    return surveys.withColumn("overlaps", F.coalesce(F.col("end") > nxt, F.lit(False)))


def pseudo_surveys(df: DataFrame, ts: str, year: int, keys: list[str] | None = None) -> DataFrame:
    """A survey for each distinct day of the year that has rows: survey_id Y_M_D_number, from midnight to 23:59:59.999999."""
    keys = keys or []
    days = df.where(F.year(ts) == year).select(*keys, F.to_date(ts).alias("day")).distinct()
    number = F.row_number().over(Window.partitionBy(*keys, F.year("day")).orderBy("day"))
    start = F.col("day").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(F.date_add("day", 1).cast("timestamp")) - 1)
    return days.withColumn("number", number).select(
        *keys, F.format_string("%d_%d_%d_%d", F.year("day"), F.month("day"), F.day("day"), F.col("number")).alias("survey_id"), start.alias("start"), end.alias("end")
    )


def transponder_positions(df: DataFrame, id_: str, lat: str, lon: str, height: str, centre: tuple[Column | float, Column | float, Column | float]) -> DataFrame:
    """Approximate positions as Earth-centred x, y, z and relative to the array's centre as east, north, up."""
    xyz = geodetic_to_ecef(F.col(lat), F.col(lon), F.col(height))
    enu = geodetic_to_enu((F.col(lat), F.col(lon), F.col(height)), centre)
    return df.select(id_, *[c.alias(n) for c, n in zip((*xyz, *enu), ("x", "y", "z", "east", "north", "up"), strict=True)])


def incomplete(sites: DataFrame) -> DataFrame:
    """What is missing in sites (site, benchmarks array of struct(name, transponders array), campaigns array of struct(name, surveys array)): (site, part, name, problem)."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) < 1
    b = sites.select("site", F.explode("benchmarks").alias("b")).where(none("b.transponders")).select("site", F.lit("benchmark").alias("part"), F.col("b.name").alias("name"), F.lit("no transponders").alias("problem"))
    c = sites.select("site", F.explode("campaigns").alias("c")).where(none("c.surveys")).select("site", F.lit("campaign").alias("part"), F.col("c.name").alias("name"), F.lit("no surveys").alias("problem"))
    s = sites.where(none("benchmarks")).select("site", F.lit("site").alias("part"), F.col("site").alias("name"), F.lit("no benchmarks").alias("problem"))
    return s.unionByName(b).unionByName(c)
