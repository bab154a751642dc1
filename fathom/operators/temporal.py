"""Joins and windows over time. Times are doubles in seconds, long in milliseconds where said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.sources.workspace import stable


def nearest_asof(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, tolerance: float, left_id: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the nearest right row within the tolerance (inclusive), else nulls.

    Of two at equal distance the earlier one wins, of equal times the first by values. Bins of the tolerance's width
    make it an equi-join: only the right side is copied, into three bins.
    """
    l = left.withColumn("_bin", F.floor(F.col(left_time) / tolerance))
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(right_time).alias("_t"), *[F.col(v).alias(f"_v_{v}") for v in values])
    r = r.where("_t is not null").withColumn("_bin_r", F.explode(F.array(*[F.floor(F.col("_t") / tolerance) + i for i in (-1, 0, 1)])))
    cond = (l["_bin"] == r["_bin_r"]) & (F.abs(l[left_time] - r["_t"]) <= tolerance)
    for k in keys:
        cond = cond & (l[k] == r[f"_k_{k}"])
    best = F.min(F.struct(F.abs(F.col(left_time) - F.col("_t")).alias("_d"), F.col("_t"), *[F.col(f"_v_{v}") for v in values]))
    found = l.join(r, cond).groupBy(left_id).agg(best.alias("_best"))
    return left.join(found, left_id, "left").select(*left.columns, F.col("_best._t").alias("match_time"), *[F.col(f"_best._v_{v}").alias(v) for v in values])


def radius_mean(points: DataFrame, samples: DataFrame, keys: list[str], point_time: str, sample_time: str, radius: float, point_id: str, values: list[str], weighting: str = "distance") -> DataFrame:
    """Per point: id, n_neighbours and the mean of the samples' values within the radius (inclusive); no row without any.

    weighting "distance" weighs by the inverse distance, and where samples lie at distance 0 takes the plain mean of
    those; "uniform" takes the plain mean. Sums are aggregated before the shuffle by point.
    """
    s = samples.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(sample_time).alias("_t"), *[F.col(v).alias(f"_v_{v}") for v in values])
    s = s.where("_t is not null").withColumn("_bin_s", F.explode(F.array(*[F.floor(F.col("_t") / radius) + i for i in (-1, 0, 1)])))
    p = points.select(point_id, *keys, F.col(point_time).alias("_p")).withColumn("_bin", F.floor(F.col("_p") / radius))
    cond = (p["_bin"] == s["_bin_s"]) & (F.abs(p["_p"] - s["_t"]) <= radius)
    for k in keys:
        cond = cond & (p[k] == s[f"_k_{k}"])
    near = p.join(s, cond).withColumn("_d", F.abs(F.col("_p") - F.col("_t")))
    at = F.col("_d") == 0
    if weighting == "uniform":
        means = [F.avg(f"_v_{v}").alias(v) for v in values]
    else:
        w = F.when(~at, 1 / F.col("_d"))
        means = [F.coalesce(F.avg(F.when(at, F.col(f"_v_{v}"))), F.sum(w * F.col(f"_v_{v}")) / F.sum(F.when(F.col(f"_v_{v}").isNotNull(), w))).alias(v) for v in values]
    return near.groupBy(point_id).agg(F.count("*").alias("n_neighbours"), *means)


def interpolate(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Left rows inside the right side's time span with the right values interpolated linearly.

    Both sides are merged in time order per key and day, and each row sees the right rows before and after it. A day also
    gets the last right row before it and the first one behind it, found on a row per key and day.
    """
    none = [F.lit(None).cast("double").alias(f"_v_{v}") for v in values]
    l = left.select(*keys, F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_row"), F.lit(None).cast("double").alias("_rt"), *none)
    r = right.groupBy(*keys, right_time).agg(*[F.min(v).alias(v) for v in values])
    r = r.select(*keys, F.col(right_time).alias("_t"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(right_time).alias("_rt"), *[F.col(v).cast("double").alias(f"_v_{v}") for v in values])
    names = ["_rt", *[f"_v_{v}" for v in values]]
    both = l.unionByName(r).withColumn("_day", F.floor(F.col("_t") / 86_400))
    sample = F.when(F.col("_rt").isNotNull(), F.struct(*names))
    days = both.groupBy(*keys, "_day").agg(F.min(sample).alias("_first"), F.max(sample).alias("_last"))
    earlier, later = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_day"), F.col("_day").desc()))
    days = days.select(*keys, "_day", F.last("_last", ignorenulls=True).over(earlier).alias("_a"), F.last("_first", ignorenulls=True).over(later).alias("_b"))
    days = days.select(*keys, "_day", F.explode(F.array("_a", "_b")).alias("_edge")).where("_edge is not null")
    edges = days.select(*keys, F.col("_edge._rt").alias("_t"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), *[F.col(f"_edge.{c}").alias(c) for c in names], "_day")
    both = both.unionByName(edges)
    before = Window.partitionBy(*keys, "_day").orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*keys, "_day").orderBy(F.col("_t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.select("*", *[F.last(c, ignorenulls=True).over(before).alias(f"{c}_a") for c in names], *[F.last(c, ignorenulls=True).over(after).alias(f"{c}_b") for c in names])
    both = both.where("_row is not null and _rt_a is not null and _rt_b is not null")
    share = F.when(F.col("_rt_b") > F.col("_rt_a"), (F.col("_t") - F.col("_rt_a")) / (F.col("_rt_b") - F.col("_rt_a"))).otherwise(F.lit(0.0))
    return both.select("_row.*", *[(F.col(f"_v_{v}_a") + share * (F.col(f"_v_{v}_b") - F.col(f"_v_{v}_a"))).alias(v) for v in values])


def _neighbours(df: DataFrame, keys: list[str], part: str | None, order: list[str], columns: list[str]) -> DataFrame:
    """Adds _before and _after, the columns of the rows next to each one in its key's order (null where there is none).

    With a part, whose order must agree with the rows', a window runs over one part of a key only; the rows at the edges
    of its neighbours are found on a row per part.
    """
    at = [F.col(k) for k in (*keys, *([part] if part else []))]
    w = Window.partitionBy(*at).orderBy(*order)
    row = F.struct(*columns)
    near = df.select("*", F.lag(row).over(w).alias("_before"), F.lead(row).over(w).alias("_after"))
    if part is None:
        return near
    edges = df.groupBy(*keys, part).agg(F.min_by(row, F.struct(*order)).alias("_first"), F.max_by(row, F.struct(*order)).alias("_last"))
    parts = Window.partitionBy(*keys).orderBy(part)
    edges = edges.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(part).alias("_part"), F.lag("_last").over(parts).alias("_b"), F.lead("_first").over(parts).alias("_a"))
    same = F.col(part).eqNullSafe(F.col("_part"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return near.join(edges, same).select(*df.columns, F.coalesce("_before", "_b").alias("_before"), F.coalesce("_after", "_a").alias("_after"))


def differences(df: DataFrame, keys: list[str], order: list[str], columns: list[str], part: str | None = None) -> DataFrame:
    """Adds d_<column>: each row's value minus that of the row before. Long keys can be worked on in parts, as of days."""
    near = _neighbours(df, keys, part, order, columns)
    return near.select(*df.columns, *[(F.col(c) - F.col(f"_before.{c}")).alias(f"d_{c}") for c in columns])


def velocities(df: DataFrame, keys: list[str], order: list[str], time: str, columns: list[str], part: str | None = None) -> DataFrame:
    """Adds v_<column>: change per second since the row before; the first row takes the second one's."""
    near = _neighbours(df, keys, part, order, [time, *[c for c in columns if c != time]])

    def speed(c: str, new: str, old: str) -> Column:
        value = lambda name, side: F.col(f"{side}.{name}") if side else F.col(name)
        return (value(c, new) - value(c, old)) / F.nullif(value(time, new) - value(time, old), F.lit(0.0))

    first = F.col(f"_before.{time}").isNull()
    return near.select(*df.columns, *[F.when(first, F.when(F.col(time).isNotNull(), speed(c, "_after", ""))).otherwise(speed(c, "", "_before")).alias(f"v_{c}") for c in columns])


def fill_both_ways(df: DataFrame, keys: list[str], order: list[str], columns: list[str], part: str | None = None) -> DataFrame:
    """Nulls take the next value, and behind the last one the last value. Long keys can be worked on in parts, as of days."""
    at = [*keys, *([part] if part else [])]
    w = Window.partitionBy(*at).orderBy(*order)
    # Looking back in reverse order is one pass; a frame that ends at the last row would be worked out anew for each row.
    onward = Window.partitionBy(*at).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if part is None:
        filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(onward), F.last(c, ignorenulls=True).over(back)) for c in columns}
        return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    place = lambda c: F.when(F.col(c).isNotNull(), F.struct(*order))
    ends = df.groupBy(*keys, part).agg(*[f(c, place(c)).alias(f"{n}{c}") for c in columns for f, n in ((F.min_by, "_first_"), (F.max_by, "_last_"))])
    earlier, later = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col(part), F.col(part).desc()))
    names = [f"{n}{c}" for c in columns for n in ("_next_", "_past_")]
    ends = ends.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(part).alias("_part"),
        *[F.last(f"{a}{c}", ignorenulls=True).over(o).alias(f"{n}{c}") for c in columns for a, o, n in (("_first_", later, "_next_"), ("_last_", earlier, "_past_"))],
    )
    same = F.col(part).eqNullSafe(F.col("_part"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = df.select("*", *[F.last(c, ignorenulls=True).over(o).alias(f"{n}{c}") for c in columns for o, n in ((onward, "_on_"), (back, "_back_"))])
    both = inside.join(ends.select(*[f"_k_{k}" for k in keys], "_part", *names), same)
    filled = {c: F.coalesce(f"_on_{c}", f"_next_{c}", f"_back_{c}", f"_past_{c}") for c in columns}
    return both.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def standard_scores(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Adds z_<column>: the value less its key's mean, over its key's population deviation; null where that is 0.

    Means and deviations are aggregated first, so no window holds a key's rows.
    """
    stats = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*[f(c).alias(f"{n}{c}") for c in columns for f, n in ((F.avg, "_m_"), (F.stddev_pop, "_s_"))])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(stats, same).select(*df.columns, *[((F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0))).alias(f"z_{c}") for c in columns])


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order: keep-first deduplication."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def decimate(df: DataFrame, keys: list[str], millis: str, every: int, carry_keys: list[str], flags: str) -> DataFrame:
    """Rows of epochs whose time in milliseconds is a multiple of `every`; skipped epochs' flags are not lost.

    The flag bits of skipped epochs are or-ed into the same carry_keys of the next kept epoch; where that epoch lacks
    them they are lost, as are those behind the last kept epoch. every <= 0 changes nothing. The epoch of a skipped
    row is found on the distinct epochs of its day; only behind a day's last kept epoch it is the first one of a later
    day, and those are found on a row per key and day.
    """
    if every <= 0:
        return df
    kept = F.pmod(F.col(millis), F.lit(every)) == 0
    epochs = df.select(*keys, millis).distinct().withColumn("_day", F.floor(F.col(millis) / 86_400_000))
    in_day = Window.partitionBy(*keys, "_day").orderBy(F.col(millis).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later_days = Window.partitionBy(*keys).orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = epochs.groupBy(*keys, "_day").agg(F.min(F.when(kept, F.col(millis))).alias("_first"))
    days = days.select(*keys, "_day", F.last("_first", ignorenulls=True).over(later_days).alias("_later"))
    epochs = epochs.withColumn("_next", F.last(F.when(kept, F.col(millis)), ignorenulls=True).over(in_day))
    epochs = epochs.join(days, [*keys, "_day"]).withColumn("_next", F.coalesce("_next", "_later")).drop("_day", "_later")
    skipped = df.where(~kept).join(epochs, [*keys, millis]).where("_next is not null")
    carried = skipped.groupBy(*keys, F.col("_next").alias(millis), *carry_keys).agg(F.bit_or(flags).alias("_bits"))
    out = df.where(kept).join(carried, [*keys, millis, *carry_keys], "left")
    return out.withColumn(flags, F.col(flags).bitwiseOR(F.coalesce("_bits", F.lit(0)))).select(*df.columns)


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Adds the row's place in its key's order, from 1, without a window over a key's rows.

    Rows are sorted in ranges of (keys, order), written once, and counted per range and key; a row's place is its place in
    the range after all of the ranges before. A key with most of the rows is spread over as many ranges as it fills.
    """
    held = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    held = stable(held, "ranges")
    counts = held.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"), (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = held["_range"] == starts["_r"]
    for k in keys:
        same = same & held[k].eqNullSafe(starts[f"_k_{k}"])
    return held.join(starts, same).select(*[held[c] for c in df.columns], (held["_at"] + F.col("_shift")).alias(name))


def model_order(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds position: the row's place in its key's order, from 1."""
    return ranked(df, keys, order)


def day_batches(df: DataFrame, ts: str) -> DataFrame:
    """The days that have rows, as text, and how many: the batches in which a table is worked on."""
    return df.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


def hour_slice(ts: Column, hours: int) -> Column:
    """The number of the slice of a day that a time is in, for slices of 1 to 24 hours."""
    return F.floor(F.hour(ts) / F.lit(min(24, max(1, hours)))).cast("int")


def of_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows of a year; all rows for a year of 0 or less."""
    return df if year <= 0 else df.where(F.year(ts) == year)


def gap_summary(df: DataFrame, keys: list[str], time: str, below: float = 1.0, part: str | None = None) -> DataFrame:
    """Per key: least difference of consecutive times, the number of those below the limit, and their mean (0 if none)."""
    d = differences(df, keys, [time], [time], part).where(f"d_{time} is not null")
    short = F.when(F.col(f"d_{time}") < below, F.col(f"d_{time}"))
    return d.groupBy(*keys).agg(F.min(f"d_{time}").alias("min_gap"), F.count(short).alias("n_short"), F.coalesce(F.avg(short), F.lit(0.0)).alias("mean_short"))


def gap_histogram(df: DataFrame, keys: list[str], time: str, scale: float = 1.0, bins: int = 49, part: str | None = None) -> DataFrame:
    """Counts of consecutive differences in bins with edges (k + 0.5) / 10 * scale seconds, k = 0..bins; the last edge is closed."""
    d = differences(df, keys, [time], [time], part).where(f"d_{time} is not null")
    k = F.col(f"d_{time}") * 10 / scale - F.lit(0.5)
    inside = d.where((k >= 0) & (k <= bins))
    return inside.groupBy(F.least(F.floor(k), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def r_squared(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """1 - residual sum of squares / total sum of squares of each (actual, predicted), averaged over the pairs."""
    sums = [F.sum(F.pow(F.col(a) - F.col(p), 2)).alias(f"_r{i}") for i, (a, p) in enumerate(pairs)] + [(F.var_pop(a) * F.count(a)).alias(f"_t{i}") for i, (a, _) in enumerate(pairs)]
    score = sum((1 - F.col(f"_r{i}") / F.col(f"_t{i}") for i in range(len(pairs))), F.lit(0.0)) / len(pairs)
    return df.agg(*sums).select(score.alias("r2"))
