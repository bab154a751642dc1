"""Statistics behind the reports: reply rates, residuals, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.sources.workspace import stable

#: Replies of a transponder in ten minutes that count as 100 %.
NOMINAL_REPLIES = 40
#: Parts into which a span of values is cut to find exact quantiles; values of a part from which on it is cut again.
BUCKETS, SORTED = 1024, 50_000
#: The largest finite number.
MOST = 1.7976931348623157e308


def reply_rates(df: DataFrame, keys: list[str], ts: str, minutes: int = 10) -> DataFrame:
    """Replies per key and time bin, empty bins between a key's first and last one included, and the rate in percent.

    Bins are counted before anything else, so the fill works on as many rows as there are bins.
    """
    width = minutes * 60
    bin_ = (F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000 * width)) * width).cast("long")
    counts = df.where(F.col(ts).isNotNull()).groupBy(*keys, bin_.alias("bin_start")).agg(F.count("*").alias("n"))
    nxt = F.lead("bin_start").over(Window.partitionBy(*keys).orderBy("bin_start"))
    gaps = counts.withColumn("_next", F.coalesce(nxt, F.col("bin_start") + width))
    every = gaps.withColumn("_bin", F.explode(F.expr(f"sequence(bin_start, _next - {width}, {width}L)")))
    n = F.when(F.col("_bin") == F.col("bin_start"), F.col("n")).otherwise(F.lit(0)).cast("long")
    return every.select(*keys, F.timestamp_seconds("_bin").alias("bin"), n.alias("n"), (n / F.lit(NOMINAL_REPLIES) * 100).alias("rate"))


def survey_totals(raw: DataFrame, filtered: DataFrame, ping: str) -> DataFrame:
    """Distinct pings and replies before and after filtering, and the percentage of pings that is left."""
    a = raw.agg(F.countDistinct(ping).alias("pings"), F.count("*").alias("replies"))
    b = filtered.agg(F.countDistinct(ping).alias("filtered_pings"), F.count("*").alias("filtered_replies"))
    return a.crossJoin(b).withColumn("filtered_percent", F.round(F.col("filtered_pings") * 100.0 / F.col("pings"), 4))


def unflagged_share(df: DataFrame, key: str, flag: Column) -> DataFrame:
    kept = F.sum(F.when(flag, 0).otherwise(1))
    return df.groupBy(key).agg(F.count("*").alias("n_raw"), kept.alias("n_unflagged"), F.round(kept * 100.0 / F.count("*"), 1).alias("percent"))


def exact_quantiles(df: DataFrame, column: str, names: dict[str, float], keys: list[str]) -> DataFrame:
    """(keys, names): exact quantiles of each key's values, interpolated between neighbours; nulls and NaN don't count.

    Each key's values are counted in BUCKETS equal parts of their span; of the parts that hold a wanted rank, those with
    more than SORTED values that are not all equal are cut again, between their own least and largest value. What is left
    is counted value by value. So all that is exchanged are counts, and equal values, however many, are one of them.
    """
    x = F.col("_x")
    values = df.select(*keys, F.col(column).cast("double").alias("_x")).where("_x is not null and not isnan(_x)")
    whole = values.groupBy(*keys).agg(F.count("*").alias("_all"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).where("_all > 0")
    whole = stable(whole.select(*keys, "_all", F.lit(0).cast("long").alias("_before"), F.col("_all").alias("_n"), "_lo", "_hi"), "quantiles")
    places = F.array(*[F.struct(F.lit(n).alias("name"), ((F.col("_all") - 1) * F.lit(q)).alias("at")) for n, q in names.items()])
    wanted = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p["at"]), F.ceil(p["at"])))))
    holds = F.exists(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))

    def inside(parts: DataFrame) -> DataFrame:
        """The values that lie in the parts, which are few for each key, with the part's columns."""
        both = values.join(parts, keys) if keys else values.crossJoin(F.broadcast(parts))
        return both.where((x >= F.col("_lo")) & (x <= F.col("_hi")))

    done, open_ = [], whole
    while True:
        large = (F.col("_n") > SORTED) & (F.col("_lo") < F.col("_hi"))
        done.append(open_.where(~large))
        open_ = open_.where(large)
        if open_.isEmpty():
            break
        lo, hi = F.col("_lo"), F.col("_hi")
        half = lambda c: F.least(F.greatest(c, F.lit(-MOST)), F.lit(MOST)) / 2
        wide = (half(x) - half(lo)) / F.nullif(half(hi) - half(lo), F.lit(0.0))  # where the span itself is no finite number
        share = F.when(x == lo, 0.0).when(hi - lo <= MOST, (x - lo) / (hi - lo)).otherwise(wide)
        counts = inside(open_).groupBy(*keys, "_all", F.col("_before").alias("_start"), F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("_bucket"))
        counts = counts.agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        ahead = Window.partitionBy(*keys, "_start").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        open_ = stable(counts.where(holds).select(whole.columns), "quantiles")
    parts = done[0]
    for more in done[1:]:
        parts = parts.unionByName(more)
    apart = inside(parts.where("_lo < _hi")).groupBy(*keys, "_all", F.col("_before").alias("_start"), "_x").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*keys, "_start").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    apart = apart.select(*keys, "_all", (F.col("_start") + F.coalesce(F.sum("_n").over(ahead), F.lit(0))).alias("_before"), "_n", "_x")
    found = apart.unionByName(parts.where("_lo = _hi").select(*keys, "_all", "_before", "_n", F.col("_lo").alias("_x"))).where(holds)

    def weight(q: float) -> Column:
        """What a value adds to the quantile: the share of its lower neighbour's rank and of its upper one's that it holds."""
        at = (F.col("_all") - 1) * F.lit(q)
        has = lambda r: ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_n"))).cast("double")
        up = at - F.floor(at)
        return has(F.floor(at)) * (1 - up) + has(F.floor(at) + 1) * up

    return found.groupBy(*keys).agg(*[F.sum(F.when(weight(q) > 0, weight(q) * x)).alias(n) for n, q in names.items()])


def residual_quartiles(df: DataFrame, column: str, below: float = 50.0, keys: list[str] | None = None) -> DataFrame:
    """Exact quartiles and maximum of the absolute values below a limit."""
    keys = keys or []
    inside = df.select(*keys, F.abs(F.col(column)).alias("_a")).where(F.col("_a") < below)
    most = inside.groupBy(*keys).agg(F.max("_a").alias("max"))
    quartiles = exact_quantiles(inside, "_a", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    return quartiles.join(most, keys) if keys else quartiles.crossJoin(most)  # one row each


def residual_histogram(df: DataFrame, column: str, limit: float, width: float = 0.05) -> DataFrame:
    """Density of absolute values in bins [k width, (k + 1) width) up to limit - width; the last bin's end belongs to it."""
    last = round(limit / width) - 2
    a = F.abs(F.col(column))
    inside = df.where(a <= F.lit((last + 1) * width)).select(F.least(F.floor(a / F.lit(width)), F.lit(last)).cast("int").alias("bin"))
    counts = inside.groupBy("bin").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select("bin", "n", (F.col("n") / (F.col("_total") * F.lit(width))).alias("density"))


def offset_summary(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """A row per column: count, mean, sample deviation, least, quartiles, largest."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("x")) for c in columns])).alias("s")).select("s.*")
    r = lambda c: F.round(c, digits)
    names = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    sums = long.groupBy("axis").agg(F.count("x").alias("n"), r(F.avg("x")).alias("mean"), r(F.stddev_samp("x")).alias("std"), r(F.min("x")).alias("min"), r(F.max("x")).alias("max"))
    quartiles = exact_quantiles(long, "x", names, ["axis"]).select("axis", *[r(F.col(n)).alias(n) for n in names])
    return sums.join(quartiles, "axis", "left").select("axis", "n", "mean", "std", "min", *names, "max")


def remaining_counts(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """Rows of each key that are not flagged."""
    return df.where(~flag).groupBy(key).agg(F.count("*").alias("n"))


def cast_extremes(cast: DataFrame, depth: str = "depth", speed: str = "speed") -> DataFrame:
    """Least and largest depth and speed of a cast."""
    return cast.agg(*[f(c).alias(f"{n}_{name}") for c, name in ((depth, "depth"), (speed, "speed")) for f, n in ((F.min, "min"), (F.max, "max"))])


def largest_offsets(df: DataFrame, pairs: dict[str, tuple[str, str]], warn: float = 1.0) -> DataFrame:
    """Largest absolute difference of each named (predicted, original) pair, and whether it is over the limit."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("axis"), F.abs(F.col(a) - F.col(b)).alias("d")) for n, (a, b) in pairs.items()])).alias("s")).select("s.*")
    return long.groupBy("axis").agg(F.max("d").alias("max_offset")).withColumn("over", F.col("max_offset") > warn)


def unique_dates(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day")).distinct()


def coverage(df: DataFrame, ts: str) -> DataFrame:
    """Per month: distinct days, first and last time."""
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(F.countDistinct(F.to_date(ts)).alias("days"), F.min(ts).alias("first"), F.max(ts).alias("last"))


def epoch_counts(obs: DataFrame, epoch: str, system: str, satellite: str) -> DataFrame:
    """Satellites, systems and observations of each epoch."""
    return obs.groupBy(epoch).agg(F.countDistinct(system, satellite).alias("n_satellites"), F.array_join(F.array_sort(F.collect_set(system)).cast("array<string>"), ",").alias("systems"), F.count("*").alias("n_observations"))


def status_counts(df: DataFrame, file: str, status: Column) -> DataFrame:
    """Rows per file and status, and of each file in all."""
    return df.groupBy(file, status.alias("status")).agg(F.count("*").alias("n"))
