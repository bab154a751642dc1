"""Input of the positioning model and what follows from its output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.geo import ecef_to_enu
from fathom.functions.text import transponder_code

ORDER = ["SET", "LN", "MT", "TT", "ResiTT", "TakeOff", "gamma", "flag", "ST", "ant_e0", "ant_n0", "ant_u0", "head0", "pitch0", "roll0", "RT", "ant_e1", "ant_n1", "ant_u1", "head1", "pitch1", "roll1"]


def rectify(shots: DataFrame, centre_xyz: tuple[Column | float, Column | float, Column | float], lat0: float, lon0: float) -> DataFrame:
    """Shots in the model's columns, both ends turned to the local system about the centre. Sort by ST where it is written."""
    ends = []
    for k in (0, 1):
        e, n, u = ecef_to_enu((F.col(f"east{k}"), F.col(f"north{k}"), F.col(f"up{k}")), centre_xyz, lat0, lon0)
        ends += [e.alias(f"ant_e{k}"), n.alias(f"ant_n{k}"), u.alias(f"ant_u{k}"), *[F.col(f"{a}{k}") for a in ("head", "pitch", "roll")]]
    zero = lambda n: F.lit(0.0).alias(n)
    return shots.select(
        F.lit("S01").alias("SET"), F.lit("L01").alias("LN"), F.col("transponderID").alias("MT"), F.col("tt").alias("TT"), zero("ResiTT"), zero("TakeOff"), zero("gamma"),
        F.lit(False).alias("flag"), F.col("pingTime").alias("ST"), F.col("returnTime").alias("RT"), *ends,
    ).select(*ORDER)


def finalise(observations: DataFrame, transponders: DataFrame) -> DataFrame:
    """Observations of known transponders (MT), names as M and digits."""
    coded = observations.withColumn("MT", transponder_code(F.col("MT")))
    known = transponders.select(transponder_code(F.col("MT")).alias("MT")).distinct()
    return coded.join(known, "MT", "left_semi")


def harmonic_mean(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.count(column) / F.sum(1 / F.col(column))).alias("harmonic_mean"))


def residual_range(df: DataFrame, cast: DataFrame, speed: str = "speed") -> DataFrame:
    """Adds ResiRange, the residual travel time as metres by the cast's harmonic mean speed (one row, sent to all tasks)."""
    return df.crossJoin(F.broadcast(harmonic_mean(cast, speed))).withColumn("ResiRange", F.col("ResiTT") * F.col("harmonic_mean") / 2).drop("harmonic_mean")


def mean_directions(df: DataFrame) -> DataFrame:
    """Mean direction cosines of each transponder; the third one is of the azimuth, as the model's reports have it."""
    take, azimuth = F.radians("TakeOff"), F.radians("head1")
    return df.groupBy("MT").agg(F.avg(F.cos(take) * F.cos(azimuth)).alias("delta_x"), F.avg(F.cos(take) * F.sin(azimuth)).alias("delta_y"), F.avg(F.sin(azimuth)).alias("delta_z"))


def array_centre(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def final_position(centres: DataFrame, offsets: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Centre plus estimated offset of each run."""
    both = centres.join(offsets.select(key, *[F.col(c).alias(f"_o_{c}") for c in columns]), key)
    return both.select(key, *[(F.col(c) + F.col(f"_o_{c}")).alias(c) for c in columns])


def survey_descriptors(shots: DataFrame, surveys: DataFrame, transponders: DataFrame, keys: list[str]) -> DataFrame:
    """One row per survey: its columns, the number of shots, the sorted transponders and their number."""
    counts = shots.groupBy(*keys).agg(F.count("*").alias("n_shots"))
    names = transponders.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("MT")), ",").alias("transponders"), F.countDistinct("MT").alias("n_transponders"))
    return surveys.join(counts, keys, "left").join(names, keys, "left").na.fill(0, ["n_shots", "n_transponders"])


def join_on_time(left: DataFrame, right: DataFrame, key: str, size: int = 256, parts: int = 8) -> DataFrame:
    """Residuals and what else is known of the same time: rows of both sides with an equal, not null key.

    A key has as many pairs as the product of its rows. So each side is cut into lists of `size` rows, and the pairs of lists are
    dealt to all tasks, which make the pairs of rows of two lists at a time. The lists of a key do meet in one task, one side's
    held there. Rows are cut in the order of all their columns, so that a task that runs again cuts the same lists.
    """
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def lists(df: DataFrame, name: str) -> DataFrame:
        cut = df.where(F.col(key).isNotNull()).select(key, F.struct(*[c for c in df.columns if c != key]).alias(name)).withColumn("_part", F.pmod(F.xxhash64(name), F.lit(parts)))
        cut = cut.withColumn("_cut", F.floor((F.row_number().over(Window.partitionBy(key, "_part").orderBy(name)) - 1) / size))
        return cut.groupBy(key, "_part", "_cut").agg(F.collect_list(name).alias(name)).select(key, name, F.struct("_part", "_cut").alias(f"{name}_id"))

    pairs = lists(left, "_left").join(lists(right, "_right"), key).repartition(tasks, key, "_left_id", "_right_id")
    return pairs.select(key, F.explode("_left").alias("_left"), "_right").select(key, "_left", F.explode("_right").alias("_right")).select(key, "_left.*", "_right.*")


def merged(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames, columns matched by name; one that a frame lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def extend_cast(cast: DataFrame, metres: int = 200) -> DataFrame:
    """The cast and metres - 1 rows below it, a metre apart, with the deepest row's speed."""
    last = cast.agg(F.max("depth").alias("d"), F.max_by("speed", "depth").alias("speed"))
    below = last.select(F.explode(F.sequence(F.lit(1), F.lit(metres - 1))).alias("k"), "d", "speed").select((F.col("d") + F.col("k")).alias("depth"), "speed")
    return cast.select("depth", "speed").unionByName(below)
