"""Mixing sources to target weights, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Rows of a source that one window sums, about: sources are cut into so many ranges of the random key.
RANGE_ROWS = 100_000
LEAST_RANGES = 256


def word_count(text: Column) -> Column:
    """Words of a text as a long; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float, most: float, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> adds weight and target: shares by weight of `share` times all sizes, none above `most` times its size.

    Sharing an excess by weight again and again ends where all sources below their limit have the same target per
    weight; sources in order of limit per weight, that level is the first, and largest, one not above the next source's.
    Sources with size 0 have target 0. One row per source: the windows are over sources, never over documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    limit = F.lit(float(most)) * F.col("source_size")
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(onward))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("level", F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level")))
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("level") * F.col("weight"))))
        .select("source", "source_size", "weight", "target")
    )


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """What a mix of `share` times all words takes of each document: doc_id, size, source, source_size, target, taken.

    Each document has a random key, the MD5 of seed and doc_id. A source of S words gives all its documents
    floor(target / S) times (epochs), then a last epoch in key order up to the exact budget: the document on the
    cut gives only its first words. So taken sums to the rounded target, and is at most `most` times the size.
    The prefix sums are in two levels: within ranges of the key, and over the ranges' sums.

    Null texts and texts without words have size 0 and give 0; a null source is a source of its own, the last.
    Repeated rows count each, in the order doc_id (nulls first), size. An empty table gives an empty result.
    Other columns of `docs` are ignored, whatever their names.
    """
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = written(docs.select("doc_id", "source", source_key.alias("source_key"), word_count(F.col("text")).alias("size"), key.alias("key")), "sizes")
    n_ranges = max(LEAST_RANGES, sized.count() // RANGE_ROWS)
    # The ranges follow the key's order: its first 8 hex digits, scaled.
    sized = sized.withColumn("part", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * n_ranges / F.lit(2**32)).cast("long"))
    parts = sized.groupBy("source_key", "part").agg(F.first("source").alias("source"), F.sum("size").alias("part_size"))
    parts = written(parts, "ranges")
    per_source = targets(parts.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("part_size").alias("source_size")).drop("source_key"), share, most, weights)
    per_source = per_source.withColumn("source_key", source_key).drop("source")
    earlier = Window.partitionBy("source_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.join(per_source, "source_key").select("source_key", "part", "source_size", "target", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source_key", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.round("target").cast("long")
    return (
        sized.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(parts, ["source_key", "part"])
        .withColumn("ahead", F.col("ahead") + F.col("before"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("last", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead"))))
        .select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("last")).alias("taken"), "epochs", "last")
    )


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """The mix itself: rows with the columns of `docs`, once per epoch, and the text on the cut shortened to its first words (and n_chars with it).

    Documents that the mix takes nothing of are absent. Each document's share is found on (doc_id, source, size) and
    joined back by doc_id, so doc_id must identify rows; rows with a null doc_id or of a repeated one take the share
    of the largest row with that id.
    """
    taken = mix(docs, share, most, weights, seed).where("taken > 0")
    taken = taken.groupBy("doc_id").agg(F.max("epochs").alias("_epochs"), F.max("last").alias("_last"), F.max("size").alias("_size"))
    names = docs.columns
    both = docs.join(taken.withColumnRenamed("doc_id", "_id"), docs["doc_id"].eqNullSafe(F.col("_id")))
    copies = F.array_repeat(F.lit(-1).cast("long"), F.col("_epochs").cast("int"))
    copies = F.concat(copies, F.when(F.col("_last") > 0, F.array(F.col("_last"))).otherwise(F.array().cast("array<bigint>")))
    both = both.select(*[docs[c] for c in names], F.explode(copies).alias("_words"), "_size")
    # The text cut before each word; a text that begins with white space has one piece more.
    pieces = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    led = F.col("text").rlike(r"^[\x20\x09-\x0D]").cast("int")
    first = F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), F.col("_words").cast("int") + led), ""), r"[\x20\x09-\x0D]++$", "")
    text = F.when((F.col("_words") < 0) | (F.col("_words") >= F.col("_size")), F.col("text")).otherwise(first)
    both = both.withColumn("text", text)
    if "n_chars" in names:
        both = both.withColumn("n_chars", F.when((F.col("_words") < 0) | (F.col("_words") >= F.col("_size")), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return both.select(*names)
