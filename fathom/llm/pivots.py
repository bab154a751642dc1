"""Near copies among embeddings by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Vectors that share at least two of their
PREFIX nearest pivots are candidates: there is an inverted list for each pair of pivots, and a candidate pair is
handled in the list of its two smallest shared pivots alone, so that it counts once. The lists of one smallest pivot
lie in one bin, so a vector is sent once for each of its pivots and not for each pair. Candidates are verified by their
cosine in double precision, list by list in blocks; only counts and a spanning forest of the links leave a task's batch of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import Written, components, local_forest

#: Pivots, nearest pivots of a vector that count, vectors that the pivots are drawn from (a fixed bound), and the
#: largest cosine of two pivots: pivots from one dense group would order that group's vectors by noise alone.
PIVOTS = 256
PREFIX = 6
SAMPLE = 4096
APART = 0.6
#: Members of a list that one block takes; longer lists are cut into blocks, and pairs of blocks compared.
BLOCK = 512
#: Vectors of one smallest pivot whose lists a task holds together; of more, the lists are dealt to several bins.
BIN = 32768
#: Vectors whose postings are made at once.
POSTED = 2000


_NO_LINKS = (np.zeros(0, np.int64),) * 4


def choose_pivots(vectors: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to n of the vectors that are apart from each other, filled up with random directions."""
    chosen: list[np.ndarray] = []
    for v in vectors:
        if len(chosen) == n:
            break
        if not chosen or np.max(np.abs(np.array(chosen) @ v)) < APART:
            chosen.append(v)
    dims = vectors.shape[1]
    rng = np.random.default_rng(17)
    while len(chosen) < n:
        v = rng.normal(size=dims)
        chosen.append(v / np.linalg.norm(v))
    return np.array(chosen)


def nearest(vectors: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The numbers of each vector's nearest pivots, in order."""
    scores = vectors @ pivots.T
    top = np.argpartition(-scores, prefix - 1, axis=1)[:, :prefix]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(scores, top, 1), axis=1, kind="stable"), 1)


def unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length, scaled to length 1 in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(embeddings: DataFrame, cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `embeddings` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine is at least `cosine`.
    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing. Equal vectors are
    compared with others once: each copy has all the others' links and those to its copies. Rows with a null vec_id
    link with nothing and are their own (null) component. Rows that repeat a vec_id are vectors of their own, linked by
    their values: equal ones count each other as links, unlike ones may be in different components. A vector may be of any length.
    The pivots are drawn from SAMPLE vectors; all vectors are indexed.
    """
    spark = embeddings.sparkSession
    base = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].alias("v"), embeddings["label"].alias("label"))
    fine = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists("v", lambda x: x != 0)
    )
    good = base.where(fine)
    # -0.0 equals 0.0 in a grouping key, so equal vectors are one group.
    first = Written(good.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).withColumn("dims", F.size("v")), "vectors")
    sizes = [r[0] for r in first.df.groupBy("dims").count().orderBy(F.desc("count")).limit(1).collect()]
    if not sizes:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    drawn = first.df.where(F.col("dims") == sizes[0]).select("v", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE).toPandas()
    pivots = {sizes[0]: choose_pivots(unit(pa.array([list(x) for x in drawn["v"]], pa.list_(pa.float64()))))}
    sent = spark.sparkContext.broadcast(pivots)  # PIVOTS vectors, whatever the input

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(sent.value)
        for whole in batches:
            for begin in range(0, len(whole), POSTED):
                batch = whole.slice(begin, POSTED)
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims):
                    part = batch.take(pa.array(np.flatnonzero(dims == d)))
                    if d not in known:
                        known[d] = choose_pivots(np.zeros((0, d)))
                    sets = np.sort(nearest(unit(part.column("v")), known[d]), axis=1).astype(np.int32)
                    near = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * PREFIX), pa.array(sets.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*part.columns, near], names=[*part.schema.names, "near"])

    label_type, v_type = (dict(first.df.dtypes)[c] for c in ("label", "v"))
    described = first.df.select("id", "copies", "label", "dims", "v").mapInArrow(post, f"id long, copies long, label {label_type}, dims int, v {v_type}, near array<int>")
    vectors = Written(described, "described")
    # A vector's lists are the pairs p < q of its pivots. It travels once for each p, with its q's.
    bin_ = ["label", "dims", "p"]
    posted = vectors.df.withColumn("p", F.explode("near")).withColumn("qs", F.expr("filter(near, x -> x > p)")).where(F.size("qs") > 0)
    slim = posted.select(*bin_, "qs")
    lengths = slim.select(*bin_, F.explode("qs").alias("q")).groupBy(*bin_, "q").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    long_lists = Written(lengths.select(*bin_, "q", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "lists")
    per_bin = slim.groupBy(*bin_).agg(F.ceil(F.count("*") / BIN).cast("int").alias("parts"))
    left_out = long_lists.df.groupBy(*bin_).agg(F.collect_list("q").alias("long"))
    bins = Written(per_bin.join(left_out, bin_, "left"), "bins")
    columns = ["id", "copies", "near", "v"]
    short = posted.join(bins.df, bin_).withColumn("qs", F.expr("filter(qs, q -> long is null or not array_contains(long, q))"))
    short = short.withColumn("part", F.explode(F.expr("array_distinct(transform(qs, q -> q % parts))"))).withColumn("qs", F.expr("filter(qs, q -> q % parts = part)"))
    short = short.select(*bin_, "part", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("block"), "qs", *columns)
    # Long lists are cut into blocks, and pairs of blocks compared.
    long_ = posted.withColumn("q", F.explode("qs")).join(long_lists.df, [*bin_, "q"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    long_ = long_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    long_ = long_.select(*bin_, (-1 - F.col("q")).alias("part"), F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", F.array("q").alias("qs"), *columns)
    keys = [*bin_, "part", "lo", "hi"]
    index = short.union(long_).repartition(*keys).sortWithinPartitions(*keys)

    def compare(ids: np.ndarray, copies: np.ndarray, near: np.ndarray, v: np.ndarray, block: np.ndarray, high: int, cross: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Linked pairs (a, b) and weighted counts (id, links) of one block or pair of blocks."""
        left, right = (np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())) if cross else (np.arange(len(ids)),) * 2
        i, j = np.nonzero(v[left] @ v[right].T >= cosine)
        i, j = left[i], right[j]
        if not cross:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return _NO_LINKS
        # In this list only if its two pivots are the smallest that the two share.
        shared = ((near[i][:, :, None] == near[j][:, None, :]).any(axis=2) & (near[i] <= high)).sum(axis=1)
        i, j = i[shared == 2], j[shared == 2]
        who, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([copies[j], copies[i]]), minlength=len(who)).astype(np.int64)
        return ids[i], ids[j], ids[who], count

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def edges(table: pa.Table) -> np.ndarray:
            """The first rows of the groups of equal keys."""
            new = np.zeros(len(table), bool)
            new[:1] = True
            for k in keys:
                c = table.column(k).to_numpy(zero_copy_only=False)
                new[1:] |= c[1:] != c[:-1]
            return np.flatnonzero(new)

        def work(table: pa.Table) -> pa.RecordBatch:
            out: list[tuple] = []
            n = len(table)
            block, ids, copies, dims, lows, highs = (table.column(k).to_numpy() for k in ("block", "id", "copies", "dims", "lo", "hi"))
            group = np.searchsorted(edges(table), np.arange(n), "right")
            near = pa.concat_arrays(table.column("near").chunks).flatten().to_numpy().reshape(n, PREFIX)
            column = pa.concat_arrays(table.column("v").chunks)
            whole = unit(column) if (dims == dims[0]).all() else None
            qs = pa.concat_arrays(table.column("qs").chunks)
            row, q = np.repeat(np.arange(n), qs.value_lengths().to_numpy()), qs.flatten().to_numpy()
            order = np.lexsort((q, group[row]))
            row, q = row[order], q[order]
            new = np.ones(len(row), bool)
            new[1:] = (q[1:] != q[:-1]) | (group[row[1:]] != group[row[:-1]])
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(row))
            for lo, hi in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
                at = row[lo:hi]
                cross = bool(lows[at[0]] != highs[at[0]])
                if cross and len(np.unique(block[at])) < 2:
                    continue
                v = unit(column.take(pa.array(at))) if whole is None else whole[at]
                out.append(compare(ids[at], copies[at], near[at], v, block[at], int(q[lo]), cross))
            cat = lambda k: np.concatenate([np.zeros(0, np.int64), *[x[k] for x in out]])
            a, b, who, count = cat(0), cat(1), cat(2), cat(3)
            who, at = np.unique(who, return_inverse=True)
            count = np.bincount(at, weights=count, minlength=len(who)).astype(np.int64)
            if len(a):
                a, b = local_forest(a, b)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, who])), pa.array(np.concatenate([b, count])), pa.array(np.repeat([True, False], [len(a), len(who)]))], names=["a", "b", "link"])

        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            # Whole groups are worked on; the last group may go on in the next batch.
            start = int(edges(held)[-1]) if len(held) else 0
            if start > 0:
                yield work(held.slice(0, start))
                held = held.slice(start).combine_chunks()
        if held is not None and len(held):
            yield work(held)

    result = Written(index.mapInArrow(check, "a long, b long, link boolean"), "links")
    for done in (vectors, long_lists, bins):
        done.drop()
    counts = result.df.where("not link").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
    label = components(result.df.where("link").select("a", "b"))
    per_first = first.df.join(counts, "id", "left").join(label, "id", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    per_vector = good.join(per_first, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = base.where(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return per_vector.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
