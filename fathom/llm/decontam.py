"""Benchmark decontamination as a prefix-filtered set join.

Each benchmark item is cut into windows of SIZE consecutive words, and a window is a set of shingles of SHINGLE words. A
document contains a window only if it contains all its shingles, so of the shingles ordered by rarity the prefix that
must match (size - ceil(1.0 * size) + 1 of them) is the rarest one. How often each shingle stands in all documents is
counted first. Then the documents give up only places of rarest shingles, each with the words that can belong to a
window around it; these meet the windows in an equi-join, bounds on place and length go first, and the words decide.

Documents are scanned twice and never shuffled. Tasks filter their shingles by a Bloom filter of the benchmark's, whose
size is bounded; the benchmark itself may have any size and is neither collected nor broadcast by this module.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import Written, mix, slices, text_buffers
from fathom.llm.packed import GATHERED
from fathom.llm.terms import BREAK, bloom, maybe_in, terms

SIZE = 10
SHINGLE = 3
#: A shingle of a frequent passage stands in very many documents: its places are dealt to so many tasks.
SALT = 16


def shingles(word: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first word and hash of every shingle of k words that lies in one row."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    h = np.full(len(at), mix(np.array([k], np.uint64))[0])
    for i in range(k):
        h = mix(h ^ word[at + i])
    return at, h


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, words, n, token, at): every window of every item with each of its shingles and the shingle's place in it.

    `words` are the window's n words joined by spaces. An item of fewer than `size` words is one window; one without
    words, or null, has none. Shingles of windows of fewer than SHINGLE words are the whole windows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for lo, hi in slices(offs):
                part, own = data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                low, start, end, row, word = terms(part, own)
                count = np.bincount(row, minlength=hi - lo)
                first = np.cumsum(count) - count
                out: list[list] = [[], [], [], [], []]
                for i in np.flatnonzero(count).tolist():
                    texts = [low[a:b].tobytes().decode() for a, b in zip(start[first[i] : first[i] + count[i]], end[first[i] : first[i] + count[i]], strict=True)]
                    n = min(size, len(texts))
                    k = min(SHINGLE, n)
                    token = shingles(word[first[i] : first[i] + count[i]], np.zeros(count[i], np.int64), k)[1].view(np.int64)
                    for w in range(len(texts) - n + 1):
                        out[0].append(lo + i)
                        out[1].append(" ".join(texts[w : w + n]))
                        out[2].append(n)
                        out[3].append(token[w : w + n - k + 1])
                        out[4].append(np.arange(n - k + 1, dtype=np.int32))
                if out[0]:
                    each = np.repeat(np.arange(len(out[0])), [len(x) for x in out[3]])
                    columns = [batch.column(0).take(pa.array(np.array(out[0])[each])), pa.array(out[1]).take(pa.array(each)), pa.array(np.array(out[2], np.int32)[each])]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(out[3])), pa.array(np.concatenate(out[4]))], names=["item", "words", "n", "token", "at"])

    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(cut, "item string, words string, n int, token long, at int")


def frequencies(docs: DataFrame, bits, sizes: list[int]) -> DataFrame:
    """(token, n): how often shingles that the filter lets pass stand in all texts; tasks sum their own first."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int64())], names=["token", "n"])

        for batch in batches:
            data, offs = text_buffers(batch.column(0))
            for lo, hi in slices(offs):
                _, _, _, row, word = terms(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                for k in sizes:
                    h = shingles(word, row, k)[1]
                    held.append(h[maybe_in(bits.value, h)])
                    count += len(held[-1])
                if count >= GATHERED:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(tally, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, bits, sizes: list[int], size: int) -> DataFrame:
    """(row, doc_id, n_words, found) of every document, found being (token, at, before, near) of each shingle that the filter lets pass.

    `near` is the lowered text from `before` words ahead of the shingle to as many behind it as a window can reach.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(2))
            for lo, hi in slices(offs):
                low, start, end, row, word = terms(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                count = np.bincount(row, minlength=hi - lo)
                first = np.cumsum(count) - count
                at, token, last = [], [], []
                for k in sizes:
                    a, h = shingles(word, row, k)
                    ok = maybe_in(bits.value, h)
                    at.append(a[ok])
                    token.append(h[ok])
                    last.append(a[ok] + size - 1)
                at, token, last = np.concatenate(at), np.concatenate(token), np.concatenate(last)
                order = np.argsort(at, kind="stable")
                at, token, last = at[order], token[order], last[order]
                begin = first[row[at]]
                near_from = np.maximum(at - size + 1, begin)
                near_to = np.minimum(last, begin + count[row[at]] - 1)
                near = [low[a:b].tobytes() for a, b in zip(start[near_from].tolist(), end[near_to].tolist(), strict=True)]
                found = pa.StructArray.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array((at - begin).astype(np.int32)), pa.array((at - near_from).astype(np.int32)), pa.array(near, pa.binary()).cast(pa.string())],
                    names=["token", "at", "before", "near"],
                )
                edges = np.searchsorted(row[at], np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), found)], names=["row", "doc_id", "n_words", "found"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(scan, f"row long, doc_id {kind}, n_words long, found array<struct<token:long,at:int,before:int,near:string>>")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items of every row of `docs` (doc_id, text).

    Words are lowered runs of ASCII letters and digits and of all that is not ASCII. A word is hit that lies inside an
    occurrence of a window of any row of `benchmark` (item_id, text), that is, of its `size` consecutive words, or of all
    of them if it has fewer. spans are the occurrences (first word, word after the last one), items the sorted ids, as
    strings, of the items that have one. Null and empty texts have no words; rows that repeat a doc_id are judged each;
    rows that repeat an item_id are one item; windows of items with a null id hit words but add no item. Empty tables are
    allowed on both sides, other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    cut = Written(windows(benchmark, size), "windows")
    sizes = sorted(min(r["n"], SHINGLE) for r in cut.df.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()) or [SHINGLE]
    every = spark.sparkContext.broadcast(bloom(cut.df.select("token").distinct()))
    often = Written(frequencies(docs, every, sizes), "frequencies")
    # Of each window the rarest shingle, the necessary prefix of its order; ties are settled the same way in all windows.
    rare = F.min(F.struct(F.coalesce(F.col("often"), F.lit(0)).alias("often"), "token", "at")).alias("rare")
    prefix = cut.df.join(often.df.select("token", F.col("n").alias("often")), "token", "left").groupBy("item", "words", "n").agg(rare)
    chosen = Written(prefix.select("item", "words", "n", "rare.token", "rare.at"), "prefixes")
    cut.drop()
    often.drop()
    every.unpersist()
    rarest = spark.sparkContext.broadcast(bloom(chosen.df.select("token").distinct()))
    seen = Written(candidates(docs, rarest, sizes, size), "seen")

    place = seen.df.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*").withColumn("salt", F.pmod("row", F.lit(SALT)))
    window = chosen.df.select("item", "words", "n", "token", F.col("at").alias("inside")).withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALT - 1}L)")))
    begin = F.col("at") - F.col("inside")
    fits = (begin >= 0) & (begin + F.col("n") <= F.col("n_words"))
    own = F.array_join(F.slice(F.split("near", BREAK), F.col("before") - F.col("inside") + 1, F.col("n")), " ")
    hit = place.join(window, ["token", "salt"]).where(fits).where(own == F.col("words"))
    by_row = hit.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(begin.alias("begin"), (begin + F.col("n")).alias("end")))).alias("spans"), F.sort_array(F.collect_set("item")).alias("items")
    )
    n_hit = F.expr("""aggregate(spans, named_struct('n', 0L, 'upto', 0),
        (s, x) -> named_struct('n', s.n + greatest(0, x.end - greatest(x.begin, s.upto)), 'upto', greatest(s.upto, x.end)), s -> s.n)""")
    out = seen.df.select("row", "doc_id", "n_words").join(by_row, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        "spans",
        "items",
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of `docs`, with all columns, whose doc_id has no hit in any row; rows with a null doc_id stay."""
    bad = contamination(docs.select("doc_id", "text"), benchmark, size).where("contaminated and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["_id"], "left_anti")
