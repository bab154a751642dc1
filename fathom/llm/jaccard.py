"""N-gram Jaccard join by partitioned universes.

Two sets x, y of similarity >= s differ in at most (1 - s) / (1 + s) * (|x| + |y|) elements. Sizes are cut into bands;
per band every element is hashed into one of its segments, more segments than elements can differ. So in one segment
at least similar sets agree wholly, or in a segment of double weight but for one element: a set's keys are hashes of
its segments, and for the double ones also those with one element taken away.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import Step, Written, exact_word_shingles, mix, word_shingles
from fathom.llm.near import Keys, Scheme, near_groups, normal, sliced

#: Elements that a plain segment has on average at least; fewer, and unlike sets share segments by chance.
FILL = 4
#: What a plain segment of fewer elements costs in keys, for the unlike sets that share it: CHANCE times the share of empty ones.
CHANCE = 12
#: Plain segments of at most so many elements are weak keys; a set leaves out as many of them as it has spare segments.
WEAK = 1


@cache
def bands(s: Fraction, most: int) -> list[int]:
    """The least sizes of the bands, up to size `most`: similar sets are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] <= most:
        out.append(math.floor(out[-1] / s) + 1)
    return out


@cache
def allocation(s: Fraction, least: int, most: int) -> tuple[int, int, int]:
    """Plain segments, double segments and spare ones for sets of least..most elements and their larger partners.

    Costs are counted in keys: a plain segment has one key, a double one a key per element more. A plain segment
    needs FILL elements to be worth having, so where sets are too small for that, double segments take over.
    """
    differ = math.floor((1 - s) / (1 + s) * (most + math.floor(most / s)))
    best = None
    for double in range(differ // 2 + 2):
        plain = max(0, differ + 1 - 2 * double)
        spare = 0
        if plain:
            weak = plain * math.exp(-least / (plain + 2 * double)) * (1 + least / (plain + 2 * double))
            spare = math.ceil(weak + 4 * math.sqrt(weak)) if weak > 0.01 else 1
        slots = plain + spare + 2 * double
        keys = plain + spare + double * (1 + 2 * most / slots)
        chance = (plain + spare) * math.exp(-least / slots) * CHANCE if plain and least / slots < FILL else 0
        if best is None or keys + chance < best[0]:
            best = (keys + chance, plain + spare, double, spare)
    return best[1:]


def keys_of_sets(row: np.ndarray, elements: np.ndarray, n_rows: int, s: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of sets of distinct 64-bit elements, given as (row, element) in the order of rows: the row of each key, the keys,
    whether each belongs to the set's own band (0) or the band below, for smaller partners (1), or -1 if it may not be
    left out; and for each row and band the number of keys that may be.

    Sets of a band have `spare` plain segments more than can differ, so similar ones agree in over `spare` segments. A set
    may leave out so many of its plain keys if their segments alone tell which: the weak ones here, frequent ones later.
    """
    edges = np.searchsorted(row, np.arange(n_rows + 1))
    size = np.diff(edges)
    starts = np.array(bands(s, 1 << max(8, int(size.max(initial=0)).bit_length())))
    own = np.searchsorted(starts, size, "right") - 1
    of, keys, family, free = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int8)], np.zeros((n_rows, 2), np.int32)
    for below in (0, 1):
        band = own - below
        use = (size > 0) & (band >= 0)
        if below:
            use &= s.numerator * size <= s.denominator * (starts[own] - 1)
        for b in np.unique(band[use]).tolist():
            mine = np.flatnonzero(use & (band == b))
            plain, double, spare = allocation(s, int(starts[b]), int(starts[b + 1]) - 1)
            n = plain + double
            h = mix(np.concatenate([elements[edges[i] : edges[i + 1]] for i in mine.tolist()]) ^ mix(np.array([b], np.uint64)))
            who = np.repeat(np.arange(len(mine)), size[mine])
            slot = ((h >> np.uint64(32)) * np.uint64(plain + 2 * double) >> np.uint64(32)).astype(np.int64)
            segment = np.where(slot < plain, slot, plain + (slot - plain) // 2)
            at = who * n + segment
            total = np.zeros(len(mine) * n, np.uint64)
            np.add.at(total, at, h)
            count = np.bincount(at, minlength=len(total)).reshape(len(mine), n)
            number = mix(np.arange(n, dtype=np.uint64) ^ np.uint64(b * 3 + 1))
            # The emptiest segments go first, so that of equal ones the fullest stays in both sets.
            drop = np.zeros(count.shape, bool)
            emptiest = np.argsort(count[:, :plain], axis=1, kind="stable")[:, :spare]
            np.put_along_axis(drop, emptiest, np.take_along_axis(count, emptiest, 1) <= WEAK, 1)
            free[mine, below] = spare - drop.sum(axis=1)
            i, j = np.nonzero(~drop)
            of.append(mine[i])
            keys.append(mix(total.reshape(count.shape)[i, j] + number[j]))
            family.append(np.where(j < plain, below, -1).astype(np.int8))
            inside = segment >= plain
            of.append(mine[who[inside]])
            keys.append(mix(total[at[inside]] - h[inside] + number[segment[inside]]))
            family.append(np.full(int(inside.sum()), -1, np.int8))
    return np.concatenate(of), np.concatenate(keys), np.concatenate(family), free


def set_keys(items: np.ndarray, s: Fraction) -> np.ndarray:
    """The keys of one set of distinct 64-bit elements."""
    return keys_of_sets(np.zeros(len(items), np.int64), items, 1, s)[1]


def scheme(k: int, similarity: Fraction) -> Scheme:
    """Documents as sets of k-word shingles."""

    def joined(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(items), np.uint8), np.cumsum([0, *map(len, items)])

    def keys(items: list[bytes]) -> Keys:
        row, h = word_shingles(*joined(items), k)
        of, found, family, free = keys_of_sets(row, h, len(items), similarity)
        return Keys(of, found, np.bincount(row, minlength=len(items)), family, free)

    return Scheme(lambda text: [text], keys, lambda items: exact_word_shingles(*joined(items), k), similarity)


def similar_documents(docs: DataFrame, k: int = 4, similarity: str = "0.85") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text): groups of documents linked by Jaccard similarity.

    Sets are distinct k-word shingles over A-Z lower-cased words; a text with fewer words is one shingle, a text
    without words (or null) has an empty set and links with nothing. Two documents link when intersection >= similarity
    * union, decided on the words themselves. component_id is the smallest doc_id reachable by links. Texts of equal
    words (by a 128-bit digest of them) are linked and compared with others once. Rows with a null doc_id link with
    nothing and have a null component_id; rows that repeat a doc_id are judged each by its text. Other columns are
    ignored; an empty table gives an empty result.
    """
    rule = scheme(k, Fraction(similarity))
    own = docs.select(docs["doc_id"].cast("long").alias("id"), "text")
    firsts, again, group = near_groups(own.where("id is not null"), rule, "jaccard")
    known = group.select("node", F.col("least.doc_id").alias("component_id"))
    heads = firsts.join(known, "node", "left").select("a", "b", "doc_id", "size", F.coalesce("component_id", "doc_id").alias("component_id"))
    copies = again.select("a", "b", "doc_id", "size").join(heads.select("a", "b", "component_id"), ["a", "b"])
    columns = ["doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [normal(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            for lo, hi in sliced(items):
                n = rule.keys(items[lo:hi]).size
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n, pa.int64()), batch.column(0)[lo:hi]], names=["doc_id", "n_shingles", "component_id"])

    # Rows without a word or without an id stand in no key.
    rest = own.where(F.col("id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    alone = rest.mapInArrow(sizes, "doc_id long, n_shingles long, component_id long")
    return heads.select(*columns).union(copies.select(*columns)).union(alone)


def one_of_each_group(docs: DataFrame, k: int = 5, similarity: str = "0.8") -> DataFrame:
    """The rows of `docs` with all columns, of each group of similar documents only the one of the smallest doc_id.

    Rows with a null doc_id stay.
    """
    with Step() as step:
        gone = Written(similar_documents(docs, k, similarity).where("doc_id != component_id").select(F.col("doc_id").alias("_id")), "gone")
        step.keep(gone)
    return docs.join(gone.df, docs["doc_id"].cast("long") == gone.df["_id"], "left_anti")
