"""Ranked lexical search of many queries at once, sharing what the queries have in common.

Queries are taken in blocks of bounded size. Of a block, sets of terms that several items share are mined: terms that
stand in the same items form one set, and pairs of sets that most items share are joined again and again. That gives a
DAG whose nodes are term sets, each the sum of two others; an item is the sum of the few nodes left to it. All
documents are scanned once for the terms of a block, which leaves a small table of postings; from that come the
statistics, and then each task computes the partial score of every node once for a batch of documents, combines the
nodes along the DAG, and keeps the best documents of each item. Only those leave the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm.common import Written, equal_spans, lanes, prefix_hashes, range_hash, slices, text_buffers
from fathom.llm.terms import terms

#: Items of a block, and distinct terms of its items all together; a block of one item may have more.
BLOCK_ITEMS, BLOCK_TERMS = 512, 100_000
#: Sets of terms of which pairs are counted, at most (the largest numbers of items); others stay as they are.
MINED = 2048
#: Bytes of partial scores that a task holds at once, about.
SCORES = 32 << 20
#: The best documents of an item come from so many parts first.
PARTS = 64


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), distinct, of (item_id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            low, start, end, row, _ = terms(data, offs)
            words = pa.array([low[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), words], names=["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(cut, f"item_id {items.schema['item_id'].dataType.simpleString()}, term string").distinct()


class Lexicon:
    """Numbers of known terms; lookup() finds them among the spans of a text, byte by byte."""

    def __init__(self, words: list[bytes]):
        self.data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words], dtype=np.int64)
        start = end - np.array([len(w) for w in words], np.int64)
        h = range_hash(prefix_hashes(self.data), start, end)
        self.order = np.argsort(h, kind="stable")
        self.hash, self.start, self.size = h[self.order], start[self.order], (end - start)[self.order]
        self.rounds = int(np.unique(h, return_counts=True)[1].max(initial=0))  # terms that share a hash, at most

    def lookup(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The number of each span's term, -1 where it is none."""
        out = np.full(len(h), -1)
        if not len(self.hash):
            return out
        at = np.searchsorted(self.hash, h)
        text, own = lanes(low), lanes(self.data)
        for k in range(self.rounds):
            i = np.minimum(at + k, len(self.hash) - 1)
            some = np.flatnonzero((self.hash[i] == h) & (out < 0))
            i = i[some]
            same = equal_spans(text, start[some], (end - start)[some], own, self.start[i], self.size[i])
            out[some[same]] = self.order[i[same]]
        return out


def postings(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, n, terms, tf) of every document: its number of terms, and of the known terms in it the numbers and frequencies."""
    n_terms = max(1, len(lexicon.hash))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for lo, hi in slices(offs):
                low, start, end, row, h = terms(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                number = shared.value.lookup(low, start, end, h)
                known = number >= 0
                both, tf = np.unique(row[known] * n_terms + number[known], return_counts=True)
                edges = pa.array(np.searchsorted(both, np.arange(hi - lo + 1) * n_terms).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(c.astype(np.int32))) for c in (both % n_terms, tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(np.bincount(row, minlength=hi - lo), pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, n long, terms array<int>, tf array<int>")


def document_frequencies(posted: DataFrame, n_terms: int) -> np.ndarray:
    """Documents of each term; tasks sum their own first, and the result is of a block's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    found = posted.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return out


class SharingDag:
    """Term sets that items share: how to get all items' sums from the terms' with few additions.

    group has each term's set; levels are pairs (left, right) of nodes whose sums are the next nodes; an item is the sum of
    `nodes` between its `edges`.
    """

    def __init__(self, item: np.ndarray, term: np.ndarray, n_items: int, n_terms: int):
        order = np.lexsort((item, term))
        item, term = item[order], term[order]
        edges = np.searchsorted(term, np.arange(n_terms + 1))
        # Terms of the same items are one set.
        known: dict[bytes, int] = {}
        self.group = np.array([known.setdefault(item[a:b].tobytes(), len(known)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], np.int64)
        member = [np.frombuffer(k, item.dtype) for k in known]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        shared = sorted((i for i in range(len(member)) if len(member[i]) > 1), key=lambda i: -len(member[i]))[:MINED]
        has = np.zeros((len(shared), n_items), np.float32)
        for k, i in enumerate(shared):
            has[k, member[i]] = 1
        node = np.array(shared, np.int64)  # the DAG's node of each row
        total = len(member)
        while len(node) > 1:
            both = has @ has.T
            np.fill_diagonal(both, 0)
            partner = both.argmax(axis=1)
            worth = both[np.arange(len(node)), partner]
            free, left, right = np.ones(len(node), bool), [], []
            for i in np.argsort(-worth, kind="stable").tolist():
                j = int(partner[i])
                if worth[i] < 2:
                    break
                if free[i] and free[j]:
                    free[i] = free[j] = False
                    left.append(i)
                    right.append(j)
            if not left:
                break
            self.levels.append((node[left], node[right]))
            joined = has[left] * has[right]
            has[left] -= joined
            has[right] -= joined
            has = np.concatenate([has, joined])
            node = np.concatenate([node, total + np.arange(len(left))])
            total += len(left)
            keep = has.sum(axis=1) > 1  # sets of one item or none join no more
            self._settle(member, node[~keep], has[~keep])
            has, node = has[keep], node[keep]
            if len(node) > 2 * MINED:
                break
        self._settle(member, node, has)
        self.n_nodes = total
        member += [np.zeros(0, np.int64)] * (total - len(member))
        of = np.concatenate([np.full(len(m), i) for i, m in enumerate(member)]) if member else np.zeros(0, np.int64)
        items = np.concatenate(member).astype(np.int64) if member else np.zeros(0, np.int64)
        order = np.argsort(items, kind="stable")
        self.nodes = of[order].astype(np.int64)
        self.edges = np.searchsorted(items[order], np.arange(n_items + 1))

    @staticmethod
    def _settle(member: list[np.ndarray], nodes: np.ndarray, has: np.ndarray) -> None:
        """These nodes keep the items that they have now."""
        for i, row in zip(nodes.tolist(), has, strict=True):
            member += [np.zeros(0, np.int64)] * (i + 1 - len(member))
            member[i] = np.flatnonzero(row)

    def sums(self, term: np.ndarray, column: np.ndarray, value: np.ndarray, n_columns: int) -> np.ndarray:
        """Items' sums for each column, of values of terms."""
        acc = np.zeros((self.n_nodes, n_columns), np.int64)
        np.add.at(acc.reshape(-1), self.group[term] * n_columns + column, value)
        at = self.n_nodes - sum(len(left) for left, _ in self.levels)
        for left, right in self.levels:
            acc[at : at + len(left)] = acc[left] + acc[right]
            at += len(left)
        out = np.zeros((len(self.edges) - 1, n_columns), np.int64)
        full = np.flatnonzero(np.diff(self.edges))
        step = max(1, SCORES // (8 * n_columns))  # nodes whose rows are gathered at once
        for lo in range(0, len(full), step):
            some = full[lo : lo + step]
            while len(some):
                a = self.edges[some[0]]
                fit = max(1, int(np.searchsorted(self.edges[some + 1] - a, step, "right")))
                part, some = some[:fit], some[fit:]
                out[part] = np.add.reduceat(acc[self.nodes[a : self.edges[part[-1] + 1]]], self.edges[part] - a, axis=0)
        return out


def first_k(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """The places of each item's k best, in order: highest score, then smallest doc, null last."""
    order = np.lexsort((doc, null, -score, item))
    sorted_ = item[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_, sorted_, "left")
    return order[rank < k]


def best_documents(posted: DataFrame, dag: SharingDag, weight: np.ndarray, n_docs: int, all_terms: int, ids: pa.Array, kind: str, k: int) -> DataFrame:
    """(item_id, doc_id, score): of each task's documents the k best of each item."""
    n_items = len(dag.edges) - 1
    batch_docs = max(16, min(2048, SCORES // (8 * max(1, dag.n_nodes + n_items))))
    shared = posted.sparkSession.sparkContext.broadcast((dag, weight, ids))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag, weight, ids = shared.value
        item, points, doc, null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        least = np.ones(n_items, np.int64)  # what a document needs to come in
        for whole in batches:
            for lo in range(0, len(whole), batch_docs):
                batch = whole.slice(lo, batch_docs)
                size = len(batch)
                n = batch.column(1).to_numpy()
                lists = batch.column(2)
                column = np.repeat(np.arange(size), lists.value_lengths().to_numpy())
                term, tf = lists.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy().astype(np.int64)
                m = 100 - 50 + (50 * n * n_docs) // all_terms
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[column]))
                total = dag.sums(term, column, part, size)
                i, j = np.nonzero(total >= least[:, None])
                if not len(i):
                    continue
                own = batch.column(0)
                item, points = np.concatenate([item, i]), np.concatenate([points, total[i, j]])
                doc = np.concatenate([doc, own.fill_null(0).to_numpy()[j]])
                null = np.concatenate([null, own.is_null().to_numpy(zero_copy_only=False)[j]])
                best = first_k(item, points, doc, null, k)
                item, points, doc, null = item[best], points[best], doc[best], null[best]
                edges = np.searchsorted(item, np.arange(n_items + 1))
                full = np.flatnonzero(np.diff(edges) == k)
                least[full] = points[edges[full + 1] - 1]
        if len(item):
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(item)), pa.array(doc, mask=null), pa.array(points)], names=["item_id", "doc_id", "score"])

    return posted.mapInArrow(score, f"item_id {kind}, doc_id long, score long")


def blocked(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(block, item_id, term) and the number of blocks: so many that the blocks' sizes are within their bounds."""
    sizes = Written(pairs.groupBy("item_id").count(), "items")
    n_items, n_pairs = sizes.df.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    n_blocks = max(1, -(-n_items // BLOCK_ITEMS), -(-n_pairs // BLOCK_TERMS))
    block = lambda n: F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int")
    while True:
        large = sizes.df.groupBy(block(n_blocks).alias("block")).agg(F.count("*").alias("items"), F.sum("count").alias("pairs"))
        if large.where(f"items > 1 and (items > {2 * BLOCK_ITEMS} or pairs > {2 * BLOCK_TERMS})").isEmpty():
            sizes.drop()
            return pairs.select(block(n_blocks).alias("block"), "item_id", "term"), n_blocks
        n_blocks *= 2


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: for each of `items` (item_id, text) its k documents of `docs` (doc_id, text) of highest score above 0.

    Terms are lowered runs of ASCII letters and digits and of all that is not ASCII. A term in df of N documents (those
    with a term) weighs w = floor(1000 * ln((2N + 2) / (2df + 1))). A document of n terms has m = 50 + (50 n N) div L, L
    being all documents' terms; it scores the sum of w * ((10**9 tf) div (1000 tf + 20 m)) over an item's distinct terms.
    Ranks run from 1 without gaps; equal scores go by doc_id, null ids last. Rows that repeat a doc_id are documents of
    their own; rows that repeat an item_id (or have none) are one item with all their terms. Null and empty texts have
    no terms; items without terms, or that no document matches, have no row; empty tables are allowed; other columns
    are ignored.
    """
    spark = docs.sparkSession
    pairs = Written(item_terms(items), "terms")
    dealt, n_blocks = blocked(pairs.df)
    kind = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    for b in range(n_blocks):
        block = dealt.where(F.col("block") == b).select("item_id", "term").toArrow().combine_chunks()
        if not len(block):
            continue
        item, term = (block.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("item_id", "term"))
        names = term.dictionary.cast(pa.binary()).to_pylist()
        posted = Written(postings(docs, Lexicon(names)), "postings").df
        n_docs, all_terms = posted.agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).cast("long"), F.sum("n")).first()
        if not all_terms:
            return found.withColumn("rank", F.lit(1)).select("item_id", "rank", "doc_id", "score")
        df = document_frequencies(posted, len(names))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        dag = SharingDag(item.indices.to_numpy().astype(np.int64), term.indices.to_numpy().astype(np.int64), len(item.dictionary), len(names))
        found = found.union(best_documents(posted, dag, weight, n_docs, all_terms, item.dictionary, kind, k))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
