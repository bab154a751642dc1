"""Substring dedup by content-defined chunks: a gear rolling hash cuts texts where their bytes say so."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import Written, mix, prefix_hashes, range_hash, slices, text_buffers
from fathom.llm.packed import GATHERED, bucket_count, bucketed_by, pack, total_bytes

_GEAR = np.random.default_rng(5).integers(0, 2**32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Cuts:
    """Bytes of the shortest and longest chunk, neighbouring chunks that are compared as one span, and bytes that a run of repeated spans must have to go.

    A cut depends on the least + 8 bytes before it and the least bytes after it alone (but for stretches of `most` bytes without
    one), so two texts cut a passage alike from its first bytes on. A passage of over 50 words has about 250 bytes; what lies outside its first and last cut may stay.
    """

    least: int = 8
    most: int = 64
    span: int = 3
    run: int = 150


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, h = 2 h + table[byte] modulo 2**32 over the last 8 bytes."""
    h = _GEAR[data]
    for k in (1, 2, 4):
        more = np.zeros_like(h)
        more[k:] = h[:-k] << np.uint32(k)
        h = h + more
    return h


def lowest(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours in h."""
    k = 1
    while 2 * k <= width:
        h, k = np.minimum(h[:-k], h[k:]), 2 * k
    return np.minimum(h[: len(h) - (width - k)], h[width - k :])


def chunk_ends(data: np.ndarray, cuts: Cuts) -> np.ndarray:
    """Ends of the chunks of one text: where the hash is below its `least` neighbours on both sides, and in longer stretches at the lowest hash within `most` bytes."""
    n, w = len(data), cuts.least
    h = gear(data)
    edge = np.full(w, 2**32 - 1, np.uint32)
    around = lowest(np.concatenate((edge, h, edge)), w)
    places = np.flatnonzero((h < around[:n]) & (h <= around[w + 1 :])) + 1
    places = places[(places >= w) & (places < n)]
    ends = np.append(places, n) if n else places
    wide = np.flatnonzero(np.diff(ends, prepend=0) > cuts.most)
    if not len(wide):
        return ends.astype(np.int64)
    more = []
    for i in wide.tolist():
        at, stop = int(ends[i - 1]) if i else 0, int(ends[i])
        while stop - at > cuts.most:
            part = h[at + w - 1 : min(at + cuts.most, stop - w)]
            at += w + len(part) - 1 - int(np.argmin(part[::-1]))
            more.append(at)
    return np.sort(np.append(ends, np.array(more, np.int64)))


#: Packed records: spans that go to their digest's bucket, and spans that a task knows to be repeats.
HEAD, REST = 0, 1


def repeated_spans(docs: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:  # noqa: B008
    """(doc_id, start, end, first_docs): runs of chunks of `docs` (doc_id, text) that stand in a document with a smaller doc_id.

    Offsets are UTF-8 bytes. Spans of cuts.span chunks, one from each chunk on, are compared by a digest of 128 bits. A run of
    overlapping repeated spans counts if it has at least cuts.run bytes; first_docs are the smallest documents that have its spans, sorted. Rows with a
    null doc_id are left out; rows of equal doc_id are one document's.
    """
    source = docs.where("doc_id is not null").select(docs["doc_id"].cast("long").alias("id"), "text")
    n_buckets = bucket_count(total_bytes(source, "text"))
    kinds = {HEAD: [np.uint64, np.uint64, np.int64, np.int32, np.int32], REST: [np.uint64, np.int64, np.int32, np.int32, np.int64, np.int32]}
    columns_ = max(map(len, kinds.values()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offs):
                part = data[offs[lo] : offs[hi]]
                own = offs[lo : hi + 1] - offs[lo]
                ends = [chunk_ends(part[own[i] : own[i + 1]], cuts) for i in range(hi - lo)]
                spans = [(np.append(0, e[: -cuts.span]), e[cuts.span - 1 :] if len(e) >= cuts.span else e[-1:]) for e in ends if len(e)]
                size = np.array([max(1, len(e) - cuts.span + 1) if len(e) else 0 for e in ends])
                start = np.concatenate([np.zeros(0, np.int64), *[s for s, _ in spans]])
                end = np.concatenate([np.zeros(0, np.int64), *[e for _, e in spans]])
                base = np.repeat(own[:-1], size)
                a = range_hash(prefix_hashes(part), start + base, end + base)
                b = range_hash(prefix_hashes(part, _OTHER), start + base, end + base)
                held.append((a, b, np.repeat(ids[lo:hi], size), start.astype(np.int32), (end - start).astype(np.int32)))
                count += len(a)
                if count >= GATHERED:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    def row(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        batch = pack(kind, (bucket % np.uint64(n_buckets)).astype(np.int64), columns)
        none = pa.nulls(len(batch), pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, *[none] * (columns_ - len(columns))], names=["kind", "bucket", *(f"c{i}" for i in range(columns_))])

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        """Of each digest only what stands in the first document of those gathered goes to the digest's bucket, others name that one."""
        a, b, doc, start, size = (np.concatenate([x[i] for x in held]) for i in range(5))
        order = np.lexsort((start, doc, b, a))
        a, b, doc, start, size = a[order], b[order], doc[order], start[order], size[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        own = doc == doc[lead]
        yield row(HEAD, mix(a[own]), [a[own], b[own], doc[own], start[own], size[own]])
        rest, lead = ~own, lead[~own]
        yield row(REST, mix(doc[rest].astype(np.uint64)), [a[rest], doc[rest], start[rest], size[rest], doc[lead], start[lead]])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in bucketed_by(batches, kinds):
            if HEAD in held:
                yield from settle(held[HEAD])
            for key, doc, start, size, first, at in held.get(REST, []):
                yield found(key, doc, start, size, first, at)

    def found(key: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, first: np.ndarray, at: np.ndarray | None = None) -> pa.RecordBatch:
        none = pa.nulls(len(doc), pa.int64())
        columns = [pa.array(key.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int64)), pa.array(size), pa.array(first), none if at is None else pa.array(at.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "start", "size", "first", "at"])

    def settle(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        a, b, doc, start, size = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.lexsort((doc, b, a))
        a, b, doc, start, size = a[order], b[order], doc[order], start[order], size[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = np.flatnonzero(doc != first)
        for lo in range(0, len(again), 100_000):
            at = again[lo : lo + 100_000]
            yield found(a[at], doc[at], start[at], size[at], first[at])

    packed = source.mapInArrow(cut, "kind int, bucket int, " + ", ".join(f"c{i} binary" for i in range(columns_)))
    again = Written(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(match, "key long, doc_id long, start long, size int, first long, at long"), "chunks").df
    # Who names a place that is a repeat itself gets the document that it repeats.
    known = again.where("at is null").select("key", F.col("doc_id").alias("first"), F.col("start").alias("at"), F.col("first").alias("least")).dropDuplicates(["key", "first", "at"])
    named = again.where("at is not null").join(known, ["key", "first", "at"], "left").select("doc_id", "start", "size", F.coalesce("least", "first").alias("first"))
    every = again.where("at is null").select("doc_id", "start", "size", "first").union(named)
    per_doc = every.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "size", "first"))).alias("found"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            found = batch.column(1)
            for i in range(len(batch)):
                flat = found[i].values
                start, size, first = (flat.field(k).to_numpy() for k in range(3))
                stop = np.maximum.accumulate(start + size)
                new = np.ones(len(start), bool)
                new[1:] = start[1:] >= stop[:-1]
                s, run = np.flatnonzero(new), np.cumsum(new) - 1
                e = np.append(stop[s[1:] - 1], stop[-1])
                for k in np.flatnonzero(e - start[s] >= cuts.run):
                    rows.append((batch.column(0)[i].as_py(), int(start[s[k]]), int(e[k]), np.unique(first[run == k]).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["doc_id", "start", "end", "first_docs"])

    return per_doc.mapInArrow(join, "doc_id long, start long, end long, first_docs array<long>")


_OTHER = np.random.default_rng(6).integers(1, 2**63, 256, dtype=np.uint64)


def chunk_report(docs: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:  # noqa: B008
    """doc_id, n_bytes, n_removed, n_spans, first_docs of every row of `docs`: what repeated_spans() takes out of each.

    Null texts count as empty, as do texts of a null doc_id; rows that repeat a doc_id get the sum of what goes from all of
    them, and repeats within one document count for nothing. Long texts are cut whole. An empty table gives an empty
    result, other columns are ignored. first_docs (sorted, empty if nothing goes) are the documents that keep the passages.
    """
    spans = repeated_spans(docs, cuts).groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).alias("n_removed"), F.count("*").alias("n_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_docs")))).alias("first_docs"))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    nothing = F.array().cast("array<long>")
    return base.join(spans, "doc_id", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("first_docs", nothing).alias("first_docs"))


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of `docs` with all columns, the bytes of spans (doc_id, start, end) gone from their text.

    A cut may fall inside a UTF-8 character; what is left of one then goes too.
    """
    per_doc = spans.groupBy(F.col("doc_id").alias("_id")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    names = docs.columns
    both = docs.join(per_doc, docs["doc_id"].cast("long") == per_doc["_id"], "left").select(*[docs[c] for c in names], "_spans")
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if spans and t:
                    raw, left, last = t.encode("utf-8"), [], 0
                    for s in spans:
                        left.append(raw[last : max(last, s["start"])])
                        last = max(last, s["end"])
                    t = b"".join([*left, raw[last:]]).decode("utf-8", "ignore")
                texts.append(t)
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, docs.schema)
