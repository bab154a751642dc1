"""Removing repeated substrings with a suffix sort whose comparisons use hashes.

Every WIDTH-byte window is assigned to its anchor, the K bytes in it with the smallest hash: equal windows have equal
anchors at equal places, so windows are only ever compared with those that lie alike around the same anchor bytes.
Occurrences of an anchor with all windows around it equal (by a 128-bit BLAKE2b digest of those bytes) form a class; all
but its first document's are repeats. Where an anchor has several classes, the suffixes
at those windows of their first members whose hash stands more than once there are sorted: two suffixes are compared by binary search for their common extension
over prefix polynomial hashes, so a comparison in the mergesort takes logarithmic time; neighbours that share WIDTH
bytes by hash are compared byte by byte before they count. Contexts of an anchor that has very many are dealt on window
by window, by the hash of each, so no task gets them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import Written, mix, prefix_hashes, range_hash, slices, span_hashes, text_buffers, window_hashes
from fathom.llm.packed import GATHERED, bucket_count, bucketed_by, pack, total_bytes, unpack

WIDTH = 50
K = 24
SPAN = WIDTH - K + 1  # anchors that a window may have
CONTEXT = WIDTH + SPAN - 1  # bytes of all windows of an anchor, at most

ENTRY, COVERED, OPEN, TEXT = 0, 1, 2, 3
DIGEST = np.dtype([("a", np.uint64), ("b", np.uint64)])
KINDS = {
    ENTRY: [np.uint32, DIGEST, np.int64, np.int32, np.uint8, np.uint8],
    COVERED: [np.int64, np.int32, np.int32],
    OPEN: [np.uint64, np.int64, np.int32, np.uint8, np.uint8],
    TEXT: [np.uint64, np.int64, np.int32, np.uint8, np.uint8, f"V{CONTEXT}"],
}
COLUMNS = max(map(len, KINDS.values()))
SCHEMA = "kind int, bucket int, " + ", ".join(f"c{i} binary" for i in range(COLUMNS))


def _packed(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    batch = pack(kind, bucket, columns)
    none = pa.nulls(len(batch), pa.binary())
    return pa.RecordBatch.from_arrays([*batch.columns, *[none] * (COLUMNS - len(columns))], names=["kind", "bucket", *(f"c{i}" for i in range(COLUMNS))])


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor: its row, its place, its first window, its number of windows, and the hash of its bytes."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    n = len(data)
    if n < WIDTH:
        return none
    h = window_hashes(prefix_hashes(data), K)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - K + 1, dtype=np.uint64)  # the leftmost of equal ones is the least
    reach = 1
    while 2 * reach <= SPAN:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < SPAN:
        low = np.minimum(low[: len(low) - (SPAN - reach)], low[SPAN - reach :])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the window at each byte
    fits, new = np.ones(len(place), bool), np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        fits[max(a, b - WIDTH + 1) : b] = False
        new[a : a + 1] = True
    new[1:] |= ~fits[:-1]
    edges = np.flatnonzero(new | ~fits)
    is_start = fits[edges]
    start, count = edges[is_start], np.diff(np.append(edges, len(place)))[is_start]
    return np.searchsorted(offs, start, "right") - 1, place[start], start, count, h[place[start]]


def suffix_sort(text: np.ndarray, prefix: np.ndarray, suffix: np.ndarray, segment: np.ndarray, width: int) -> np.ndarray:
    """The order of suffixes by the first `width` bytes within segments (`segment` must be sorted).

    A bottom-up mergesort; in each round every suffix finds its rank in the neighbouring run by binary search. text
    must hold `width` bytes from each suffix on.
    """
    n = len(suffix)
    order = np.arange(n)
    first = np.searchsorted(segment, segment, "left")
    size = np.searchsorted(segment, segment, "right") - first

    def extension(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Common bytes of the texts at p and q, up to width, by binary search over hashes."""
        low = np.zeros(len(p), np.int64)
        high = np.full(len(p), width, np.int64)
        while True:
            active = low < high
            if not active.any():
                return low
            mid = (low + high + 1) // 2
            same = range_hash(prefix, p, p + mid) == range_hash(prefix, q, q + mid)
            low = np.where(active & same, mid, low)
            high = np.where(active & ~same, mid - 1, high)

    def less(p: np.ndarray, q: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        k = extension(p, q)
        inside = np.minimum(k, width - 1)
        return np.where(k == width, or_equal, text[p + inside] < text[q + inside])

    run = 1
    while n and run < size.max():
        active = np.flatnonzero(size > run)
        at = active - first[active]
        own = at // run
        left = own % 2 == 0
        sibling = np.where(left, own + 1, own - 1)
        lo = np.minimum(sibling * run, size[active])
        hi = np.minimum(lo + run, size[active])
        base, begin = first[active], lo.copy()
        mine = suffix[order[active]]
        while True:
            busy = np.flatnonzero(lo < hi)
            if not len(busy):
                break
            mid = (lo[busy] + hi[busy]) // 2
            other = suffix[order[base[busy] + mid]]
            before = less(other, mine[busy], ~left[busy])  # equal ones of the left run stay first
            lo[busy] = np.where(before, mid + 1, lo[busy])
            hi[busy] = np.where(before, hi[busy], mid)
        start = own // 2 * 2 * run
        target = base + start + at - own * run + (lo - begin)
        new = order.copy()
        new[target] = order[active]
        order = new
        run *= 2
    return order


def repeated(h: np.ndarray) -> np.ndarray:
    """The places, in order, of the values that stand more than once."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    return np.sort(order[np.append(same, False)[: len(h)] | np.append(False, same)[: len(h)]])


def equal_windows(text: np.ndarray, suffix: np.ndarray, segment: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
    """A number for each suffix, equal where segment and WIDTH bytes are equal; prefix: the text's prefix hashes, if they are there."""
    prefix = prefix_hashes(text) if prefix is None else prefix
    order = suffix_sort(text, prefix, suffix, segment, WIDTH)
    a, b = suffix[order[:-1]], suffix[order[1:]]
    same = (segment[order[:-1]] == segment[order[1:]]) & (range_hash(prefix, a, a + WIDTH) == range_hash(prefix, b, b + WIDTH))
    at = np.flatnonzero(same)
    for lo in range(0, len(at), 1 << 16):  # hashes can collide: bytes decide
        x = at[lo : lo + (1 << 16), None]
        equal = (text[a[x] + np.arange(WIDTH)] == text[b[x] + np.arange(WIDTH)]).all(axis=1)
        if not equal.all():
            exact = np.ascontiguousarray(text[suffix[:, None] + np.arange(WIDTH)]).view(f"V{WIDTH}").reshape(-1)
            _, number = np.unique(exact, return_inverse=True)
            return number.reshape(-1) + segment * len(suffix)
    out = np.zeros(len(suffix), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(~same)))[: len(suffix)]
    return out


def _runs(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2b digests of data[start:end]."""
    raw, hash_ = data.tobytes(), hashlib.blake2b
    return np.frombuffer(b"".join([hash_(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]), DIGEST)


class Held:
    """Records of one kind that a task gathers over several buckets before it packs them; of: the column that deals them."""

    def __init__(self, kind: int, of: int, n_buckets: int):
        self.kind, self.of, self.n_buckets = kind, of, n_buckets
        self.parts: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n >= GATHERED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            columns = [np.concatenate([p[i] for p in self.parts]) for i in range(len(KINDS[self.kind]))]
            yield _packed(self.kind, columns[self.of] % self.n_buckets, columns)
        self.parts, self.n = [], 0


def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[list[np.ndarray]]]]]:
    return bucketed_by(batches, KINDS)


def removed_spans(docs: DataFrame) -> tuple[DataFrame, int]:
    """Packed rows of covered spans (doc_id, start, end), dealt by doc_id into the number of buckets that is returned.

    Covered is each byte of a WIDTH-byte string that also starts in a document with a smaller doc_id.
    """
    source = docs.where("doc_id is not null and octet_length(text) > 0").select(docs["doc_id"].cast("long").alias("id"), "text")
    n_buckets = bucket_count(total_bytes(source, "text")) | 1
    of_doc = lambda doc: doc % n_buckets
    hot = HOT

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, full, doc, start, before, windows = (np.concatenate([x[i] for x in held]) for i in range(6))
            order = np.argsort(full["a"])  # equal contexts have equal anchors
            h, full, doc, start, before, windows = (x[order] for x in (h, full, doc, start, before, windows))
            new = _runs(full["a"], full["b"])
            first = np.minimum.reduceat(doc, np.flatnonzero(new)) if len(doc) else doc
            again = doc != first[np.cumsum(new) - 1]  # repeats of this task's own texts need no exchange
            yield _packed(COVERED, of_doc(doc[again]), [doc[again], start[again], start[again] + windows[again].astype(np.int32) + np.int32(WIDTH - 1)])
            keep = ~again
            h = h[keep]
            # Anchors of one bucket that share 32 bits of their hash are taken for one, which costs comparisons alone.
            yield _packed(ENTRY, (h % np.uint64(n_buckets)).astype(np.int64), [(h >> np.uint64(32)).astype(np.uint32), full[keep], doc[keep], start[keep], before[keep], windows[keep]])

        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offs):
                part, own = data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                row, place, start, windows, h = anchors(part, own)
                full = digests(part, start, start + windows + WIDTH - 1)
                held.append((h, full, np.asarray(ids[lo:hi], np.int64)[row], (start - own[row]).astype(np.int32), (place - start).astype(np.uint8), windows.astype(np.uint8)))
                count += len(h)
                if count >= GATHERED // 2:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covered, open_ = Held(COVERED, 0, n_buckets), Held(OPEN, 1, n_buckets)
        for bucket, kinds in bucketed(batches):
            for columns in kinds.get(COVERED, []):
                yield from covered.add(columns)
            if ENTRY in kinds:
                yield from settle(bucket, kinds[ENTRY], covered, open_)
        yield from covered.flush()
        yield from open_.flush()

    def settle(bucket: int, parts: list[list[np.ndarray]], covered: Held, opened: Held) -> Iterator[pa.RecordBatch]:
        key, full, doc, start, before, windows = (np.concatenate([c[i] for c in parts]) for i in range(6))
        key = key.astype(np.uint64) | np.uint64(bucket) << np.uint64(32)
        order = np.lexsort((full["a"], key))
        same = (key[order][1:] == key[order][:-1]) & (full["a"][order][1:] == full["a"][order][:-1])
        if (same & (full["b"][order][1:] != full["b"][order][:-1])).any():  # half a digest never told them apart so far
            order = np.lexsort((full["b"], full["a"], key))
        key, full, doc, start, before, windows = (x[order] for x in (key, full, doc, start, before, windows))
        new = _runs(key, full["a"], full["b"])
        which = np.cumsum(new) - 1
        first = np.minimum.reduceat(doc, np.flatnonzero(new)) if len(doc) else doc
        again = doc != first[which]
        end = start + windows.astype(np.int32) + np.int32(WIDTH - 1)
        yield from covered.add([doc[again], start[again], end[again]])
        # Classes of one anchor whose first documents differ: their first members' texts must be compared.
        group_new = _runs(key)
        group = np.cumsum(group_new) - 1
        lead = first[which]
        edges = np.flatnonzero(group_new)
        differ = np.minimum.reduceat(lead, edges) != np.maximum.reduceat(lead, edges)
        open_ = differ[group] & ~again
        many = np.bincount(group[open_], minlength=len(edges))[group] > hot
        marked = np.where(many, windows | MANY, windows).astype(np.uint8)
        yield from opened.add([key[open_], doc[open_], start[open_], before[open_], marked[open_]])

    found = Written(source.mapInArrow(find, SCHEMA).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(classes, SCHEMA), "classes")

    def records(padded: np.ndarray, number: np.ndarray, doc: np.ndarray, start: np.ndarray, before: np.ndarray, marked: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Packed TEXT records of contexts that begin at `begin` of the bytes `padded`."""
        windows = marked & np.uint8(MANY - 1)
        many = np.flatnonzero(marked >= MANY)
        if len(many):  # a record for each window, with its own hash as the number
            w = windows[many].astype(np.int64)
            of, shift = np.repeat(many, w), np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            alone = np.zeros((len(of), CONTEXT), np.uint8)
            alone[:, :WIDTH] = padded[(begin[of] + shift)[:, None] + np.arange(WIDTH)]
            own = span_hashes(padded, begin[of] + shift, begin[of] + shift + WIDTH)
            one = np.ones(len(of), np.uint8)
            yield _packed(TEXT, (own % np.uint64(n_buckets)).astype(np.int64), [own, doc[of], start[of] + shift.astype(np.int32), one - one, one, alone.view(f"V{CONTEXT}").reshape(-1)])
            few = marked < MANY
            number, doc, start, before, windows, begin, size = (x[few] for x in (number, doc, start, before, windows, begin, size))
        text = padded[begin[:, None] + np.arange(CONTEXT)]
        text[np.arange(CONTEXT) >= size[:, None]] = 0
        yield _packed(TEXT, (number % np.uint64(n_buckets)).astype(np.int64), [number, doc, start, before, windows, text.view(f"V{CONTEXT}").reshape(-1)])

    def contexts(key: tuple, texts: pa.Table, open_rows: pa.Table) -> pa.Table:
        ids, (data, offs) = texts.column("id").to_numpy(), text_buffers(texts.column("text"))
        parts = [c for b in open_rows.select(["kind", "bucket", *(f"c{i}" for i in range(COLUMNS))]).to_batches() for _, c in unpack(b, KINDS)]
        out: list[pa.RecordBatch] = []
        if len(ids) and parts:
            number, doc, start, before, marked = (np.concatenate([p[i] for p in parts]) for i in range(5))
            by_id = np.argsort(ids, kind="stable")
            at = np.searchsorted(ids[by_id], doc, "right") - 1
            row = by_id[at]
            begin, size = offs[row] + start, (marked & np.uint8(MANY - 1)).astype(np.int64) + WIDTH - 1
            ok = (at >= 0) & (ids[row] == doc) & (begin + size <= offs[row + 1])
            padded = np.concatenate((data, np.zeros(CONTEXT, np.uint8)))
            columns = [x[ok] for x in (number, doc, start, before, marked, begin, size)]
            for lo in range(0, len(columns[0]), TAKEN):
                out += records(padded, *(x[lo : lo + TAKEN] for x in columns))
        return pa.Table.from_batches(out, schema=_ARROW)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covered = Held(COVERED, 0, n_buckets)
        for _, kinds in bucketed(batches):
            number, doc, start, before, windows, text = (np.concatenate([p[i] for p in kinds[TEXT]]) for i in range(6))
            order = np.argsort(number, kind="stable")
            number, doc, start, before, windows, text = (x[order] for x in (number, doc, start, before, windows, text))
            edges = np.append(np.flatnonzero(_runs(number)), len(number))
            lo = 0
            while lo < len(number):  # whole anchors, about SORTED contexts at once
                hi = int(edges[min(np.searchsorted(edges, lo + SORTED, "right"), len(edges)) - 1])
                if hi <= lo:
                    hi = int(edges[np.searchsorted(edges, lo, "right")])
                flat = np.ascontiguousarray(text[lo:hi]).view(np.uint8).reshape(-1)
                w = windows[lo:hi].astype(np.int64)
                of = np.repeat(np.arange(hi - lo), w)
                shift = np.arange(len(of)) - np.repeat(np.cumsum(w) - w, w)
                # Equal windows lie alike around their anchor: a segment for each anchor and place.
                place = before[lo:hi][of].astype(np.int64) - shift
                prefix = prefix_hashes(flat)
                anchor = np.cumsum(_runs(number[lo:hi]))[of]
                some = repeated(mix(range_hash(prefix, of * CONTEXT + shift, of * CONTEXT + shift + WIDTH) ^ (anchor * CONTEXT + place).astype(np.uint64)))
                of, shift, place, anchor = of[some], shift[some], place[some], anchor[some]
                by_place = np.argsort(anchor * CONTEXT + place, kind="stable")
                segment = np.cumsum(_runs(anchor[by_place], place[by_place])) - 1
                same = np.zeros(len(of), np.int64)
                same[by_place] = equal_windows(flat, (of * CONTEXT + shift)[by_place], segment, prefix)
                least = np.full(int(same.max()) + 1 if len(of) else 0, np.iinfo(np.int64).max)
                np.minimum.at(least, same, doc[lo:hi][of])
                hit = least[same] < doc[lo:hi][of]
                d, s = doc[lo:hi][of][hit], (start[lo:hi][of] + shift)[hit]
                # Neighbouring windows of one context become one span.
                new = np.ones(len(d), bool)
                new[1:] = (of[hit][1:] != of[hit][:-1]) | (s[1:] != s[:-1] + 1)
                begin = np.flatnonzero(new)
                last = np.append(begin[1:], len(d))[: len(begin)] - 1
                yield from covered.add([d[begin], s[begin].astype(np.int32), (s[last] + WIDTH).astype(np.int32)])
                lo = hi
        yield from covered.flush()

    dealt = source.withColumn("bucket", F.pmod("id", F.lit(n_buckets)).cast("int"))
    texts = dealt.groupBy("bucket").cogroup(found.df.where(f"kind = {OPEN}").groupBy("bucket")).applyInArrow(contexts, SCHEMA)
    more = Written(texts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, SCHEMA), "sorted")
    return found.df.where(f"kind = {COVERED}").union(more.df), n_buckets


#: Contexts whose bytes are taken at once. Contexts whose suffixes are sorted at once; contexts from which on an anchor's are dealt on window by window.
TAKEN = 1 << 17
SORTED = 8192
HOT = 4096
#: Marks the windows of such contexts; more than windows that a context can have.
MANY = 128
_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *((f"c{i}", pa.binary()) for i in range(COLUMNS))])


def without_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of `docs` (doc_id, text), and with keep_text the bytes left.

    Texts are UTF-8 bytes (null: empty). Each byte goes that is covered by a 50-byte string which also starts in a
    document with a smaller doc_id; strings are judged on the input. Rows with a null doc_id keep all and take no part;
    doc_id must identify a text: rows that repeat one with its text are all treated alike. Texts below 50 bytes stay.
    An empty table gives an empty result, other columns are ignored.
    """
    spans, n_buckets = removed_spans(docs)
    all_docs = docs.select(docs["doc_id"].cast("long").alias("id"), "text")
    own = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("text"), F.lit(n_buckets))).otherwise(F.pmod("id", F.lit(n_buckets))).cast("int")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def cut(key: tuple, texts: pa.Table, covered: pa.Table) -> pa.Table:
        parts = [c for b in covered.select(["kind", "bucket", *(f"c{i}" for i in range(COLUMNS))]).to_batches() for _, c in unpack(b, KINDS)]
        doc, start, end = (np.concatenate([np.zeros(0, np.int64), *[p[i] for p in parts]]) for i in range(3))
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        ids = texts.column("id").to_pylist()
        data, offs = text_buffers(texts.column("text"))
        rows = []
        for i, d in enumerate(ids):
            raw = data[offs[i] : offs[i + 1]]
            lo, hi = (0, 0) if d is None else np.searchsorted(doc, [d, d + 1])
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, np.minimum(start[lo:hi], len(raw)), 1)
            np.add.at(edge, np.minimum(end[lo:hi], len(raw)), -1)
            gone = np.cumsum(edge)[:-1] > 0
            spans_ = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            left = raw[~gone].tobytes()
            rows.append((d, len(raw), int(gone.sum()), spans_, hashlib.sha256(left).hexdigest(), left)[: 5 + keep_text])
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=names[: len(kinds)])

    return all_docs.withColumn("bucket", own).groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(cut, schema)
