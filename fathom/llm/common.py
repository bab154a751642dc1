"""Shared pieces: table access, the shared work folder, Arrow text buffers, word hashing, connected components."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one round of NumPy work takes (a longer text is taken alone).
SLICE_BYTES = 1 << 20

#: The six white-space bytes that end a word: 0x20 and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_folder: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="fathom-")
    return _own_folder[app]


#: While a table is written, Spark removes a query's shuffle files when the query ends, and texts go to and from Python in small batches.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


class Written:
    """A DataFrame written as Parquet in the work folder, so its lineage ends there and its shuffle files can go at once."""

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self.path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
        before = {k: spark.conf.get(k, None) for k in SETTINGS}
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        try:
            df.write.parquet(self.path)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        self.df = spark.read.schema(df.schema).parquet(self.path)
        if _steps:
            _steps[-1].tables.append(self)

    def drop(self) -> None:
        """Removes the files; only for a table that nothing reads any more."""
        spark = self.df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    return Written(df, name).df


class Step:
    """As a context: the tables that are written in it are dropped at its end, but for those that are kept.

    Kept ones belong to the step around it, if there is one. Nothing that is used after it may read the others.
    """

    def __init__(self) -> None:
        self.tables: list[Written] = []
        self.kept: list[Written] = []

    def keep(self, *tables: Written) -> None:
        self.kept += tables

    def __enter__(self) -> Step:
        _steps.append(self)
        return self

    def __exit__(self, *_: object) -> None:
        _steps.remove(self)
        for t in self.tables:
            if t not in self.kept:
                t.drop()
        if _steps:
            _steps[-1].tables += self.kept


#: Steps that are under way, the innermost last.
_steps: list[Step] = []


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of a task's batches that returns free memory, Arrow's and the C library's, when the task ends: workers live on, beside those of later stages."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            give_back()

    return whole


def give_back() -> None:
    """Returns the C library's free memory to the system, where it can (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# ---------------------------------------------------------------- Arrow text


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (null as empty) and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    offs = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; every row is in one range, whole."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


# ---------------------------------------------------------------- hashing

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        _powers[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64)))) for x in (_BASE, _INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray, lut: np.ndarray = _BYTE) -> np.ndarray:
    """Prefix polynomial hashes: out[j] - out[i] belongs to data[i:j], scaled by base**i."""
    p, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(lut[data] * p, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the same wherever equal bytes stand."""
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def window_hashes(prefix: np.ndarray, k: int) -> np.ndarray:
    """range_hash() of the k bytes from each place on where they stand."""
    _, inverse = powers(len(prefix))
    h = prefix[k:] - prefix[:-k]
    h *= inverse[: len(h)]
    h += np.uint64(k)
    return mix(h)


def word_spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the row that holds it; words don't cross rows.

    `inside` says which bytes belong to words, if not all but white space.
    """
    if inside is None:
        inside = ~IS_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    edges = offs[(offs >= 0) & (offs <= len(data))]
    start_ok, end_ok = before.copy(), after.copy()
    start_ok[edges] = False  # what stands before a row's first byte is no part of it
    end_ok[edges] = False
    starts = np.flatnonzero(inside & ~start_ok[:-1])
    ends = np.flatnonzero(inside & ~end_ok[1:]) + 1
    rows = np.searchsorted(offs, starts, "right") - 1
    return starts, ends, rows


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number; zeros follow the last one."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


_BELOW = (np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1)
#: Lanes of a span that are mixed in bulk; a span beyond them is hashed alone.
LANES = 128


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] in which every eight bytes pass a mixer.

    Texts can be made whose hashes are equal, so equal hashes prove nothing: what depends on them is compared by bytes.
    """
    size = end - start
    out = mix(size.astype(np.uint64) ^ _BASE)
    every = lanes(data)
    todo = np.arange(len(start))
    for k in range(LANES):
        left = size[todo] - 8 * k
        x = every[start[todo] + 8 * k]
        short = left < 8
        x[short] &= _BELOW[left[short]]
        out[todo] = mix(out[todo] ^ x)
        todo = todo[left > 8]
        if not len(todo):
            break
    for i in todo.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def numbered(h: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray], exact: Callable[[], np.ndarray]) -> np.ndarray:
    """A number for each element, equal where elements are equal, from their hashes.

    same(i, j) compares elements i and j themselves; exact() numbers all without hashes, if ever unlike ones share one.
    """
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    run = np.cumsum(new) - 1
    number = np.empty(len(h), np.int64)
    number[order] = run
    lead = order[new][run]
    other = ~new
    return number if same(order[other], lead[other]).all() else exact()


def equal_spans(x: np.ndarray, at: np.ndarray, x_size: np.ndarray, y: np.ndarray, to: np.ndarray, y_size: np.ndarray) -> np.ndarray:
    """Whether x[at : at + x_size] is y[to : to + y_size], byte by byte, for each pair of places; x and y are lanes()."""
    out = x_size == y_size
    todo = np.flatnonzero(out)
    k = 0
    while len(todo):
        left = x_size[todo] - 8 * k
        differ = x[at[todo] + 8 * k] ^ y[to[todo] + 8 * k]
        short = left < 8
        differ[short] &= _BELOW[left[short]]
        out[todo[differ != 0]] = False
        todo = todo[(left > 8) & (differ == 0)]
        k += 1
    return out


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word data[start:end], equal where words are equal byte by byte."""
    every, size = lanes(data), end - start

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return equal_spans(every, start[i], size[i], every, start[j], size[j])

    def exact() -> np.ndarray:
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)

    return numbered(span_hashes(data, start, end), same, exact)


def tuple_numbers(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row of the columns (integers), equal where rows are equal."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = mix(h ^ c.astype(np.uint64)) + np.uint64(1)

    def exact() -> np.ndarray:
        return np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)[1].reshape(-1)

    return numbered(h, lambda i, j: np.logical_and.reduce([c[i] == c[j] for c in columns]), exact)


#: Bits of an element's number; owners in one piece of work have the other 20.
NUMBER_BITS = 44


def distinct(owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order."""
    bits = np.uint64(NUMBER_BITS)
    both = np.sort(owner.astype(np.uint64) << bits | number.astype(np.uint64))
    both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
    owner = both >> bits
    return owner.astype(np.int64), (both ^ owner << bits).astype(np.int64)


def shingle_places(rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First element, size and row of each shingle of k of a row's elements (all of them where a row has fewer)."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(count) - count
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(n_rows), n)
    at = first[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]
    return at, np.minimum(count[row], k), row


def word_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct shingles of k words as (row, 64-bit hash), in order; A-Z are lowered.

    Unlike shingles are told apart by their words, so of a row with colliding ones some hash stands twice. With fewer than k words the whole sequence counts as one shingle; without words there is none.
    """
    low = LOWER[data]
    start, end, rows = word_spans(low, offs)
    w = span_hashes(low, start, end)
    at, size, row = shingle_places(rows, len(offs) - 1, k)
    h = mix(size.astype(np.uint64))
    for i in range(k):
        use = slice(None) if (size > i).all() else size > i
        h[use] = mix(h[use] ^ w[at[use] + i])
    order = np.arange(len(h))
    edges = np.searchsorted(row, np.arange(len(offs)))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        order[lo:hi] = lo + h[lo:hi].argsort()
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    # Shingles of equal hashes count once only if their words are equal.
    i = np.flatnonzero(~new)
    x, y = order[i], order[i - 1]
    same = size[x] == size[y]
    every, length = lanes(low), end - start
    for j in range(k):
        p, q = at[x[same]] + np.minimum(j, size[x[same]] - 1), at[y[same]] + np.minimum(j, size[x[same]] - 1)
        same[same] = equal_spans(every, start[p], length[p], every, start[q], length[q])
    if same.all():
        return row[new], h[new]
    number = word_numbers(low, start, end)
    padded = np.append(number, np.full(k, -1))
    number = tuple_numbers([np.where(size > i, padded[at + i], -1) for i in range(k)])[order]
    by_number = np.lexsort((number, row))
    first = np.sort(by_number[np.append(True, (np.diff(row[by_number]) != 0) | (np.diff(number[by_number]) != 0))])
    return row[first], h[first]


def exact_word_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As word_shingles(), but the second column numbers the shingles by their words themselves, within these rows alone."""
    low = LOWER[data]
    start, end, rows = word_spans(low, offs)
    number = word_numbers(low, start, end)
    at, size, row = shingle_places(rows, len(offs) - 1, k)
    padded = np.append(number, np.full(k, -1))
    return distinct(row, tuple_numbers([np.where(size > i, padded[at + i], -1) for i in range(k)]))


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long) by distributed union-find.

    Tasks first shrink their own edges to a forest. Then each round hooks every node to its smallest neighbour, jumps
    along parents until all point to roots, and rewrites the edges between roots; components at least halve in number.
    All steps are grouped minima and joins. Returns (id, component_id) for every node of an edge; component_id is the
    component's smallest id. Self-loops and repeated edges are harmless; edges with a null end are ignored.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = local_forest(*(c.to_numpy() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    def step(df: DataFrame, name: str, what: str) -> tuple[Written, bool]:
        """The rows without `what`, written, and whether it was true in any of them."""
        seen = Observation()
        out = Written(df.observe(seen, F.max(F.col(what).cast("int")).alias("n")).drop(what), name)
        return out, bool(seen.get["n"])

    some = edges.where("a is not null and b is not null").select("a", "b").mapInArrow(forest, "a long, b long")
    edge, more = step(some.distinct().withColumn("any", F.lit(True)), "edges", "any")
    label = None
    while more or label is None:
        both = edge.df.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edge.df.select("b", "a"))
        parent, moved = Written(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("root")), "parents"), True
        while moved:
            up = parent.df.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jump = parent.df.join(up, "root").select("id", "root", "next").join(up.select(F.col("root").alias("next"), F.col("next").alias("last")), "next")
            jumped, moved = step(jump.select("id", F.col("last").alias("root"), (F.col("last") != F.col("next")).alias("moved")), "parents", "moved")
            parent.drop()
            parent = jumped
        if label is None:
            label = parent
        else:
            up = parent.df.select(F.col("id").alias("root"), F.col("root").alias("next"))
            newer = Written(label.df.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "labels")
            label.drop()
            label = newer
        ends = edge.df
        for c in ("a", "b"):
            ends = ends.join(parent.df.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root")), c)
        left = ends.where("a_root != b_root").select(F.greatest("a_root", "b_root").alias("a"), F.least("a_root", "b_root").alias("b")).distinct()
        left, more = step(left.withColumn("any", F.lit(True)), "edges", "any")
        edge.drop()
        if parent is not label:
            parent.drop()
        edge = left
    edge.drop()
    return label.df.select("id", F.col("root").alias("component_id"))


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges a-b connect."""
    ids, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            up = new[new]
            if np.array_equal(up, new):
                break
            new = up
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(ids))
    return ids[keep], ids[root[keep]]
