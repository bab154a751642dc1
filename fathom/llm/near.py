"""Groups of near copies from shared keys, without ever pairing all members of a key.

An item is a text, or a line of one, with A-Z lowered and white-space runs as one space. Equal items meet by a 128-bit
digest: a task sends each of its items once, and of all places where an item stands the first one represents it.
Items that share a key are candidates. In each key all members are paired with one leader, the member that shares most
of its keys, so that a group's keys mostly have the same leader: first within a task's own items, so that only one entry
per key goes into the shuffle, and then among those. Of each member's pairs the one with most keys is verified first,
exactly; links are joined by distributed union-find; then pairs that are still apart are verified. Where a pair fails
and stays apart, the keys that it shares are open: there every two members of different groups are compared, of short
keys as pairs, of long ones in blocks that only return a spanning forest. So the result is that of comparing all
members of all keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import IS_SPACE, LOWER, NUMBER_BITS, Step, Written, components, local_forest, mix, tidy
from fathom.llm.packed import bucket_count, bucketed_by, pack, total_bytes
from fathom.llm.terms import bloom, maybe_in

#: Bytes of items that are worked on at once (a longer item is taken alone).
SLICE = 1 << 17
#: Keys and places that a task gathers before it packs them; bounds its memory.
HELD = 1_000_000
#: Members that are verified with one copy of their leader's text; members of an open key up to which its pairs are
#: listed; members, and bytes of their items, of a block beyond it; rows and elements of a matrix that is multiplied at once.
TEAM = 256
SHORT = 32
BLOCK = 2048
BLOCK_BYTES = 8 << 20
ROWS = 512
ELEMENTS = 2048


@dataclass(frozen=True)
class Keys:
    """of: the item of each key; keys; size: each item's size, for the caller.

    An item may leave out free[item, f] of its keys of family f, chosen by the keys alone: items that link have another
    key in common then. family is -1 for keys that may not go; without families none may.
    """

    of: np.ndarray
    keys: np.ndarray
    size: np.ndarray
    family: np.ndarray | None = None
    free: np.ndarray | None = None


@dataclass(frozen=True)
class Scheme:
    """How items are made and compared.

    parts: a text's parts, each of which is an item. keys: the keys of items. numbers (below 2**NUMBER_BITS): from items, the distinct (item, element) in order, elements numbered exactly within these items.
    Items link where intersection >= similarity * union of their elements, and they have one in common.
    """

    parts: Callable[[bytes], list[bytes]]
    keys: Callable[[list[bytes]], Keys]
    numbers: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    similarity: Fraction


def normal(part: bytes) -> bytes:
    """A-Z lowered, runs of the six white-space bytes as one space, none at the ends."""
    part = part.translate(_PLAIN)
    return b" ".join(part.split()) if b"  " in part else part.strip(b" ")


#: Each byte with A-Z lowered and white space as a space.
_PLAIN = bytes(np.where(IS_SPACE, np.uint8(0x20), LOWER))


def digest(item: bytes) -> bytes:
    return hashlib.blake2b(item, digest_size=16).digest()


def id_of(digests: np.ndarray) -> np.ndarray:
    """63 bits of each digest (V16)."""
    return (digests.view(np.uint64).reshape(-1, 2)[:, 0] >> np.uint64(1)).astype(np.int64)


def identity(item: bytes) -> tuple[int, int]:
    """The columns a and b of an item: id_of() its digest, and the digest's second half."""
    d = digest(item)
    return int.from_bytes(d[:8], "little") >> 1, int.from_bytes(d[8:], "little", signed=True)


def sliced(items: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of items of about SLICE bytes."""
    lo, size = 0, 0
    for i, x in enumerate(items):
        if size and size + len(x) > SLICE:
            yield lo, i
            lo, size = i, 0
        size += len(x)
    if lo < len(items):
        yield lo, len(items)


def counted(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their n."""
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    start = np.flatnonzero(new)
    return a[start], b[start], np.add.reduceat(n, start) if len(start) else n


def lead(keys: np.ndarray, ids: np.ndarray, weight: np.ndarray | None = None, of: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct keys, their leaders (largest weight, then smallest id) and the leaders' weights; and the distinct pairs
    (leader, other id of the key) with the number of keys.

    In place of weights there may be the number of each key's item: its weight is the number of its keys that others have.
    """
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    size = np.diff(np.append(start, len(keys)))
    many = np.flatnonzero(size > 1)  # most keys have one member, which is their leader
    shared = np.flatnonzero(np.repeat(size > 1, size))
    if weight is None:
        of = of[order]
        weight = np.minimum(np.bincount(of[shared], minlength=int(of.max(initial=-1)) + 1), 255).astype(np.uint8)[of]
    else:
        weight = weight[order]
    first, top = ids[start], weight[start]
    if not len(many):
        return keys[start], first, top, ids[:0], ids[:0], ids[:0]
    size, ids, weight = size[many], ids[shared], weight[shared]
    begin, run = np.cumsum(size) - size, np.repeat(np.arange(len(many)), size)
    top[many] = np.maximum.reduceat(weight, begin)
    first[many] = np.minimum.reduceat(np.where(weight == top[many][run], ids, np.iinfo(np.int64).max), begin)
    a = first[many][run]
    other = ids != a
    return keys[start], first, top, *counted(a[other], ids[other], np.ones(int(other.sum()), np.int64))


FIRST, ENTRY, PAIR, AGAIN = 0, 1, 2, 3
KINDS = {
    FIRST: ["V16", np.int64, np.int32, np.int32],
    ENTRY: [np.uint32, np.int64, np.uint8],  # of the key its low half; the bucket comes from the high one
    PAIR: [np.int64, np.int64, np.int64],
    AGAIN: ["V16", np.int64, np.int32, np.int32],
}
WIDTH = max(map(len, KINDS.values()))
PACKED = "kind int, bucket int, " + ", ".join(f"c{i} binary" for i in range(WIDTH))
#: kind FIRST and AGAIN: item id, rest of its digest, its place (doc_id, part; ~part if another row has that place too), its
#: size, and for FIRST its node (the id, or another number if an unlike item has the same id); kind PAIR: nodes a and b, and
#: the n keys in which a leads b.
FOUND = "kind int, a long, b long, n long, doc_id long, part int, size int, node long"


def firsts(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows (item's columns, doc_id, part) the order by them, and in it: each item's first row, and rows that repeat a place."""
    order = np.lexsort(columns[::-1])
    same = [np.concatenate(([False], c[order][1:] == c[order][:-1])) for c in columns]
    again = np.logical_and.reduce(same[:-2])
    return ~again, again & same[-2] & same[-1], order


def candidates(source: DataFrame, scheme: Scheme, name: str) -> Written:
    """Written rows of FOUND for all items of source (id long, not null; text) that have a word."""
    n_buckets = bucket_count(total_bytes(source, "text"))
    dealt = lambda h: ((h >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)  # noqa: E731  hashes in order give buckets in order

    def row(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        batch = pack(kind, bucket, columns)
        none = pa.nulls(len(batch), pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, *[none] * (WIDTH - len(columns))], names=["kind", "bucket", *(f"c{i}" for i in range(WIDTH))])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}  # digests of the items that this task has gathered
        places: list[list[int]] = [[], [], []]  # item, doc_id, part
        fresh: list[bytes] = []
        made: list[tuple[np.ndarray, np.ndarray]] = []  # items and their keys
        sizes: list[np.ndarray] = []
        held = fresh_bytes = 0

        def make() -> None:
            nonlocal held, fresh_bytes
            base = len(known) - len(fresh)
            for lo, hi in sliced(fresh):
                found = scheme.keys(fresh[lo:hi])
                made.append(((found.of + base + lo).astype(np.int32), found.keys))
                sizes.append(found.size.astype(np.int32))
                held += len(found.keys)
            fresh.clear()
            fresh_bytes = 0

        def flush() -> Iterator[pa.RecordBatch]:
            item, doc, part = (np.array(x, np.int64) for x in places)
            digests, size = np.frombuffer(b"".join(known), "V16"), np.concatenate(sizes)
            new, twin, order = firsts(item, doc, part)
            item, doc, part = item[order], doc[order], np.where(twin, ~part[order], part[order]).astype(np.int32)
            ids = id_of(digests)
            for kind, at, where in ((FIRST, new, ids[item[new]]), (AGAIN, ~new, doc[~new])):
                yield row(kind, dealt(mix(where.view(np.uint64))), [digests[item[at]], doc[at], part[at], size[item[at]]])
            of, keys = np.concatenate([i for i, _ in made]), np.concatenate([k for _, k in made])
            made.clear()
            keys, first, weight, a, b, n = lead(keys, ids[of], of=of)
            # Keys that agree in their bucket and low half count as one: what meets by them is compared all the same.
            yield row(ENTRY, dealt(keys), [keys.astype(np.uint32), first, weight])
            yield row(PAIR, dealt(mix(a.view(np.uint64) ^ b.view(np.uint64))), [a, b, n])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for number, part in enumerate(scheme.parts(text.as_py() or b"")):
                    item = normal(part)
                    if not item:
                        continue
                    d = digest(item)
                    if d not in known:
                        known[d] = len(known)
                        fresh.append(item)
                        fresh_bytes += len(item)
                    places[0].append(known[d])
                    places[1].append(doc)
                    places[2].append(number)
                if fresh_bytes >= SLICE:
                    make()
                if held + len(places[0]) >= HELD:
                    make()
                    yield from flush()
                    known, places, made, sizes, held = {}, [[], [], []], [], [], 0
        if places[0]:
            make()
            yield from flush()

    def rows(kind: int, **columns: np.ndarray) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        fields = [f.split() for f in FOUND.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64()}
        columns["kind"] = np.full(n, kind)
        return pa.RecordBatch.from_arrays([pa.array(columns[f], types[t]) if f in columns else pa.nulls(n, types[t]) for f, t in fields], names=[f for f, _ in fields])

    def items(kind: int, digests: np.ndarray, doc: np.ndarray, part: np.ndarray, size: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
        return rows(kind, a=id_of(digests), b=digests.view(np.int64).reshape(-1, 2)[:, 1], doc_id=doc, part=part, size=size, **more)

    def settle(kind: int, parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Of one bucket."""
        columns = [np.concatenate([p[i] for p in parts]) for i in range(len(KINDS[kind]))]
        if kind == AGAIN:
            yield items(AGAIN, *columns)
        elif kind == FIRST:
            digests, doc, part, size = columns
            words = digests.view(np.uint64).reshape(-1, 2)
            new, twin, order = firsts(words[:, 0], words[:, 1], doc, part)
            digests, doc, part, size, words = digests[order], doc[order], np.where(twin, ~part[order], part[order]), size[order], words[order]
            yield items(AGAIN, digests[~new], doc[~new], part[~new], size[~new])
            digests, doc, part, size, words = digests[new], doc[new], part[new], size[new], words[new]
            node = id_of(digests)
            twin = np.zeros(len(node), bool)
            twin[1:] = node[1:] == node[:-1]  # unlike items with one id: those after the first are told apart
            node[twin] = (mix(words[twin, 1] ^ words[twin, 0]) >> np.uint64(1)).astype(np.int64)
            yield items(FIRST, digests, doc, part, size, node=node)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in bucketed_by(batches, KINDS):
            for kind in (FIRST, AGAIN):
                if kind in parts:
                    yield from settle(kind, parts[kind])
            pairs = parts.get(PAIR, [])
            if ENTRY in parts:
                columns = (np.concatenate([p[i] for p in parts[ENTRY]]) for i in range(3))
                pairs = [*pairs, list(lead(*columns)[3:])]
            if pairs:
                a, b, n = counted(*(np.concatenate([p[i] for p in pairs]) for i in range(3)))
                yield rows(PAIR, a=a, b=b, n=n)

    shared = source.select("id", "text").mapInArrow(tidy(share), PACKED)
    return Written(shared.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(gather), FOUND), name)


def fetched(source: DataFrame, wanted: DataFrame, scheme: Scheme, name: str) -> Written:
    """Written (id, text): the items of wanted (node, a, b, doc_id, part) from the documents where they stand first."""
    per_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("part", "a", "b", "node")).alias("items"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked: set[int] = set()  # rows of one doc_id are in one task
        for batch in batches:
            ids, texts = [], []
            for text, items in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                parts = scheme.parts(text.as_py() or b"")
                for x in items:
                    item = normal(parts[x["part"]]) if x["part"] < len(parts) and x["node"] not in picked else b""
                    if item and identity(item) == (x["a"], x["b"]):  # of rows that repeat a doc_id the first that has the item counts
                        picked.add(x["node"])
                        ids.append(x["node"])
                        texts.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], names=["id", "text"])

    # Only texts that may be wanted travel: others fail a Bloom filter of the ids, which has a bounded size.
    own = F.xxhash64("doc_id").alias("h")
    bits = source.sparkSession.sparkContext.broadcast(bloom(per_doc.select(own)))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = maybe_in(bits.value, batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names=["doc_id", "text"]).filter(pa.array(ok))

    source = source.select(F.col("id").alias("doc_id"), "text").select(own, "doc_id", "text").mapInArrow(tidy(maybe), "doc_id long, text string")
    # Dealt by a number of its own, so that no skewed partition is split; the short side is hashed, so texts need no sorting.
    tasks = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = source.repartition(tasks, "doc_id").join(per_doc.hint("shuffle_hash"), "doc_id").select("text", "items")
    return Written(docs.mapInArrow(tidy(pick), "id long, text binary"), name)


def linked(owner: np.ndarray, number: np.ndarray, n: int, leader: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Whether each of n items links with its leader, the item whose number is given."""
    edges = np.searchsorted(owner, np.arange(n + 1))
    size = np.diff(edges)
    # Each member's elements and, with the member's number, its leader's: equal neighbours in order are common ones.
    member = np.flatnonzero(leader != np.arange(n))
    many = size[leader[member]]
    who = np.repeat(member, many)
    at = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + edges[leader[who]]
    bits = np.uint64(NUMBER_BITS)
    mine = owner != leader[owner]
    all_ = np.sort(np.concatenate([owner[mine].astype(np.uint64) << bits | number[mine].astype(np.uint64), who.astype(np.uint64) << bits | number[at].astype(np.uint64)]))
    both = np.bincount((all_[1:][all_[1:] == all_[:-1]] >> bits).astype(np.int64), minlength=n)
    return (both > 0) & (similarity.denominator * both >= similarity.numerator * (size + size[leader] - both))


def common_keys(keys: list[np.ndarray], left: np.ndarray, right: np.ndarray, row: np.ndarray, n: int) -> list[list[int] | None]:
    """For pairs of numbers in `keys` their common keys, each at its row among n rows."""
    size = np.array([len(x) for x in keys])
    both = np.concatenate([keys[i] for pair in zip(left.tolist(), right.tolist(), strict=True) for i in pair])
    pair = np.repeat(np.arange(len(left)), size[left] + size[right])
    order = np.argsort(both ^ mix(pair.astype(np.uint64)))
    a, b = order[:-1], order[1:]
    hit = a[(both[a] == both[b]) & (pair[a] == pair[b])]
    out: list[list[int] | None] = [None] * n
    for i in row.tolist():
        out[i] = []
    for i, key in zip(row[pair[hit]].tolist(), both[hit].view(np.int64).tolist(), strict=True):
        out[i].append(key)
    return out


def verified(pairs: DataFrame, texts: DataFrame, scheme: Scheme, with_keys: bool, name: str) -> Written:
    """Written rows (a, b, linked, keys): keys are those that the two share if they are not linked, null without with_keys.

    Members travel to their leader a, in teams of about TEAM with a copy of its text each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead: tuple[int, bytes] | None = None  # the leader of the rows that come next
        for batch in batches:
            ids, texts, leads = batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(2).to_pylist()
            for lo, hi in sliced(texts):
                who, items, is_lead = ids[lo:hi], texts[lo:hi], leads[lo:hi]
                if ahead and not is_lead[0]:
                    who, items, is_lead = [ahead[0], *who], [ahead[1], *items], [True, *is_lead]
                n = len(who)
                at = np.maximum.accumulate(np.where(is_lead, np.arange(n), 0))
                ahead = who[at[-1]], items[at[-1]]
                ok = linked(*scheme.numbers(items), n, at, scheme.similarity)
                member = np.flatnonzero(~np.array(is_lead))
                shared: list[list[int] | None] = [None] * n
                bad = member[~ok[member]]
                if with_keys and len(bad):
                    need = np.unique(np.concatenate([bad, at[bad]]))
                    keys = keys_of([items[i] for i in need], scheme)
                    shared = common_keys(keys, np.searchsorted(need, bad), np.searchsorted(need, at[bad]), bad, n)
                columns = [pa.array([who[at[i]] for i in member], pa.int64()), pa.array([who[i] for i in member], pa.int64()), pa.array(ok[member]), pa.array([shared[i] for i in member], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked", "keys"])

    # Comparing costs far more than moving, so the work is dealt to as many tasks as shuffles have.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    teams = pairs.groupBy("a").agg(F.ceil(F.count("*") / TEAM).cast("int").alias("teams"))
    seats = teams.where("teams > 1")
    members = pairs.select("a", "b").join(seats, "a", "left").select("a", F.pmod(F.xxhash64("b"), F.coalesce("teams", F.lit(1))).cast("int").alias("team"), "b")
    members = members.select("a", F.col("b").alias("id"), F.lit(False).alias("leads"), "team")
    leaders = teams.select("a", F.col("a").alias("id"), F.lit(True).alias("leads"), F.explode(F.sequence(F.lit(0), F.col("teams") - 1)).alias("team"))
    seated = texts.join(members.union(leaders).hint("shuffle_hash"), "id").repartition(tasks, "a", "team").sortWithinPartitions("a", "team", F.desc("leads"))
    return Written(seated.select("a", "id", "leads", "text").mapInArrow(tidy(run), "a long, b long, linked boolean, keys array<long>"), name)


def keys_of(items: list[bytes], scheme: Scheme) -> list[np.ndarray]:
    """The distinct keys of each item."""
    found = scheme.keys(items)
    order = np.argsort(found.of, kind="stable")
    edges = np.searchsorted(found.of[order], np.arange(len(items) + 1))
    keys = found.keys[order]
    return [np.unique(keys[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def block_links(ids: np.ndarray, owner: np.ndarray, number: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Links between the left and right members of different groups; intersections by one product of 0/1 matrices."""
    size = np.bincount(owner, minlength=len(ids))
    number = np.unique(number, return_inverse=True)[1]
    count = np.bincount(number)
    rank = np.cumsum(count > 1) - 1
    use = count[number] > 1
    e, o = rank[number[use]], owner[use]
    order = np.argsort(e, kind="stable")
    e, o = e[order], o[order]
    n = int(e[-1]) + 1 if len(e) else 0
    where = np.full(len(ids), -1)
    where[right] = np.arange(len(right))
    row = np.full(len(ids), -1)
    row[left] = np.arange(len(left))
    both = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, n, ELEMENTS):  # a slice of the elements, and some rows, at a time bound memory
        a, b = np.searchsorted(e, [lo, lo + ELEMENTS])
        ee, oo = e[a:b] - lo, o[a:b]
        k = where[oo] >= 0
        y = np.zeros((len(right), ELEMENTS), np.float32)
        y[where[oo[k]], ee[k]] = 1
        k = row[oo] >= 0
        i, j = row[oo[k]], ee[k]
        for begin in range(0, len(left), ROWS):
            use = (i >= begin) & (i < begin + ROWS)
            if use.any():
                x = np.zeros((min(ROWS, len(left) - begin), ELEMENTS), np.float32)
                x[i[use] - begin, j[use]] = 1
                both[begin : begin + ROWS] += x @ y.T
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for begin in range(0, len(left), ROWS):
        rows, common = left[begin : begin + ROWS], both[begin : begin + ROWS]
        i, j = np.nonzero((common > 0) & (group[rows][:, None] != group[right][None, :]))
        shared = common[i, j].astype(np.int64)
        union = size[rows[i]] + size[right[j]] - shared
        ok = similarity.denominator * shared >= similarity.numerator * union
        found.append((ids[rows[i[ok]]], ids[right[j[ok]]]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def long_key_links(postings: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): links among members of long open keys, by clusters of members whose keys overlap.

    postings has (key, id, group, bytes). Members of a cluster are dealt to blocks, those of one large group to blocks of
    their own, and pairs of blocks are compared unless they are of one group.
    """
    least = postings.groupBy("key").agg(F.min("id").alias("b"))
    cluster = components(postings.join(least, "key").where("id != b").select(F.col("id").alias("a"), "b"))
    members = Written(postings.select("id", "group", "bytes").distinct().join(cluster, "id").select("id", "group", "bytes", F.col("component_id").alias("cluster")), "members")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int")
    sizes = members.df.groupBy("cluster", "group").agg(parts.alias("parts"))
    large = sizes.where("parts > 1")
    pooled = members.df.join(large, ["cluster", "group"], "left_anti").groupBy("cluster").agg(parts.alias("pools"))
    placed = members.df.join(large, ["cluster", "group"], "left").join(pooled, "cluster", "left")
    own = F.col("parts").isNotNull()
    placed = placed.withColumn("of", F.when(own, F.col("group"))).withColumn("block", F.when(own, F.pmod(F.xxhash64("id"), "parts")).otherwise(F.pmod(F.xxhash64("group"), "pools")).cast("int"))
    placed_w = Written(placed.select("cluster", "of", "block", "id", "group"), "placed")
    kinds = placed_w.df.select("cluster", F.struct(F.coalesce("of", F.lit(-1)).alias("of"), "block").alias("x")).distinct()
    twice = kinds.join(kinds.withColumnRenamed("x", "y"), "cluster").where("x <= y and (x.of != y.of or x.of = -1)")
    sides = twice.select("cluster", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("side"))
    mine = placed_w.df.select("cluster", F.struct(F.coalesce("of", F.lit(-1)).alias("of"), "block").alias("side"), "id", "group")
    dealt = sides.join(mine, ["cluster", "side"]).join(texts, "id").withColumn("first", F.col("side") == F.col("x")).withColumn("cross", F.col("x") != F.col("y"))
    kinds_out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        ids, group, first = (table.column(c).to_numpy() for c in ("id", "group", "first"))
        owner, number = scheme.numbers(table.column("text").to_pylist())
        cross = table.column("cross")[0].as_py()
        left, right = (np.flatnonzero(first), np.flatnonzero(~first)) if cross else (np.arange(len(ids)),) * 2
        a, b = block_links(ids, owner, number, group, left, right, scheme.similarity)
        if len(a):
            a, b = local_forest(a, b)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=kinds_out)

    # Pairs of blocks are few bytes and much work: they are dealt to as many tasks as shuffles have, and not put together again.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "cluster", "x", "y").groupBy("cluster", "x", "y").applyInArrow(run, "a long, b long")


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are in different groups so far."""
    for c in ("a", "b"):
        pairs = pairs.join(found.select(F.col("id").alias(c), F.col("component_id").alias(f"{c}_group")), c, "left")
    return pairs.where("coalesce(a_group, a) != coalesce(b_group, b)").drop("a_group", "b_group")


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The groups (id, component_id) that the links (a, b) make of found ones, whose own links are not needed again."""
    ends = links
    for c in ("a", "b"):
        ends = ends.join(found.select(F.col("id").alias(c), F.col("component_id").alias(f"{c}_group")), c, "left")
    ends = Written(ends.select("a", "b", F.coalesce("a_group", "a").alias("x"), F.coalesce("b_group", "b").alias("y")), "ends")
    larger = components(ends.df.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    # Items without a group so far are their own.
    new = ends.df.where("a = x").select(F.col("a").alias("id")).union(ends.df.where("b = y").select("b")).distinct().join(found, "id", "left_anti")
    every = found.union(new.select("id", F.col("id").alias("component_id")))
    larger = larger.select(F.col("id").alias("component_id"), F.col("component_id").alias("least"))
    out = Written(every.join(larger, "component_id", "left").select("id", F.coalesce("least", "component_id").alias("component_id")), "labels")
    ends.drop()
    return out.df


def groups(pairs: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, component_id) of all items that have a link, from candidate pairs (a, b, n); texts (id, text) has their items."""
    best = pairs.groupBy("b").agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
    best = Written(best, "best")
    first = verified(best.df, texts, scheme, True, "verified")
    found = components(first.df.where("linked").select("a", "b"))
    rest = Written(apart(pairs.select("a", "b").join(best.df, ["a", "b"], "left_anti"), found), "rest")
    second = verified(rest.df, texts, scheme, True, "verified")
    best.drop()
    rest.drop()
    more = second.df.where("linked").select("a", "b")
    if more.head(1):
        found = joined(found, more)
    failed = first.df.where("not linked").union(second.df.where("not linked"))
    open_keys = Written(apart(failed, found).select(F.explode("keys").alias("key")).distinct(), "open")
    if not open_keys.df.head(1):
        return found

    # Only keys that may be open leave Python; others fail a Bloom filter of bounded size.
    bits = texts.sparkSession.sparkContext.broadcast(bloom(open_keys.df))

    def keys_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(1).to_pylist()
            for lo, hi in sliced(items):
                found = scheme.keys(items[lo:hi])
                at = np.flatnonzero(maybe_in(bits.value, found.keys))
                of, keys = found.of[at], found.keys[at]
                family = np.full(len(at), -1, np.int8) if found.family is None else found.family[at]
                free = np.zeros(len(at), np.int32) if found.free is None else np.where(family >= 0, found.free[of, np.maximum(family, 0)], 0)
                size = np.array([len(x) for x in items[lo:hi]], np.int64)[of]
                columns = [batch.column(0)[lo:hi].take(pa.array(of)), pa.array(keys.view(np.int64)), pa.array(family), pa.array(free.astype(np.int32)), pa.array(size)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "family", "free", "bytes"])

    postings = texts.mapInArrow(tidy(keys_run), "id long, key long, family byte, free int, bytes long").join(open_keys.df, "key")
    postings = Written(postings.join(found, "id", "left").select("key", "id", "family", "free", "bytes", F.coalesce("component_id", "id").alias("group")).distinct(), "postings")
    sizes = Written(postings.df.groupBy("key").agg(F.count("*").alias("n"), F.min("group").alias("g"), F.max("group").alias("h")).where("g != h").select("key", "n"), "sizes")
    short = postings.df.join(sizes.df.where(F.col("n") <= SHORT), "key")
    left = short.select("key", F.col("id").alias("a"), F.col("group").alias("a_group"))
    right = short.select("key", F.col("id").alias("b"), F.col("group").alias("b_group"))
    tried = failed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crossed = Written(left.join(right, "key").where("a < b and a_group != b_group").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "crossed")
    third = verified(crossed.df, texts, scheme, False, "verified").df.where("linked").select("a", "b")
    if sizes.df.where(F.col("n") > SHORT).head(1):
        # Items with few enough long keys leave them out: their partners share another key with them, which is done already.
        long_ = Written(postings.df.join(sizes.df.where(F.col("n") > SHORT).select("key"), "key"), "long")
        able = long_.df.where("family >= 0").groupBy("id", "family", "free").agg(F.count("*").alias("n")).where("n <= free").select("id", "family")
        long_ = long_.df.join(able, ["id", "family"], "left_anti").select("key", "id", "group", "bytes")
        third = Written(third.union(long_key_links(long_, texts, scheme)), "links").df
    for done in (open_keys, postings, crossed):
        done.drop()
    return joined(found, third) if third.head(1) else found


def near_groups(source: DataFrame, scheme: Scheme, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For source (id, text): the items' first places (a, b, doc_id, part, size, node), their other places (a, b, doc_id,
    part, size), and (node, own, least) of linked items: structs (doc_id, part) of their own place and the first one of their group.

    a and b together are an item's identity. Rows that repeat an id are places of their own texts.
    """
    with Step() as step:
        found = candidates(source, scheme, name)
        firsts = found.df.where(f"kind = {FIRST}").select("a", "b", "doc_id", "part", "size", "node")
        again = found.df.where(f"kind = {AGAIN}").select("a", "b", "doc_id", "part", "size")
        pairs = Written(found.df.where(f"kind = {PAIR}").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
        ids = pairs.df.select(F.col("a").alias("node")).union(pairs.df.select("b")).distinct()
        wanted = Written(firsts.join(ids.hint("shuffle_hash"), "node"), "wanted")
        texts = fetched(source, wanted.df, scheme, "texts")
        label = groups(pairs.df, texts.df, scheme)
        places = wanted.df.select("node", F.struct("doc_id", "part").alias("own")).join(label.withColumnRenamed("id", "node"), "node")
        least = Written(places.groupBy("component_id").agg(F.min("own").alias("least")), "least")
        result = Written(places.join(least.df, "component_id").select("node", "own", "least"), "groups")
        step.keep(found, result)
    return firsts, again, result.df
