"""Spelling variants of the words of a corpus: pairs one edit apart, by composition of finite-state machines.

The vocabulary's minimised acceptor is composed with a one-edit transducer and with the acceptor again; the accepted pairs
are the words that are one edit apart (acceptor.py). No task holds the whole vocabulary: the pairs are cut by where their
composition starts. A pair that reads HEAD or more code points alike lies in the sub-acceptor behind those; any other
pair has its edit there, so its last TAIL code points are alike and it lies in one sub-acceptor of the reversed words.
Initial states with more than MOST words behind them are replaced by the states one symbol on, again and again. What that
cuts apart are pairs whose edit stands at one of the symbols passed: there the rest of both words is the same,
so words without that symbol are equal, and these meet by it, at most an alphabet's size of words at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fathom.llm.acceptor import Acceptor, edit_pairs
from fathom.llm.common import LOWER, Written, slices, text_buffers, word_numbers, word_spans

#: Code points of the shortest words.
LEAST = 7
#: Code points that choose the initial state, from the front and from the back; HEAD + TAIL <= LEAST, so each pair has one alike.
HEAD, TAIL = 3, 4
#: Words of one sub-acceptor, and of several small ones that are composed at once.
MOST = 30_000
#: Distinct words that a task gathers before it hands on their counts.
GATHERED = 400_000

#: Rows that a task gathers before it hands them on.
OUT = 10_000

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF, and of nothing else
#: Bytes of a run up to which checksums are computed in bulk.
BULK = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end], each carried on from the CRC-32 `before` of what stands ahead of it."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = end - start
    todo = np.flatnonzero(size <= BULK)
    for k in range(BULK):
        todo = todo[size[todo] > k]
        if not len(todo):
            break
        state[todo] = _CRC[(state[todo] ^ data[start[todo] + k]) & np.uint32(0xFF)] ^ (state[todo] >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > BULK).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(before[i]))
    return out


def vocabulary(docs: DataFrame, delete_every: int = 31) -> DataFrame:
    """(word, n): words of at least LEAST code points that occur twice or more in all texts.

    A word is a run of Latin letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lowered. Where `delete_every` divides h, the
    CRC-32 of "doc_id:run", the run's code point h % length goes. A null doc_id counts as empty there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()).cast(pa.string()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            heads = np.array([zlib.crc32(f"{d}:".encode()) for d in batch.column(0).to_pylist()], np.uint32)
            for lo, hi in slices(offs):
                low = LOWER[data[offs[lo] : offs[hi]]]
                lead = low == _LEAD
                inside = _LETTER[low] | lead
                inside[1:] |= lead[:-1]
                start, end, row = word_spans(low, offs[lo : hi + 1] - offs[lo], inside)
                leads = np.concatenate(([0], np.cumsum(lead)))
                length = end - start - (leads[end] - leads[start])
                long = np.flatnonzero(length >= LEAST)
                start, end, row, length = start[long], end[long], row[long], length[long]
                h = checksums(low, start, end, heads[lo:hi][row])
                cut = h % np.uint32(delete_every) == 0
                for i in np.flatnonzero(cut & (length > LEAST)).tolist():
                    word, at = low[start[i] : end[i]].tobytes().decode(), int(h[i]) % int(length[i])
                    word = (word[:at] + word[at + 1 :]).encode()
                    known[word] = known.get(word, 0) + 1
                start, end = start[~cut], end[~cut]
                if len(start):
                    _, first, n = np.unique(word_numbers(low, start, end), return_index=True, return_counts=True)
                    for a, b, k in zip(start[first].tolist(), end[first].tolist(), n.tolist(), strict=True):
                        word = low[a:b].tobytes()
                        known[word] = known.get(word, 0) + k
                if len(known) >= GATHERED:
                    yield flush()
                    known = {}
        if known:
            yield flush()

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), "text")
    return named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


def initial_states(words: DataFrame, most: int) -> Written:
    """(word, n, depth, spread): code points that choose the word's initial state, and whether too many words end alike.

    Prefixes with more than `most` words behind them are followed one symbol on, level by level, until none is left.
    """
    tail = words.groupBy(F.expr(f"right(word, {TAIL})").alias("tail")).count().where(F.col("count") > most).select("tail", F.lit(True).alias("spread"))
    known = words.withColumn("tail", F.expr(f"right(word, {TAIL})")).join(tail, "tail", "left")
    state = Written(known.select("word", "n", F.lit(HEAD).alias("depth"), F.coalesce("spread", F.lit(False)).alias("spread")), "states")
    depth = HEAD
    while True:
        prefix = F.expr(f"substring(word, 1, {depth})")
        open_ = state.df.where((F.col("depth") == depth) & (F.length("word") >= depth))
        large = Written(open_.groupBy(prefix.alias("prefix")).count().where(F.col("count") > most).select("prefix"), "prefixes")
        if large.df.isEmpty():
            large.drop()
            return state
        deeper = state.df.join(large.df, (F.col("depth") == depth) & (prefix == F.col("prefix")), "left")
        depth += 1
        new = Written(deeper.select("word", "n", F.when(F.col("prefix").isNotNull(), F.lit(depth)).otherwise(F.col("depth")).alias("depth"), "spread"), "states")
        state.drop()
        large.drop()
        state = new


FRONT, BACK, DELETED = 0, 1, 2


def dealt(state: DataFrame) -> DataFrame:
    """(side, key, word, n, at): each word for its sub-acceptor, for its reversed one, and by what is left of it without one symbol.

    at is the symbol's place, or -1 where the key is the word itself.
    """
    front = state.select(F.lit(FRONT).alias("side"), F.expr("substring(word, 1, depth)").alias("key"), "word", "n", F.lit(-1).alias("at"))
    back = state.where("not spread").select(F.lit(BACK).alias("side"), F.expr(f"right(word, {TAIL})").alias("key"), "word", "n", F.lit(-1).alias("at"))
    places = F.expr(f"""array_append(filter(sequence(0, greatest(depth, {HEAD}) - 1), i -> i < length(word) and ((i < {HEAD} and spread) or (i >= {HEAD} and i < depth))), -1)""")
    cut = state.where(f"spread or depth > {HEAD}").select("word", "n", F.explode(places).alias("at"))
    left = F.expr("if(at < 0, word, concat(substring(word, 1, at), substring(word, at + 2)))")
    return front.union(back).union(cut.select(F.lit(DELETED).alias("side"), left.alias("key"), "word", "n", "at"))


class _Best:
    """Near words of each word: how many, and the one of largest n (of equal n the first in order)."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.found += [(x, y), (y, x)]

    def rows(self) -> pa.RecordBatch | None:
        if not self.found:
            return None
        x, y = (np.concatenate([f[i] for f in self.found]) for i in (0, 1))
        order = np.lexsort((y, -self.n[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
        count = np.diff(np.append(first, len(x)))
        x, y = x[first], y[first]
        columns = [pa.array([self.words[i] for i in x.tolist()], pa.string()), pa.array(count, pa.int64()), pa.array(self.n[y]), pa.array([self.words[i] for i in y.tolist()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "near_n", "near"])


def _compose(side: int, keys: list[str], words: list[str], n: list[int]) -> pa.RecordBatch | None:
    """Near pairs within whole groups of words, each group having one key."""
    order = sorted(range(len(words)), key=words.__getitem__)
    names = [words[i] for i in order]
    best = _Best(names, np.array([n[i] for i in order], np.int64))
    group = np.unique([keys[i] for i in order], return_inverse=True)[1].reshape(-1)
    if side == FRONT:
        for x, y, _ in edit_pairs(Acceptor(names), HEAD):
            ok = group[x] == group[y]
            best.add(x[ok], y[ok])
        return best.rows()
    back = [w[::-1] for w in names]
    to_front = np.array(sorted(range(len(back)), key=back.__getitem__), np.int64)
    head = np.unique([w[:HEAD] for w in names], return_inverse=True)[1].reshape(-1)
    for x, y, _ in edit_pairs(Acceptor(sorted(back)), TAIL):
        x, y = to_front[x], to_front[y]
        ok = head[x] != head[y]  # others are found from the front
        best.add(x[ok], y[ok])
    return best.rows()


def _without_one(words: list[str], n: list[int], at: list[int]) -> pa.RecordBatch | None:
    """Near pairs of words that are the same string without the symbol at `at` (-1: as they are)."""
    names = sorted(set(words))
    number = {w: i for i, w in enumerate(names)}
    count = np.zeros(len(names), np.int64)
    for w, k in zip(words, n, strict=True):
        count[number[w]] = k
    best = _Best(names, count)
    whole = [number[w] for w, i in zip(words, at, strict=True) if i < 0]
    by_place: dict[int, list[int]] = {}
    for w, i in zip(words, at, strict=True):
        if i >= 0:
            by_place.setdefault(i, []).append(number[w])
            if whole and (i + 1 == len(w) or w[i] != w[i + 1]):  # the symbol's last place, so that it counts once
                best.add(np.array([number[w]]), np.array(whole))
    for same in by_place.values():
        x, y = np.triu_indices(len(same), 1)  # at most the alphabet's size of them
        best.add(np.array(same)[x], np.array(same)[y])
    return best.rows()


def near_words(state: DataFrame, most: int) -> DataFrame:
    """(word, n_near, near_n, near) of each word that has near words: their number and the one of largest n."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, rows, found = -1, ([], [], [], []), []

        def work() -> None:
            """Works on the rows, whole groups of one side, and forgets them."""
            keys, words, n, at = (list(c) for c in rows)
            for c in rows:
                c.clear()
            if len(words) > 1:
                out = _without_one(words, n, at) if side == DELETED else _compose(side, keys, words, n)
                if out is not None:
                    found.append(out)

        def ready() -> Iterator[pa.RecordBatch]:
            if found:
                yield from pa.Table.from_batches(found).combine_chunks().to_batches()
                found.clear()

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for s, key, word, k, place in zip(*columns, strict=True):
                # At a new key the rows are whole groups; small ones are composed together.
                if rows[0] and (s != side or key != rows[0][-1]) and (s != side or side == DELETED or len(rows[0]) >= most):
                    work()
                side = s
                for c, x in zip(rows, (key, word, k, place), strict=True):
                    c.append(x)
            if sum(map(len, found)) >= OUT:
                yield from ready()
        work()
        yield from ready()

    sorted_ = dealt(state).repartition("side", "key").sortWithinPartitions("side", "key")
    each = sorted_.mapInArrow(pairs, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where following forms ends, by pointer jumping; forms must not run in circles."""
    top = Written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        seen = Observation()
        up = top.df.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = Written(top.df.join(up, "root", "left").observe(seen, F.count("next").alias("n")).select("word", F.coalesce("next", "root").alias("root")), "roots")
        top.drop()
        top = jumped
        if not seen.get["n"]:
            return top.df


def spelling_groups(docs: DataFrame, delete_every: int = 31, ratio: int = 10, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `docs` (doc_id, text) of LEAST code points and two occurrences or more.

    n counts a word's occurrences in all texts, n_near the words that differ from it by one inserted, deleted or replaced
    code point. form is the near word of largest n (of equal n the first in code-point order) if that n is at least
    `ratio` times the word's, else null; form_n is its n. root is where following forms ends, the word itself if it has
    none; as n grows with every step, this ends. Null and empty texts have no words; rows that repeat a doc_id count
    each; a null doc_id is empty in the checksums; words of any length; an empty table gives an empty result; other
    columns are ignored.
    """
    words = Written(vocabulary(docs, delete_every), "vocabulary")
    state = initial_states(words.df, most)
    words.drop()
    known = state.df.join(near_words(state.df, most), "word", "left")
    form = F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near"))
    judged = Written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(form.isNotNull(), F.col("near_n")).alias("form_n")), "judged")
    state.drop()
    top = roots(judged.df.where("form is not null"))
    return judged.df.join(top, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
