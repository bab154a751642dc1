"""Near copies and repeats against brute force on small fixtures."""

import collections
import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import chunks, common, jaccard, lines, near, pivots, suffix


def groups(ids, links):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose with exact copies, chains of near copies, shared passages, tiny and empty texts, and a passage in a third of all."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("aeioumnst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = " ".join(prose(60)), []
    for i in range(120):
        w = prose(rng.choice([3, 8, 20, 60, 150]))
        texts.append(" ".join(w[: len(w) // 2]) + "\n" + " ".join(w[len(w) // 2 :]) + ("\n" + passage if i % 3 == 0 else ""))
        if i % 6 == 0:
            texts += [texts[-1]] * 3
        if i % 5 == 0:  # a chain: each one differs a little from the one before
            chain = w
            for _ in range(6):
                chain = list(chain)
                chain[rng.randrange(len(chain))] = rng.choice(vocabulary).upper()
                texts.append(" ".join(chain))
    rng.shuffle(texts)
    rows = [(i * 3, t, "component", 1) for i, t in enumerate(texts)] + [(5000, None, None, None), (5001, "", "x", 2), (5002, " \n ", "x", 2), (5003, "é ü", "x", 2), (5004, "é ü", "x", 2), (None, "é ü", "x", 2), (None, None, None, None), (5005, "same " * 4000, "x", 2), (5006, "a\rb\x0bc\x0cd\te\rf g", "x", 2), (5007, "a b c d e f\x0bg", "x", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string, n_chars long")


def shingle_set(text, k):
    w = text.encode("utf-8").lower().split()
    return set(zip(*(w[i:] for i in range(k)))) if len(w) >= k else {tuple(w)} if w else set()  # noqa: B905


def similar_lines(x, y):
    p, q = ({t[i : i + 5] for i in range(len(t) - 4)} if len(t) >= 5 else {t} for t in (x, y))
    return 5 * len(p & q) >= 4 * len(p | q)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.where("doc_id is not null").collect()]


@pytest.mark.parametrize(("k", "s"), [(4, "0.85"), (5, "0.8")])
def test_jaccard_groups(corpus, k, s):
    docs = texts_of(corpus)
    sets = {d: shingle_set(t, k) for d, t in docs}
    limit = Fraction(s)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b])]
    want = groups(sets, links)
    rows = [tuple(r) for r in jaccard.similar_documents(corpus, k, s).collect()]
    assert sorted(r for r in rows if r[0] is not None) == sorted((d, len(sets[d]), want[d]) for d in sets)
    assert sorted(r for r in rows if r[0] is None) == [(None, 0, None), (None, 1, None)]
    kept = jaccard.one_of_each_group(corpus, k, s)
    assert kept.columns == corpus.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values()) | {None}
    assert jaccard.similar_documents(corpus.limit(0), k, s).count() == 0


def test_long_open_keys_are_compared_in_blocks(corpus, monkeypatch):
    monkeypatch.setattr(near, "SHORT", 1)
    monkeypatch.setattr(near, "BLOCK", 7)
    docs = texts_of(corpus)
    sets = {d: shingle_set(t, 4) for d, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(corpus, 4, "0.85").where("doc_id is not null").collect()}
    assert got == groups(sets, links)


def test_words_that_a_polynomial_hash_confuses_are_told_apart(spark):
    """Thue-Morse words of 1024 bytes collide in every polynomial hash modulo 2**64."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    x, y = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    docs = spark.createDataFrame([(1, f"one two three {x}"), (2, f"one two three {y}"), (3, f"one two three {x}")], "doc_id long, text string")
    assert {tuple(r) for r in jaccard.similar_documents(docs).collect()} == {(1, 1, 1), (2, 1, 2), (3, 1, 1)}
    assert len({near.identity(t.encode()) for t in (x, y)}) == 2
    raw = np.frombuffer((x + y).encode(), np.uint8)
    assert len(set(common.span_hashes(raw, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2


def colliding(first, rest, size, seed=0):
    """A printable text of 16 bytes and `rest` whose span hash over `size` bytes is that of `first` and `rest`."""
    rng = np.random.default_rng(seed)
    a, b = np.frombuffer(first, "<u8")
    h = common.mix(np.array([size], np.uint64) ^ common._BASE)
    other = rng.integers(33, 127, (1 << 17, 8)).astype(np.uint8)
    other[other == 35] = 36
    x = np.ascontiguousarray(other).view("<u8").reshape(-1)
    y = b ^ common.mix(h ^ a) ^ common.mix(h ^ x)
    lanes = np.stack([x, y], axis=1).view(np.uint8)
    good = np.flatnonzero(((lanes > 32) & (lanes < 127)).all(axis=1))
    return lanes[good[0]].tobytes() + rest


def test_unlike_words_of_one_hash_are_two_shingles(spark):
    x, y = b"qwertyuiopasdfgh", colliding(b"qwertyuiopasdfgh", b"", 16)
    raw = np.frombuffer(x + y, np.uint8)
    h = common.span_hashes(raw, np.array([0, 16]), np.array([16, 32]))
    assert h[0] == h[1] and x != y
    x, y = x.decode(), y.decode()
    docs = spark.createDataFrame([(1, f"{x} b c d {y} b c d"), (2, f"{x} b c d {x} b c d"), (3, f"{y} b c d {y} b c d")], "doc_id long, text string")
    assert {tuple(r) for r in jaccard.similar_documents(docs).collect()} == {(1, 5, 1), (2, 4, 2), (3, 4, 3)}


def test_unlike_contexts_of_one_hash_are_no_repeat(spark):
    rng = random.Random(1)
    for seed in range(40):
        rest = "".join(rng.choice("abcdefghij klm") for _ in range(104)).encode()
        one = "".join(rng.choice("abcdefghij klm") for _ in range(16)).encode() + rest
        _, _, start, windows, _ = suffix.anchors(np.frombuffer(one, np.uint8), np.array([0, 120]))
        two = colliding(one[:16], rest, int(windows[0]) + suffix.WIDTH - 1, seed)
        other = suffix.anchors(np.frombuffer(two, np.uint8), np.array([0, 120]))
        if start[0] == other[2][0] == 0 and windows[0] == other[3][0]:
            break
    both, ends = np.frombuffer(one + two, np.uint8), np.array([0, 120]) + windows[0] + suffix.WIDTH - 1
    assert len(set(common.span_hashes(both, np.array([0, 120]), ends).tolist())) == 1
    docs = spark.createDataFrame([(1, one.decode()), (2, two.decode())], "doc_id long, text string")
    assert {tuple(r)[:4] for r in suffix.without_repeats(docs).collect()} == {(1, 120, 0, 0), (2, 120, 104, 1)}


def test_numbers_stay_exact_when_hashes_collide(monkeypatch):
    data = np.frombuffer(b"aa bb aa cc dd bb", np.uint8)
    start = np.array([0, 3, 6, 9, 12, 15])
    monkeypatch.setattr(common, "span_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    n = common.word_numbers(data, start, start + 2)
    assert len(set(n.tolist())) == 4 and n[0] == n[2] and n[1] == n[5]
    monkeypatch.setattr(common, "mix", lambda h: h * np.uint64(0))
    t = common.tuple_numbers([np.array([1, 1, 2, 1]), np.array([5, 6, 5, 5])])
    assert len(set(t.tolist())) == 3 and t[0] == t[3]


def test_rows_that_repeat_a_doc_id(spark):
    long = " ".join(f"word{i}" for i in range(30))
    rows = [(1, long + "\n" + long), (1, long), (2, long), (2, "other " + long), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similar_documents(docs).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 2, 2, 3] and {r["component_id"] for r in got} == {1, 3}
    kept = lines.dedup_lines(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"]) == [(1, long), (1, long)]
    assert suffix.without_repeats(docs).count() == pivots_rows(docs) == len(rows)


def pivots_rows(docs):
    vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), F.lit(1).alias("label"))
    return pivots.near_vectors(vectors).count()


def test_keys_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    s = Fraction("0.8")
    for size in [*range(1, 40), 75, 130, 400, 1500]:
        for _ in range(20):
            pool = rng.integers(1, 2**63, 2 * size + 5, dtype=np.uint64)
            gone, new = rng.integers(0, size // 4 + 2, 2)
            x, y = pool[:size], np.concatenate([pool[: max(0, size - gone)], pool[size : size + new]])
            both = len(np.intersect1d(x, y))
            if both and both >= s * (len(x) + len(y) - both):
                assert len(np.intersect1d(jaccard.set_keys(x, s), jaccard.set_keys(y, s)))


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_repeated_substrings(corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)  # with 1, windows are dealt on one by one
    docs = sorted(texts_of(corpus))
    first, want = {}, {}
    for d, t in docs:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i : i + 50], d) < d:
                gone[i : i + 50] = True
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        want[d] = (len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(left).hexdigest())
    got = suffix.without_repeats(corpus, keep_text=True).collect()
    assert len(got) == corpus.count()
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r)[1:5] == want[r["doc_id"]] and hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        else:
            assert r["n_removed"] == 0
    assert suffix.without_repeats(corpus.limit(0)).count() == 0


def test_blocks_of_a_dense_family_are_dealt_to_all_tasks(spark, monkeypatch):
    """They are few bytes and much work, so they may not be put together into one task; links are those of all pairs."""
    monkeypatch.setattr(near, "BLOCK", 4)
    monkeypatch.setattr(near, "ROWS", 3)
    monkeypatch.setattr(near, "ELEMENTS", 16)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(80))
    items = []
    for _ in range(24):
        x = list(base)
        for _ in range(rng.randint(1, 4)):
            x[rng.randrange(80)] = rng.choice("xyz")
        items.append("".join(x))
    postings = spark.createDataFrame([(7, i, i, 80) for i in range(24)], "key long, id long, group long, bytes long")
    texts = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(items)], "id long, text binary")
    links = near.long_key_links(postings, texts, lines.SCHEME)
    assert links.rdd.getNumPartitions() == 4
    want = groups(range(24), [(i, j) for i in range(24) for j in range(i) if similar_lines(items[i], items[j])])
    assert len(set(want.values())) < 24
    assert groups(range(24), [tuple(r) for r in links.collect()]) == want


def test_suffix_records_of_many_buckets_share_rows(spark):
    """Rows in the exchange follow tasks times buckets, not pairs of buckets; what is removed stays exact."""
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(200)]
    docs = spark.createDataFrame([(i, "#".join(rng.sample(passages, 40))) for i in range(400)], "doc_id long, text string").repartition(16, "doc_id")
    spans, n_buckets = suffix.removed_spans(docs)
    assert spans.count() <= (16 + 2 * 4) * n_buckets
    seen, want = set(), {}
    for d, t in sorted(texts_of(docs)):
        gone = np.zeros(len(t), bool)
        own = {t[i : i + 50] for i in range(len(t) - 49)}
        for i in range(len(t) - 49):
            if t[i : i + 50] in seen:
                gone[i : i + 50] = True
        want[d] = int(gone.sum())
        seen |= own
    assert {r["doc_id"]: r["n_removed"] for r in suffix.without_repeats(docs).collect()} == want


def test_suffix_sorts_what_may_be_equal():
    assert suffix.repeated(np.array([5, 2, 5, 9, 2, 7], np.uint64)).tolist() == [0, 1, 2, 4]
    assert suffix.repeated(np.zeros(0, np.uint64)).tolist() == [] == suffix.repeated(np.array([1], np.uint64)).tolist()


def test_suffix_sort_orders_by_bytes():
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(0, 3, 600).astype(np.uint8), np.full(80, 1, np.uint8), np.zeros(60, np.uint8)])
    at = rng.integers(0, 680, 500)
    segment = np.sort(rng.integers(0, 4, 500))
    order = suffix.suffix_sort(text, common.prefix_hashes(text), at, segment, 50)
    keys = [(segment[i], text[at[i] : at[i] + 50].tobytes()) for i in range(500)]
    assert [keys[i] for i in order] == sorted(keys) and sorted(order) == list(range(500))
    number = suffix.equal_windows(text, at, segment)
    for i in range(0, 500, 7):
        assert [keys[i] == k for k in keys] == (number == number[i]).tolist()


def test_lines_keep_one_of_each_group(corpus):
    docs = texts_of(corpus)
    own = [(d, k, b" ".join(x.encode().lower().split()).decode()) for d, t in docs for k, x in enumerate(t.split("\n")) if x.encode().split()]
    names = sorted({x for _, _, x in own})
    links = [(i, j) for i, x in enumerate(names) for j in range(i) if similar_lines(x, y := names[j]) or x == y]
    group = groups(range(len(names)), links)
    keep = {}
    for d, k, x in own:
        g = group[names.index(x)]
        keep[g] = min(keep.get(g, (d, k)), (d, k))
    gone = collections.defaultdict(set)
    for d, k, x in own:
        if keep[group[names.index(x)]] != (d, k):
            gone[d].add(k)
    result = lines.dedup_lines(corpus)
    assert result.columns == [*corpus.columns, "n_lines_dropped"]
    for r in result.where("doc_id is not null and text is not null").collect():
        want = "\n".join(x for k, x in enumerate(dict(docs)[r["doc_id"]].split("\n")) if k not in gone[r["doc_id"]])
        assert r["text"] == want and r["n_lines_dropped"] == len(gone[r["doc_id"]])
    assert result.where("text is null").count() == 2
    assert lines.dedup_lines(corpus.limit(0)).count() == 0


@pytest.mark.parametrize("n", [10, 20, 30, 50, 100, 120, 200])
def test_bands_of_lines_meet_at_the_threshold(n):
    """3000 pairs of sets with n shingles in all, four fifths of them in both: few have no key in common, however short the line."""
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 2**64, (3000, n), dtype=np.uint64)
    common_part, own = hashes[:, : n * 4 // 5], hashes[:, n * 4 // 5 :]
    half = own.shape[1] // 2
    sets = [s for c, o in zip(common_part, own, strict=True) for s in (np.append(c, o[:half]), np.append(c, o[half:]))]
    found = [set() for _ in sets]
    for k in range(0, len(sets), 1000):
        some = sets[k : k + 1000]
        keys, owner = lines.band_keys(np.concatenate(some), np.repeat(np.arange(len(some)), [len(s) for s in some]), len(some))
        for key, i in zip(keys.tolist(), owner.tolist(), strict=True):
            found[k + i].add(key)
    assert sum(not (x & y) for x, y in zip(found[::2], found[1::2], strict=True)) <= 15


def test_chunks_find_shared_passages_and_leave_others_alone(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    own = lambda n: " ".join(word() for _ in range(n))
    passage = own(55)
    texts = [own(100) + " " + passage + " " + own(40) if i % 2 else own(150) for i in range(40)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(90, None, 1), (None, texts[1], 1), (91, "", 1), (92, "x" * 5000, 1), (93, "x" * 5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed long")
    got = {r["doc_id"]: r for r in chunks.chunk_report(docs).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        assert (got[i]["n_removed"] >= 150) == (i % 2 == 1 and i > 1)
        assert (1 in got[i]["first_docs"]) == (i % 2 == 1 and i > 1)
    assert got[93]["n_removed"] >= 4900 and got[92]["n_removed"] == got[90]["n_removed"] == got[None]["n_removed"] == 0
    left = chunks.without_spans(docs, chunks.repeated_spans(docs))
    for r in left.where("doc_id < 40 and doc_id > 1 and doc_id % 2 = 1").collect():
        assert len(r["text"]) == len(texts[r["doc_id"]]) - got[r["doc_id"]]["n_removed"] and r["text"][:200] == texts[r["doc_id"]][:200]
    assert chunks.chunk_report(docs.limit(0)).count() == 0


def test_chunks_find_passages_of_51_words_in_just_two_documents(spark):
    rng = random.Random(12)
    lengths = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    word = lambda: "".join(rng.choices("etaoinshrdlucmfw", k=rng.choices(lengths, [6, 20, 22, 16, 12, 8, 6, 4, 2, 2, 1])[0]))
    own = lambda n: " ".join(word() for _ in range(n))
    passages = [own(51) for _ in range(400)]
    rows = [(2 * i + k, own(30) + " " + p + " " + own(30)) for i, p in enumerate(passages) for k in (0, 1)]
    got = {r["doc_id"]: r for r in chunks.chunk_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, p in enumerate(passages):
        assert len(p) - 100 <= got[2 * i + 1]["n_removed"] <= len(p) + 16 and got[2 * i + 1]["first_docs"] == [2 * i]
        assert got[2 * i]["n_removed"] == 0


def naive_cuts(raw, cuts):
    """Ends of the chunks by the rule as it is stated, byte by byte."""
    table, n, w = chunks._GEAR.tolist(), len(raw), cuts.least
    h = [sum(table[raw[i - k]] << k for k in range(8) if i >= k) % 2**32 for i in range(n)]
    ends = [i + 1 for i in range(n) if w <= i + 1 < n and all(h[i] < x for x in h[max(0, i - w) : i]) and all(h[i] <= x for x in h[i + 1 : i + 1 + w])] + [n] * (n > 0)
    out, at = [], 0
    for stop in ends:
        while stop - at > cuts.most:
            inside = range(at + w - 1, min(at + cuts.most, stop - w))
            at = min(inside, key=lambda i: (h[i], -i)) + 1
            out.append(at)
        out.append(stop)
        at = stop
    return out


def test_chunks_equal_brute_force(spark):
    rng = random.Random(21)
    make = lambda n: "".join(rng.choice("abcdefghij  é") for _ in range(n))
    passages = [make(n) for n in (140, 200, 400, 900)]
    texts = [make(rng.randint(0, 300)) + rng.choice(passages) * rng.choice([0, 1, 1]) + make(rng.randint(0, 200)) for _ in range(60)]
    texts += [texts[3], "y" * 700, "y" * 700, "", "short", "short"]
    ids = list(range(0, 2 * len(texts), 2))
    rng.shuffle(ids)
    cuts, spans, first = chunks.Cuts(), {}, {}
    for i, t in sorted(zip(ids, texts, strict=True)):
        raw = t.encode()
        ends = naive_cuts(raw, cuts)
        starts = [0, *ends[:-1]]
        last = len(ends) - cuts.span if len(ends) >= cuts.span else 0
        spans[i] = [(starts[k], ends[min(k + cuts.span, len(ends)) - 1]) for k in range(last + 1)] if ends else []
        for a, b in spans[i]:
            first.setdefault(raw[a:b], i)
    want = {}
    for i, t in zip(ids, texts, strict=True):
        raw, runs = t.encode(), []
        for a, b in spans[i]:
            if first[raw[a:b]] != i:
                if runs and a < runs[-1][1]:
                    runs[-1] = (runs[-1][0], max(b, runs[-1][1]), runs[-1][2] | {first[raw[a:b]]})
                else:
                    runs.append((a, b, {first[raw[a:b]]}))
        runs = [r for r in runs if r[1] - r[0] >= cuts.run]
        want[i] = (len(raw), sum(b - a for a, b, _ in runs), len(runs), sorted(set().union(*[r[2] for r in runs])))
    got = chunks.chunk_report(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["first_docs"]) for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) > 15


def test_chunks_resist_insertions():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 123, 4000).astype(np.uint8)
    cuts = chunks.Cuts()
    cut = lambda x: {x[a:b].tobytes() for a, b in zip(np.concatenate(([0], chunks.chunk_ends(x, cuts)[:-1])), chunks.chunk_ends(x, cuts), strict=True)}
    a, b = cut(data), cut(np.concatenate([data[:1000], rng.integers(97, 123, 13).astype(np.uint8), data[1000:]]))
    assert len(a & b) >= len(a) - 8
    ends = chunks.chunk_ends(data, cuts)
    sizes = np.diff(ends, prepend=0)
    assert ends[-1] == 4000 and sizes.max() <= cuts.most and sizes[:-1].min() >= cuts.least


@pytest.mark.parametrize("bin_", [pivots.BIN, 3])
def test_vectors(spark, monkeypatch, bin_):
    monkeypatch.setattr(pivots, "BIN", bin_)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 24))
    vectors = [*base, *(base[:40] + rng.normal(size=(40, 24)) * 0.12), *(base[0] + rng.normal(size=(80, 24)) * 0.05), *base[:10]]
    rows = [(i * 2, [float(np.float32(x)) for x in v], i % 3, "c") for i, v in enumerate(vectors)]
    rows += [(9001, None, 1, "c"), (9002, [0.0] * 24, 1, "c"), (9003, [float("nan")] + [1.0] * 23, 1, "c"), (9004, [1.0] * 24, None, "c"), (9005, [], 1, "c"), (9006, [1.0, 2.0], 1, "c"), (9007, [2.0, 4.0], 1, "c"), (None, [1.0] * 24, 1, "c"), (9008, [float("inf")] * 24, 0, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component_id string")
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and np.isfinite(r[1]).all() and any(r[1])]
    unit = {r[0]: np.array(r[1], np.float64) / np.linalg.norm(r[1]) for r in good}
    links = [(a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and unit[a[0]] @ unit[b[0]] >= 0.93]
    want, count = groups([r[0] for r in rows if r[0] is not None], links), collections.Counter(x for p in links for x in p)
    got = pivots.near_vectors(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (count[r["vec_id"]], want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"])
    assert pivots.near_vectors(df.limit(0)).count() == 0
    assert pivots.near_vectors(df.where("vec_id = 9001")).first()["component_id"] == 9001


@pytest.mark.parametrize("cosine", [0.93, 0.945, 0.96])
def test_recall_of_the_pivot_index(spark, cosine):
    """1000 pairs of 64 dimensions just above the limit, among 2000 other vectors, against brute force."""
    rng = np.random.default_rng(8)
    norm = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = norm(rng.normal(size=(1000, 64)))
    away = rng.normal(size=x.shape)
    away = norm(away - (away * x).sum(1, keepdims=True) * x)
    y = (cosine + 1e-3) * x + np.sqrt(1 - (cosine + 1e-3) ** 2) * away
    vectors = np.concatenate([x, y, norm(rng.normal(size=(2000, 64)))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    got = pivots.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine).collect()
    exact = (vectors @ vectors.T >= cosine).sum(1) - 1
    found = {r["vec_id"]: r["n_links"] for r in got}
    assert all(found[i] <= exact[i] for i in range(len(exact)))
    assert sum(found.values()) >= 0.97 * exact.sum()


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    monkeypatch.setattr(pivots, "BIN", 20)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    df = spark.createDataFrame([(i, [float(x) for x in centre + rng.normal(size=16) * 0.05], 1) for i in range(150)], "vec_id long, embedding array<double>, label int")
    got = pivots.near_vectors(df).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(149, 0)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200), (55, 50), (55, 60), (60, 70), (None, 3)]
    got = {r["id"]: r["component_id"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and {got[i] for i in (50, 55, 60, 70)} == {50} and got.get(200, 200) == 200
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_grow_by_new_links(spark):
    rng = random.Random(3)
    pick = lambda n: [(rng.randrange(400), rng.randrange(400)) for _ in range(n)]
    old, new = pick(90), pick(60)
    edges = lambda e: spark.createDataFrame(e, "a long, b long")
    found = {r["id"]: r["component_id"] for r in near.joined(common.components(edges(old)), edges(new)).collect()}
    expected = groups(range(400), old + new)
    assert all(found.get(i, i) == c for i, c in expected.items())
    assert all(i in found for e in new for i in e)


def test_leaders_equal_brute_force():
    rng = np.random.default_rng(8)
    for top in (3, 40, 2**40):
        of = rng.integers(0, 30, 300).astype(np.int32)
        keys, ids = rng.integers(0, top, 300).astype(np.uint64), of.astype(np.int64) * 7
        found, first, weight, a, b, n = near.lead(keys, ids, of=of)
        at = {k: np.flatnonzero(keys == k) for k in np.unique(keys)}
        shared = collections.Counter(int(of[i]) for x in at.values() if len(x) > 1 for i in x)
        leader = {k: min((-min(shared[int(of[i])], 255), int(ids[i])) for i in x) for k, x in at.items()}
        assert found.tolist() == sorted(at) and first.tolist() == [leader[k][1] for k in found] and weight.tolist() == [-leader[k][0] for k in found]
        pairs = collections.Counter((leader[k][1], int(ids[i])) for k, x in at.items() for i in x if ids[i] != leader[k][1])
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == pairs


def test_near_copies_move_few_bytes(spark, corpus, monkeypatch):
    """An entry of a key takes 13 bytes; texts are joined without being sorted; only open keys leave Python."""
    assert sum(np.dtype(t).itemsize for t in near.KINDS[near.ENTRY]) <= 13
    docs = spark.createDataFrame([(i, f"line {i}\nline {i} of a text") for i in range(50)], "doc_id long, text string")
    monkeypatch.setattr(lines, "surplus_lines", lambda d: d.select("doc_id", F.lit(1).alias("line_no")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lines.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
