"""Decontamination, spelling variants and ranked search against brute force on small fixtures."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from fathom.llm import decontam, search, spelling, terms
from fathom.llm.acceptor import Acceptor, edit_pairs

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")
NAMES = "doc_id long, text string, token long, item_id string, n long"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcdé9") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    some = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows = [(i, some(rng.choice([1, 2, 5, 9, 10, 11, 25]))) for i in range(30)]
    rows += [(30, None), (31, " .,\r\n"), (32, rows[6][1]), (33, ("ab " * 14).strip()), (5, some(12)), (None, some(12)), (34, some(13).upper().replace(" ", "\x0b-\r"))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def corpus(spark, bench):
    rng = random.Random(12)
    items = [r["text"] for r in bench.collect() if r["text"]]
    pool = sorted({w for t in items for w in words(t)}) + ["zz", "Über", "x1"]
    texts = []
    for i in range(150):
        w = [rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 12, 60]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            part = words(rng.choice(items))
            cut = rng.randint(0, max(0, len(part) - 9))
            w[len(w) // 2 : len(w) // 2] = part[cut : cut + rng.choice([9, 10, 11, 40])]
        if i % 3 == 0:  # a passage in a third of all
            w += words(items[-1])
        texts.append(rng.choice([" ", "  ", "\r\n", "-", "\x0c"]).join(w))
    texts += [None, "", "...", "ab " * 3000, texts[3], texts[3]]
    rows = [(i * 2, t, i, "clash", 1) for i, t in enumerate(texts)] + [(4, texts[7], 0, "clash", 1), (None, texts[9], 0, None, None), (None, None, 0, None, None)]
    return spark.createDataFrame(rows, NAMES)


def test_contamination(spark, corpus, bench):
    windows = collections.defaultdict(set)
    for r in bench.collect():
        w = words(r["text"])
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(r["item_id"])
    sizes = {len(w) for w in windows}
    want = []
    for r in corpus.collect():
        w, hit, items = words(r["text"]), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found is not None:
                    hit |= set(range(i, i + n))
                    items |= {str(x) for x in found if x is not None}
        want.append((str(r["doc_id"]), len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    got = decontam.contamination(corpus, bench)
    rows = got.collect()
    assert sorted((str(r[0]), *r[1:6]) for r in rows) == sorted(want)
    assert 0 < sum(r["contaminated"] for r in rows) < len(rows)
    for r in rows:
        covered = {p for s in r["spans"] or [] for p in range(s["begin"], s["end"])}
        assert len(covered) == r["n_hit"] and len(r["items"] or []) == r["n_items"]
    assert decontam.contamination(corpus.limit(0), bench).count() == 0
    assert decontam.contamination(corpus, bench.limit(0)).where("contaminated or n_hit > 0").count() == 0
    left = decontam.clean(corpus, bench)
    bad = {r["doc_id"] for r in rows if r["contaminated"]} - {None}
    assert left.columns == corpus.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in rows} - bad | {None}


def test_bloom_filters_have_no_false_negative(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 3000)
    bits = terms.bloom(spark.createDataFrame([(int(k),) for k in keys], "h long"))
    assert terms.maybe_in(bits, keys.view(np.uint64)).all()
    assert terms.maybe_in(bits, rng.integers(0, 2**63, 20000, dtype=np.uint64)).mean() < 0.02
    assert not terms.maybe_in(terms.bloom(spark.createDataFrame([], "h long")), keys.view(np.uint64)).any()


def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def test_composition_finds_each_pair_once():
    for seed in range(60):
        rng = random.Random(seed)
        names = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 60))})
        pairs = [(i, j) for x, y, _ in edit_pairs(Acceptor(names)) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        found = {frozenset(p) for p in pairs}
        assert len(found) == len(pairs)
        assert found == {frozenset((i, j)) for i in range(len(names)) for j in range(i) if near(names[i], names[j])}
        far = {frozenset(p) for x, y, d in edit_pairs(Acceptor(names), 2) for p in zip(x.tolist(), y.tolist(), strict=True)}
        assert far == {p for p in found if all(names[i][:2] == names[min(p)][:2] and len(names[i]) >= 2 for i in p)}


def test_acceptors_are_minimal():
    a = Acceptor(sorted(x + y for x in "abcd" for y in ("tion", "ment", "ting")))
    assert len(a.final) == 10  # of the four first letters one state is left; "ti" is shared; all words have one end
    assert len(Acceptor(["a", "b", "c"]).final) == 2


@pytest.mark.parametrize("most", [spelling.MOST, 6, 2])
def test_spelling_groups(spark, most):
    """Small `most` splits initial states down to single words and takes the way over deleted symbols."""
    rng = random.Random(21)
    stems = ["".join(rng.choice("abdeé") for _ in range(rng.randint(6, 11))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaab", "baaaaaaa", "Straßenbahn", "élèvesÀB"]
    texts = []
    for i in range(80):
        w = []
        for _ in range(rng.choice([0, 5, 60])):
            s = rng.choice(stems)
            if rng.random() < 0.3:
                p = rng.randrange(len(s))
                s = s[:p] + rng.choice(["", "a", "e", s[p] * 2, "z"]) + s[p + 1 :]
            w.append(s if rng.random() < 0.8 else s.upper())
        texts.append(" ".join(w))
    long = "x" * 3000
    rows = [(i, t, "w", 1) for i, t in enumerate(texts)] + [(900, None, "w", 1), (901, "", "w", 1), (902, f"{long} {long} {long}y {long}y", "w", 1), (903, stems[0] + " " + stems[0], "w", 1), (903, stems[0] + " " + stems[0], "w", 1), (None, stems[1], "w", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    n = collections.Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-z\xc0-\xff]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    want = {}
    for w in n:
        close = sorted((-n[x], x) for x in n if abs(len(x) - len(w)) < 2 and x != w and near(x, w))
        form = close[0][1] if close and -close[0][0] >= 10 * n[w] else None
        want[w] = (form, n[w], len(close), n[form] if form else None)
    got = {r["word"]: r for r in spelling.spelling_groups(docs, most=most).collect()}
    assert {w: (r["form"], r["n"], r["n_near"], r["form_n"]) for w, r in got.items()} == want
    for w, r in got.items():
        while want[w][0]:
            w = want[w][0]
        assert r["root"] == w
    assert any(r["form"] for r in got.values())
    assert spelling.spelling_groups(docs.limit(0), most=most).count() == 0


def test_chains_of_forms(spark):
    """Each word is a hundred times as frequent as the one before it."""
    text = " ".join(["letters"] * 2 + ["lettersa"] * 20 + ["lettersab"] * 200 + ["lettersabc"] * 2000)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r["word"]: r["root"] for r in spelling.spelling_groups(docs, delete_every=2**32 - 1).collect()}
    assert got == dict.fromkeys(["letters", "lettersa", "lettersab", "lettersabc"], "lettersabc")


def ranking(docs, items, k):
    """By the definition, with whole numbers."""
    counts = [(d, collections.Counter(words(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for i, each in wanted.items():
        scores = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in each if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(str(i), r, str(x[3]), -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, corpus, bench, monkeypatch, small):
    if small:  # many blocks of items, few documents at once, few sets mined
        for name, value in {"BLOCK_ITEMS": 4, "BLOCK_TERMS": 40, "MINED": 5, "SCORES": 2000, "PARTS": 3}.items():
            monkeypatch.setattr(search, name, value)
    docs, items = [(r["doc_id"], r["text"]) for r in corpus.collect()], [(r["item_id"], r["text"]) for r in bench.collect()]
    for k in (50, 3):
        got = search.ranked_search(corpus, bench, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got.collect()) == ranking(docs, items, k)
    assert search.ranked_search(corpus.limit(0), bench).count() == 0
    assert search.ranked_search(corpus, bench.limit(0)).count() == 0


def test_dag_shares_sums():
    rng = np.random.default_rng(4)
    has = rng.random((40, 300)) < rng.random(300) * 0.6
    item, term = np.nonzero(has)
    dag = search.SharingDag(item, term, 40, 300)
    value = rng.integers(0, 1000, (300, 7))
    t, c = np.nonzero(value)
    assert (dag.sums(t, c, value[t, c], 7) == has.astype(int) @ value).all()
    assert dag.levels and len(dag.nodes) < 0.8 * len(item)


def test_lexicon_tells_equal_hashes_apart(monkeypatch):
    monkeypatch.setattr(search, "range_hash", lambda p, s, e: np.zeros(len(s), np.uint64))
    names = [b"one", b"two", b"three", b"a-very-long-term"]
    text = np.frombuffer(b"two a-very-long-term four one", np.uint8)
    start = np.array([0, 4, 21, 26])
    end = np.array([3, 20, 25, 29])
    assert search.Lexicon(names).lookup(text, start, end, np.zeros(4, np.uint64)).tolist() == [1, 3, -1, 0]
