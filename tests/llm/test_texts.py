"""Operators on single texts and pages: quality rules, tokenizer, HTML, WARC, mixing."""

import collections
import gzip
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fathom.llm import common, html, mixing, quality, spm, warc
from fathom.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, source string, kept boolean, size int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty texts, repeated rows, ties, a long text and columns with the operators' own names."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma,", "über", "日本", "x#y", "<b>", "\t", "\n", " "]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "é", None]), None, 1) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "some words here", "a", True, 0), (100, "", "b", None, None), (101, "same text", "c", None, 2), (101, "same text", "c", None, 2), (102, "word " * 30000, "b", None, 3), (103, "  \n\t ", "empty", None, 4)]
    return spark.createDataFrame(rows, DOCS)


def brute_quality(t):
    t = t or ""
    w = t.encode().split()
    grams = collections.Counter(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if x.encode().split()]
    n = len(w)
    failed = n < 10 or 100 * len(hit) > 20 * n
    return n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed


def test_quality_equals_brute_force(odd):
    for r in quality.quality(odd.select("doc_id", "text", "kept")).collect():
        texts = [x["text"] for x in odd.where(F.col("doc_id").eqNullSafe(F.lit(r["doc_id"]))).collect()]
        assert tuple(r)[1:7] in [brute_quality(t) for t in texts]
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality(odd.limit(0)).count() == 0


def test_bands_reject_repetition_and_noise_alone():
    rng = random.Random(1)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(800))
    import zstandard

    packer, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    assert quality.in_bands(prose.encode(), bands, packer)
    assert not quality.in_bands(b"buy now cheap " * 400, bands, packer)
    assert not quality.in_bands(bytes(rng.randrange(256) for _ in range(5000)), bands, packer)
    assert quality.in_bands(b"short", bands, packer)


def test_keep_good_keeps_columns(odd):
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    good = {(r["doc_id"]) for r in quality.quality(odd).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == good


def test_tokenizer_equals_the_library(spark, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    rng = random.Random(2)
    pieces = [*"abcdef xyz  é日😀▁\n\t\r\x00.,", "the", "ing", "   ", "http://"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [r["text"] for r in odd.collect() if r["text"] is not None]
    model = spm.load(tokenizer_path())
    for t, ids in zip(texts, library.encode(texts), strict=True):
        joined, decoded = model.encode_text(t)
        assert joined == ",".join(map(str, ids)) and decoded == library.decode(ids)
    got = spm.encoded(odd, tokenizer_path())
    for r in got.where("doc_id = 101 or doc_id is null").collect():
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    assert got.count() == odd.count()


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(spm, "REMEMBERED", 5)
    small, full = spm.MergeModel(tokenizer_path()), spm.load(tokenizer_path())
    text = "The quick brown fox jumps over the lazy dog. \x01 " * 3
    for _ in range(3):
        assert small.encode_text(text) == full.encode_text(text)


def test_a_worker_remembers_nothing_of_an_ended_task(spark):
    """A worker serves later stages, too; what a tokenizer task gathered must not stay in it."""
    docs = spark.range(0, 40, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("unusual wordings "), F.col("id").cast("string")).alias("text"))
    assert spm.encoded(docs, tokenizer_path(), forget=True).count() == 40

    def held(batches):
        for _ in batches:
            models = list(spm._models.values())
            yield pa.RecordBatch.from_arrays([pa.array([len(models)]), pa.array([sum(len(m.seen) + len(m.older) + len(m.odd) + len(m.fits) for m in models)])], names=["models", "n"])

    rows = spark.range(0, 16, 1, 4).mapInArrow(held, "models long, n long").collect()
    assert any(r["models"] for r in rows) and not any(r["n"] for r in rows)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies, the usual notice that is long enough to be taken for a paragraph of the text by its length.</div>
<article><h1>Head &amp; line</h1><p>First paragraph of the article, with <b>bold</b> and <a href=/x>one link</a>, that is long enough and has the usual words in it.
<p>Short one.<br>Next&nbsp;line <script>if (a < b) x("</p>")</script>&#x4e2d;<p>5 < 6 and 7 > 3</p><ul class="share"><li>Share this</li></ul><section id="comments"><p>A reader comment that is as long as the paragraphs of the article and has many of the words in it too.</p></section></article>
<aside>Side</aside><form><p>Your name</p></form><!-- <p>gone</p> --><footer>&copy; x</footer>"""


def test_main_text_leaves_the_frame_out():
    assert html.main_text(PAGE).split("\n") == [
        "Head & line",
        "First paragraph of the article, with bold and one link, that is long enough and has the usual words in it.",
        "Short one. Next line 中",
        "5 < 6 and 7 > 3",
    ]


def test_ambiguous_blocks_take_their_neighbours_labels():
    long = "This is a paragraph that is long enough and has the usual words of the language in it, as they are."
    page = f"<body><p><a href=/>a</a> <a href=/>b</a></p><h2>Title</h2><p>{long}</p><p>short</p><p>{long}</p><p>tail</p><p><a href=/>c</a></p></body>"
    assert html.main_text(page).split("\n") == ["Title", long, "short", long, "tail"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "plain", "<p>" * 3000, "</div></div>", "<a href='x>y", "<!--", "<script>", "&#0;&bogus;", "<div>" * 500 + "x"])
def test_broken_pages_do_not_break(page):
    assert isinstance(html.main_text(page), str)


def test_extract_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>hello</p>", "y"), (1, "u", "", "z")], "page_id long, url string, html string, text string")
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html.extract(df).collect()) == [("1", "", 0), ("1", "", 0), ("None", "hello", 5)]


def test_warc_round_trip_at_any_split(spark, tmp_path):
    same = "<p>" + "equal payload " * 20
    rows = [(1, "u", same), (2, "v\r\nX: 1", same), (2, "v", same), (None, None, None), (3, "w", ""), (4, "w", "small"), (5, "w", "small"), (6, "é", "ü" * 5000), (None, "n", same)]
    rows += [(10 + i, "r", hashlib.sha256(str(i).encode()).hexdigest() * (i % 90)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    files = warc.write_warc(pages, f"file://{tmp_path}/w")
    want = sorted((str(p), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for p, _, h in rows)
    assert files.agg(F.sum("records")).first()[0] == len(rows)
    for split in (97, 5000, 1 << 30):
        got = warc.read_warc(spark, files, split).collect()
        assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == want
        again = {(str(r["page_id"]), r["refers_to"]) for r in got if r["record_type"] == "revisit"}
        assert again == {("2", 1), ("None", 1)}
        assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    whole = b"".join(gzip.decompress(open(r["path"].removeprefix("file://"), "rb").read()) for r in files.collect())
    assert whole.count(b"WARC/1.1\r\n") == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_damaged_archives_raise(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    files = warc.write_warc(pages, f"file://{tmp_path}/d")
    path = files.first()["path"].removeprefix("file://")
    whole = open(path, "rb").read()
    starts = [i for i in range(len(whole)) if whole.startswith(b"\x1f\x8b\x08", i)]
    for start in (starts[0], starts[30], starts[-1]):
        broken = bytearray(whole)
        broken[start + 40] ^= 0xFF
        for data in (bytes(broken), whole[:-3]):
            with pytest.raises(ValueError):
                for split in range(0, len(data), 700):
                    list(warc.records_in(pa.BufferReader(data), len(data), split, min(len(data), split + 700)))


def test_false_magic_inside_a_payload_is_no_record(tmp_path):
    inner = gzip.compress(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n")
    import zlib

    head = f"WARC/1.1\r\nContent-Length: {len(inner)}\r\n\r\n".encode()
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)  # keeps the payload as it is
    data = (stored.compress(head + inner + b"\r\n\r\n") + stored.flush()) * 3
    (tmp_path / "x").write_bytes(data)
    for step in (7, 50, len(data)):
        with pa.OSFile(str(tmp_path / "x")) as f:
            found = [r for s in range(0, len(data), step) for r in warc.records_in(f, len(data), s, min(len(data), s + step))]
        assert [body for _, body in found] == [inner] * 3


def brute_targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    open_, left, out = set(names), share * sum(sizes.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix_meets_its_targets(odd):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s, t in brute_targets(sizes).items():
        assert target[s] == pytest.approx(t) and taken[s] == round(t)
    assert sorted(map(str, mixing.mix(odd.repartition(3)).collect())) == sorted(map(str, got))
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mixed_documents_hold_the_words_that_were_taken(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 9)) + "\n", f"s{i % 4}", "en", 3) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
    assert {r["doc_id"]: r["n"] for r in words.collect()} == {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}


CJK = "这是一篇关于城市公园改造的新闻报道，记者昨天走访了现场的几位居民。"
LONG = "This is a paragraph that is long enough and has the usual words of the language in it, as they are."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<div class=content><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><article><h3>Card</h3><p>Short teaser</p></article>", ["Head", LONG, "Short.", LONG]),
        (f"<nav><a href=/>x</a></nav><h1>Head</h1><article><p>{LONG}</p></article>", ["Head", LONG]),
        (f"<article><h2 id='related-work'>Related work</h2><section class='related-work'><p>{LONG}</p></section><section id=discussion><p>{LONG}</p></section></article>", ["Related work", LONG, LONG]),
        (f"<div class='post-header-share'><h1>T</h1><p>{LONG}</p></div>", ["T", LONG]),
        ("<div><a href=/a>Главная страница сайта</a></div><div><p>" + "Это длинный абзац статьи на русском языке, который должен остаться в тексте. " * 2 + "</p></div>", [("Это длинный абзац статьи на русском языке, который должен остаться в тексте. " * 2).strip()]),
        (f"<article><p>{LONG}</p><div class='comment-list'><p>{LONG}</p></div></article><div id=comments><p>{LONG}</p></div><div class=cookie-banner><p>{LONG}</p></div><footer>{LONG}</footer>", [LONG]),
        (f"<article><h1>Short</h1><p>Tiny text.</p></article><div class=ad>{LONG}</div>", ["Short", "Tiny text."]),
        (f"<nav><a href=/>x</a></nav><h1><a href=/story>Linked headline</a></h1><p>{LONG}</p>", ["Linked headline", LONG]),
        (f"<div><h2><a href=/story>Linked headline</a></h2><p>{LONG}</p></div>", ["Linked headline", LONG]),
        (f"<article><p>{LONG} <a href=/x>{' ' * 240}here</a> and <a href=/y>&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;&#8220;there</a>.</p></article>", [f"{LONG} here and {'“' * 13}there."]),
        (f"<div><h1>Head</h1><p>{LONG}</p></div><div>" + "".join(f"<a href=/{i}><h3>Card {i}</h3><p>{LONG}</p></a>" for i in range(3)) + "</div>", ["Head", LONG]),
        (f"<article><p>{LONG} <a href=/x>never closed</p><p>{LONG}</p><p>{LONG} <a href=/y>closed</a></p></article>", [f"{LONG} never closed", LONG, f"{LONG} closed"]),
        (f"<div><p>{LONG}</p></div><div class='comment-body'><p>{LONG}</p></div><section class='reader-comments-thread'><p>{LONG}</p></section><div class='fb-comments-wrapper'><p>{LONG}</p></div>", [LONG]),
        (f"<div><p>{LONG}</p></div><ol><li class='comment'><p>{LONG}</p><ul><li class='comment'><div><p>{LONG}</p></div></ul><li class=comment>{LONG}</ol><p>{LONG} Again.</p>", [LONG, f"{LONG} Again."]),
        (f"<div class='gdpr-cookie-law'><p>{LONG}</p></div><main><p>{LONG}</p></main>", [LONG]),
        (f"<div class='post comments-open'><h1>Head</h1><p>{LONG}</p></div>", ["Head", LONG]),
        (f"<article><p>{LONG}</p><section id='cookie-recipes'><h2>Cookie recipes</h2><p>{LONG}</p></section></article>", [LONG, "Cookie recipes", LONG]),
        ("<ul><li><a href=/a>首页</a><li><a href=/b>新闻中心</a></ul><div><p>" + CJK + "</p><p>" + CJK + "</p></div>", [CJK, CJK]),
        (f"<ul><li>{LONG}<li>{LONG}<ol><li>Inner<li>Last</ol></ul><table><tr><td>{LONG}<td>{LONG}</table>", [LONG, LONG, "Inner", "Last", LONG, LONG]),
    ],
)
def test_densities_decide_and_names_help(page, want):
    assert html.main_text(page).split("\n") == want


@pytest.mark.parametrize("page", ["<a href='" * 20000, "<!" * 20000, "<div>" * 20000 + "</section>" * 20000, "<p " + "a" * 200000 + ">x", "<button>" * 20000, "<a href='\"" * 20000 + ">", "<p" + " a    " * 30000 + ">x", "<ul>" + "<li><div>" * 20000, "<ul><li>" + "<div>" * 10000 + "<ul>" * 10000 + "<li>" * 10000, "<td><table>" * 20000, "<a href=x><p>" * 20000])
def test_long_broken_pages_take_linear_time(page):
    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 2  # a scan for each tag takes a minute


def test_second_pass_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        kinds = [rng.choice(["long", "short", "links", "h2"]) for _ in range(rng.randint(1, 12))]
        made = {"long": f"<p>{LONG} %d</p>", "short": "<p>few words %d</p>", "links": "<p><a href=/>only a link %d</a></p>", "h2": "<h2>Heading %d</h2>"}
        page = "".join(made[k] % i for i, k in enumerate(kinds))
        decided = [i for i, k in enumerate(kinds) if k in ("long", "links")]
        kept = []
        for i, k in enumerate(kinds):
            # Nearest decided block; at equal distance the next one for headings, the previous one for others.
            j = min(decided, key=lambda d: (abs(d - i), d < i if k == "h2" else d > i), default=None)
            if k == "long" or (k in ("short", "h2") and (j is None or kinds[j] == "long")):
                kept.append(i)
        assert [int(x.split()[-1]) for x in html.main_text(page).split("\n") if x] == kept


def test_kept_equals_brute_force(spark):
    """The verdict from ratios worked out anew for each text and chunk, on prose, noise, repeats and mixtures of them."""
    import zstandard

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    noise = lambda n: " ".join("".join(chr(rng.randint(33, 0x2FFF)) for _ in range(12)) for _ in range(n))
    few = [prose(3) for _ in range(4)]
    texts = [prose(rng.randint(10, 1500)) for _ in range(30)] + [noise(rng.randint(10, 400)) for _ in range(15)]
    texts += [" ".join(f"{rng.choice(few)} {i}" for i in range(rng.randint(20, 600))) for _ in range(15)] + [prose(900) + noise(n) for n in (50, 300, 900)] + [None, "", "x"]
    packed = lambda raw: len(raw) / len(zstandard.compress(raw, 3))

    def fits(raw):
        band = [x for x in quality.Bands().limits if x[0] <= len(raw)][-1]
        return band[1] <= packed(raw) <= band[2]

    got = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    seen = set()
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        parts = [raw[k : k + 4096] for k in range(0, len(raw), 4096)]
        bad = sum(len(x) for x in parts if not fits(x))
        verdict = not got[i]["base_failed"] and (not raw or (fits(raw) and (len(parts) == 1 or 2 * bad <= len(raw))))
        assert got[i]["kept"] == verdict
        seen.add((got[i]["base_failed"], verdict))
    assert len(seen) == 3


def test_a_model_that_will_forget_remembers_fewer(monkeypatch):
    monkeypatch.setattr(spm, "BRIEFLY", 3)
    brief, full = spm.MergeModel(tokenizer_path()), spm.load(tokenizer_path())
    brief.brief = True
    for i in range(20):
        text = f"wordings number{i} of text{i} \x01"
        assert brief.encode_text(text) == full.encode_text(text)
        assert len(brief.seen) <= 3 and len(brief.older) <= 3


def test_free_memory_goes_back_to_the_system():
    def private() -> int:
        return sum(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon:"))

    blocks = [np.ones(12_000) for _ in range(1500)]  # 96 KB each, below what the C library maps for itself
    last, before = np.ones(12_000), private()
    del blocks
    common.give_back()
    assert last.sum() == 12_000 and before - private() > 100_000
