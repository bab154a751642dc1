"""Main text of web pages by two passes over text blocks."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an the and or of to in on at by for from with as is are was were be been it its this that these those he she they we you i not but have has had
    der die das den dem des ein eine einer eines und oder ist sind war im in zu von mit auf für als auch nicht es sie er wir ich an dass sich
    le la les un une des du de et ou en est sont dans pour par sur avec que qui ne pas ce cette il elle nous vous au aux se
    el los las una unos unas y o del es son por para con como más pero su sus lo al que no se""".split()
)

# Elements whose content is never text of the page; elements that frame a page; class names of what is no article.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "title", "textarea", "select", "button", "audio", "video")
FRAMES = frozenset("nav footer aside form menu dialog head".split())
SCOPES = frozenset("article main".split())
# Elements that end where the next one of their kind begins, and what they stand in.
ITEMS = {"li": "ul ol menu".split(), "dt": ["dl"], "dd": ["dl"], "td": ["tr", "table"], "th": ["tr", "table"]}
HOLDERS = frozenset("html body div section table tbody thead tfoot tr ul ol dl fieldset details figure center header hgroup blockquote".split()) | FRAMES | SCOPES | ITEMS.keys()
BREAKS = HOLDERS | frozenset("p h1 h2 h3 h4 h5 h6 caption legend figcaption summary pre address hr option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
NOT_ARTICLE = frozenset(
    """ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice alert
    sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus respond reply replies share sharing
    social related recommended recommendations newsletter subscribe subscription popup modal overlay widget pagination pager login signin signup skip
    copyright""".split()
)
# Words that may stand beside those in the name of such a part; any other word makes the name uncertain.
BESIDE = frozenset(
    """area articles bar block blocks bottom box button buttons container content footer form global group header inner item items left link links list main
    middle outer page pages panel post posts reader right section side site slot stories text top unit user wrap wrapper""".split()
)
NOT_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
READERS = frozenset("comment comments disqus respond reply replies".split())
# Words that tell even among unknown ones: in a class, or in an id outside articles (within, ids come from headings).
STRONG = frozenset("comment comments disqus cookie cookies gdpr".split())
# Of those without markup of their own the text ends at the end tag, or never.
PLAIN = frozenset("script style title textarea noscript iframe".split())

TAG_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
IN_TAG = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++))")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)", re.IGNORECASE)
END_TAGS = {t: re.compile(rf"</{t}(?![a-zA-Z0-9:-])[^>]*+>?", re.IGNORECASE) for t in RAW}
NAME = re.compile(r"[a-z]+")
#: Scripts of which a character says about as much as three letters: Chinese, Japanese, Korean.
DENSE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x2E80, 0x9FFF), (0xAC00, 0xD7AF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF))) + "]")


def length(text: str) -> int:
    """Characters, those of dense scripts thrice."""
    return len(text) if text.isascii() else len(text) + 2 * len(DENSE.findall(text))


@dataclass
class Token:
    """A tag (name in lower case, with its attributes) or, without a name, what stands for nothing but a space or less."""

    start: int
    end: int
    name: str = ""
    close: bool = False
    more: str = ""
    space: bool = False


def tokens(page: str) -> Iterator[Token]:
    """Tags, comments and raw elements in order; what is between them is text. Takes time in proportion to the page.

    A quote that is never closed makes all later quotes mean nothing, a tag that is never closed is text.
    """
    at, quotes, unended = 0, True, set()
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        at = start + 1
        if page.startswith("!--", at):
            end = page.find("-->", at + 3)
            yield Token(start, len(page) if end < 0 else end + 3)
            if end < 0:
                return
            at = end + 3
            continue
        close = page.startswith("/", at)
        named = TAG_NAME.match(page, at + close)
        if not named:
            if page[at : at + 1] in ("!", "?", "/"):
                end = page.find(">", at)
                if end < 0:
                    return
                yield Token(start, end + 1)
                at = end + 1
            continue
        name = named[0].lower()
        end = named.end()
        while quotes:
            mark = IN_TAG.search(page, end)
            if not mark:
                quotes = False
            elif mark[0] == ">":
                end = mark.start()
                break
            else:
                end = page.find(mark[0], mark.end()) + 1
                quotes = end > 0
        if not quotes:
            end = page.find(">", named.end())
            if end < 0:
                return
        more = page[named.end() : end]
        at = end + 1
        if name in END_TAGS and not close and not more.endswith("/") and name not in unended:
            over = END_TAGS[name].search(page, at)
            if over or name in PLAIN:
                at = over.end() if over else len(page)
                yield Token(start, at, space=True)
                continue
            unended.add(name)
        yield Token(start, at, name, close, more)


@dataclass(frozen=True)
class Rules:
    """Limits of the first pass: shares of linked characters and of stop words among words, a length in characters, and the
    share of stop words from which a page's language is known."""

    most_links: float = 0.5
    stop_share: float = 0.2
    long_enough: int = 70
    known_share: float = 0.05


@dataclass
class Block:
    text: str
    linked: int  # characters of it that stand in links
    heading: int  # 1 to 6, 0 for others
    scope: int  # number of the article it stands in, 0 outside
    framed: bool  # inside a menu, footer, form, hidden part ...
    named: int  # inside a part whose name says advert, comment, notice ...: CERTAIN or LIKELY, else 0


def _attributes(more: str) -> dict[str, str]:
    return {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(more)} if more else {}


def _framed(tag: str, found: dict[str, str], more: str, in_scope: bool) -> bool:
    if tag in FRAMES or (tag == "header" and not in_scope):
        return True
    if not more or tag in ("html", "body"):
        return False
    hidden = found.get("aria-hidden") == "true" or HIDDEN.search(found.get("style", "")) or (BARE_HIDDEN.search(more) and BARE_HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", more)))
    return bool(hidden) or found.get("role", "").lower() in NOT_ARTICLE_ROLES


CERTAIN, LIKELY = 1, 2


def _named(tag: str, found: dict[str, str], in_scope: bool) -> int:
    """Whether a word of class or id says that this is no article: CERTAIN if only such words stand beside it as go with
    that, LIKELY if a strong word stands among others."""
    if tag in HEADINGS or tag in ("html", "body"):
        return 0
    telling, likely = READERS if tag in SCOPES else NOT_ARTICLE, 0
    for kind in ("class", "id"):
        for name in found.get(kind, "").lower().split():
            words = set(NAME.findall(name))
            if words & telling and words <= NOT_ARTICLE | BESIDE:
                return CERTAIN
            if words & STRONG and tag not in SCOPES and (kind == "class" or not in_scope):
                likely = LIKELY
    return likely


def blocks(page: str) -> list[Block]:
    """The page's text between block elements, in order; comments, markup and raw elements are gone.

    A link reaches over blocks up to its end tag; one whose end tag is missing (another link begins, or none follows)
    ends with its block.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # open holders: tag, framed, named, scope
    depth: Counter[str] = Counter()  # how often each tag is in the stack
    framed, named, scope, scopes = False, 0, 0, 0
    linked, ended = False, False  # in a link; one that has an end tag
    parts: list[str] = []
    in_links: list[str] = []
    heading, own_framed, own_named = 0, False, 0
    clean = lambda pieces: " ".join(entities.unescape("".join(pieces)).split())

    def flush() -> None:
        if parts:
            text = clean(parts)
            if text:
                out.append(Block(text, len(clean(in_links)), heading, scope, framed or own_framed, named or own_named))
            parts.clear()
        in_links.clear()

    def pop() -> None:
        nonlocal framed, named, scope
        depth[stack.pop()[0]] -= 1
        framed, named, scope = stack[-1][1:] if stack else (False, 0, 0)

    every = list(tokens(page))
    # Whether the next tag of a link after each one is an end tag.
    closed, next_closes = [False] * len(every), False
    for i in range(len(every) - 1, -1, -1):
        closed[i] = next_closes
        if every[i].name == "a":
            next_closes = every[i].close

    at = 0
    for i, token in enumerate(every):
        if token.start > at:
            piece = page[at : token.start]
            parts.append(piece)
            if linked:
                in_links.append(piece)
        at, tag = token.end, token.name
        if not tag:
            if token.space:
                parts.append(" ")
                in_links.append(" ")
            continue
        if tag == "a":
            linked = not token.close and "href" in token.more.lower()
            ended = linked and closed[i]
            in_links.append(" ")
            continue
        if tag not in BREAKS:
            if tag == "br":
                parts.append(" ")
                in_links.append(" ")
            continue
        flush()
        linked, own_framed, own_named = linked and ended, False, 0
        if token.close:
            heading = 0
            if tag in HOLDERS and depth[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        found = _attributes(token.more)
        if tag in HOLDERS:
            heading = 0
            if tag in SCOPES or tag == "body":  # a menu or page header that was never closed ends here
                while stack and stack[-1][0] in ("nav", "header", "head", "menu"):
                    pop()
            if tag in ITEMS and any(depth[t] for t in ITEMS if ITEMS[t] == ITEMS[tag]):
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in ITEMS[tag] and ITEMS.get(stack[k][0]) != ITEMS[tag]:
                    k -= 1
                if k >= 0 and stack[k][0] not in ITEMS[tag]:  # the item before was not closed
                    while len(stack) > k:
                        pop()
            bad, called = _framed(tag, found, token.more, bool(scope)), _named(tag, found, bool(scope))
            inner = scope
            if tag in SCOPES and not scope and not (bad or called or framed or named):
                scopes += 1
                inner = scopes
            if not token.more.endswith("/"):
                framed, named, scope = framed or bad, named or called, inner
                stack.append((tag, framed, named, scope))
                depth[tag] += 1
        elif tag not in VOID:
            heading = int(tag[1]) if tag in HEADINGS else 0
            own_framed, own_named = _framed(tag, found, token.more, bool(scope)), _named(tag, found, bool(scope))
    parts.append(page[at:])
    flush()
    return out


def first_pass(found: list[Block], rules: Rules) -> list[bool | None]:
    """A label for each block by its densities: good, bad or undecided.

    Bad is what is framed, mostly linked, or named as no article; good is what is long enough and has enough stop words. In a
    language without known stop words (hardly any in the long blocks) length decides. A heading in a link stands for what
    follows it: a first-order one, or one before a block without links, is undecided. Names count only while they leave
    some text (names that are only likely: some good text), and articles are the only place of good text if they have
    most of it; where the most of it stands outside, short blocks of articles are bad (cards of other stories).
    """
    shape = []  # long enough, words, stop words
    for b in found:
        words = b.text.lower().split()
        shape.append((length(b.text) >= rules.long_enough, len(words), sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words)))
    plain = [not b.framed and b.linked <= rules.most_links * len(b.text) for b in found]
    follows = False  # whether the next block that is no heading is plain
    for i in range(len(found) - 1, -1, -1):
        if not found[i].heading:
            follows = plain[i]
        elif not found[i].framed and (follows or found[i].heading == 1):
            plain[i] = True
    told = [s for s, p in zip(shape, plain, strict=True) if p and s[0]]
    known = sum(s[2] for s in told) >= rules.known_share * sum(s[1] for s in told)
    good = [p and s[0] and (not known or s[2] >= rules.stop_share * s[1]) for p, s in zip(plain, shape, strict=True)]

    def mass(chosen: Callable[[Block], bool]) -> int:
        return sum(len(b.text) for b, g in zip(found, good, strict=True) if g and chosen(b))

    names = any(p and not b.named for b, p in zip(found, plain, strict=True))
    likely = any(g and not b.named for b, g in zip(found, good, strict=True))
    free = lambda b: not b.named or not (names if b.named == CERTAIN else likely)
    inside, outside = mass(lambda b: free(b) and bool(b.scope)), mass(lambda b: free(b) and not b.scope)
    articles = any(b.scope and not b.framed and free(b) for b in found)
    label: list[bool | None] = []
    for b, p, g in zip(found, plain, good, strict=True):
        if not p or not free(b):
            label.append(False)
        elif articles and inside >= outside and not b.scope:
            label.append(None if b.heading == 1 else False)
        elif articles and inside < outside and b.scope and not g:
            label.append(False)
        else:
            label.append(True if g else None)
    return label


def main_text(page: str | None, rules: Rules = Rules()) -> str:  # noqa: B008
    """The blocks of the article, joined by line ends.

    The first pass labels blocks by their densities. Second pass: an undecided block takes the label of the nearest
    decided block (of its article, if it stands in one), of the two at equal distance the next one for a heading and
    the previous one for others; without any decided block in reach it stays.
    """
    found = blocks(page or "")
    label = first_pass(found, rules)
    n = len(found)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, int] = {}
        for i in order:
            scope = found[i].scope
            near[i] = last.get(scope)
            # Inside an article a bad block (a list of links, a share bar) says nothing of the text beside it.
            if label[i] is not None and (not scope or label[i]):
                last[scope] = last[0] = i
    kept = []
    for i, b in enumerate(found):
        good = label[i]
        if good is None:
            p, q = before[i], after[i]
            if p is None and q is None:
                good = True
            elif p is None or q is None:
                good = label[q if p is None else p]
            elif i - p == q - i:
                good = label[q if b.heading else p]
            else:
                good = label[p if i - p < q - i else q]
        if good:
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """page_id, url, text, n_chars for every row of `pages` (page_id, url, html).

    Null html counts as empty; a page without main text has an empty text and n_chars 0. Repeated rows are extracted
    each, an empty table gives an empty result, other columns are ignored. A narrow map: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), rules) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(pages["page_id"].cast("long"), pages["url"], pages["html"]).mapInArrow(run, "page_id long, url string, text string, n_chars long")
