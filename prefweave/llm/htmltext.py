"""Main text of web pages by two-pass block rules (operator 9).

A page is cut into blocks at block-level tags. First pass: every block is
judged alone by its length, stop-word density and link density, and by where it
stands (menus, headers, footers, sidebars, notices, adverts, forms, comments,
hidden parts are boilerplate; by element, role or a whole class or id). A name
never rejects an ``article`` or ``main`` itself, nor, where none stands outside such
containers, one that holds more than half of the page's text. On a page with too
few known stop words, length and link density decide. Second pass: a short or undecided block takes
the label of its nearest decided neighbours in the same main element: good if
either nearest neighbour is good, or if none is decided and the element is the
page's article; a long block with few stop words must stand between two good ones.
Where a page has an ``article`` or ``main`` element, main text
is looked for inside it only, and there only its place makes a block bad; otherwise
in the whole body.

Pages are independent: a narrow Arrow map, with no shuffle; whole pages are
read whatever their length.

Edge cases: a null or empty page gives an empty text and 0; plain text without
tags is one block; unclosed tags, comments and scripts end with the page; a tag whose
quote never closes ends at its first ``>``, and so do the tags after it. Character
references are decoded within one stretch of text, not across tags. Repeated rows
each give a row; extra columns are ignored. Work is linear in the page's length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from prefweave.llm.tables import need

# Common function words of the languages that occur.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he her his in is it not of on or she that the their they this to was were
which with you
aber als am auch auf aus bei das dem den der des die durch ein eine einer es für haben hat im in ist mit nach nicht oder
sich sie sind und von war werden wie zu
au aux avec ce ces cette dans de des du elle en est et il la le les leur mais ne ou par pas pour qui que sa se ses son
sur un une
al como con de del el ella en es esta ha la las lo los más no o para pero por que se ser sin su sus un una y ya
""".split())

# Thresholds of the first pass.
SHORT_CHARS = 70               # below: too short to decide
GOOD_CHARS = 140               # good on its own with enough stop words
STOP_LOW, STOP_HIGH = 0.15, 0.25
MAX_LINKS = 0.4                # share of characters inside links

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol
optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul""".split())
OUTSIDE = frozenset("""aside button dialog fieldset footer form head iframe input menu nav noscript object option select
svg template textarea title""".split())
MAIN = frozenset(("article", "main"))
CLOSED_BY_BLOCK = frozenset(("p",))
# Whole classes or ids: a part of one ("no-sidebar", "comments-open") says nothing.
OUTSIDE_NAME = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|cookie-(?:banner|notice|consent|bar)|consent|notice|popup|modal"
    r"|newsletter|subscribe|nav|navbar|navigation|(?:main|site|top|post|page)-nav(?:igation)?|menu|(?:main|site|top)-menu"
    r"|breadcrumbs?|sidebar|side-bar|(?:left|right)-sidebar|sidebar-(?:left|right)|footer|(?:site|page)-(?:header|footer)"
    r"|masthead|comments?|comments-area|comment-?list|disqus\w*|replies|respond|related|related-(?:posts|articles)|share"
    r"|sharing|social|social-(?:links|share)|share-buttons|pagination|pager|login|search|search-form|skip-link", re.I)
OUTSIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_NO_TAG = (r"<!--.*?(?:--!?>|\Z)"
           r"|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\Z)"
           r"|<[!?][^>]*(?:>|\Z)")
_NAME = r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
TOKEN = re.compile(_NO_TAG + "|" + _NAME + r"""((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z|(["']))""", re.S | re.I)
TOKEN_TO_FIRST = re.compile(_NO_TAG + "|" + _NAME + r"([^>]*+)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                       re.I)
WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN, BETWEEN = 1, 0, None, -1      # BETWEEN: good between two good blocks only


def _tokens(page: str) -> Iterator[re.Match]:
    """Comments, scripts and tags in order. From the first tag on whose quote
    never closes, quotes are not looked at."""
    at = 0
    while (m := TOKEN.search(page, at)) and m.group(4) is None:
        yield m
        at = m.end()
    if m:
        yield from TOKEN_TO_FIRST.finditer(page, m.start())


class Block:
    __slots__ = ("parts", "link_parts", "outside", "named", "main")

    def __init__(self, outside: bool, named: int, main: int):
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.outside, self.named, self.main = outside, named, main


def _hidden(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in OUTSIDE_ROLE:
            return True
    return False


def _named(attributes: str) -> bool:
    return any(m.group(1).lower() in ("class", "id") and any(map(OUTSIDE_NAME.fullmatch, (m.group(2) or "").strip("\"'").split()))
               for m in ATTRIBUTE.finditer(attributes))


def _reject_named(found: list[Block], parents: list[int]) -> None:
    """Blocks inside containers with a boilerplate name become outside, unless
    the container holds most of the text. ``parents``: of each container the one
    around it (0: none)."""
    if len(parents) == 1:
        return
    sizes = [0] * len(parents)
    for b in found:
        if not b.outside:
            sizes[b.named] += sum(len(x) - x.count(" ") for x in b.parts)
    for i in range(len(parents) - 1, 0, -1):
        sizes[parents[i]] += sizes[i]
    spare = not any(b.main and not b.named and not b.outside for b in found)
    rejected = [False] * len(parents)
    for i in range(1, len(parents)):
        rejected[i] = rejected[parents[i]] or not (spare and 2 * sizes[i] > sizes[0])
    for b in found:
        b.outside = b.outside or rejected[b.named]


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, with their place: outside the main text or
    not, and the number of the innermost article or main element (0: none)."""
    stack: list[tuple[str, bool, int, int]] = []   # open element, outside, named container, main element
    n_open: Counter[str] = Counter()               # open elements by name
    outside, named, main, links, n_main = False, 0, 0, 0, 0
    parents = [0]
    block = Block(False, 0, 0)
    found = [block]

    def new_block() -> None:
        nonlocal block
        if block.parts or (block.outside, block.named, block.main) != (outside, named, main):
            block = Block(outside, named, main)
            found.append(block)

    def unwind(depth: int) -> None:
        nonlocal outside, named, main, links
        while len(stack) > depth:
            name, outside, named, main = stack.pop()
            n_open[name] -= 1
            links -= name == "a"

    at = 0
    for m in _tokens(page):
        if m.start() > at:
            text = html.unescape(page[at:m.start()])
            block.parts.append(text)
            if links:
                block.link_parts.append(text)
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            block.parts.append(" ")
            continue
        is_block = name in BLOCK
        if m.group(1):
            if n_open[name]:
                unwind(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            if is_block:
                new_block()
            continue
        if is_block and stack and stack[-1][0] in CLOSED_BY_BLOCK:
            unwind(len(stack) - 1)
        if name == "body":
            unwind(0)
        if name not in VOID and not m.group(3).rstrip().endswith("/"):
            stack.append((name, outside, named, main))
            n_open[name] += 1
            links += name == "a"
            if not outside:
                if name in OUTSIDE or name == "header" and not main:
                    outside = True
                elif m.group(3) and name not in ("html", "body") and _hidden(m.group(3)):
                    outside = True
                elif name in MAIN:
                    n_main += 1
                    main = n_main
                elif m.group(3) and name not in ("html", "body") and _named(m.group(3)):
                    parents.append(named)
                    named = len(parents) - 1
        if is_block:
            new_block()
    if at < len(page):
        block.parts.append(html.unescape(page[at:]))
    _reject_named(found, parents)
    return found


def _clean(text: str) -> str:
    return " ".join(text.split())


def stop_words(text: str) -> tuple[int, int]:
    """(stop words, words) of a block."""
    tokens = WORD.findall(text.lower())
    return sum(t in STOP_WORDS for t in tokens), len(tokens)


def first_pass(text: str, link_chars: int, in_main: bool, density: float, known: bool) -> int | None:
    """Label of a block on its own; None if it can't be decided. ``known``: the
    page is in a language with stop words; else lengths count in bytes, as
    scripts with several bytes a character say more in each."""
    linked = link_chars / len(text)
    if linked > MAX_LINKS:
        return OPEN if in_main else BAD
    if not known:
        return GOOD if len(text.encode("utf-8", "surrogatepass")) >= SHORT_CHARS else OPEN
    if len(text) < SHORT_CHARS:
        return OPEN
    if density >= STOP_HIGH or density >= STOP_LOW and len(text) >= GOOD_CHARS:
        return GOOD
    if density >= STOP_LOW or in_main:
        return OPEN
    return BETWEEN


def main_text(page: str | None) -> str:
    if not page:
        return ""
    rows = []                                      # text, main element, label
    blocks = blocks_of(page)
    in_main_only = any(b.main and not b.outside for b in blocks)
    texts = [_clean("".join(b.parts)) for b in blocks]
    stops = [(0, 0) if b.outside or in_main_only and not b.main else stop_words(t) for b, t in zip(blocks, texts)]
    known = sum(s for s, _ in stops) >= STOP_LOW * sum(n for _, n in stops)
    for b, text, (n_stop, n_words) in zip(blocks, texts, stops):
        if not text:
            continue
        if b.outside or in_main_only and not b.main:
            label = BAD
        else:
            link = len(_clean(" ".join(b.link_parts))) if b.link_parts else 0
            label = first_pass(text, link, b.main > 0, n_stop / max(n_words, 1), known)
        rows.append((text, 0 if label == BAD and b.outside else b.main, label))
    # Second pass: nearest decided neighbours in the same main element.
    before, after = [], [None] * len(rows)
    last: dict[int, int | None] = {}
    for text, main, label in rows:
        before.append(last.get(main))
        if label in (GOOD, BAD):
            last[main] = label
    last = {}
    for i in range(len(rows) - 1, -1, -1):
        _, main, label = rows[i]
        after[i] = last.get(main)
        if label in (GOOD, BAD):
            last[main] = label
    out = []
    for (text, main, label), a, b in zip(rows, before, after):
        if label is OPEN:
            label = GOOD if GOOD in (a, b) or (a is None and b is None and main) else BAD
        elif label == BETWEEN and a == b == GOOD:
            label = GOOD
        if label == GOOD:
            out.append(text)
    return "\n".join(out)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(v.as_py()) for v in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = need(pages, "page_id", "url", "html").selectExpr(
        "cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInArrow(_extract_batches, "page_id bigint, url string, text string, n_chars bigint")
