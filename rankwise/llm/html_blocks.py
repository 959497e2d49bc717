"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. What the markup itself calls a
menu, header, footer, sidebar, notice, advert, form or comment is a bad block.
The first pass judges every other block on its own: many linked characters are
bad; a long block is good if enough of its words are stop words, or if no language
of the lists fits the page; short blocks, and long ones in between, stay undecided. In the second pass an undecided block
takes the label of its nearest decided neighbour. Inside an article element only
blocks of that article are neighbours, and a block that finds none is good there.

Tasks hold one page at a time; rows do not depend on each other.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rankwise.llm.text import fresh

ROWS_AT_ONCE = 64
LONG = 70               # characters from which a block is judged by its words
LINKED = 0.5            # share of linked characters that makes a block bad
STOP_HIGH = 0.15        # shares of stop words: good from here on,
STOP_LOW = 0.05         # and bad below, undecided in between

# Frequent function words of the languages in the tables.
STOP_WORDS = frozenset("""
the of and to in a is that it for was on are as with be by this or an from at not have but
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er
le la les de des du et un une est que en dans qui pour au par sur pas ce se plus ne avec il
el los las del y que en un una es por con se para no al lo como su más o
""".split())
# Elements by what they mean for a block.
BLOCK_TAGS = frozenset("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
noscript ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul
""".split())
# Raw text up to the end tag, or the end of the page; what the others hold is
# markup, so they end with the element they stand in at the latest.
RAW_TAGS = frozenset("script style textarea title".split())
UNREAD_TAGS = frozenset("template noscript iframe svg canvas object select button audio video "
                        "noframes".split())
NESTING_TAGS = frozenset("svg object template".split())
LABELLED_TAGS = frozenset("button select".split())
BAD_TAGS = frozenset("nav footer aside form dialog menu head".split())
STRUCTURE = frozenset("""
article aside blockquote body center details dialog div dl fieldset figure footer form head
header html main menu nav ol section table td ul
""".split())
ARTICLE_TAGS = frozenset(["article", "main"])
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                      "alertdialog menu menubar toolbar".split())
BAD_NAMES = frozenset("""
ad ads adv advert adverts advertisement advertising adsbygoogle adsense adbox adslot sponsor
sponsored sponsors promo promoted promotion banner banners nav navbar navigation menu menus
breadcrumb breadcrumbs topbar toolbar masthead header footer foot sidebar sidebars aside rail
cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
subscribe subscription signup login signin register comment comments commentlist discussion
disqus replies respond reviews share sharing social related recommended recommendations teaser
teasers widget widgets pager pagination copyright legal disclaimer skip print tags search form
""".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                                              # comment
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"    # tag
    r"|<[!?/a-zA-Z][^<>]*(?:>|\Z|(?=<))", re.S)                        # other markup
RAW_END = {t: re.compile(rf"</{t}(?![a-zA-Z0-9:-])[^>]*(?:>|\Z)", re.I) for t in RAW_TAGS}
NEXT_MARKUP = re.compile(r"<|\Z")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
WORD = re.compile(r"\w+")


def unread_ends(page: str) -> dict[int, int]:
    """Where elements that are not read end, by where their tags begin.

    An element without its end tag is not listed: the element that it stands in ends
    first, an article begins, or another of its kind where these do not nest. One
    pass with a stack of open elements.
    """
    ends, stack, at = {}, [], 0
    known = dict.fromkeys(STRUCTURE | UNREAD_TAGS, 0)      # open on the stack, by name

    def pop(upto: str) -> int:
        while True:
            name, start = stack.pop()
            known[name] -= 1
            if name == upto:
                return start
    while m := TOKEN.search(page, at):
        at = m.end()
        name, closing = (m[2] or "").lower(), bool(m[1])
        if name in RAW_TAGS:
            if not closing and not m[3].endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
        elif name not in known or (not closing and m[3].endswith("/")):
            continue
        elif not closing:
            if name in ARTICLE_TAGS:
                # No such element goes on into an article.
                first = next((i for i, (x, _) in enumerate(stack) if x in UNREAD_TAGS), len(stack)) \
                    if any(known[x] for x in UNREAD_TAGS) else len(stack)
                while len(stack) > first:
                    known[stack.pop()[0]] -= 1
            elif name in UNREAD_TAGS and name not in NESTING_TAGS and known[name]:
                pop(name)
            stack.append((name, m.start()))
            known[name] += 1
        elif known[name]:
            start = pop(name)
            if name in UNREAD_TAGS:
                ends[start] = m.end()
    return ends


@dataclass
class Block:
    tag: str
    bad: bool
    article: int          # 0 outside of any article element
    parent: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class _Open:
    tag: str
    bad: bool
    article: int
    number: int


def _is_bad(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the markup calls an element something other than the article."""
    if tag in BAD_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", *ARTICLE_TAGS):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") \
                or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)) \
                or (name == "role" and value.lower() in BAD_ROLES):
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in NAME_PART.findall(word)}
                # "with-sidebar" and the like speak of what is beside the element.
                if parts & {"with", "has", "no", "without", "main", "article", "content"} \
                        and not parts & {"comment", "comments"}:
                    continue
                if in_article:
                    parts -= {"header", "tags"}
                if parts & BAD_NAMES:
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order, with their text and what markup says."""
    out: list[Block] = []
    stack = [_Open("", False, 0, 0)]
    opened = links = 0
    current: Block | None = None

    def add(text: str):
        nonlocal current
        if not text:
            return
        if current is None:
            top = stack[-1]
            current = Block(tag, top.bad, top.article, top.number)
            out.append(current)
        current.parts.append(text)
        if links:
            current.linked += len("".join(text.split()))

    tag, at, ends = "", 0, None
    while m := TOKEN.search(page, at):
        add(html.unescape(page[at:m.start()]))
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW_TAGS and not closing:
            if not m[3].endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
        elif name in UNREAD_TAGS:
            if not closing and not m[3].endswith("/"):
                ends = unread_ends(page) if ends is None else ends
                if m.start() in ends:
                    at = ends[m.start()]
                elif name in LABELLED_TAGS:
                    at = NEXT_MARKUP.search(page, at).start()
            if name in BLOCK_TAGS:
                current = None
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br":
            add(" ")
        elif name in BLOCK_TAGS:
            current, tag = None, "" if closing else name
            links = 0
            if name not in STRUCTURE:
                continue
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == name:
                        del stack[i:]
                        break
            else:
                # An article ends a menu, header or form that was never closed.
                while name in ARTICLE_TAGS and len(stack) > 1 \
                        and stack[-1].bad and (stack[-1].tag in ("nav", "header", "form", "head", "ul")
                                               or name == "main"):
                    stack.pop()
                if name == "body":
                    del stack[1:]
                top, opened = stack[-1], opened + 1
                article = opened if name in ARTICLE_TAGS and not top.article else top.article
                bad = top.bad or _is_bad(name, m[3], bool(top.article))
                stack.append(_Open(name, bad, article, opened))
    add(html.unescape(page[at:]))
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in out if b.text]


def _is_out(b: Block) -> bool:
    """Whether markup, links or a copyright sign make a block bad."""
    return b.bad or b.linked > LINKED * len("".join(b.text.split())) or \
        (not b.article and bool(re.match(r"(©|\(c\)|copyright\b)", b.text, re.I)))


def _stop_words(b: Block) -> tuple[int, int]:
    """Stop words and words of a block."""
    words = WORD.findall(b.text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def language_fits(found: list[Block]) -> bool:
    """Whether the long blocks of a page, taken together, have stop words as texts in
    one of the listed languages do. A page without such blocks fits."""
    counts = [_stop_words(b) for b in found if len(b.text) >= LONG and not _is_out(b)]
    return sum(n for n, _ in counts) >= STOP_HIGH * sum(n for _, n in counts)


def first_pass(b: Block, fits: bool = True) -> bool | None:
    """Good, bad or undecided, from the block alone. Where no listed language fits
    the page, stop words tell nothing: there a long block without links is good."""
    if _is_out(b):
        return False
    if len(b.text) < LONG:
        return None
    if not fits:
        return True
    stops, words = _stop_words(b)
    share = stops / max(words, 1)
    if share >= STOP_HIGH:
        return True
    return False if share < STOP_LOW and not b.article else None


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided neighbour.

    Where one before and one after are equally near, a heading goes with what
    follows; else one in the same element wins, and then the good one.
    """
    def nearest(order):
        """For each block (steps, label, parent) of the next decided block that
        way; articles know only their own blocks, without adverts and the like."""
        out, last, steps = {}, {}, {}
        for i in order:
            b = found[i]
            for scope in {0, b.article}:
                if scope and b.bad:
                    continue
                steps[scope] = steps.get(scope, 0) + 1
                if scope == b.article and scope in last:
                    at, label, parent = last[scope]
                    out[i] = steps[scope] - at, label, parent == b.parent
                if labels[i] is not None:
                    last[scope] = steps[scope], labels[i], b.parent
        return out
    earlier = nearest(range(len(found)))
    later = nearest(range(len(found) - 1, -1, -1))
    out = []
    for i, (b, label) in enumerate(zip(found, labels, strict=True)):
        if label is None:
            before, after = earlier.get(i), later.get(i)
            if not before or not after:
                known = before or after
                label = known[1] if known else bool(b.article)
            elif before[1] == after[1]:
                label = before[1]
            elif before[0] != after[0]:
                label = min(before, after)[1]
            elif b.tag[:1] == "h":
                label = after[1]
            else:
                label = (before if before[2] > after[2] else after if after[2] > before[2]
                         else (0, True))[1]
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The text of the good blocks, one a line."""
    found = blocks(page or "")
    fits = language_fits(found)
    labels = second_pass(found, [first_pass(b, fits) for b in found])
    return "\n".join(b.text for b, good in zip(found, labels, strict=True) if good)


def _extracted(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            texts = [main_text(p) for p in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])


def extract(pages: DataFrame, *, source: str = "html") -> DataFrame:
    """All columns of ``pages`` but the markup, with text and n_chars (its code
    points); a clashing name gets a leading underscore.

    A null or empty page has the empty text, as has one without a good block.
    Markup that is cut off ends the page; an element without its end tag does not. Each row stands for itself, so
    repeated rows give equal results; an empty table gives an empty result.
    """
    others = [c for c in pages.columns if c != source]
    packed = pages.select(F.struct(*(F.col(f"`{c}`") for c in others), F.lit(0).alias("_"))
                          .alias("row"), F.col(f"`{source}`").alias("html"))
    out = packed.mapInArrow(_extracted, StructType([
        packed.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType())]))
    rest = pages.drop(source)
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in others),
                      F.col("text").alias(fresh(rest, "text")),
                      F.col("n_chars").alias(fresh(rest, "n_chars")))
