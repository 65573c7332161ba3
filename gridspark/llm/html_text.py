"""Operator 3: main text of HTML pages by the distribution of text over lines.

Markup is stripped to lines, one for each block of text, with the length of the text that counts:
none for menus, page headers and footers, sidebars, notices, adverts, forms and comments, none for
link text, and none outside the article where the page marks one. Words of a class, id or role mark
what is around an article only as a guess: an article inside counts if no other has text, and a page
without any article whose other lines are empty gives the long ones of these. Lengths are summed over sliding
windows of lines. Text begins where the sums surge and ends where they dive to nothing; lines between
the two that count are kept, however short.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.llm.common import for_workers, text_or_empty

WINDOW = 3
#: A window sum above this is a surge on a page that marks no article.
SURGE = 86

# Element names of HTML, by what they do to the text.
RAW = "script style template textarea title noscript xmp iframe noembed noframes svg"
SKIPPED = "nav aside form button select dialog menu footer header head"
ARTICLE = "article main"
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr "
    "output picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var "
    "wbr input link meta object "
    "math semantics annotation mrow mi mn mo ms mtext mspace mstyle mpadded mphantom msub msup msubsup "
    "mfrac msqrt mroot mover munder munderover mmultiscripts mprescripts merror mtable mtr mtd menclose"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
# Words of class names, ids and roles that mark what is not the article.
MARKED = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent notice notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs header "
    "footer comment comments respond disqus reply replies share sharing social related recommended "
    "newsletter subscribe signup popup modal overlay widget toolbar pagination pager masthead copyright "
    "complementary contentinfo search"
)

_RAW, _SKIPPED, _ARTICLE = (frozenset(x.split()) for x in (RAW, SKIPPED, ARTICLE))
_INLINE, _VOID, _MARKED = (frozenset(x.split()) for x in (INLINE, VOID, MARKED))
_CLOSES_P = re.compile(r"^(p|div|ul|ol|dl|li|h[1-6]|table|section|article|main|blockquote|pre|form|hr|nav|aside|header|footer)$")

_OPEN = re.compile(r"(/?)([A-Za-z][^\s/>]{0,63})")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_CUT_TAG = re.compile("<[A-Za-z/!?]")
_LIMIT = re.compile("[>\"']")


class Tags:
    """The tags of a page, in time proportional to its length whatever stands in it.

    Where quotes and ends of tags are is looked up once, and where a tag that reaches one of them
    ends is remembered, so that no part of the page is gone through again for each `<`.
    """

    def __init__(self, page: str):
        self.page = page
        self._limits = [m.start() for m in _LIMIT.finditer(page)]
        self._of = {c: [i for i in self._limits if page[i] == c] for c in "\"'>"}
        self._ends: dict[int, int] = {}

    def close(self, at: int) -> int:
        """Place behind the next `>`, -1 if there is none."""
        return self._next(">", at) + 1 or -1

    def _next(self, char: str, at: int) -> int:
        places = self._of[char]
        i = bisect_left(places, at)
        return places[i] if i < len(places) else -1

    def _tag_end(self, at: int) -> int:
        """Place behind the first `>` from here on outside of quotes; -1 if a quote stays open."""
        passed, end = [], -1
        i = bisect_left(self._limits, at)
        while i < len(self._limits):
            limit = self._limits[i]
            if limit in self._ends:
                end = self._ends[limit]
                break
            passed.append(limit)
            char = self.page[limit]
            if char == ">":
                end = limit + 1
                break
            closed = self._next(char, limit + 1)
            if closed < 0:
                break
            i = bisect_left(self._limits, closed + 1)
        self._ends.update(dict.fromkeys(passed, end))
        return end

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Begin and end of the next tag from `at` on, whether it is an end tag, its name (empty for
        comments and declarations) and its attributes."""
        page = self.page
        while (begin := page.find("<", at)) >= 0:
            at = begin + 1
            if page.startswith("!--", at):
                stop = page.find("-->", at + 3)
                return begin, len(page) if stop < 0 else stop + 3, False, "", ""
            if page.startswith(("!", "?"), at):
                stop = self.close(at)
                if stop >= 0:
                    return begin, stop, False, "", ""
            elif name := _OPEN.match(page, at):
                stop = self._tag_end(name.end())
                if stop >= 0:
                    return begin, stop, bool(name[1]), name[2].lower(), page[name.end() : stop - 1]
        return None


class Stack:
    """Open elements: name, why skipped, in an article (1, in marked surroundings 2), in a link.
    Knows where each name and the innermost block is, without a search."""

    def __init__(self):
        self.open: list[tuple[str, int, int, bool]] = []
        self._places: dict[str, list[int]] = {}
        self._blocks: list[int] = []

    def push(self, name: str, skip: int, article: int, link: bool) -> None:
        self._places.setdefault(name, []).append(len(self.open))
        if name not in _INLINE:
            self._blocks.append(len(self.open))
        self.open.append((name, skip, article, link))

    def place(self, name: str) -> int:
        """Place of the innermost element of a name, -1 if there is none."""
        return (self._places.get(name) or [-1])[-1]

    def block(self) -> int:
        """Place of the innermost block, -1 if there is none."""
        return self._blocks[-1] if self._blocks else -1

    def cut(self, depth: int) -> tuple[int, int, bool]:
        """Close all elements from a place on; what holds then."""
        while len(self.open) > depth:
            name = self.open.pop()[0]
            self._places[name].pop()
            if name not in _INLINE:
                self._blocks.pop()
        return self.open[-1][1:] if self.open else (0, 0, False)


#: Why the text of an element does not count: words that mark it, or what it is.
GUESSED, CERTAIN = 1, 2


def _marked(attributes: str, inside_article: bool) -> int:
    """`CERTAIN` for a hidden element, `GUESSED` for one with a marking class, id or role, else 0."""
    found = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden":
            return CERTAIN
        if name in ("class", "id", "role"):
            words = (a or b or c).lower().split()
            # Inside an article a header's words name its own headline.
            if any(w in _MARKED and not (inside_article and w in ("header", "masthead")) for w in words):
                found = GUESSED
    return found


def lines(page: str) -> tuple[list[str], list[int], bool]:
    """Blocks of text in page order, the length of each that counts, and whether an article is marked.

    Of articles those in marked surroundings count if the others are empty. Where no article has text
    and all other text is marked, the lengths are those of the marked text, if it has a surge.
    Unclosed elements end with their parent; a page cut off in its middle gives the lines so far.
    """
    texts: list[str] = []
    lengths: list[int] = []
    skipped: list[int] = []
    inside: list[int] = []
    stack = Stack()
    skip, article, link = 0, 0, False
    words: list[str] = []
    linked = 0

    def close_block() -> None:
        nonlocal linked
        if words:
            text = _SPACE.sub(" ", html.unescape("".join(words))).strip()
            if text:
                texts.append(text)
                lengths.append(max(0, len(text) - linked) or (1 if article else 0))
                skipped.append(skip)
                inside.append(article)
            words.clear()
        linked = 0

    tags = Tags(page)
    at, end = 0, len(page)
    while at < end:
        tag = tags.after(at)
        if tag is None:
            rest = page[at:]
            # A tag that the end of the page cuts off is no text.
            words.append(rest[: rest.rindex("<")] if _CUT_TAG.search(rest, rest.rfind(">") + 1) else rest)
            break
        begin, stop, ends, name, attributes = tag
        if begin > at:
            chunk = page[at:begin]
            words.append(chunk)
            if link:
                linked += len(chunk.strip())
        at = stop
        if not name:
            continue
        if ends:
            depth = stack.place(name)
            if name not in _INLINE:
                close_block()
            elif name == "br":
                words.append(" ")
            # An inline end tag does not close the blocks around it.
            if depth >= 0 and (name not in _INLINE or stack.block() < depth):
                skip, article, link = stack.cut(depth)
            continue
        if name in _RAW:
            if name not in _INLINE:
                close_block()
            if not attributes.endswith("/"):
                closing = re.compile(rf"</{name}\b", re.I).search(page, at)
                stop = tags.close(closing.end()) if closing else -1
                at = stop if stop >= 0 else end
            continue
        if name not in _INLINE:
            close_block()
            block = stack.block()
            if block >= 0 and stack.open[block][0] == "p" and _CLOSES_P.match(name):
                skip, article, link = stack.cut(block)
        elif name == "br":
            words.append(" ")
        if name in _VOID or attributes.endswith("/"):
            continue
        if name in _ARTICLE:
            # Inside an article, what is marked stays out: comments are often articles, too.
            if not article and skip < CERTAIN:
                article, skip = 1 + skip, 0
        elif name in _SKIPPED and not (name == "header" and article):
            skip = CERTAIN
        elif name not in ("html", "body"):
            skip = max(skip, _marked(attributes, article > 0))
        link = link or name == "a"
        stack.push(name, skip, article, link)
    close_block()

    def of(why: int, kinds: tuple[int, ...]) -> list[int]:
        return [n if s <= why and i in kinds else 0 for n, s, i in zip(lengths, skipped, inside, strict=True)]

    for kind in (1, 2):
        own = of(0, (kind,))
        if any(own):
            return texts, own, True
    clear, guessed = of(0, (0,)), of(GUESSED, (0, 1, 2))
    if not any(clear) and max(_sums(guessed, WINDOW), default=0) > SURGE:
        return texts, guessed, False
    return texts, clear, False


def _sums(lengths: list[int], window: int) -> list[int]:
    """Sum of each line's window: itself and the lines around it."""
    half = window // 2
    total = [0]
    for n in lengths:
        total.append(total[-1] + n)
    return [total[min(i + half + 1, len(lengths))] - total[max(i - half, 0)] for i in range(len(lengths))]


def between_surges(texts: list[str], lengths: list[int], surge: int, window: int = WINDOW) -> list[str]:
    """The lines that count and lie between a surge and the dives around it.

    A line's window is itself and the lines around it, `window` in all. Windows that sum to nothing
    are dives and part the page into regions. A region with a sum above `surge` is text; if there is
    none, the one with the highest sum is.
    """
    sums = _sums(lengths, window)
    regions: list[tuple[int, list[str]]] = []
    highest, kept = 0, []
    for i, n in enumerate([*sums, 0]):
        if n:
            highest = max(highest, n)
            if lengths[i]:
                kept.append(texts[i])
        elif kept:
            regions.append((highest, kept))
            highest, kept = 0, []
    least = min(surge, max((h for h, _ in regions), default=0) - 1)
    return [text for h, own in regions if h > least for text in own]


def main_text(page: str, surge: int = SURGE, window: int = WINDOW) -> str:
    """Main text of a page, one block a line; empty if it has none."""
    texts, lengths, marked = lines(page)
    return "\n".join(between_surges(texts, lengths, 0 if marked else surge, window))


def extract(df: DataFrame, page: str = "html", surge: int = SURGE, window: int = WINDOW, to: str = "text") -> DataFrame:
    """`df` without the column `page` and with its main text in `to` and its code points in `n_chars`.

    Null and empty pages give an empty text. Columns of `df` called like the new ones are replaced;
    repeated rows stay.
    """
    for_workers(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    own = [f for f in df.schema.fields if f.name not in (page, to, "n_chars")]
    shape = to_arrow_schema(T.StructType([*own, T.StructField(to, T.StringType())]))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for low in range(0, frame.num_rows, 512):
                part = frame.slice(low, 512)
                texts = [main_text(p, surge, window) for p in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())], names=shape.names
                )

    picked = df.select(*[F.col(f"`{f.name}`") for f in own], text_or_empty(page).alias(to))
    out = picked.mapInArrow(run, T.StructType([*own, T.StructField(to, T.StringType())]))
    return out.withColumn("n_chars", F.char_length(to).cast("long"))
