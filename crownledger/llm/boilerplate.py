"""Main text of web pages by line-block distribution.

A page's markup is stripped to lines: one per block of text (paragraph, heading, list item, cell and so on). What markup itself says
is no content - navigation, headers, footers, side columns, notices, adverts, forms, scripts, reader comments, hidden parts - becomes empty
lines, ``WINDOW`` of them where the page's structure changes, so that the distribution falls to zero there, and one for an advert or the like. Each line counts its characters outside links. Summed over
sliding windows of ``WINDOW`` lines, the text surges where a window holds more than ``SURGE`` characters and dives where one holds none. All
lines between are kept, short ones too. If a page says where its article is, only that article's lines are counted, and what
is cut out within it leaves no gap. A page without any surge keeps its heaviest run of lines.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import kind_of, schema

WINDOW = 3  # lines of a window
SURGE = 86  # characters in a window that begin a region

# An attribute's quotes may hold anything; a tag that is cut off is text
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?:!|\?)[^>]*+>|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")

# Elements by their role in a page
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg math".split())
DROPPED = frozenset(
    "nav footer aside form dialog menu search button select input textarea label fieldset iframe object embed applet canvas audio video "
    "head datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in class or id, alone or as parts of compounds such as cookie-notice
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu submenu breadcrumb "
    "breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal overlay banner newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations pagination "
    "pager toolbar masthead skip toc".split()
)
HEADER_WORDS = frozenset("header topbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies".split())
# An element that one of these ends although its own end is not written
CLOSES = {
    "li": ("li", frozenset("ul ol menu".split())),
    "dt": ("dt dd", frozenset(["dl"])),
    "dd": ("dt dd", frozenset(["dl"])),
    "tr": ("tr td th", frozenset(["table"])),
    "td": ("td th", frozenset("tr table".split())),
    "th": ("td th", frozenset("tr table".split())),
    "option": ("option", frozenset(["select"])),
}


class Node:
    """An open element: what it makes of the text in it."""

    __slots__ = ("name", "dropped", "article", "link")

    def __init__(self, name: str, dropped: int, article: int, link: bool):
        self.name, self.dropped, self.article, self.link = name, dropped, article, link


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def unwanted(name: str, given: str, inside: bool) -> bool:
    """Whether an element's name or attributes say that it is no part of the article."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not given or name in ("html", "body"):
        return False
    own = attributes(given)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", ""), re.IGNORECASE):
        return True
    if own.get("role", "").lower() in ROLES:
        return True
    spelled = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{own.get('class', '')} {own.get('id', '')}")
    spelled = re.sub(r"\b(?:has|with|without|no)[-_ ]?[a-z]+", "", spelled.lower())  # of a layout, not of a part
    found = set(re.split(r"[^a-z0-9]+", spelled))
    if name in ("article", "main", "h1"):
        return bool(found & COMMENT_WORDS)
    return bool(found & WORDS) or (bool(found & HEADER_WORDS) and not inside)


def ended(page: str) -> tuple[dict[int, int], list[int]]:
    """Start and end of the elements whose end is written, since others must not swallow the rest of a page; and starts of articles and titles."""
    out: dict[int, int] = {}
    waiting: dict[str, list[int]] = {}
    marks = []
    for m in TAG.finditer(page):
        if m[2]:
            name = m[2].lower()
            if m[1]:
                if waiting.get(name):
                    out[waiting[name].pop()] = m.start()
            elif name not in VOID:
                waiting.setdefault(name, []).append(m.start())
                if name in ("article", "main", "h1") and not unwanted(name, m[3], False):
                    marks.append(m.start())
    return out, marks


def lines(page: str) -> list[tuple[str, int, int, int]]:
    """(text, characters outside links, number of the article or 0, empty lines in its place) per block of the page, in order."""
    out: list[tuple[str, int, int, int]] = []
    stack: list[Node] = [Node("", 0, 0, False)]
    closed, marks = ended(page)
    endless: set[str] = set()
    parts: list[str] = []
    plain, articles, at = 0, 0, 0

    def flush(dropped: int = 0) -> None:
        nonlocal plain
        text = " ".join("".join(parts).split())
        if text or dropped:
            out.append((text, plain, stack[-1].article, dropped))
        parts.clear()
        plain = 0

    def add(text: str) -> None:
        nonlocal plain
        if text and not stack[-1].dropped:
            text = html.unescape(text)
            parts.append(text)
            if not stack[-1].link:
                plain += sum(map(len, text.split()))

    def pop(depth: int) -> None:
        """Closes the elements from ``depth`` on."""
        if any(n.name in BLOCKS for n in stack[depth:]):
            flush()
        was = stack[-1].dropped
        del stack[depth:]
        if was and not stack[-1].dropped:
            flush(was)

    while True:
        m = TAG.search(page, at)
        if m is None:
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    pop(depth)
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name in RAW and not m[3].rstrip().endswith("/"):
            end = None if name in endless else re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            if end or name in ("script", "style"):
                at = end.end() if end else len(page)
            else:
                endless.add(name)
            continue
        if name == "br":
            add("\n")
            continue
        if name in BLOCKS:
            while stack[-1].name == "p" or (stack[-1].name in ("h1", "h2", "h3", "h4", "h5", "h6") and name[0] == "h" and name[1:].isdigit()):
                pop(len(stack) - 1)
            p = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].name in BLOCKS), 0)
            if stack[p].name == "p":
                pop(p)  # inline elements that were left open end with their paragraph
            if name in CLOSES:
                ends, walls = CLOSES[name]
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name in walls:
                        break
                    if stack[depth].name in ends.split():
                        pop(depth)
                        break
            flush()
        if name in VOID or m[3].rstrip().endswith("/") and name not in BLOCKS:
            continue
        above = stack[-1]
        article = above.article
        if name in ("article", "main") and not above.dropped and not (article and name == "main"):
            if not article or name == "article":
                articles += 1
                article = articles if not above.article else above.article
        dropped = above.dropped or WINDOW * (name == "head")
        if not dropped and m.start() in closed and unwanted(name, m[3], bool(above.article)):
            # what its class or a form says does not count if the article or its title is inside
            n = bisect_right(marks, m.start())
            holds = n < len(marks) and marks[n] < closed[m.start()]
            structure = name in ("nav", "header", "footer", "aside", "dialog")
            dropped = (WINDOW if structure or name in DROPPED else 1) if structure or not holds else 0
        if name == "body":  # a head that was left open ends here
            dropped = 0
            del stack[1:]
        stack.append(Node(name, dropped, article, above.link or name == "a"))
    add(re.sub(r"<[a-zA-Z/!][^<>]*\Z", "", page[at:]))  # without a tag that is cut off
    flush()
    return out


def regions(sizes: list[int]) -> list[tuple[int, int]]:
    """[begin, end) of the runs of lines from each surge to the next dive; the heaviest run if none surges."""
    runs, begin = [], None
    for i, n in enumerate([*sizes, *[0] * WINDOW]):
        if n and begin is None:
            begin = i
        if begin is not None and not any(sizes[i : i + WINDOW]):
            runs.append((begin, i))
            begin = None
    surging = [(b, e) for b, e in runs if any(sum(sizes[i : i + WINDOW]) > SURGE for i in range(b, e))]
    return surging or sorted(runs, key=lambda r: (-sum(sizes[r[0] : r[1]]), r[0]))[:1]


def main_text(page: str) -> str:
    """The page's article: its blocks, joined by empty lines."""
    found = lines(page)
    mass: dict[int, int] = {}
    for _, n, article, _ in found:
        mass[article] = mass.get(article, 0) + n
    mass.pop(0, None)
    spread: list[tuple[str, int]] = []
    if mass:
        chosen = max(mass, key=lambda a: (mass[a], -a))
        # in an article links are text, too
        spread = [(text, len(text)) for text, _, article, dropped in found if article == chosen and not dropped]
    else:
        for text, n, _, dropped in found:
            spread += [("", 0)] * dropped if dropped else [(text, n)]
    kept = [spread[i][0] for b, e in regions([n for _, n in spread]) for i in range(b, e)]
    return "\n\n".join(t for t in kept if t)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every row; no shuffle, one page in memory at a time besides its batch."""
    rows = pages.select("page_id", "url", F.coalesce(F.col(page).cast("string"), F.lit("")).alias("page"))
    out = schema(page_id=kind_of(rows, "page_id"), url=kind_of(rows, "url"), text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p.as_py()) for p in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], out.names)

    return rows.mapInArrow(run, out)


def op12_boilerplate(pages: DataFrame) -> DataFrame:
    """The contract's columns per row of ``pages``: page_id, url, text, n_chars.

    Null and empty pages have the empty text, as has a page without content. Repeated rows give repeated results; an empty table gives none.
    """
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
