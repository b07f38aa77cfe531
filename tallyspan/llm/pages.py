"""HTML extraction by tag-path ratios.

A page's texts are its leaves, each with the path of tags from the root. Over each path
the length of its texts outside links and their punctuation are summed and divided by how
often the path occurs. These ratios are fused and brought between 0 and 1, and smoothed
along the page, as neighbouring leaves belong together. Walking from the root into the
branch that holds most text by score, until no branch holds enough, selects the content
node, and the paths below it that pass the threshold are the content.

Names say what ratios can't: a short paragraph of an article has less text than a long
notice. So a path through ``article``, ``main`` or the content node gets ``TERM`` more, and one
through an element that is no content by tag, role, class or id (menu, footer, sidebar,
notice, advert, form, comments) as much less. The threshold lies above the term: no path
is content by its names alone.

Pages are read by one scan that never goes back, and paths are numbers with a parent, so
time and memory grow with the page, however broken or deep its markup.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspan.llm.blocks import blocks
from tallyspan.llm.tables import extended

# Element names of HTML, and words that name parts beside the content.
HIDDEN = frozenset(
    "head title style script noscript template svg math canvas audio video object iframe "
    "select datalist button textarea input map".split())
RAW = "script|style|textarea|title|noscript|iframe|template|svg"
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
          "option": "option", "p": "p", "thead": "tr td th", "tbody": "tr td th thead",
          "tfoot": "tr td th tbody"}
ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS = HEADINGS | frozenset("p li td pre".split())  # blocks, which the walk does not enter
NOT_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot copyright sidebar "
    "aside widget toolbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended "
    "pagination pager comment comments commentlist disqus replies respond discussion form "
    "complementary contentinfo skip".split())
CONTENT = frozenset("article main".split())
SCOPES = frozenset("table button td th".split())  # a paragraph outside goes on
TERM, THRESHOLD = 0.5, 0.6  # of names, and of a path's score
# Characters a leaf, weighed by punctuation, that make half of the largest ratio; on pages of
# shorter texts, their mean does.
HALF = 40.0

_BLOCK_BYTES = 2_000_000
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:.-]{0,80})")
_PLAIN = re.compile(r"[^\"'>]*")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_POINT = re.compile(r"[.,;:!?…。，、！？।؟\"'()–—-]")


def tokens(page: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, tag, attributes, whether it is an end tag) of each piece of markup.

    Comments, declarations and the insides of scripts and the like have the tag ''. A quote
    that is never closed is a character like others, and a ``<`` that never ends is text.
    """
    at, size, quotes = 0, len(page), {'"': True, "'": True}
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield start, at, "", "", False
            continue
        found = _TAG.match(page, start)
        if found is None:
            if not page.startswith(("<!", "<?"), start):
                at = start + 1
                continue
            end = page.find(">", start)
            if end < 0:
                return
            at = end + 1
            yield start, at, "", "", False
            continue
        end = found.end()
        while True:  # to the tag's end, over quoted values
            end = _PLAIN.match(page, end).end()
            if end >= size or page[end] == ">":
                break
            close = page.find(page[end], end + 1) if quotes[page[end]] else -1
            if close < 0:
                quotes[page[end]] = False
            end = max(end, close) + 1
        if end >= size:  # no end outside quotes: from now on quotes mean nothing
            quotes = dict.fromkeys(quotes, False)
            end = page.find(">", found.end())
            if end < 0:
                return
        tag, rest, at = found[2].lower(), page[found.end():end], end + 1
        if tag in _RAW_END and not found[1] and not (tag == "svg" and rest.endswith("/")):
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else size
            yield start, at, "", "", False
        elif not (tag in ("svg", "math") and rest.endswith("/")):
            yield start, at, tag, rest, bool(found[1])
        else:
            yield start, at, "", "", False


class Paths:
    """Paths of a page by number, 0 the root; a path's number is above its parent's.

    ``out``: it or one above is no content by name; ``held``: it or one above is an article
    or main element; ``block``: a heading, paragraph and the like.
    """

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.parent, self.out, self.held, self.block = [0], [False], [False], [False]

    def below(self, up: int, tag: str, names: frozenset[str]) -> int:
        key = up, tag + "".join("." + n for n in sorted(names))
        if key not in self.known:
            self.known[key] = len(self.parent)
            self.parent.append(up)
            self.held.append(self.held[up] or tag in CONTENT or "main" in names)
            self.out.append(self.out[up] or tag in HIDDEN or tag in ASIDE or (
                tag not in ("html", "body", *CONTENT) and bool(names & NOT_CONTENT)))
            self.block.append(tag in ENDS)
        return self.known[key]


class _Open:
    """The open elements: (tag, path, place of the paragraph that a new block would end)."""

    def __init__(self, paths: Paths):
        self.paths, self.stack, self.count = paths, [("", 0, -1)], Counter()

    def push(self, tag: str, names: frozenset[str]) -> None:
        _, path, paragraph = self.stack[-1]
        paragraph = len(self.stack) if tag == "p" else -1 if tag in SCOPES else paragraph
        self.stack.append((tag, self.paths.below(path, tag, names), paragraph))
        self.count[tag] += 1

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            self.count[self.stack.pop()[0]] -= 1

    def close(self, tag: str) -> None:
        if self.count[tag]:
            size = len(self.stack) - 1
            while self.stack[size][0] != tag:
                size -= 1
            self.pop_to(size)


def leaves(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The paths, and (path, text, characters inside links) of each block of text, in page order."""
    paths = Paths()
    stack, found, texts, linked, links, at = _Open(paths), [], [], 0, 0, 0

    def flush() -> None:
        nonlocal texts, linked
        text = _SPACE.sub(" ", unescape("".join(texts))).strip() if texts else ""
        if text:
            found.append((stack.stack[-1][1], text, linked))
        texts, linked = [], 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            texts.append(text)
            linked += len(text) if links else 0

    for start, end, tag, rest, closes in tokens(page):
        take(page[at:start])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            links = max(0, links + (-1 if closes else 1)) if tag == "a" else links
            names = names_of(rest)
            if names & NOT_CONTENT and not closes:
                flush()
                stack.push(tag, names)
            elif closes and stack.stack[-1][0] == tag:
                flush()
                stack.pop_to(len(stack.stack) - 1)
            continue
        if tag == "br":
            texts.append("\n")
            continue
        if tag in ("img", "wbr", "input", "source", "track", "area", "col"):
            continue
        flush()
        links = 0
        if closes:
            stack.close(tag)
            continue
        if tag in ENDS_P and stack.stack[-1][2] >= 0:
            stack.pop_to(stack.stack[-1][2])
        ended = CLOSES.get(tag, "").split()
        while len(stack.stack) > 1 and stack.stack[-1][0] in ended:
            stack.pop_to(len(stack.stack) - 1)
        if tag not in VOID:
            stack.push(tag, names_of(rest))
    take(page[at:])
    flush()
    return paths, found


def names_of(attributes: str) -> frozenset[str]:
    """Words in the class, id and role of an element that say what it is."""
    if not attributes or "=" not in attributes:
        return frozenset()
    words = {w.lower() for x in _NAMES.findall(attributes) for w in _PARTS.findall(" ".join(x))}
    return frozenset(words & (NOT_CONTENT | CONTENT))


def path_ratios(found: list[tuple[int, str, int]], out: list[bool], spread: float = 1.0) -> dict[int, float]:
    """A ratio from 0 to 1 for each path: text and punctuation a leaf, without links, smoothed."""
    sums: dict[int, list[int]] = {}
    for path, text, linked in found:
        s = sums.setdefault(path, [0, 0, 0])
        s[0] += 1
        s[1] += len(text) - min(linked, len(text))
        s[2] += len(_POINT.findall(text))
    fused = {path: s[1] / s[0] * np.log2(2 + s[2] / s[0]) for path, s in sums.items()}
    row = np.array([0.0 if out[p] else fused[p] for p, _, _ in found])
    if row.any():
        row = row / (row + min(HALF, row.sum() / np.count_nonzero(row)))
    reach = np.exp(-0.5 * (np.arange(-2, 3) / spread) ** 2)
    near = np.convolve(np.pad(row, 2, "edge"), reach / reach.sum(), "valid") if len(row) else row
    total: dict[int, float] = {}
    for (path, _, _), x in zip(found, near.tolist(), strict=True):
        total[path] = total.get(path, 0.0) + x
    return {path: x / sums[path][0] for path, x in total.items()}


def _content_node(paths: Paths, found: list[tuple[int, str, int]], scores: dict[int, float], share: float) -> int:
    """The path reached from the root by going into the branch that holds more than ``share``.

    A leaf's weight is its text outside links times its path's score. The walk ends at the
    first article or main element, and above headings, paragraphs and the like.
    """
    weight = np.zeros(len(paths.parent))
    for path, text, linked in found:
        weight[path] += max(0.0, scores[path]) * (len(text) - min(linked, len(text)))
    weight, parent = weight.tolist(), paths.parent
    for path in range(len(parent) - 1, 0, -1):
        weight[parent[path]] += weight[path]
    best: dict[int, int] = {}
    for path in range(1, len(parent)):
        if not paths.block[path] and weight[path] > weight[best.get(parent[path], path)] * (
                parent[path] in best):
            best[parent[path]] = path
    root = 0
    while root in best and weight[best[root]] > share * weight[root]:
        root = best[root]
        if paths.held[root]:
            break
    return root


def extract(page: str | None, share: float = 0.5) -> list[str]:
    """The blocks of a page's main text, in page order.

    A path's score is its ratio and the terms of its names. Below the content node, the
    paths that come to ``THRESHOLD`` are kept, but for those outside articles that are
    mostly links; a page of names without ratios has no content.
    """
    paths, found = leaves(page or "")
    scores = {path: ratio + (-TERM if paths.out[path] else TERM if paths.held[path] else 0.0)
              for path, ratio in path_ratios(found, paths.out).items()}
    kept = [x for x in found if not paths.out[x[0]]]
    if not kept:
        return []
    root = _content_node(paths, kept, scores, share)
    inside = [False] * len(paths.parent)
    for path in range(len(inside)):
        inside[path] = path == root or (path > 0 and inside[paths.parent[path]])
    taken = []
    for path, text, linked in found:
        score = scores[path] + (0.0 if paths.held[path] or paths.out[path] else TERM)
        if inside[path] and score >= THRESHOLD and (
                paths.held[path] or min(linked, len(text)) <= 0.5 * len(text)):
            taken.append(text)
    return taken


def extract_pages(pages: DataFrame, column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``column`` and with the main text of each page in ``text``.

    Blocks are joined by a newline; within a block, white space is one space and
    character references are decoded. Null, empty and contentless pages give an empty
    text; broken markup is read as far as it goes; repeated rows are pages of their own;
    a column named ``text`` is replaced. Pages are independent: nothing is shuffled.
    """
    pages = pages.drop(text) if text != column else pages
    others = [c for c in pages.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column, _BLOCK_BYTES):
                found = ["\n".join(extract(x.as_py())) for x in part.column(column)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in others], pa.array(found, pa.string())], [*others, text])

    return pages.mapInArrow(run, extended(pages, f"`{text}` string", without=(column,)))
