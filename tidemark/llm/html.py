"""Main text of web pages, by wrappers inferred from the pages of the same host.

A page is a stream of text tokens, each with the path of its element. The streams of a host are
aligned into one union-free expression: runs and repeated groups of tokens fold into one piece, pieces that some
pages lack become optional, and a piece whose texts differ from page to page is a slot. Each task aligns
the pages it reads, and the expressions of all tasks are merged in a tree. All pages are then aligned with their host's
expression and the texts of its pieces counted, which makes it a wrapper; a page's article is the element that holds most
of the text in slots, with all that stands there. Pages are parsed once and their blocks stored.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from heapq import nsmallest
from itertools import groupby
from math import prod
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick
from tidemark.session import written

#: Distinct pages that an expression on its own remembers of a piece, those with the least hashes, whatever their order.
SAMPLE = 32
#: A piece is no slot if it has so many distinct pages and at most this share of so many of them, on average, differ in its text.
ALIKE_PAGES, ALIKE_SHARE, ALIKE_OF = 3, 0.5, 32
#: A text at an end of an article is the template's if the piece has so many pages, and this share of them, at least half, have it there.
TEMPLATE_PAGES, TEMPLATE_SHARE = 6, 0.5
#: Pieces of an expression before its paths are cut shorter, tokens of a repeated group, pieces a task holds,
#: and expressions that one task merges.
MOST_PIECES, LONGEST_GROUP, HELD_PIECES, FAN_IN = 256, 12, 50_000, 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<raw>script|style|textarea|title)\b.*?(?:</(?P=raw)\s*>|$)"
    # left out only where they end before another one begins; otherwise they are elements like others
    r"|<(?P<pair>template|svg|iframe|select)\b(?![^>]*/>)(?:(?!<(?P=pair)\b).)*?</(?P=pair)\s*>"
    r"|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)(?:>|[\"'][^>]*>)",
    re.S | re.I,
)
_ATTR = re.compile(r"(?P<key>[\w:-]+)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s\"'>]+)))?")
#: Fixed values of HTML: elements without content, and elements that stand within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split()
)
#: What can stand in a head; anything else ends it, as a head needs no end tag.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: An open element of the key ends where one of its values opens.
_ENDED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article blockquote pre header footer nav aside form hr main figure".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
#: Elements, roles and words in class or id of what surrounds an article.
_ASIDE_TAGS = frozenset("nav footer aside form button menu dialog fieldset noscript".split())
#: What surrounds an article even where it has most of a page's letters.
_NEVER_MOST = frozenset("nav footer".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal"
    " newsletter subscribe subscription signup login sidebar menu navigation nav navbar breadcrumb breadcrumbs topbar footer masthead comment comments"
    " disqus respond share sharing social related recommended widget widgets pagination pager toolbar alert overlay paywall skip".split()
)
#: What follows one of these words in a class tells of the page's layout, state or subject.
_MODIFIERS = frozenset("no not non has have with without is are tag tagged category cat topic hide hidden show".split())
_COMMENT_WORDS = frozenset("comment comments disqus respond".split())
#: Of these words, those that count inside an article too.
_INNER_WORDS = _COMMENT_WORDS | frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored".split())
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


@dataclass(slots=True)
class Element:
    """One element: ``up`` is the place of the element around it. ``aside``: it surrounds the article by its
    name or role; ``words``: those in its class or id that say so. ``story``: it is in an article or main element.
    """

    name: str
    path: str
    up: int = -1
    aside: bool = False
    words: frozenset[str] = frozenset()
    story: bool = False
    linked: bool = False


class Block(NamedTuple):
    """A run of text without a break. ``aside``: it surrounds the article; ``article``: it is in an article or main element."""

    path: str
    value: str
    aside: bool
    article: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m["key"].lower(): m["a"] or m["b"] or m["c"] or "" for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _is_aside(name: str, attrs: dict[str, str], within_article: bool) -> bool:
    if name in ("header", "noscript"):
        return not within_article
    return name in _ASIDE_TAGS or attrs.get("role", "").lower() in _ASIDE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"


def _aside_words(name: str, attrs: dict[str, str], within_article: bool) -> frozenset[str]:
    """The words in class and id of what surrounds an article, up to a modifier in each name; inside one, comments and adverts."""
    if name in ("html", "body"):
        return frozenset()
    found = set()
    for named in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        for w in map(str.lower, _WORDS.findall(named)):
            if w in _MODIFIERS:
                break
            if w in _ASIDE_WORDS:
                found.add(w)
    return frozenset(found & _INNER_WORDS if within_article else found)


def _set_aside(elements: list[Element], texts: list[tuple[int, str]]) -> list[bool]:
    """Which elements' texts surround the article.

    An element does not surround it that holds an article or main element with text, or most of the page's text
    outside links; a navigation or footer only counts by the former. The words of a class do not count for an
    article or main element, for the elements around the longest of these, and for those around most of the
    text, unless they name comments. If nothing else is left, the words do not count at all.
    """
    letters = [0] * len(elements)
    for place, value in texts:
        if not elements[place].linked:
            letters[place] += len(value.strip())
    for i in range(len(elements) - 1, 0, -1):
        letters[elements[i].up] += letters[i]

    def above(i: int) -> Iterator[int]:
        while i > 0:
            yield i
            i = elements[i].up

    stories = [i for i, e in enumerate(elements) if e.name in ("article", "main") and letters[i] and not any(elements[k].words & _COMMENT_WORDS for k in above(i))]
    around = {k for i in stories for k in above(i)}
    strong = [False] * len(elements)
    for i, e in enumerate(elements):
        own = e.aside and i not in around and (e.name in _NEVER_MOST or 2 * letters[i] <= letters[0])
        strong[i] = own or (e.up >= 0 and strong[e.up])
    if not any(e.words for e in elements):
        return strong
    kept = set(stories)
    if stories:
        kept.update(above(max(stories, key=lambda i: (letters[i], -i))))
    kept.update(i for i, e in enumerate(elements) if e.words and 2 * letters[i] > letters[0] and not any(elements[k].words & _COMMENT_WORDS for k in above(i)))
    weak = [False] * len(elements)
    for i, e in enumerate(elements):
        weak[i] = bool(e.words and i not in kept) or (e.up >= 0 and weak[e.up] and i not in kept)
    if all(strong[i] or weak[i] for i, value in texts if value.strip()):
        return strong
    return [s or w for s, w in zip(strong, weak, strict=True)]


def parsed(page: str) -> list[Block]:
    """The page's blocks in order, blank ones left out."""
    texts: list[tuple[int, str]] = []  # element, text
    news: list[bool] = []  # a block begins
    elements = [Element("", "")]
    places = [0]  # of the open elements
    stack = [elements[0]]
    new, last = True, 0
    unescape = html.unescape

    def leave_head() -> None:
        depth = next((i for i, e in enumerate(stack) if e.name == "head"), 0)
        if depth:
            del stack[depth:], places[depth:]

    def text(raw: str) -> None:
        nonlocal new
        value = unescape(raw) if "&" in raw else raw
        if stack[-1].name == "head" and value.strip():
            leave_head()
        texts.append((places[-1], value))
        news.append(new)
        new = False

    for m in _TOKEN.finditer(page):
        if last < m.start():
            text(page[last : m.start()])
        last = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            new = True
        if m["close"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                del stack[depth:], places[depth:]
            continue
        if name not in _IN_HEAD:
            leave_head()
        while len(stack) > 1 and name in _ENDED_BY.get(next((e.name for e in reversed(stack) if e.name not in INLINE), ""), ()):
            while stack[-1].name in INLINE:
                stack.pop(), places.pop()
            stack.pop(), places.pop()
        if name in ("article", "main"):  # a navigation that was never closed
            while len(stack) > 1 and stack[-1].name in ("nav", "header", "ul", "li", "a") and any(e.aside or e.words for e in stack):
                stack.pop(), places.pop()
        raw = m["attrs"]
        if name not in VOID and not raw.endswith("/") and not raw.rstrip().endswith("/"):
            up = stack[-1]
            attrs = _attributes(raw) if raw else {}
            path = up.path if name in INLINE else f"{up.path}/{'.'.join([name, *sorted(attrs.get('class', '').lower().split())])}"
            aside, words = _is_aside(name, attrs, up.story), _aside_words(name, attrs, up.story) if attrs else frozenset()
            stack.append(Element(name, path, places[-1], aside, words, up.story or name in ("article", "main"), up.linked or name == "a"))
            places.append(len(elements))
            elements.append(stack[-1])
    if last < len(page):
        text(page[last:])
    aside = _set_aside(elements, texts)
    blocks: list[Block] = []
    run: list[str] = []
    held: tuple | None = None  # path, aside and article of the open run
    for (place, value), fresh in zip(texts, news, strict=True):
        e = elements[place]
        key = (e.path, aside[place])
        if fresh or held is None or held[:2] != key:
            if held and (joined := " ".join("".join(run).split())):
                blocks.append(Block(held[0], joined, held[1], held[2]))
            run, held = [], (*key, e.story)
        run.append(value)
        held = (*key, held[2] or e.story)
    if held and (joined := " ".join("".join(run).split())):
        blocks.append(Block(held[0], joined, held[1], held[2]))
    return blocks


def hashed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1  # as a signed long


def page_hash(blocks: Sequence[Block]) -> int:
    return hashed("\0".join(f"{b.path}\0{b.value}" for b in blocks))


def piece_hashes(blocks: Sequence[Block]) -> tuple[int, int]:
    """The hashes of a piece's whole text and of its last one."""
    return hashed("\0".join(b.value for b in blocks)), hashed(blocks[-1].value)


def differing(sizes: Sequence[tuple[int, int]]) -> float:
    """Share of pages that differ in a text, on average over all choices of ALIKE_OF of them.

    ``sizes`` says for all pages how many texts there are that so many pages have: (pages, texts). The mean is exact, and
    means the same for a small host and a large one: the plain share of distinct texts falls as pages are added.
    """
    pages = sum(c * m for c, m in sizes)
    some = min(pages, ALIKE_OF)
    return sum(m * (1 - prod(max(pages - c - i, 0) / (pages - i) for i in range(some))) for c, m in sizes) / some


class Piece:
    """A piece of an expression: the ``key`` it is matched by, which is the path of its texts or the paths of a repeated group.

    ``pages`` have it, with ``letters`` of text altogether; on ``aside`` of them it surrounds the article, on ``leads`` it is the
    longest piece of the others. ``sample``
    holds its whole text and its last one, hashed, for the distinct pages with the least hashes; merging keeps it exact. It serves
    expressions that stand alone: wrappers of a table get the counts of all pages instead.
    """

    __slots__ = ("key", "pages", "letters", "aside", "leads", "sample", "limit")

    def __init__(self, key: tuple[str, ...]):
        self.key, self.pages, self.letters, self.aside, self.leads = key, 0, 0, 0, 0
        self.sample: dict[int, tuple[int, int]] = {}
        self.limit = 1 << 63  # no larger hash can get into the sample

    def add(self, page: int, blocks: Sequence[Block]) -> None:
        self.pages += 1
        self.letters += sum(len(b.value) for b in blocks)
        self.aside += all(b.aside for b in blocks)
        if page < self.limit:
            self.sample[page] = piece_hashes(blocks)
            self._cut()

    def _cut(self) -> None:
        if len(self.sample) > 2 * SAMPLE:
            self.sample = {page: self.sample[page] for page in nsmallest(SAMPLE, self.sample)}
            self.limit = max(self.sample)

    def merge(self, other: Piece) -> None:
        for name in ("pages", "letters", "aside", "leads"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.sample |= other.sample
        self.limit = 1 << 63
        self._cut()

    def least(self) -> dict[int, tuple[int, int]]:
        return {page: self.sample[page] for page in nsmallest(SAMPLE, self.sample)}

    def stored(self, sample: bool) -> list:
        return [self.key, self.pages, self.letters, self.aside, self.leads, [[page, *both] for page, both in self.least().items()] if sample else []]

    @classmethod
    def of(cls, stored: list) -> Piece:
        piece = cls(tuple(stored[0]))
        piece.pages, piece.letters, piece.aside, piece.leads = stored[1:5]
        piece.sample = {page: (value, tail) for page, value, tail in stored[5]}
        return piece

    def told(self, counted: Counted | None = None) -> Told:
        """What it says of a page. Its text differs from page to page in a slot; copies of a page count once."""
        if counted is None:
            known = list(self.least().values())
            values, tails = (Counter(own) for own in (zip(*known, strict=True) if known else ((), ())))
            counted = Counted(list(Counter(values.values()).items()), [(n, t) for t, n in tails.items()])
        n = sum(c * m for c, m in counted.sizes)
        slot = n < ALIKE_PAGES or differing(counted.sizes) > ALIKE_SHARE
        repeated = {t for c, t in counted.tails if n >= TEMPLATE_PAGES and c >= TEMPLATE_SHARE * n}
        return Told(self.key, self.pages, self.letters / self.pages, 2 * self.aside > self.pages, slot, 2 * self.leads > self.pages, frozenset(repeated))


class Counted(NamedTuple):
    """Of a piece's distinct pages: (pages, texts) with so many texts that so many pages have, and (pages, text) for last texts that are common."""

    sizes: list[tuple[int, int]]
    tails: list[tuple[int, int]]


class Told(NamedTuple):
    """A piece as pages are matched with it: usual letters, whether it is aside, a slot, the longest on most of
    its pages, and the texts that its pages repeat at its end.
    """

    key: tuple[str, ...]
    pages: int
    letters: float
    aside: bool
    slot: bool
    leads: bool
    tails: frozenset[int]


def shortened(path: str, depth: int) -> str:
    """A token's key: the path up to an article or main element, and up to the given depth."""
    signs = path.split("/")
    for i, sign in enumerate(signs):
        if sign.partition(".")[0] in ("article", "main"):
            signs = signs[: i + 1]
            break
    return "/".join(signs[: depth + 1])


def folded(keys: Sequence[str]) -> list[tuple[tuple[str, ...], int, int]]:
    """(key, start, end): the tokens with runs of one key as one piece, then neighbouring equal groups of pieces."""
    out, at = [], 0
    for key, run in groupby(keys):
        n = sum(1 for _ in run)
        out.append(((key,), at, at + n))
        at += n
    for size in range(2, LONGEST_GROUP + 1):
        if len(out) < 2 * size:
            break
        i, new = 0, []
        while i < len(out):
            group = [k for k, *_ in out[i : i + size]]
            times = 1
            while len(group) == size and all(len(k) == 1 for k in group) and [k for k, *_ in out[i + times * size : i + (times + 1) * size]] == group:
                times += 1
            if times > 1:
                last = i + times * size
                new.append((tuple(k[0] for k in group), out[i][1], out[last - 1][2]))
                i = last
            else:
                new.append(out[i])
                i += 1
        out = new
    return out


def shaped(blocks: Sequence[Block], pieces: Sequence[Piece | Told], depth: int) -> list[tuple[tuple[str, ...], int, int]]:
    """A page's tokens folded, single occurrences of the pieces' groups as groups too."""
    keys = {path: shortened(path, depth) for path in {b.path for b in blocks}}
    found = folded([keys[b.path] for b in blocks])
    for group in [p.key for p in pieces if len(p.key) > 1]:
        out, i = [], 0
        while i < len(found):
            part = found[i : i + len(group)]
            if len(part) == len(group) and all(k == (g,) for (k, *_), g in zip(part, group, strict=True)):
                out.append((group, part[0][1], part[-1][2]))
                i += len(group)
            else:
                out.append(found[i])
                i += 1
        found = out
    return found


def aligned(a: Sequence[tuple], b: Sequence[tuple]) -> list[tuple[int | None, int | None]]:
    """Pairs of places with equal keys, a longest common subsequence, and in between the places of one side alone."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(first)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append((first + i, first + j))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            out.append((first + i, None))
            i += 1
        else:
            out.append((None, first + j))
            j += 1
    return out + [(len(a) - last + k, len(b) - last + k) for k in range(last)]


class Expression:
    """The union-free expression of a host's pages: pieces in order, of which a page may lack some.

    Where pieces become too many, all paths are cut one element shorter, and neighbours that then agree become one.
    """

    def __init__(self, pieces: list[Piece] | None = None, depth: int = 1 << 16):
        self.pieces, self.depth = pieces or [], depth
        self.known: dict[tuple, list[Piece]] = {}  # the pieces of pages of one shape

    def add(self, blocks: Sequence[Block]) -> None:
        """Align a page with the expression; mismatches become optional pieces."""
        if not blocks:
            return
        page = page_hash(blocks)
        shape = shaped(blocks, self.pieces, self.depth)
        signature = tuple(k for k, *_ in shape)
        if signature not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            self.known[signature] = self._merged([Piece(k) for k in signature])
        longest, leader = 0, None
        for piece, (_, start, end) in zip(self.known[signature], shape, strict=True):
            piece.add(page, blocks[start:end])
            if (n := sum(len(b.value) for b in blocks[start:end] if not b.aside)) > longest:
                longest, leader = n, piece
        if leader is not None:
            leader.leads += 1
        self._bound()

    def _merged(self, others: list[Piece]) -> list[Piece]:
        """Merge pieces in order; the own pieces that they became part of."""
        pairs = aligned([p.key for p in self.pieces], [p.key for p in others])
        mine, theirs = self.pieces, []
        self.pieces = []
        for i, j in pairs:
            piece = mine[i] if i is not None else others[j]
            if i is not None and j is not None:
                piece.merge(others[j])
            if j is not None:
                theirs.append(piece)
            self.pieces.append(piece)
        return theirs

    def merge(self, other: Expression) -> None:
        depth = min(self.depth, other.depth)
        for e in (self, other):
            e._cut(depth)
        self._merged(other.pieces)
        self.known.clear()
        self._bound()

    def _bound(self) -> None:
        while len(self.pieces) > MOST_PIECES:
            self._cut(max(k.count("/") for p in self.pieces for k in p.key) - 1)

    def _cut(self, depth: int) -> None:
        if depth >= self.depth:
            return
        self.depth, self.known = depth, {}
        pieces: list[Piece] = []
        for p in self.pieces:
            short = tuple(k for k, _ in groupby(shortened(k, depth) for k in p.key))
            p.key = short if len(set(short)) > 1 else short[:1]
            if pieces and pieces[-1].key == p.key:
                pieces[-1].merge(p)
            else:
                pieces.append(p)
        self.pieces = pieces

    def stored(self, sample: bool = True) -> str:
        return json.dumps([self.depth, [p.stored(sample) for p in self.pieces]], separators=(",", ":"))

    @classmethod
    def of(cls, stored: str) -> Expression:
        depth, pieces = json.loads(stored)
        return cls([Piece.of(p) for p in pieces], depth)

    def wrapper(self, counted: dict[int, Counted] | None = None) -> str:
        """What extraction needs of it, stored; ``counted`` tells of all pages by the number of the piece."""
        told = [p.told() if counted is None else p.told(counted.get(i, Counted([], []))) for i, p in enumerate(self.pieces)]
        return json.dumps([self.depth, [[*t[:6], sorted(t.tails)] for t in told]], separators=(",", ":"))


class Wrapper:
    """A host's expression, ready to be matched with its pages."""

    def __init__(self, stored: str = "[65536,[]]"):
        depth, pieces = json.loads(stored)
        self.pieces = [Told(tuple(key), *rest, frozenset(tails)) for key, *rest, tails in pieces]
        self.depth = depth
        self.known: dict[tuple, list[int | None]] = {}

    def placed(self, blocks: Sequence[Block]) -> list[tuple[int | None, tuple[str, ...], int, int]]:
        """(number of the host's piece, key, start, end): the page's pieces; None where the host has no such piece there."""
        shape = shaped(blocks, self.pieces, self.depth)
        signature = tuple(k for k, *_ in shape)
        if signature not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            pairs = aligned([p.key for p in self.pieces], signature)
            self.known[signature] = [i for i, j in pairs if j is not None]
        return [(i, *part) for i, part in zip(self.known[signature], shape, strict=True)]

    def matched(self, blocks: Sequence[Block]) -> list[Told]:
        """The piece of each block; a piece of its own where the host's pages have none."""
        out = []
        for i, key, start, end in self.placed(blocks):
            if i is not None:
                piece = self.pieces[i]
            else:
                own = Piece(key)
                own.add(0, blocks[start:end])
                piece = own.told()
            out += [piece] * (end - start)
        return out


def within(path: str, element: str) -> bool:
    return f"{path}/".startswith(f"{element}/")


def prefixes(path: str) -> Iterator[str]:
    """The path and those of all elements around it."""
    yield path
    while path:
        path = path.rpartition("/")[0]
        yield path


def article_path(weights: dict[str, float]) -> str:
    """The element that has the article, by the letters in slots of each path."""
    varying: dict[str, float] = defaultdict(float)
    for path, letters in weights.items():
        for p in prefixes(path):
            varying[p] += letters
    total, path = varying.get("", 0), ""
    named = [p for p, n in varying.items() if p.rsplit("/", 1)[-1].split(".")[0] in ("article", "main") and 2 * n >= total]
    if named:
        return max(named, key=lambda p: (varying[p], p.rsplit("/", 1)[-1].startswith("article"), p.count("/"), p))
    inner: dict[str, list[str]] = defaultdict(list)
    for p in varying:
        if p and p.rsplit("/", 1)[-1].split(".")[0] in ("html", "body", "div", "section", "table", "tbody", "tr", "td", "center", "form", "fieldset"):
            inner[p.rsplit("/", 1)[0]].append(p)
    while True:  # into the element that has nearly all of the text
        most = [p for p in inner[path] if 10 * varying[p] >= 9 * varying[path]]
        if not most:
            return path
        path = max(most, key=lambda p: (varying[p], p))


_HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?$")


def article_of(blocks: Sequence[Block], wrapper: Wrapper | None) -> str:
    """The page's article: the element with most of the text in slots, as long as they are on the host's other pages.

    Whether a piece surrounds the article is what most pages say that have it. Of what stands in the article only texts at its
    ends go that most pages repeat there, and of these no heading before the text.
    """
    pieces = (wrapper or Wrapper()).matched(blocks)
    inside = [(b, p) for b, p in zip(blocks, pieces, strict=True) if not (p.aside if p.pages > 1 else b.aside)]
    if not inside:
        return ""
    size: dict[Told, int] = defaultdict(int)
    for b, p in inside:
        size[p] += len(b.value)
    varied = any(p.slot for p in size)
    counted = {p for p in size if p.slot or not varied}
    agreed = {p for p in counted if p.pages > 1}
    if 2 * sum(p.letters for p in agreed) >= sum(p.letters for p in counted):
        counted = agreed  # what only this page has does not say where the article stands
    usual = sum(p.leads for p in counted) < 2  # else the host has several layouts, and this page's own lengths tell which it has
    weights: dict[str, float] = defaultdict(float)
    for b, p in inside:
        if p in counted:
            weights[b.path] += (p.letters / size[p] if usual else 1) * len(b.value)
    path = article_path(weights)
    chosen = [(b, p) for b, p in inside if within(b.path, path)]
    if all(p.pages < 2 for _, p in chosen) and not any(b.article for b, _ in chosen):  # no other page agrees
        chosen = [(b, p) for b, p in inside if b.article] or chosen

    def template(b: Block, p: Told) -> bool:
        return hashed(b.value) in p.tails

    first, last = 0, len(chosen)
    while last > 1 and template(*chosen[last - 1]):
        last -= 1
    while first < last - 1 and not chosen[first][1].slot and template(*chosen[first]) and not _HEADING.search(chosen[first][0].path):
        first += 1
    return " ".join(b.value for b, _ in chosen[first:last])


def article_text(page: str | None, wrapper: Wrapper | None) -> str:
    return article_of(parsed(page), wrapper) if page else ""


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks) of each page, and (task, host, expression) of each task and host, in one pass.

    Rows of the second kind have an expression.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    block = "struct<path: string, value: string, aside: boolean, article: boolean>"
    schema = f"page_id {id_type}, url string, host string, blocks array<{block}>, task int, expression string"
    names = [f.split()[0] for f in ("page_id", "url", "host", "blocks", "task", "expression")]
    fields = pa.struct([("path", pa.string()), ("value", pa.string()), ("aside", pa.bool_()), ("article", pa.bool_())])

    def batch_of(ids: pa.Array, urls: pa.Array, hosts: list, blocks: list[list[Block]], expressions: list, task: int | None) -> pa.RecordBatch:
        flat = [b for own in blocks for b in own]
        offsets = [0]
        for own in blocks:
            offsets.append(offsets[-1] + len(own))
        columns = [pa.array(c, t.type) for c, t in zip(zip(*flat, strict=True) if flat else [()] * 4, fields, strict=True)]
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(fields)))
        return pa.RecordBatch.from_arrays(
            [ids, urls, pa.array(hosts, pa.string()), listed, pa.array([task] * len(hosts), pa.int32()), pa.array(expressions, pa.string())], names=names
        )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Expression] = {}
        task, kind = TaskContext.get().partitionId(), None

        def flushed() -> pa.RecordBatch:
            out = batch_of(pa.nulls(len(held), kind), pa.nulls(len(held), pa.string()), list(held), [[]] * len(held), [e.stored(sample=False) for e in held.values()], task)
            held.clear()
            return out

        for whole in batches:
            kind = whole.schema.field("page_id").type
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                hosts, blocks = batch.column("host").to_pylist(), []
                for host, page in zip(hosts, batch.column("html").to_pylist(), strict=True):
                    blocks.append(parsed(page) if page else [])
                    held.setdefault(host, Expression()).add(blocks[-1])
                yield batch_of(batch.column("page_id"), batch.column("url"), hosts, blocks, [None] * len(hosts), None)
                if sum(len(e.pieces) for e in held.values()) > HELD_PIECES:
                    yield flushed()
        if held:
            yield flushed()

    return pages.select("page_id", "url", "host", "html").mapInArrow(parse, schema)


def merged_expressions(parts: DataFrame, tasks: int) -> DataFrame:
    """(host, expression): the expressions of all hosts, those of all tasks being merged in rounds of a few at a time."""

    def merged(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("task").to_pylist(), table.column("expression").to_pylist(), strict=True))
        whole = Expression.of(rows[0][1])
        for _, stored in rows[1:]:
            whole.merge(Expression.of(stored))
        return pa.table({"task": pa.array([rows[0][0] // FAN_IN], pa.int32()), "host": table.column("host")[:1], "expression": [whole.stored(sample=False)]})

    last = False
    while not last:
        tasks = -(-tasks // FAN_IN)
        last = tasks <= 1
        grouped = parts.groupBy("host", F.expr(f"task div {FAN_IN}").alias("merged_task"))
        parts = grouped.applyInArrow(merged, "task int, host string, expression string")
    return parts.select("host", "expression")


def _blocks_of(batch: pa.RecordBatch) -> Iterator[list[Block]]:
    """The blocks of each row."""
    lists = batch.column("blocks")
    flat = lists.flatten()
    blocks = list(map(Block, *(flat.field(n).to_pylist() for n in Block._fields)))
    bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist() if len(lists) else [0]
    return (blocks[start:end] for start, end in zip(bounds, bounds[1:], strict=False))


def _kept(known: dict[str, Wrapper], stored: str | None, make: Callable[[str], str] = str) -> Wrapper | None:
    if stored is not None and stored not in known:
        if len(known) > 1000:
            known.clear()
        known[stored] = Wrapper(make(stored))
    return known.get(stored)


def counted_pieces(told: DataFrame) -> DataFrame:
    """(host, counted): for the pieces of each host how their texts repeat over all its distinct pages.

    ``told`` has the blocks of every page with its host's expression. A page gives one row of hashes, of equal pages one stays,
    and the rest is sums over hosts, pieces and texts: no task sees a host. At least half of the pages can only
    share the commonest last text, or the two commonest if these are equally common.
    """

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            pages, pieces = [], []
            for blocks, stored in zip(_blocks_of(batch), batch.column("expression").to_pylist(), strict=True):
                wrapper = _kept(known, stored, lambda e: Expression.of(e).wrapper({}))
                pages.append(page_hash(blocks))
                pieces.append([(i, *piece_hashes(blocks[start:end])) for i, _, start, end in wrapper.placed(blocks) if i is not None])
            listed = pa.array([[dict(zip(("piece", "value", "tail"), p, strict=True)) for p in own] for own in pieces], kind)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(pages, pa.int64()), listed], names=["host", "page", "pieces"])

    kind = pa.list_(pa.struct([("piece", pa.int32()), ("value", pa.int64()), ("tail", pa.int64())]))
    rows = told.where(F.size("blocks") > 0).select("host", "blocks", "expression")
    once = rows.mapInArrow(matched, "host string, page long, pieces array<struct<piece: int, value: long, tail: long>>").dropDuplicates(["host", "page"])
    texts = once.select("host", F.explode("pieces").alias("p")).select(
        "host", "p.piece", F.explode(F.array(F.struct(F.lit(False).alias("last"), F.col("p.value").alias("text")), F.struct(F.lit(True).alias("last"), F.col("p.tail").alias("text")))).alias("t")
    )
    per = texts.groupBy("host", "piece", "t.last", "t.text").agg(F.count(F.lit(1)).alias("pages"))
    sizes = per.groupBy("host", "piece", "last", "pages").agg(F.count(F.lit(1)).alias("texts"), F.min("text").alias("low"), F.max("text").alias("high"))
    pieces = sizes.groupBy("host", "piece").agg(
        F.collect_list(F.when(~F.col("last"), F.struct("pages", "texts"))).alias("sizes"),
        F.max(F.when(F.col("last"), F.struct("pages", "low", "high"))).alias("tail"),
    )
    return pieces.groupBy("host").agg(F.collect_list(F.struct("piece", "sizes", "tail")).alias("counted"))


def wrappers_of(expressions: DataFrame, counted: DataFrame) -> DataFrame:
    """(host, expression): the wrappers of all hosts, from their expressions and the counts of all their pages."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for stored, pieces in zip(batch.column("expression").to_pylist(), batch.column("counted").to_pylist(), strict=True):
                told = {}
                for p in pieces or []:
                    tail = p["tail"]
                    sizes = sorted((s["pages"], s["texts"]) for s in p["sizes"])
                    told[p["piece"]] = Counted(sizes, [(tail["pages"], t) for t in {tail["low"], tail["high"]}])
                out.append(Expression.of(stored).wrapper(told))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], names=["host", "expression"])

    return expressions.join(counted, "host", "left").mapInArrow(made, "host string, expression string")


def extract_articles(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row, from whole pages.

    Wrappers come from all pages of each host. A page whose url has no host belongs to the host ''. A null or empty
    page has the text ''. Where several elements may be the article alike, the first by path order counts. Repeated
    rows each get theirs; other columns are ignored. An empty table gives no rows.
    """
    pages = pick(df, page_id=id_col, url=url_col, html=html_col)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    pages = pages.withColumn("host", host)
    stored = written(parsed_pages(pages), "html_blocks")
    parts = stored.where("expression is not null").select("task", "host", "expression")
    # a small stored table is broadcast by the planner, a large one is joined by a shuffle
    told = stored.where("expression is null").select("page_id", "url", "host", "blocks")
    expressions = written(merged_expressions(parts, pages.rdd.getNumPartitions()), "html_expressions")
    wrappers = written(wrappers_of(expressions, counted_pieces(told.join(expressions, "host"))), "html_wrappers")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            wrappers = (_kept(known, stored) for stored in batch.column("expression").to_pylist())
            texts = [article_of(blocks, wrapper) for blocks, wrapper in zip(_blocks_of(batch), wrappers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return told.join(wrappers, "host", "left").select("page_id", "url", "blocks", "expression").mapInArrow(extracted, schema)
