"""Links of list pages by selectors: compiled once, matched while a page is parsed, given out as rows.

All selectors of a layout are one automaton.  An open element knows which parts of
which selectors its ancestors have matched, as two bit sets: those that any
descendant may go on from, and those that only a child may.  A new element is
tested against what its parent hands down, so a page is parsed once whatever
the number of selectors, and nothing is searched again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.html import _VOID, CHROME_TAGS

_COMPOUND = re.compile(r"(?P<tag>[a-zA-Z][\w-]*|\*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w:-]+)(?:(?P<op>[*^$~]?=)(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\]]*)))?\]")


@dataclass(frozen=True)
class Compound:
    """What one element must be: tag, id, classes, attributes."""

    tag: str = "*"
    ident: str = ""
    classes: frozenset[str] = frozenset()
    attributes: tuple[tuple[str, str, str], ...] = ()

    @classmethod
    def parse(cls, text: str) -> Compound:
        tag, ident, classes, attributes, at = "*", "", set(), [], 0
        while at < len(text):
            m = _COMPOUND.match(text, at)
            if m is None:
                raise ValueError(f"no selector: {text!r}")
            if m["tag"]:
                tag = m["tag"].lower()
            elif m["cls"]:
                classes.add(m["cls"])
            elif m["id"]:
                ident = m["id"]
            else:
                attributes.append((m["attr"].lower(), m["op"] or "", next((m[g] for g in ("dq", "sq", "bare") if m[g] is not None), "")))
            at = m.end()
        return cls(tag, ident, frozenset(classes), tuple(attributes))

    def fits(self, tag: str, attrs: dict[str, str], classes: set[str]) -> bool:
        if self.tag not in ("*", tag) or self.ident and attrs.get("id") != self.ident or not self.classes <= classes:
            return False
        for name, op, value in self.attributes:
            has = attrs.get(name)
            if has is None or not {"": True, "=": has == value, "*=": value in has, "^=": has.startswith(value), "$=": has.endswith(value), "~=": value in has.split()}[op]:
                return False
        return True


def _steps(alternative: str) -> list[tuple[bool, Compound]]:
    """(is a child of the one before, compound) from the outermost to the element itself."""
    parts = re.findall(r">|(?:\[[^\]]*\]|[^\s>])+", alternative)
    out, child = [], False
    for part in parts:
        if part == ">":
            if child or not out:
                raise ValueError(f"no selector: {alternative!r}")
            child = True
        else:
            out.append((child, Compound.parse(part)))
            child = False
    if child or not out:
        raise ValueError(f"no selector: {alternative!r}")
    return out


class Automaton:
    """Some selectors (each may be a list with commas) as one automaton over open elements."""

    def __init__(self, selectors: Sequence[str]):
        self.compounds: list[Compound] = []
        self.child: list[bool] = []  # whether what follows must be a child
        self.accepts: list[int] = []  # the selector that ends here, or -1
        self.start = 0
        for n, selector in enumerate(selectors):
            for alternative in re.split(r",(?![^\[]*\])", selector):
                steps = _steps(alternative)
                self.start |= 1 << len(self.compounds)
                for i, (_, compound) in enumerate(steps):
                    self.compounds.append(compound)
                    self.child.append(i + 1 < len(steps) and steps[i + 1][0])
                    self.accepts.append(n if i + 1 == len(steps) else -1)

    def enter(self, below: int, tag: str, attrs: dict[str, str], deep: int) -> tuple[int, int, set[int]]:
        """below: parts that the new element may match; deep: those of them that any descendant may.
        (what any descendant may match, what a child may match besides, the selectors that the element matches)."""
        classes, matched, children = set(attrs.get("class", "").split()), set(), 0
        i, rest = 0, below
        while rest:
            if rest & 1 and self.compounds[i].fits(tag, attrs, classes):
                if self.accepts[i] >= 0:
                    matched.add(self.accepts[i])
                elif self.child[i]:
                    children |= 1 << i + 1
                else:
                    deep |= 1 << i + 1
            rest >>= 1
            i += 1
        return deep, children, matched


@dataclass(frozen=True)
class Rule:
    """Where links are: elements that `links` select, in the order of these selectors, then of the page; or, with
    `card`, of each card the first element by the first of them that any matches.  up: the link is the element's
    parent or, without one there, an ancestor.  outside: elements in these tags don't count.  href: what an
    address must look like.  limit: links at most, 0 for all."""

    links: tuple[str, ...]
    card: str = ""
    up: bool = False
    outside: tuple[str, ...] = ()
    href: str = ""
    limit: int = 0


_ANY = Rule(("a[href]",), outside=CHROME_TAGS)


def _inside(root: str, **how) -> Rule:
    return Rule((f"{root} a[href]",), **how)


_PROSE = (Rule(("h2.hidden.font-heading",), up=True), _inside("main", outside=CHROME_TAGS), _ANY)
# Where the outlets' list pages keep their links, best first.
LISTS: dict[str, tuple[Rule, ...]] = {
    "sundaytimes": (Rule(("h2.entry_title a",), card="div.entry.loop-default.border_bottom_30"),),
    "dailynews": (Rule(("div > ul > li > article > div > div > h2 > a",), limit=100),),
    "ceylontoday": (Rule(("h3.entry-title a",), card="div.tdb_module_loop.td_module_wrap"),),
    "dailymirror": (Rule(("a[href*='/108-'] h3",), up=True), Rule(("a[href*='/108-']",))),
    "ftlk": (Rule(("h3.newsch",), card="div.lineg", up=True), Rule(("a[href*='/news/'], a[href*='/front-page/'], a[href*='/top-story/']",))),
    "economynext": (Rule(("h3.recent-top-header a", "h3 a", "a"), card=".story-grid-single-story"), Rule(("a[href]",), href=r"^(?:https://economynext\.com|/).*-\d+/?$")),
    "morning": _PROSE,
    "sundayobserver": _PROSE,
    "divaina": (Rule(("div > div > h2 > a",), limit=50), Rule(("a[href]",), href="/main-news/|/provincial-news/|/article/", limit=40)),
    "lankadeepa": (Rule(("section > div > article > a > h2", "section > div > article > div > a > h3"), up=True),),
    "aruna": (_inside("main", outside=CHROME_TAGS), _ANY),
    "mawbima": tuple(_inside(r, outside=CHROME_TAGS, href=r"^https://mawbima\.lk/\d{4}/\d{2}/\d{2}/") for r in (".td-ss-main-content", "main", ".td-main-content", "#main", "body")),
    "virakesari": (Rule(("section.group-news div.article-landing a.news-item", "section.group-news div.three-grid a.news-item")), Rule(("a.news-item",))),
    "thinakaran": (Rule(("h2.penci-entry-title a",), card="ul.penci-wrapper-data article"),),
    "thamilan": (Rule(("h2.hidden.font-heading",), up=True, limit=40), _inside("main", outside=CHROME_TAGS, href="/articles/", limit=40), _inside("body", outside=CHROME_TAGS, href="/articles/", limit=40)),
    "island": (Rule(("#mvp-cat-feat-wrap .mvp-widget-feat2-right a[href]", "ul.mvp-blog-story-list a[href]")),),
    "dinamina": (Rule(("ul li article h2 a, section article h2 a, ul section article h2 a",)),),
}


@dataclass
class _Element:
    tag: str
    href: str
    deep: int
    children: int
    cards: list[tuple[int, dict]] = field(default_factory=list)
    found: list[dict] = field(default_factory=list)


class Selecting(HTMLParser):
    """One parse of a page by some rules; found[r] are rule r's links: {pos, href, text, rank}."""

    def __init__(self, source: str, rules: Sequence[Rule], automaton: Automaton, of: Sequence[tuple[int, int]]):
        super().__init__(convert_charrefs=True)
        self.rules, self.automaton, self.of = rules, automaton, of
        self.stack: list[_Element] = []
        self.found: list[list[dict]] = [[] for _ in rules]
        self.count = 0
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in reversed(attrs)}
        above = self.stack[-1] if self.stack else None
        deep = above.deep if above else self.automaton.start
        deep, children, matched = self.automaton.enter(deep | (above.children if above else 0), tag, a, deep)
        here = _Element(tag, a.get("href", "") if tag == "a" else "", deep, children)
        for n in sorted(matched):
            r, rank = self.of[n]
            rule = self.rules[r]
            if rank < 0:
                here.cards.append((r, {"pos": self.count, "href": "", "text": [], "rank": len(rule.links)}))
                self.found[r].append(here.cards[-1][1])
                continue
            if rule.outside and any(e.tag in rule.outside for e in self.stack):
                continue
            href = next((e.href for e in reversed(self.stack) if e.href), "") if rule.up else here.href or a.get("href", "")
            href = href.strip()
            if not href or rule.href and not re.search(rule.href, href):
                continue
            link = {"pos": self.count, "href": href, "text": [], "rank": rank}
            if not rule.card:
                self.found[r].append(link)
                here.found.append(link)
            for e in self.stack if rule.card else ():
                for of, card in e.cards:
                    if of == r and rank < card["rank"]:
                        card.update(href=href, text=link["text"], rank=rank)
                        here.found.append(link)
        self.count += 1
        if tag not in _VOID:
            self.stack.append(here)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i].tag == tag), None)
        if at is not None:
            del self.stack[at:]

    def handle_data(self, data):
        if data.strip():
            for e in self.stack:
                for link in e.found:
                    link["text"].append(data.strip())


class Layout:
    """The rules of a list page, compiled."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules, selectors, self.of = tuple(rules), [], []
        for r, rule in enumerate(rules):
            for rank, selector in enumerate([rule.card, *rule.links] if rule.card else rule.links, -1 if rule.card else 0):
                selectors.append(selector)
                self.of.append((r, rank))
        self.automaton = Automaton(selectors)

    def links(self, page: str) -> tuple[int, list[dict]]:
        """(the first rule that has links, its links in order, each address once)."""
        parsed = Selecting(page, self.rules, self.automaton, self.of)
        for r, rule in enumerate(self.rules):
            listed, once = [x for x in parsed.found[r] if x["href"]], {}
            for link in sorted(listed, key=lambda x: x["pos"] if rule.card else (x["rank"], x["pos"])):
                once.setdefault(link["href"], link)
            if once:
                found = list(once.values())
                return r, found[: rule.limit] if rule.limit else found
        return 0, []


LINK_ROWS = "rule int, pos int, href string, text string"


def link_rows(rules: dict[str, Sequence[Rule]]):
    """A table function (html, layout) -> LINK_ROWS, by Arrow, of the layouts named: the links of the first rule
    that has any, numbered from 0.  A null page, and an unknown layout, have no rows.  It may be registered for SQL
    (spark.udtf.register) or joined laterally."""

    @F.udtf(returnType=LINK_ROWS, useArrow=True)
    class ListedLinks:
        def __init__(self):
            self._layouts: dict[str, Layout] = {}

        def eval(self, page: str, layout: str) -> Iterator[tuple]:
            if page is None or layout not in rules:
                return
            if layout not in self._layouts:
                self._layouts[layout] = Layout(rules[layout])
            rule, links = self._layouts[layout].links(page)
            for pos, link in enumerate(links):
                yield rule, pos, link["href"], " ".join(link["text"])

    return ListedLinks


def with_list_links(pages: DataFrame, page: str, layout: Column, rules: dict[str, Sequence[Rule]] | None = None) -> DataFrame:
    """pages with a row for each listed link (LINK_ROWS); pages without links are left out.  rules: the outlets' by default."""
    table = link_rows(LISTS if rules is None else rules)
    laid = pages.withColumn("_layout", layout)
    return laid.lateralJoin(table(F.col(page).outer(), F.col("_layout").outer())).drop("_layout")
