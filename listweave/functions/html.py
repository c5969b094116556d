"""HTML functions: block-aware text, list items, visible text, selectors, links, JSON-LD, sections.

The only functions of the engine that run in Python, over Arrow batches, on the standard library's
parser.  A page is parsed to a small tree once per function.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from listweave.shipping import ship
from pyspark.sql import SparkSession

# Tags that begin a line, tags whose text does not count, tags without an end.
BLOCKS = frozenset(
    "address article blockquote dd div dl dt figcaption figure footer header h1 h2 h3 h4 h5 h6 li main ol p pre section table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.kids, self.parent = tag, attrs, [], parent

    def walk(self):
        """This element and all below it, in page order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(k for k in reversed(node.kids) if isinstance(k, Node))

    def find_all(self, selector: str) -> list[Node]:
        chain = [parse_step(s) for s in selector.split()]
        return [n for n in self.walk() if n.tag != "#root" and _matches_chain(n, chain)]

    def find(self, selector: str) -> Node | None:
        found = self.find_all(selector)
        return found[0] if found else None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(page: str | None) -> Node:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.root


_STEP = re.compile(r"^([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[^\]]+\])*)$")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\]")


def parse_step(step: str) -> tuple[str | None, list[tuple[str, str | None]]]:
    """``tag#id.class[attr=value]`` as (tag, [(attribute, value)])."""
    m = _STEP.match(step)
    if not m:
        raise ValueError(f"selector not understood: {step}")
    wanted = []
    for kind, name, attr, value in _PART.findall(m[2] or ""):
        if kind:
            wanted.append(("class" if kind == "." else "id", name))
        else:
            wanted.append((attr.lower(), value or None))
    return (None if m[1] in (None, "*") else m[1].lower()), wanted


def _matches(node: Node, step: tuple) -> bool:
    tag, wanted = step
    if tag and node.tag != tag:
        return False
    for name, value in wanted:
        have = node.attrs.get(name)
        if have is None or (name == "class" and value not in have.split()) or (name != "class" and value is not None and have != value):
            return False
    return True


def _matches_chain(node: Node, chain: list) -> bool:
    if not _matches(node, chain[-1]):
        return False
    up, left = node.parent, len(chain) - 2
    while left >= 0 and up is not None:
        if up.tag != "#root" and _matches(up, chain[left]):
            left -= 1
        up = up.parent
    return left < 0


_INVISIBLE = re.compile("[​‌‍﻿]")
_PUNCTUATION = re.compile(r"\s+([,.;:!?%])")


def tidy(value: Any) -> str | None:
    """Lines collapsed and trimmed, without blanks and repeated neighbours; None if nothing is left."""
    if value is None:
        return None
    out: list[str] = []
    for line in _INVISIBLE.sub("", str(value).replace(" ", " ")).splitlines():
        line = _PUNCTUATION.sub(r"\1", re.sub(r"[\t\r\f\v ]+", " ", line).strip())
        if line and line != (out[-1] if out else None):
            out.append(line)
    return "\n".join(out) or None


def unique(values) -> list[str]:
    """Tidied values, each once whatever its case."""
    out: dict[str, str] = {}
    for v in values:
        t = tidy(v)
        if t:
            out.setdefault(t.casefold(), t)
    return list(out.values())


def text_of(node: Node | None) -> str | None:
    """Text of an element: inline parts joined by spaces, a line for each block and each ``br``."""
    if node is None:
        return None
    lines: list[str] = []
    inline: list[str] = []

    def end_line() -> None:
        if inline:
            lines.append(" ".join(inline))
            inline.clear()

    # an explicit stack: (item, None) to visit, (None, tag) to close
    todo: list[tuple[Any, str | None]] = [(node, None)]
    while todo:
        item, closing = todo.pop()
        if closing is not None:
            end_line()
        elif isinstance(item, str):
            words = " ".join(_INVISIBLE.sub("", item.replace(" ", " ")).split())
            if words:
                inline.append(words)
        elif item.tag == "br":
            end_line()
        elif item.tag not in SILENT:
            if item.tag in BLOCKS:
                end_line()
                todo.append((None, item.tag))
            todo.extend((k, None) for k in reversed(item.kids))
    end_line()
    return tidy("\n".join(lines))


def items_of(node: Node) -> list[str]:
    """Texts of list items, else the lines of the text."""
    return unique(text_of(n) for n in node.find_all("li")) or unique((text_of(node) or "").splitlines())


def visible_of(node: Node) -> str:
    parts = []
    todo: list[Any] = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            words = " ".join(item.split())
            if words:
                parts.append(words)
        elif item.tag not in ("script", "style"):
            todo.extend(reversed(item.kids))
    return " ".join(parts)


def sections_of(node: Node, heading: str = "h2") -> dict[str, str]:
    """Heading text to the text of what follows it up to the next heading of its rank, among siblings."""
    out: dict[str, str] = {}
    for h in node.find_all(heading):
        siblings = h.parent.kids if h.parent else []
        at = next(i for i, k in enumerate(siblings) if k is h)
        body = Node("div", {}, None)
        for k in siblings[at + 1 :]:
            if isinstance(k, Node) and k.tag in HEADINGS and k.tag <= h.tag:
                break
            body.kids.append(k)
        name, text = text_of(h), text_of(body)
        if name and text:
            out.setdefault(name, text)
    return out


def json_ld(node: Node) -> list[dict]:
    """All objects of JSON-LD scripts, with lists and graphs unfolded; malformed scripts are skipped."""
    out: list[dict] = []
    for script in node.find_all("script[type=application/ld+json]"):
        try:
            todo = [json.loads("".join(k for k in script.kids if isinstance(k, str)))]
        except ValueError:
            continue
        while todo:
            value = todo.pop(0)
            if isinstance(value, list):
                todo[:0] = value
            elif isinstance(value, dict):
                if isinstance(value.get("@graph"), list):
                    todo[:0] = value["@graph"]
                else:
                    out.append(value)
    return out


def posting_of(objects: list[dict]) -> dict | None:
    """The job posting among JSON-LD objects: by type, else the first with title and description."""
    for o in objects:
        kind = o.get("@type")
        if "JobPosting" in (kind if isinstance(kind, list) else [kind]):
            return o
    return next((o for o in objects if o.get("title") and o.get("description")), None)


def posting_identifier(posting: dict) -> str | None:
    ident = posting.get("identifier")
    return tidy(ident.get("value") or ident.get("name")) if isinstance(ident, dict) else tidy(ident)


def posting_locations(posting: dict) -> list[str]:
    places = posting.get("jobLocation")
    out = []
    for place in places if isinstance(places, list) else [places]:
        address = place.get("address") if isinstance(place, dict) else None
        if isinstance(address, str):
            out.append(address)
        elif isinstance(address, dict):
            country = address.get("addressCountry")
            country = country.get("name") if isinstance(country, dict) else country
            named = [address.get(k) for k in ("streetAddress", "addressLocality", "addressRegion")] + [country]
            out.append(", ".join(unique(x for x in named if isinstance(x, str))))
    return unique(out)


def item_list_urls(value: Any) -> list[str]:
    """URLs of every ItemList found anywhere in a JSON value, in order."""
    out: list[str] = []
    todo = [value]
    while todo:
        v = todo.pop(0)
        if isinstance(v, list):
            todo[:0] = v
        elif isinstance(v, dict):
            if v.get("@type") == "ItemList":
                for e in v.get("itemListElement") or []:
                    item = e.get("item") if isinstance(e, dict) else None
                    url = (e.get("url") or (item.get("url") or item.get("@id") if isinstance(item, dict) else item)) if isinstance(e, dict) else e
                    if isinstance(url, str):
                        out.append(url)
            todo[:0] = list(v.values())
    return list(dict.fromkeys(out))


def _sent() -> None:
    session = SparkSession.getActiveSession()
    if session is not None:
        ship(session)


def _mapped(function, kind: str):
    """A Column function that applies ``function`` to the parsed page of each row; null stays null."""

    def build(column: Column | str) -> Column:
        _sent()

        @F.pandas_udf(kind)
        def run(pages: pd.Series) -> pd.Series:
            return pages.map(lambda p: None if p is None else function(parse(p)))

        return run(F.col(column) if isinstance(column, str) else column)

    return build


html_text = _mapped(text_of, "string")
html_items = _mapped(items_of, "array<string>")
visible_text = _mapped(visible_of, "string")
html_links = _mapped(lambda n: list(dict.fromkeys(a.attrs["href"] for a in n.find_all("a") if a.attrs.get("href"))), "array<string>")
html_posting = _mapped(lambda n: json.dumps(posting_of(json_ld(n)), ensure_ascii=False, sort_keys=True) if posting_of(json_ld(n)) else None, "string")
html_sections = _mapped(lambda n: sections_of(n), "map<string,string>")
html_title = _mapped(lambda n: text_of(n.find("h1")) or text_of(n.find("title")), "string")


def has_selector(column: Column | str, selector: str) -> Column:
    for step in selector.split():
        parse_step(step)  # a malformed selector fails here, not on an executor
    return _mapped(lambda n: bool(n.find_all(selector)), "boolean")(column)
