"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page.

A page becomes a sequence of blocks, the stretches of text between block-level tags.  Each block is
described by its tag path (tags, classes and ids of the open elements, hashed), its words (hashed) and
a few measures; the network reads the sequence in both directions and labels every block as main
text or not, so a block's label rests on the whole page.  The network is plain numpy, for training as
for use.  It is trained on pages made up here, of many layouts, with invented words, so it learns
structure and no vocabulary; training is seeded and takes some seconds, once a process.
"""

from __future__ import annotations

import bisect
import functools
import html
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import map_rows

#: Hashed dimensions of tag paths and of words; measures besides; units of each direction.
PATH_DIMS, WORD_DIMS, MEASURES, UNITS = 96, 16, 6, 24
#: Padded blocks that the network reads at a time.
BATCH_BLOCKS = 8192

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select annotation annotation-xml".split())
TO_THE_END = frozenset("script style textarea title".split())
FOREIGN = frozenset("svg annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q s samp small span strike strong sub sup time tt u var "
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table nav aside article section main div body header footer form".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[\"'>]")
_CLOSING = re.compile(rf"</({'|'.join(sorted(RAW, key=len, reverse=True))})(?=[\s/>])[^<>]*>", re.I)
#: Open elements at either end of a path that describe a block; of deeper ones those between are left.
PATH_ENDS = 32
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_BYTE_HASH = np.random.default_rng(3).integers(0, 1 << 32, 256, dtype=np.uint32)
_BYTE_HASH[32] = 0
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden|aria-hidden\s*=\s*[\"']?true)", re.I)


@functools.lru_cache(200_000)
def _slot(token: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
    return h % dims, 1.0 if h & (1 << 20) else -1.0


@functools.lru_cache(20_000)
def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    names = [t for m in _NAMES.finditer(attributes) for t in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
    hidden = ["hidden"] if _HIDDEN.search(attributes) else []
    return (f"<{tag}", *(f".{t}" for t in names + hidden))


@functools.lru_cache(20_000)
def _path_vector(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    out = np.zeros(PATH_DIMS, np.float32)
    for token in {t for tokens in path for t in tokens}:
        i, sign = _slot(token, PATH_DIMS)
        out[i] += sign
    for token in path[-1] if path else ():
        i, sign = _slot("leaf" + token, PATH_DIMS)
        out[i] += sign
    return out


@dataclass
class Leaf:
    text: str
    path: tuple[tuple[str, ...], ...]
    link: float
    depth: int = 0


class Scanner:
    """The markup of a page from front to back, in time linear in the page whatever it holds.

    A tag ends at the first > that no quote holds, or at the first of all if a quote is not closed.
    When looking for ends in vain has taken several times the page, quotes hold nothing any more.  A tag
    that nothing ends, at the end of the page, is dropped, as browsers do.
    """

    def __init__(self, page: str):
        self.page, self.last_end, self.patience = page, page.rfind(">"), 4 * len(page)
        self.closings: dict[str, list[tuple[int, int]]] | None = None

    def tag_end(self, at: int) -> int:
        """Place of the > that ends the tag whose name ends at ``at``; one is there."""
        page, first = self.page, at
        while self.patience > 0:
            m = _STOP.search(page, at)
            if m is not None and m[0] == ">":
                return m.start()
            at = page.find(m[0], m.end()) + 1 if m is not None else 0
            if not at:
                self.patience -= len(page) - first
                break
        return page.find(">", first)

    def marks(self) -> Iterator[tuple[str, str, bool, str, int, int]]:
        """(text before, tag, whether it closes, attributes, start, end) of each mark; the last has no tag.

        ``send`` a place to go on from there.
        """
        page, at, size = self.page, 0, len(self.page)
        begun = 0
        while True:
            start = page.find("<", at)
            if start < 0:
                yield page[begun:], "", False, "", size, size
                return
            lead = page[start + 1 : start + 2]
            closes = lead == "/"
            name = _NAME.match(page, start + 1 + closes)
            if name is not None:
                if self.last_end < name.end():
                    yield page[begun:start], "", False, "", size, size
                    return
                end = self.tag_end(name.end())
                tag, attributes = name[0].lower(), page[name.end() : end]
            elif lead in ("!", "?", "/"):
                last = "-->" if page.startswith("<!--", start) else ">"
                found = page.find(last, start + 4 if last == "-->" else start)
                if found < 0:
                    yield page[begun:start], "", False, "", size, size
                    return
                tag, attributes, end = "", "", found + len(last) - 1
            else:
                at = start + 1
                continue
            moved = yield page[begun:start], tag, closes, attributes, start, end + 1
            at = begun = end + 1 if moved is None else moved
            if moved is not None:
                yield "", "", False, "", at, at

    def after_raw(self, tag: str, at: int) -> int | None:
        """Where the closing tag of a raw element ends, which begins at ``at``; None without one."""
        if self.closings is None:
            self.closings = {}
            for m in _CLOSING.finditer(self.page):
                self.closings.setdefault(m[1].lower(), []).append(m.span())
        found = self.closings.get(tag, [])
        i = bisect.bisect_left(found, (at, 0))
        return found[i][1] if i < len(found) else None


class Stack:
    """Open elements, with the places of each tag and of scopes, so that no step walks down the stack."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.tokens: list[tuple[str, ...]] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = [-1]

    def push(self, tag: str, tokens: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in SCOPES:
            self.scopes.append(len(self.tags))
        self.tags.append(tag)
        self.tokens.append(tokens)

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def cut(self, at: int) -> None:
        """Close everything from place ``at`` on."""
        for i in range(len(self.tags) - 1, at - 1, -1):
            self.places[self.tags[i]].pop()
            if self.scopes[-1] == i:
                self.scopes.pop()
        del self.tags[at:], self.tokens[at:]

    def path(self) -> tuple[tuple[str, ...], ...]:
        t = self.tokens
        return tuple(t) if len(t) <= 2 * PATH_ENDS else (*t[:PATH_ENDS], *t[-PATH_ENDS:])


def leaves(page: str) -> list[Leaf]:
    """The blocks of text of a page in page order.

    Comments, scripts, styles, titles and other raw elements hold no text; unclosed elements close as
    browsers close them; character references are decoded and white space becomes one space.  Formulas
    and objects are text of their block.  Time is linear in the page.
    """
    out: list[Leaf] = []
    stack = Stack()
    held: list[str] = []
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal held, linked
        if held:
            raw = "".join(held)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Leaf(text, stack.path(), min(1.0, linked / len(text)), len(stack.tags)))
            held, linked = [], 0

    scanner = Scanner(page)
    marks = scanner.marks()
    for before, tag, closes, attributes, start, end in marks:
        if before:
            held.append(before)
            if in_link:
                linked += len(before)
        if not tag:
            continue
        if closes:
            if tag in INLINE:
                in_link = in_link and tag != "a"
                continue
            flush()
            at = stack.last(tag)
            if at >= 0 and (tag != "p" or at > stack.scopes[-1]):
                stack.cut(at)
            continue
        if tag in RAW:
            if not (tag in FOREIGN and attributes.endswith("/")):
                after = scanner.after_raw(tag, end)
                if after is not None:
                    marks.send(after)
                elif tag in TO_THE_END:
                    break
            continue
        if tag in INLINE:
            in_link = in_link or tag == "a"
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P and stack.last("p") > stack.scopes[-1]:
            stack.cut(stack.last("p"))
        same = max((stack.last(t) for t in SAME_CLOSES.get(tag, ())), default=-1)
        if same > stack.scopes[-1]:
            stack.cut(same)
        stack.push(tag, _tokens(tag, attributes))
    flush()
    return out


def describe(blocks: list[Leaf]) -> np.ndarray:
    """(blocks, dimensions) of a page: path, hashed words, measures."""
    out = np.zeros((len(blocks), PATH_DIMS + WORD_DIMS + MEASURES), np.float32)
    for row, b in zip(out, blocks, strict=True):
        row[:PATH_DIMS] = _path_vector(b.path)
        words = b.text.count(" ") + 1
        stops = b.text.count(".") + b.text.count(",")
        row[-MEASURES:] = (math.log1p(len(b.text)) / 5, b.link, stops / (words + 1), words < 4, b.depth / 8, b.text[-1] in ".!?")
    out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = word_vectors([b.text for b in blocks])
    return out


def word_vectors(texts: list[str]) -> np.ndarray:
    """Unit vector of each text: its words hashed into signed dimensions, all texts at once.

    A word's hash sums random numbers of its bytes, so it costs a table lookup a byte.
    """
    out = np.zeros((len(texts), WORD_DIMS), np.float32)
    data = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass") + b" ", np.uint8)
    if not texts:
        return out
    starts = np.flatnonzero(np.concatenate([[True], data[:-1] == 32]))
    h = np.add.reduceat(_BYTE_HASH[data], starts, dtype=np.uint32)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    per = np.array([t.count(" ") + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), per)
    sign = np.where(h & np.uint32(1 << 20), 1.0, -1.0)
    flat = np.bincount(text * WORD_DIMS + (h >> np.uint32(8)) % WORD_DIMS, sign, len(texts) * WORD_DIMS)
    out[:] = flat.reshape(len(texts), WORD_DIMS)
    return out / np.maximum(1, np.sqrt((out * out).sum(1, keepdims=True)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """Two LSTMs, one for each direction, and a logistic layer over both of their states."""

    def __init__(self, dims: int, units: int, seed: int):
        rng = np.random.default_rng(seed)
        self.units = units
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 1 / np.sqrt(dims), (dims, 4 * units)).astype(np.float32)
            self.p["h" + d] = rng.normal(0, 1 / np.sqrt(units), (units, 4 * units)).astype(np.float32)
            bias = np.zeros(4 * units, np.float32)
            bias[units : 2 * units] = 1
            self.p["c" + d] = bias
        self.p["o"] = rng.normal(0, 1 / np.sqrt(2 * units), 2 * units).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction; x (steps, pages, dims), mask (steps, pages)."""
        u, steps = self.units, len(x)
        z_in = (x.reshape(-1, x.shape[2]) @ self.p["x" + d] + self.p["c" + d]).reshape(steps, x.shape[1], 4 * u)
        h = np.zeros((x.shape[1], u), np.float32)
        c = h.copy()
        out = np.zeros((steps, x.shape[1], u), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_in[t] + h @ self.p["h" + d]
            gates = _sigmoid(z[:, : 3 * u])
            i, f, o = gates[:, :u], gates[:, u : 2 * u], gates[:, 2 * u :]
            g = np.tanh(z[:, 3 * u :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            if m.all():
                c, h = new_c, o * tc
            else:
                c, h = np.where(m, new_c, c), np.where(m, o * tc, h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        states = []
        for d in "fb":
            kept: list | None = [] if keep is not None else None
            states.append(self._run(x, mask, d, kept))
            if keep is not None:
                keep[d] = kept
        both = np.concatenate(states, 2)
        if keep is not None:
            keep["both"] = both
        return both @ self.p["o"] + self.p["ob"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over real blocks and its gradients, through time."""
        keep: dict = {}
        p = _sigmoid(self.logits(x, mask, keep))
        n = max(1, int(mask.sum()))
        loss = float(-(np.where(mask, np.log(np.where(y, p, 1 - p) + 1e-7), 0)).sum() / n)
        dl = (np.where(mask, p - y, 0) / n).astype(np.float32)
        grads = {"o": np.einsum("tp,tpu->u", dl, keep["both"]), "ob": np.array([dl.sum()], np.float32)}
        u = self.units
        for k, d in enumerate("fb"):
            out_w = self.p["o"][k * u : (k + 1) * u]
            dh = np.zeros((x.shape[1], u), np.float32)
            dc = dh.copy()
            gx, gh, gc = (np.zeros_like(self.p[name + d]) for name in "xhc")
            for t, h0, c0, i, f, o, g, tc, m in reversed(keep[d]):
                dh = dh + dl[t][:, None] * out_w
                live = np.where(m, dh, 0)
                dcell = np.where(m, dc, 0) + live * o * (1 - tc * tc)
                dz = np.concatenate([dcell * g * i * (1 - i), dcell * c0 * f * (1 - f), live * tc * o * (1 - o), dcell * i * (1 - g * g)], 1)
                gx += x[t].T @ dz
                gh += h0.T @ dz
                gc += dz.sum(0)
                dh = np.where(m, dz @ self.p["h" + d].T, dh)
                dc = np.where(m, dcell * f, dc)
            grads |= {"x" + d: gx, "h" + d: gh, "c" + d: gc}
        return loss, grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j] = p
        mask[: len(p), j] = True
    return x, mask


def label(network: Network, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of main text for each block of each page; pages of like length run together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= BATCH_BLOCKS:
            end += 1
        group = order[at:end]
        p = _sigmoid(network.logits(*padded([pages[i] for i in group])))
        for j, i in enumerate(group):
            out[i] = p[: len(pages[i]), j]
        at = end
    return out


class PageMaker:
    """Pages of invented words in many layouts, with the truth of each block marked."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, *choices: str) -> str:
        return choices[int(self.rng.integers(len(choices)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        letters = np.array(list("aeioutnrshldcméüñç"))
        n = int(self.rng.integers(low, high + 1))
        return " ".join("".join(self.rng.choice(letters, int(self.rng.integers(1, 10)))) for _ in range(n))

    def prose(self, sentences: int) -> str:
        return " ".join(self.words(3, 14).capitalize() + self.pick(".", ".", ".", "!", "?") for _ in range(sentences))

    def link(self, text: str) -> str:
        return f'<a href="/x">{text}</a>'

    def menu(self) -> str:
        items = [self.link(self.words(1, 2)) for _ in range(int(self.rng.integers(2, 9)))]
        if self.chance(0.3):
            return self.pick('<div class="menu">', '<div id="navigation">', '<div class="topnav">', '<div class="breadcrumbs">') + self.pick(" | ", " ").join(items) + "</div>"
        body = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.pick("<nav>", '<nav class="menu">', '<nav id="main-nav">') + body + "</nav>" if self.chance(0.8) else f'<div class="nav">{body}</div>'

    def boxed(self, body: str, *openings: str) -> str:
        opening = self.pick(*openings)
        return f"<{opening}>{body}</{opening.split()[0]}>"

    def advert(self) -> str:
        body = self.pick(self.prose(1), self.prose(2), self.link(self.words(2, 6)), f"<p>{self.prose(1)}</p>")
        return self.boxed(body, 'div class="ad"', 'div class="advert"', 'div class="ads banner"', 'div class="sponsored"', 'aside class="promo"', 'div id="ad-top"', 'section class="advertisement"')

    def notice(self) -> str:
        body = f"<p>{self.prose(1)}</p>" + self.pick("", "<button>ok</button>")
        return self.boxed(body, 'div class="cookie-notice"', 'div class="notice"', 'div id="cookie-banner"', 'div class="alert"', 'div class="newsletter"', 'div role="alert"', 'div class="popup"')

    def form(self) -> str:
        return f'<form action="/s"><label>{self.words(1, 3)}</label><input name="q"><button>{self.words(1, 2)}</button>{self.pick("", f"<p>{self.prose(1)}</p>")}</form>'

    def sidebar(self) -> str:
        items = "".join(f"<li>{self.link(self.words(2, 6))}</li>" for _ in range(int(self.rng.integers(2, 6))))
        body = self.pick(f"<h3>{self.words(1, 3)}</h3><ul>{items}</ul>", f"<p>{self.prose(2)}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.prose(2)}</p><ul>{items}</ul>", self.prose(2))
        return self.boxed(body, "aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="related"', 'div class="widget"', 'section class="sidebar related"', 'aside class="side"')

    def comments(self) -> str:
        n = int(self.rng.integers(1, 6))
        one = lambda: self.boxed(self.pick("", f"<b>{self.words(1, 2)}</b> ") + self.pick(f"<p>{self.prose(2)}</p>", self.prose(2)), 'div class="comment"', 'li class="comment"', "li", "div")
        body = self.pick("", f"<h3>{self.words(1, 2)}</h3>") + "".join(one() for _ in range(n))
        return self.boxed(body, 'div class="comments"', 'section id="comments"', 'div id="comments" class="comment-list"', 'ol class="commentlist"', 'section class="comments"', 'ul class="comments"', 'div class="responses comments"')

    def head(self) -> str:
        body = self.pick(f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 6)}</p>", self.link(self.words(1, 3)), f"<h1>{self.words(1, 3)}</h1>{self.menu()}")
        return self.boxed(body, "header", 'div class="header"', 'div id="header"', 'header class="site-header"', 'div class="masthead"')

    def foot(self) -> str:
        body = self.pick(f"&copy; {self.words(1, 4)}", f"&copy; {self.words(1, 3)} &middot; {self.prose(1)}", f"<p>{self.prose(1)}</p>", f"<p>{self.words(2, 6)}</p>{self.menu()}")
        return self.boxed(body, "footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"')

    def article(self) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        if self.chance(0.8):
            out.append((f"<h1>{self.words(2, 9)}</h1>", True))
        for _ in range(int(self.rng.integers(1, 14))):
            r = self.rng.random()
            if r < 0.66:
                body = self.prose(int(self.rng.integers(1, 7))) if self.chance(0.75) else self.words(1, 3).capitalize() + self.pick(".", "")
                out.append((self.pick(f"<p>{body}</p>", f"<p>{body}</p>", f"<p>{body}", f"<p><b>{self.words(1, 5)}<br><p>{body}</p>", f"<p>{body} {self.link(self.words(1, 3))} {body}</p>"), True))
            elif r < 0.74:
                out.append((f"<h2>{self.words(1, 6)}</h2>", True))
            elif r < 0.81:
                out.append((self.pick("<ul>", "<ol>") + "".join(f"<li>{self.words(2, 9)}</li>" for _ in range(3)) + "</ul>", True))
            elif r < 0.86:
                out.append((self.boxed(self.prose(1), "blockquote", "pre", "figcaption"), True))
            elif r < 0.89:
                out.append((f"<table><tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr></table>", True))
            elif r < 0.93:
                out.append((self.advert(), False))
            elif r < 0.95:
                out.append((self.form(), False))
            elif r < 0.97:
                out.append((self.notice(), False))
            else:
                out.append((self.sidebar(), False))
        if self.chance(0.12):
            out.append((self.comments(), False))
        return out

    def page(self) -> tuple[str, list[tuple[str, bool]]]:
        """(page, its parts in order with the truth)."""
        before = [f() for f in (self.notice, self.head, self.menu, self.form, self.advert, self.sidebar) if self.chance(0.45)]
        after = [f() for f in (self.sidebar, self.comments, self.advert, self.form, self.menu, self.notice) if self.chance(0.3)]
        after += [self.foot()] * self.chance(0.8)
        open_, close = [("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="content">', "</div>"), ('<div class="post entry">', "</div>"), ('<main><article class="post">', "</article></main>"), ('<section class="article">', "</section>"), ("<div>", "</div>"), ("", ""), ('<div id="main"><div class="story body">', "</div></div>")][int(self.rng.integers(11))]
        parts = [(x, False) for x in before] + [(open_, False)] + self.article() + [(close, False)] + [(x, False) for x in after]
        head = f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>"
        return head + "".join(x for x, _ in parts) + self.pick("</body></html>", ""), parts


_MARK = "⁣"


def training_page(maker: PageMaker) -> tuple[np.ndarray, np.ndarray]:
    """(description, truth) of a made-up page: main parts carry an invisible mark that is taken off again."""
    page, parts = maker.page()
    marked = "".join(re.sub(r"(>)([^<]*[^<\s][^<]*)", rf"\1{_MARK}\2", x) if main else x for x, main in parts)
    blocks = leaves(marked)
    truth = np.array([_MARK in b.text for b in blocks])
    for b in blocks:
        b.text = " ".join(b.text.replace(_MARK, "").split()) or "x"
    return describe(blocks), truth


@functools.lru_cache(2)
def trained(pages: int = 900, epochs: int = 6, batch: int = 30, seed: int = 7, rate: float = 0.01) -> Network:
    """The network after seeded training on made-up pages (Adam, falling rate)."""
    maker = PageMaker(seed)
    data = [d for d in (training_page(maker) for _ in range(pages)) if len(d[1])]
    data.sort(key=lambda d: len(d[1]))
    net = Network(PATH_DIMS + WORD_DIMS + MEASURES, UNITS, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    groups = [data[i : i + batch] for i in range(0, len(data), batch)]
    step, total = 0, epochs * len(groups)
    for _ in range(epochs):
        for gi in rng.permutation(len(groups)):
            group = groups[gi]
            x, mask = padded([d[0] for d in group])
            y = np.zeros(mask.shape, bool)
            for j, d in enumerate(group):
                y[: len(d[1]), j] = d[1]
            _, grads = net.gradients(x, mask, y)
            step += 1
            scale = min(1.0, 5.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads.values())))))
            for k, g in grads.items():
                g = g * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                lr = rate * (1 - 0.9 * step / total)
                net.p[k] = (net.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def main_texts(network: Network, pages: list[str]) -> list[str]:
    """The blocks labelled main text of each page, joined by one space; empty if there is none."""
    blocks = [leaves(p) for p in pages]
    marks = label(network, [describe(b) for b in blocks])
    return [" ".join(b.text for b, p in zip(own, m, strict=True) if p >= 0.5) for own, m in zip(blocks, marks, strict=True)]


def extract(pages: DataFrame, network: Network | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    A null html is an empty page with empty text; repeated rows and null ids or urls each come back;
    an empty table gives an empty result; whole pages are read, however long or deep, in linear time;
    further columns, whatever their names, are left.
    """
    net = network or trained()

    def run(batch: pa.RecordBatch) -> dict:
        texts = main_texts(net, [x or "" for x in batch.column(2).to_pylist()])
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_rows(given, "page_id long, url string, text string, n_chars long", run)
