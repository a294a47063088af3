"""Main text of web pages: a bidirectional LSTM labels every text block with the whole page as context.

A page is cut at block tags into leaf blocks. A block is read as a vector of its tag path (tag names and the words of
class and id of all open elements, hashed, nearer ones heavier), of its words (hashed, and their lengths), and of a few
measures (length, share of link text, digits, punctuation, place). A forward and a backward LSTM in numpy read the
blocks in page order, and a logistic unit on both states tells main text from the rest.

There are no labelled blocks, so the model learns from pages made of the input's own text: paragraphs of up to
``SAMPLE`` pages, those with the least id hashes, are laid out anew with menus, notices, adverts, sidebars, forms and
comments around them, in many kinds of markup, where each block's part is known. Some of these pages have neutral markup
throughout, where only the words tell the parts apart: there the parts around are written with ``PHRASES``. Words of the
input's own text are dropped from half of the blocks in training, so that no article is learned by heart. Training runs
on the driver within that bound; extraction is a narrow map over all pages.

Cutting a page takes time in proportion to its length, whatever its markup; a long page is labelled ``STEPS`` blocks at a
time, its states carried on.

Scripts, styles, comments and other markup are no text; an element without text that is closed by a slash or never
closed hides nothing behind it, but for unclosed scripts, styles and text fields. Character references are decoded, white space in a block becomes
one space, blocks join by an empty line. Defined results: null, empty and text-free pages give an empty text; open
elements end where HTML lets them; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 150
LAYOUTS, EPOCHS, RATE, DECAY, HIDDEN = 30, 24, 0.02, 3e-4, 16
PATHS, WORDS, LENGTHS, MEASURES = 256, 512, 24, 6
WIDTH = PATHS + WORDS + LENGTHS + MEASURES
ROWS = 64
#: Blocks of a page whose vectors are in memory at a time.
STEPS = 4096
#: How much less each further name of a tag path counts.
NEARER = 0.9
#: In training, the share of blocks of the input's text that lose their words, and of blocks of phrases that do.
DROPPED, FEWER = 0.5, 0.1
#: Share of made pages without telling markup; of articles' blocks in others that a phrase follows as part of the article.
NEUTRAL, QUOTED = 0.25, 0.03

# Fixed values of HTML: elements inside a line, elements without an end, elements whose content is no text.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = "script|style|noscript|template|iframe|object|svg|math|textarea|select|button|canvas|audio|video"
#: Elements that a new one of the same group ends.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NO_TEXT = set(NO_TEXT.split("|"))
#: Of these, those whose content is characters only; without an end they go to the end of the page.
RAW = {"script", "style", "textarea"}
_MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][\w:-]*))")
_SPECIAL = re.compile("[>\"']")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z|^[^=]*/\s*\Z|\s[^\s=]+/\s*\Z")
_RAW_EDGE = {name: re.compile(rf"<(/?){name}(?:\s*>|(?![\w:-]))", re.I) for name in RAW}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_DIGIT = re.compile(r"\d")
#: Marks that are taken off both ends of a word before it is hashed.
_EDGES = ".,;:!?\"'()[]{}<>|-/"


def _raw_end(page: str, name: str, at: int, self_closed: bool) -> int:
    """Where an element of RAW ends whose tag ends at ``at``: HTML reads on to its end tag also behind a slash.

    Behind a slash without an end tag before the next element of that name, the tag is all of it.
    """
    for edge in _RAW_EDGE[name].finditer(page, at):
        if edge.group(1) and edge.group().endswith(">"):
            return edge.end()
        if self_closed and not edge.group(1):
            return at
    return at if self_closed else len(page)


class _TagEnds:
    """Where a tag ends: at the first > outside quotes, or, if quotes do not pair, at the first > at all."""

    def __init__(self, page: str):
        special = [(m.start(), m.group()) for m in _SPECIAL.finditer(page)]
        self.at = [at for at, _ in special]
        # From the end of the page on: each place is looked at once, however many tags lie before it.
        self.plain, self.quoted = [-1] * (len(special) + 1), [-1] * (len(special) + 1)
        later = {"'": -1, '"': -1}
        for k in range(len(special) - 1, -1, -1):
            at, mark = special[k]
            if mark == ">":
                self.plain[k] = self.quoted[k] = at
            else:
                self.plain[k] = self.plain[k + 1]
                self.quoted[k] = self.quoted[later[mark] + 1] if later[mark] >= 0 else -1
                later[mark] = k

    def end(self, at: int) -> int:
        """The place of the tag's > behind ``at``; -1 if there is none."""
        k = bisect_left(self.at, at)
        return self.quoted[k] if self.quoted[k] >= 0 else self.plain[k]


class Tag(NamedTuple):
    name: str
    closing: bool
    attributes: str


def _tokens(page: str) -> list[tuple[int, int, Tag | None]]:
    """Where markup begins and ends, and the tag if it is one that counts.

    An element of NO_TEXT is one piece of markup from its tag to its end tag. One that is closed by a slash, or that has
    no end tag, is its tag alone, so what stands behind it is read.
    """
    out: list[tuple[int, int, Tag | None]] = []
    open_at: list[tuple[str, int]] = []
    at, n_open, ends = 0, Counter(), _TagEnds(page)
    while found := _MARKUP.search(page, at):
        start, opened = found.span()
        mark = found.group()
        if mark in ("<!--", "<![CDATA["):
            stop = page.find("-->" if mark == "<!--" else "]]>", opened)
            at = len(page) if stop < 0 else stop + 3
            out.append((start, at, None))
            continue
        last = ends.plain[bisect_left(ends.at, opened)] if not found.group(2) else ends.end(opened)
        if last < 0:
            # No tag: its < is text, and so is that of all others behind it.
            break
        at = last + 1
        tag = Tag((found.group(2) or "").lower(), bool(found.group(1)), page[opened:last]) if found.group(2) else None
        if tag and tag.name in _NO_TEXT:
            if tag.closing:
                if n_open[tag.name]:
                    ended = ""
                    while ended != tag.name:
                        ended, first = open_at.pop()
                        n_open[ended] -= 1
                    start = out[first][0]
                    del out[first:]
            else:
                closed = tag.attributes.rstrip().endswith("/") and bool(_SELF_CLOSED.search(tag.attributes))
                if tag.name in RAW:
                    at = _raw_end(page, tag.name, at, closed)
                elif not closed:
                    open_at.append((tag.name, len(out)))
                    n_open[tag.name] += 1
            tag = None
        out.append((start, at, tag))
    return out


class Element:
    """An open element: its parent, and the names that stand for it."""

    __slots__ = ("name", "names", "parent", "read")

    def __init__(self, name: str, names: tuple[str, ...], parent: Element | None):
        self.name, self.names, self.parent = name, names, parent
        self.read: np.ndarray | None = None

    def path(self) -> tuple[str, ...]:
        """Names from the root on."""
        out: list[str] = []
        element: Element | None = self
        while element is not None:
            out += reversed(element.names)
            element = element.parent
        return tuple(reversed(out))

    def vector(self) -> np.ndarray:
        """Hashed names of the path, each further one ``NEARER`` times as heavy; made once for an element, from its parent's."""
        unread, element = [], self
        while element is not None and element.read is None:
            unread.append(element)
            element = element.parent
        vector = np.zeros(PATHS, dtype=np.float32) if element is None else element.read
        for element in reversed(unread):
            vector = vector * np.float32(NEARER ** len(element.names))
            for near, name in enumerate(reversed(element.names)):
                vector[_place(name, PATHS)] += NEARER**near
            element.read = vector
        return vector


_ROOT = Element("", (), None)


def blocks(page: str) -> Iterator[tuple[Element, str, int]]:
    """Leaf blocks in page order: the innermost open element, text, and how much of it are links."""
    stack: list[Element] = []
    #: Places in the stack of each name's open elements.
    places: dict[str, list[int]] = {}
    held: list[str] = []
    linked, in_link, at = 0, 0, 0

    def ready() -> tuple[Element, str, int] | None:
        nonlocal held, linked
        text = " ".join(entities.unescape("".join(held)).split())
        out = (stack[-1] if stack else _ROOT, text, linked) if text else None
        held, linked = [], 0
        return out

    def take(text: str) -> None:
        nonlocal linked
        if text:
            held.append(text)
            if in_link:
                linked += len(text)

    def cut(first: int) -> None:
        while len(stack) > first:
            places[stack.pop().name].pop()

    for start, end, tag in _tokens(page):
        take(page[at:start])
        at = end
        if tag is None:
            held.append(" ")
            continue
        name = tag.name
        if name == "a":
            in_link = 0 if tag.closing else 1
        if name in INLINE:
            if name == "br":
                held.append(" ")
            continue
        if held and (block := ready()):
            yield block
        in_link = 0
        if tag.closing:
            if places.get(name):
                cut(places[name][-1])
            continue
        if stack and stack[-1].name == "p":
            cut(len(stack) - 1)
        while name in ENDED_BY and stack and stack[-1].name in ENDED_BY[name]:
            cut(len(stack) - 1)
        if name in VOID or tag.attributes.rstrip().endswith("/"):
            continue
        said = " ".join(next(filter(None, m), "") for m in _NAMES.findall(tag.attributes)).lower()
        places.setdefault(name, []).append(len(stack))
        stack.append(Element(name, (f"<{name}>", *_WORD.findall(said)), stack[-1] if stack else None))
    take(page[at:])
    if block := ready():
        yield block


def _place(text: str, n: int) -> int:
    return crc32(text.encode()) % n


def vectors(
    page: list[tuple[Element, str, int]], first: int = 0, total: int | None = None, dropped: np.ndarray | None = None
) -> np.ndarray:
    """A row for each block; ``page`` begins at block ``first`` of ``total``, and blocks ``dropped`` lose their words."""
    total = len(page) if total is None else total
    x = np.zeros((len(page), WIDTH), dtype=np.float32)
    of_words, of_lengths = PATHS, PATHS + WORDS
    for i, (element, text, linked) in enumerate(page):
        x[i, :PATHS] = element.vector()
        words = text.lower().split()
        share = 1 / len(words)
        for word in words:
            x[i, of_lengths + len(word) * 31 % LENGTHS] += share
        if dropped is None or not dropped[i]:
            # Each word once: a block that repeats one word is no stronger sign than one that says it.
            bare = {word.strip(_EDGES) for word in words}
            heavy = 1 / math.sqrt(len(bare))
            for word in bare:
                x[i, of_words + _place(word, WORDS)] += heavy
        size = len(text)
        marks = sum(map(text.count, ".,;:!?"))
        digits = len(_DIGIT.findall(text))
        x[i, -MEASURES:] = [np.log1p(size) / 6, min(1, linked / size), digits / size, marks / size, (first + i) / total, 1 / total]
    return x


# What menus, headers, footers and so on often say. A made page's parts are partly written with them.
PHRASES = {
    "menu": ["Home", "News", "About us", "Contact", "Sports", "Politics", "Business", "Archive", "Sitemap", "Next page", "Previous", "Share on social media", "Print this page", "Startseite", "Accueil", "Inicio", "Tags", "Categories", "All topics", "Login", "Search"],
    "header": ["Welcome to our website", "The daily magazine for everyone", "Your source of news", "Log in or create an account", "Skip to content", "Today's edition"],
    "footer": ["Copyright all rights reserved", "Terms of use and privacy policy", "Imprint and legal notice", "Powered by our content system", "Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados", "Follow us on social media", "Contact the editors by mail"],
    "aside": ["Related articles", "Most read this week", "You may also like these stories", "Popular posts", "More from this author", "Recommended for you", "Latest headlines", "Trending now", "Read also"],
    "notice": ["We use cookies to improve your experience on this website", "By continuing you accept our privacy policy", "Accept all cookies", "Subscribe to our newsletter to get the latest news by mail", "Please enable javascript in your browser", "Please sign in to continue reading", "Diese Website verwendet Cookies", "Ce site utilise des cookies", "Este sitio usa cookies", "You have free articles left this month", "Manage your consent settings"],
    "advert": ["Advertisement", "Sponsored content", "Buy now and save with free shipping", "Limited offer, order today at the best price", "Click here to get a discount", "Anzeige", "Publicité", "Publicidad", "Try it free for thirty days", "Shop our sale"],
    "form": ["Your email address", "Enter your name", "Search this site", "Sign up", "Password", "Forgot your password?", "Submit", "Leave a message", "Send"],
    "comments": ["Great article, thanks for sharing", "I agree with you", "Reply to this comment", "Posted by a reader two hours ago", "Thanks for the post, very helpful", "I do not think this is right", "Nice text, I like it", "Log in to leave a comment", "Comments are closed", "First!", "What do you think about it?"],
}
#: Markup that tells nothing.
PLAIN = ["<div>{}</div>", "<p>{}</p>", "<section><p>{}</p></section>", "<div><div>{}</div></div>", "<div><p>{}</p></div>", '<div class="row">{}</div>', '<div class="box col"><p>{}</p></div>', "<table><tr><td>{}</td></tr></table>"]
# Kinds of markup around the parts of a made page. {} is the content; the second entry is the part's name.
MAIN = ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="main-content">{}</div>', '<div class="post-body entry">{}</div>', '<section class="story">{}</section>', '<div class="article-text">{}</div>', '<article class="post"><div class="body">{}</div></article>', '<div role="main">{}</div>', '<div class="entry-content">{}</div>', '<div id="content"><div class="text">{}</div></div>']
AROUND = {
    "menu": ["<nav>{}</nav>", '<ul class="menu">{}</ul>', '<div class="navbar">{}</div>', '<div id="navigation" role="navigation">{}</div>', '<nav class="breadcrumb">{}</nav>', '<div class="topnav links">{}</div>', '<div id="nav">{}</div>', '<div class="menu">{}</div>', '<div class="pagination">{}</div>', '<div class="share social">{}</div>', '<div class="tags">{}</div>'],
    "header": ["<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead">{}</div>', '<div class="site-header banner">{}</div>', '<div id="header" role="banner">{}</div>', '<header class="top">{}</header>'],
    "footer": ["<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="site-footer">{}</div>', '<p class="copyright">{}</p>', '<div class="bottom legal">{}</div>', '<div id="footer" role="contentinfo">{}</div>'],
    "aside": ["<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="right-column" class="widget">{}</div>', '<div class="related">{}</div>', '<section class="recommended teaser">{}</section>', '<div id="sidebar">{}</div>', '<aside class="side">{}</aside>', '<div id="secondary" role="complementary">{}</div>'],
    "notice": ['<div class="cookie-notice">{}</div>', '<div class="notice">{}</div>', '<div id="consent" class="popup">{}</div>', '<div class="alert">{}</div>', '<div class="newsletter subscribe">{}</div>', "<dialog>{}</dialog>", '<div class="cookie-banner">{}</div>', '<div id="cookies">{}</div>', '<div role="alert" class="message">{}</div>', '<div class="disclaimer gdpr">{}</div>', '<p class="notice">{}</p>'],
    "advert": ['<div class="ad">{}</div>', '<div class="advert">{}</div>', '<div id="ads">{}</div>', '<div class="sponsored promo">{}</div>', '<aside class="advertisement">{}</aside>', '<div class="banner-ad"><div>{}</div></div>', '<div class="ads">{}</div>', '<p class="ad">{}</p>', '<section class="promotion sponsor">{}</section>'],
    "form": ["<form>{}</form>", '<form class="search"><label>{}</label><input type="text"></form>', '<div class="login"><form><p>{}</p></form></div>', '<form id="signup"><fieldset><legend>{}</legend></fieldset></form>', '<form action="/"><div>{}</div></form>'],
    "comments": ['<div id="comments">{}</div>', '<section class="comments">{}</section>', '<ol class="commentlist">{}</ol>', '<div class="comment"><p>{}</p></div>', '<div class="discussion replies">{}</div>', '<ul class="comment-list">{}</ul>', '<div class="comments">{}</div>', '<section id="comments">{}</section>', '<div class="responses reader-comments">{}</div>', '<div id="disqus-thread">{}</div>', '<div class="reply">{}</div>'],
}
BEFORE, AFTER = ["menu", "header", "notice", "advert", "form"], ["aside", "comments", "advert", "footer", "notice", "menu", "form"]


def _made_page(draw: np.random.Generator, main: list[str], other: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
    """A page of known parts, its labels, and which blocks are phrases; a mark before each text tells its block's part."""
    one = lambda options: options[int(draw.integers(len(options)))]
    escape = lambda text: entities.escape(text, quote=False)
    neutral = draw.random() < NEUTRAL

    def said(kind: str, most: int) -> str:
        """A phrase, alone or with one more, or words of another page where the markup tells the part."""
        if neutral or draw.random() < 0.4:
            parts = [one(PHRASES[kind]) for _ in range(1 + int(draw.integers(2)))]
            return "\u0003" + " ".join(" ".join(p.split() if draw.random() < 0.7 else draw.permutation(p.split()).tolist()) for p in parts)
        return "\u0001" + " ".join(one(other).split()[: int(draw.integers(1, most))])

    def around(kind: str) -> str:
        n = int(draw.integers(1, 6))
        if neutral:
            return "".join(one(PLAIN).format(escape(said(kind, 40))) for _ in range(n))
        if kind == "menu":
            inner = "".join(f'<li><a href="#">{escape(said(kind, 4))}</a></li>' for _ in range(n))
            inner = inner if draw.random() < 0.5 else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = "".join(one(["<p>{}</p>", "<li><p>{}</p></li>", '<div class="comment">{}</div>', '<article class="comment"><p>{}</p></article>']).format(escape(said(kind, 40))) for _ in range(n))
        elif draw.random() < 0.5:
            inner = escape(said(kind, 40))
        else:
            inner = "".join(one(["<p>{}</p>", "<div>{}</div>", "<h3>{}</h3><p>more</p>", "<ul><li>{}</li></ul>"]).format(escape(said(kind, 40))) for _ in range(n))
            inner = inner.replace("<p>more</p>", "<p>" + escape(said(kind, 10)) + "</p>")
        frame = one(AROUND[kind])
        # A paragraph ends where another block begins, so it can hold plain text only.
        return frame.format(escape(said(kind, 40)) if frame.startswith("<p") else inner)

    def body() -> str:
        parts = ["<h1>\u0002" + escape(" ".join(main[0].split()[:9])) + "</h1>"] if draw.random() < 0.8 else []
        for text in main:
            text = "\u0002" + escape(text)
            plain = PLAIN if neutral else ["<p>{}</p>"] * 6 + ["<p><b>{}<br>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>", "<div>{}</div>"]
            parts.append(one(plain).format(text))
            if not neutral and draw.random() < QUOTED:
                # Where markup tells the part, it counts for more than the words.
                parts.append("<p>\u0002" + escape(one(PHRASES[one(list(PHRASES))])) + "</p>")
            if draw.random() < 0.15:
                parts.append(around(one(["advert", "advert", "aside", "form", "notice", "menu"])))
        return one(["{}", "<div>{}</div>", "<div><div>{}</div></div>"] if neutral else MAIN).format("".join(parts))

    some = lambda kinds: "".join(around(k) for k in kinds if draw.random() < 0.45)
    title = "<head><title>\u0001" + escape(" ".join(main[0].split()[:9])) + "</title></head>"
    page = "<html>" + title + "<body>" + some(BEFORE) + body() + some(AFTER)
    found = list(blocks(page))
    y = np.array([t[0] == "\u0002" for _, t, _ in found], dtype=np.float32)
    phrase = np.array([t[0] == "\u0003" for _, t, _ in found])
    return [(element, text.lstrip("\u0001\u0002\u0003") or "-", linked) for element, text, linked in found], y, phrase


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by step and page, and which of them are real."""
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), dtype=pages[0].dtype)
    real = np.zeros((steps, len(pages)), dtype=np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        real[: len(p), i] = 1
    return x, real


def _run(
    w: dict, side: str, inputs: np.ndarray, real: np.ndarray, state: tuple | None = None, remember: bool = False
) -> tuple[np.ndarray, list, tuple]:
    """One direction's states over projected blocks; past the end of a page the state stays as it is."""
    steps, n, _ = inputs.shape
    h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
    out, memory = np.zeros((steps, n, HIDDEN), np.float32), [None] * steps if remember else []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = inputs[t] + h @ w[f"H{side}"]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        m = real[t][:, None]
        new = f * c + i * g
        wave = np.tanh(new)
        if remember:
            memory[t] = (h, c, i, f, o, g, wave, m)
        c = m * new + (1 - m) * c
        h = m * (o * wave) + (1 - m) * h
        out[t] = h
    return out, memory, (h, c)


def _projected(w: dict, side: str, x: np.ndarray) -> np.ndarray:
    return x @ w[f"X{side}"] + w[f"b{side}"]


def _back(w: dict, side: str, x: np.ndarray, memory: list, dout: np.ndarray, grad: dict) -> None:
    steps, n, _ = x.shape
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    dgates = np.zeros((steps, n, 4 * HIDDEN), np.float32)
    before = np.zeros((steps, n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if side == "f" else range(steps):
        h, c, i, f, o, g, wave, m = memory[t]
        dh = dh + dout[t]
        live, dnew = dh * m, (dh * m) * o * (1 - wave**2) + dc * m
        dgates[t] = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), live * wave * o * (1 - o), dnew * i * (1 - g**2)], axis=1)
        before[t] = h
        dc = dnew * f + dc * (1 - m)
        dh = dgates[t] @ w[f"H{side}"].T + dh * (1 - m)
    flat = dgates.reshape(-1, 4 * HIDDEN)
    grad[f"X{side}"] = x.reshape(-1, x.shape[2]).T @ flat
    grad[f"H{side}"] = before.reshape(-1, HIDDEN).T @ flat
    grad[f"b{side}"] = flat.sum(axis=0)


def probabilities(w: dict, x: np.ndarray, real: np.ndarray) -> np.ndarray:
    forward, backward = (_run(w, side, _projected(w, side, x), real)[0] for side in "fr")
    return _sigmoid(forward @ w["vf"] + backward @ w["vr"] + w["d"])


def labelled(w: dict, page: list[tuple[Element, str, int]]) -> np.ndarray:
    """Probabilities of a page's blocks, ``STEPS`` of them read at a time."""
    parts = [page[a : a + STEPS] for a in range(0, len(page), STEPS)]
    inputs = {"f": [], "r": []}
    for k, part in enumerate(parts):
        x = vectors(part, k * STEPS, len(page))
        for side, made in inputs.items():
            made.append(_projected(w, side, x)[:, None])
    logits = [np.full(len(p), w["d"], dtype=np.float32) for p in parts]
    for side, made in inputs.items():
        state = None
        for k in range(len(parts)) if side == "f" else range(len(parts) - 1, -1, -1):
            out, _, state = _run(w, side, made[k], np.ones((len(parts[k]), 1), np.float32), state)
            logits[k] = logits[k] + out[:, 0] @ w[f"v{side}"]
    return _sigmoid(np.concatenate(logits))


def fit(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> dict:
    """Adam on batches of pages of like length; ``pages`` is empty afterwards."""
    draw = np.random.Generator(np.random.PCG64(11))
    w = {}
    for side in "fr":
        w[f"X{side}"] = (draw.standard_normal((WIDTH, 4 * HIDDEN)) / np.sqrt(WIDTH)).astype(np.float32)
        w[f"H{side}"] = (draw.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
        w[f"b{side}"] = np.zeros(4 * HIDDEN, np.float32)
        w[f"v{side}"] = (draw.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
    w["d"] = np.float32(0)
    pages.sort(key=lambda p: len(p[0]), reverse=True)
    made = []
    while pages:
        batch = [pages.pop() for _ in range(min(64, len(pages)))]
        made.append((*_padded([p[0] for p in batch]), _padded([p[1][:, None] for p in batch])[0][:, :, 0]))
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        for b in draw.permutation(len(made)):
            x, real, y = made[b]
            x = x.astype(np.float32)
            forward, mf, _ = _run(w, "f", _projected(w, "f", x), real, remember=True)
            backward, mr, _ = _run(w, "r", _projected(w, "r", x), real, remember=True)
            p = _sigmoid(forward @ w["vf"] + backward @ w["vr"] + w["d"])
            error = (p - y) * real / real.sum()
            grad = {"vf": np.tensordot(error, forward, 2), "vr": np.tensordot(error, backward, 2), "d": error.sum()}
            _back(w, "f", x, mf, error[:, :, None] * w["vf"], grad)
            _back(w, "r", x, mr, error[:, :, None] * w["vr"], grad)
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in w:
                slope = grad[k] + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                move = rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                w[k] = (w[k] - move).astype(np.float32)
    return w


def made_pages(pages: list[str], layouts: int = LAYOUTS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training pages from the texts of real ones."""
    texts = [[t for _, t, _ in blocks(p)] for p in pages]
    texts = [t for t in texts if t]
    pool = [t for page in texts for t in page]
    draw = np.random.Generator(np.random.PCG64(5))
    out = []
    for page in texts:
        for _ in range(layouts):
            # The longer half of a page's blocks is taken for its text; short paragraphs are beginnings of these.
            long = sorted(page, key=len, reverse=True)[: max(1, len(page) // 2)][: int(draw.integers(1, 12))]
            short = [long[int(k)].split() for k in draw.integers(len(long), size=int(draw.integers(0, 6)))]
            main = long + [" ".join(words[: int(draw.integers(1, 7))]) for words in short]
            main = [main[int(k)] for k in draw.permutation(len(main))]
            made, y, phrase = _made_page(draw, main, pool)
            dropped = draw.random(len(made)) < np.where(phrase, FEWER, DROPPED)
            # Half precision: all training pages are in the driver's memory at once.
            out.append((vectors(made, dropped=dropped).astype(np.float16), y))
    return out


def train(pages: DataFrame, sample: int = SAMPLE) -> dict | None:
    drawn = pages.where("html is not null").select(F.xxhash64("page_id").alias("h"), "page_id").orderBy("h", "page_id").limit(sample)
    rows = pages.select("page_id", "html").join(F.broadcast(drawn), "page_id").select("h", "html").collect()
    made = made_pages([r.html for r in sorted(rows, key=lambda r: (r.h, r.html or "")) if r.html])
    return fit(made) if made else None


def _chosen(page: list[tuple[Element, str, int]], p: np.ndarray) -> str:
    return "\n\n".join(text for (_, text, _), q in zip(page, p, strict=False) if q > 0.5)


def _extractor(w: dict | None):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                texts = [""] * part.num_rows
                short: list[tuple[int, list]] = []
                for k, page in enumerate(part.column("html").to_pylist()):
                    found = list(blocks(page or "")) if w is not None else []
                    if len(found) > STEPS:
                        texts[k] = _chosen(found, labelled(w, found))
                    elif found:
                        short.append((k, found))
                short.sort(key=lambda p: len(p[1]))
                for b in range(0, len(short), 16):
                    some = short[b : b + 16]
                    p = probabilities(w, *_padded([vectors(found) for _, found in some]))
                    for i, (k, found) in enumerate(some):
                        texts[k] = _chosen(found, p[:, i])
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return extract


def main_text(pages: DataFrame, w: dict | None) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    schema = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(w), schema)
