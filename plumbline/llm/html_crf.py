"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

``leaf_blocks`` reads the tags of a page (quoted attributes, raw-text elements, comments, unclosed tags, implied end
tags) and gives the text runs between block-level tags with their ancestors. Features of a block are its ancestor tags,
the words of their class, id and role, and its text's length, links and punctuation. The chain has two labels, main text
or not; weights are fitted by stochastic gradient on the conditional log-likelihood (forward-backward) of labelled pages
of several families (FAMILIES) and a page is decoded by Viterbi. The labelled pages come from ``labelled_pages``, a generator of articles amid menus,
headers, footers, sidebars, notices, adverts, forms and reader comments in many markups, with lists, data tables, terms,
captions and code in the articles, so that these are told from menus and page frames by what they lie in.

Defined results: a null or empty html has no blocks and an empty text; character references are decoded after the tags
are read; what is in an unclosed tag or comment at the end is dropped; ``br`` is white space; a page of text without
tags is one block; an element that is not shown or is a control is left out if it has an end tag; ties in decoding go to "not main". Repeated rows get the same text each. Extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Callable, Container, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table

# HTML element categories.
BLOCK = frozenset("address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text for the parser up to their end tag, and without one to the end of the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements whose content is not shown or is a control; without an end tag they are read like any inline element.
UNSHOWN = frozenset("noscript template svg object audio video select button".split())
#: A start tag of the first ends an open element of the second kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SPACE = frozenset(("br", "wbr"))
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*.?true", re.I)
PART = re.compile(r"[A-Z]?[a-z]+")
END = re.compile(r"[.!?…:;\"”»)]$")


def _marks(name: str, attributes: str) -> tuple[str, ...]:
    """Features an element gives to every block in it."""
    if not attributes:
        return ("in=" + name,)
    out = ["in=" + name]
    for m in NAMED.finditer(attributes):
        out += ["named=" + w.lower() for w in PART.findall(m[1] or m[2] or m[3] or "")]
    if HIDDEN.search(attributes):
        out.append("hidden")
    return tuple(out)


#: Elements that say what part of a page a block is in; the innermost that is open counts.
PARTS = frozenset("article main section nav aside header footer form table ul ol dl figure details div".split())


class _Open:
    """The open elements: where each name is open last, which of them are blocks or parts, and the features they give now.

    Every step costs what it adds or takes away, so a page is read in time linear in its length however deep it nests.
    """

    def __init__(self, known: Container[str] | None):
        self.known, self.stack, self.at, self.blocks, self.parts = known, [], {}, [], []
        self.active: dict[str, int] = {}

    def push(self, name: str, marks: tuple[str, ...]) -> None:
        if self.known is not None:
            marks = tuple(m for m in marks if m in self.known)
        for m in marks:
            self.active[m] = self.active.get(m, 0) + 1
        self.at.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.blocks.append(len(self.stack))
        if name in PARTS:
            self.parts.append(name)
        self.stack.append((name, marks))

    def pop(self) -> None:
        name, marks = self.stack.pop()
        self.at[name].pop()
        if name in BLOCK:
            self.blocks.pop()
        if name in PARTS:
            self.parts.pop()
        for m in marks:
            if self.active[m] == 1:
                del self.active[m]
            else:
                self.active[m] -= 1

    def close(self, name: str) -> None:
        """An end tag: of an inline element it does not close blocks around it."""
        where = self.at.get(name)
        if where and (name in BLOCK or not self.blocks or where[-1] > self.blocks[-1]):
            for _ in range(len(self.stack) - where[-1]):
                self.pop()

    def begin_block(self, name: str) -> None:
        """An open paragraph ends at any block, and so do the inline elements in it; an item ends where the next begins."""
        while self.stack and (self.stack[-1][0] not in BLOCK or self.stack[-1][0] == "p"):
            self.pop()
        if name in CLOSES and self.stack and self.stack[-1][0] in CLOSES[name]:
            self.pop()


_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW | UNSHOWN}


def leaf_blocks(page: str | None, known: Container[str] | None = None) -> list[tuple[str, tuple[str, ...]]]:
    """(text, features) of each block that has text, in page order. ``known``: the features to keep of ancestors."""
    page = page or ""
    found: list[tuple[str, tuple[str, ...]]] = []
    open_ = _Open(known)
    parts: list[str] = []
    linked = in_link = 0
    unended: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                words = text.count(" ") + 1
                own = open_.stack[open_.blocks[-1]][0] if open_.blocks else "none"
                share = linked / max(1, len(text))
                links = "all" if share > 0.6 else "some" if share > 0.1 else "no"
                # what holds the block, and what holds that: an item of a list in an article is no item of a menu
                part, around = ["none", "none", *open_.parts][-1:-3:-1]
                marks = {"tag=" + own, f"words={min(7, words.bit_length())}", "links=" + links, "end" if END.search(text) else "open", f"{own}:links={links}", f"{own}<{part}<{around}", f"{part}<{around}:links={links}"}
                if "©" in text or "®" in text:
                    marks.add("rights")
                found.append((text, tuple(sorted(marks.union(open_.active)))))
            parts.clear()
        linked = 0

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            parts.append(page[at:stop])
            if in_link:
                linked += stop - at
        if m is None:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name in SPACE:
            parts.append(" ")
        elif m[1]:
            if name == "a":
                in_link = 0
            if name in BLOCK:
                flush()
            open_.close(name)
        elif name in _ENDS:
            # one that has no end tag from here on has none later either
            end = None if name in unended else _ENDS[name].search(page, at)
            if name in RAW and name not in ("textarea", "iframe"):
                flush()
            if end:
                at = end.end()
            elif name in RAW:
                at = n
            else:
                unended.add(name)
        elif name in VOID:
            if name in BLOCK:
                flush()
        else:
            if name in BLOCK:
                flush()
                open_.begin_block(name)
            if name == "a":
                in_link = 1
            if not m[3].endswith("/"):
                open_.push(name, _marks(name, m[3]))
    flush()
    return found


class Chain:
    """Weights of a two-label chain: a difference (main minus not) for each feature, and for each pair of labels."""

    def __init__(self) -> None:
        self.features: dict[str, float] = {}
        self.bias = 0.0
        self.pair = [[0.0, 0.0], [0.0, 0.0]]
        self.start = 0.0

    def scores(self, blocks: list[tuple[str, ...]]) -> list[float]:
        get = self.features.get
        return [self.bias + sum(get(f, 0.0) for f in own) for own in blocks]

    def decode(self, blocks: list[tuple[str, ...]]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not blocks:
            return []
        (p00, p01), (p10, p11) = self.pair
        unary = self.scores(blocks)
        a, b = 0.0, unary[0] + self.start
        back: list[tuple[int, int]] = []
        for s in unary[1:]:
            to0 = (a + p00, 0) if a + p00 >= b + p10 else (b + p10, 1)
            to1 = (a + p01, 0) if a + p01 >= b + p11 else (b + p11, 1)
            back.append((to0[1], to1[1]))
            a, b = to0[0], to1[0] + s
        label = 1 if b > a else 0
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def learn(self, blocks: list[tuple[str, ...]], gold: list[int], rate: float, decay: float) -> float:
        """One gradient step on a page's conditional log-likelihood, which it returns."""
        n = len(blocks)
        unary = self.scores(blocks)
        unary[0] += self.start
        log = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
        fwd, bwd = [(0.0, unary[0])], [(0.0, 0.0)] * n
        for s in unary[1:]:
            a, b = fwd[-1]
            fwd.append((log(a + self.pair[0][0], b + self.pair[1][0]), log(a + self.pair[0][1], b + self.pair[1][1]) + s))
        for k in range(n - 2, -1, -1):
            a, b = bwd[k + 1][0], bwd[k + 1][1] + unary[k + 1]
            bwd[k] = (log(self.pair[0][0] + a, self.pair[0][1] + b), log(self.pair[1][0] + a, self.pair[1][1] + b))
        z = log(*fwd[-1])
        likely = sum(u for u, g in zip(unary, gold, strict=True) if g) + sum(self.pair[x][y] for x, y in zip(gold, gold[1:], strict=False)) - z
        step = [[0.0, 0.0], [0.0, 0.0]]
        for k in range(n - 1):
            for x in (0, 1):
                for y in (0, 1):
                    p = math.exp(fwd[k][x] + self.pair[x][y] + (unary[k + 1] if y else 0.0) + bwd[k + 1][y] - z)
                    step[x][y] += (gold[k] == x and gold[k + 1] == y) - p
        for k, own in enumerate(blocks):
            g = rate * (gold[k] - math.exp(fwd[k][1] + bwd[k][1] - z))
            for f in own:
                w = self.features.get(f, 0.0)
                self.features[f] = w + g - rate * decay * w
            self.bias += g
            if not k:
                self.start += g
        for x in (0, 1):
            for y in (0, 1):
                self.pair[x][y] += rate * step[x][y]
        return likely


def fit(pages: list[tuple[list[tuple[str, ...]], list[int]]], epochs: int = 12, rate: float = 0.1, decay: float = 1e-3, seed: int = 5) -> Chain:
    chain, rng = Chain(), random.Random(seed)
    pages = [p for p in pages if p[0]]
    for epoch in range(epochs):
        rng.shuffle(pages)
        for blocks, gold in pages:
            chain.learn(blocks, gold, rate / (1 + 0.3 * epoch), decay)
    return chain


#: Families of labelled pages: portals with all kinds of surroundings, texts with hardly a tag, short pages, articles with
#: a header and footer of their own, pages laid out by tables, and articles with lists, data tables, terms, captions and code.
FAMILIES = ("portal", "bare", "short", "headed", "table", "structured")


def structure(kind: str, rng: random.Random, line: Callable, sentence: Callable) -> tuple[str, int]:
    """A piece of an article that is no paragraph, and how many blocks it has: short and long lists, data tables with or
    without a head, terms, captions, code, quotes, details."""
    few = lambda: line(1, 4) if rng.random() < 0.6 else f"{rng.randint(1, 3000)}{rng.choice(['', '.5', ' %', ' km'])}"
    item = lambda: few() if rng.random() < 0.6 else sentence(2, 14) if rng.random() < 0.85 else f'<a href="/{rng.randint(1, 99)}">{line(1, 3)}</a> {line(1, 6)}'
    k = rng.randint(2, 6)
    if kind in ("ul", "ol"):
        end = rng.choice(["</li>", "</li>", ""])
        return f"<{kind}>" + "".join(f"<li>{item()}{end}" for _ in range(k)) + f"</{kind}>", k
    if kind == "table":
        wide = rng.randint(2, 4)
        head = "<tr>" + "".join(f"<th>{line(1, 2)}</th>" for _ in range(wide)) + "</tr>" if rng.random() < 0.7 else ""
        rows = "".join("<tr>" + "".join(f"<td>{few()}</td>" for _ in range(wide)) + "</tr>" for _ in range(k))
        caption = f"<caption>{line(2, 6)}</caption>" if rng.random() < 0.3 else ""
        body = f"<thead>{head}</thead><tbody>{rows}</tbody>" if head and rng.random() < 0.5 else head + rows
        return f"<table>{caption}{body}</table>", wide * (k + bool(head)) + bool(caption)
    if kind == "dl":
        return "<dl>" + "".join(f"<dt>{line(1, 3)}</dt><dd>{item()}</dd>" for _ in range(k)) + "</dl>", 2 * k
    if kind == "figure":
        return f'<figure><img src="x.png">' + f"<figcaption>{line(2, 12)}</figcaption></figure>", 1
    if kind == "details":
        return f"<details><summary>{line(1, 5)}</summary><p>{sentence(3, 20)}</p></details>", 2
    return f"<{kind}>{sentence(2, 25) if kind != 'pre' else line(1, 9)}</{kind}>", 1


STRUCTURES = ("ul", "ol", "table", "dl", "figure", "details", "pre", "blockquote", "h3")


def _other_page(kind: str, rng: random.Random, line: Callable, sentence: Callable) -> tuple[str, list[int]]:
    """A page of a family other than portals."""
    body, gold = [], []

    def add(tag: str, text: str, main: int) -> None:
        body.append(f"<{tag}>{text}</{tag.split()[0]}>" if tag else text)
        gold.append(main)

    text = lambda most: " ".join(sentence(3, 25) for _ in range(rng.randint(1, most)))
    links = lambda sep: sep.join(f'<a href="/{k}">{line(1, 2)}</a>' for k in range(rng.randint(2, 6)))
    if kind == "bare":
        tag = rng.choice(["", "", "p", "pre", "div"])
        for _ in range(rng.randint(1, 6) if tag else 1):
            add(tag, text(6) if rng.random() < 0.75 else line(1, 4), 1)
        return rng.choice(["{}", "<html><body>{}</body></html>"]).format("".join(body)), gold
    if kind == "short":
        if rng.random() < 0.4:
            add(rng.choice(["nav", "nav class='menu'", "div id='nav'"]), links(" "), 0)
        wrap = rng.choice(["main", "article", "div id='content'", "div class='post'", "body", "section"])
        body.append(f"<{wrap}>")
        if rng.random() < 0.4:
            add("h1", line(1, 8), 1)
        for _ in range(rng.choice([1, 1, 2])):
            add("p", text(2), 1)
        body.append(f"</{wrap.split()[0]}>")
        if rng.random() < 0.4:
            add("footer", "&copy; " + line(1, 4), 0)
    elif kind == "headed":
        add("header" if rng.random() < 0.5 else "header class='site-header'", line(1, 5), 0)
        add("nav", links(" | "), 0)
        body.append(rng.choice(["<main><article>", "<article>", "<article class='entry'>"]))
        body.append("<header>")
        add(rng.choice(["h1", "h2"]), line(2, 10), 1)
        body.append("</header>")
        for _ in range(rng.randint(2, 9)):
            add("p", text(4), 1)
        if rng.random() < 0.5:
            add("footer", "Tags: " + links(", "), 0)
        body.append("</article>")
        add("aside", links(" "), 0)
        add("footer", "&copy; " + line(1, 6), 0)
    elif kind == "structured":
        menu = lambda: "<ul>" + "".join(f'<li><a href="/{k}">{line(1, 2)}</a></li>' for k in range(rng.randint(2, 7))) + "</ul>"

        def listed(tag: str, made: str, n: int, main: int) -> None:
            body.append(f"<{tag}>{made}</{tag.split()[0]}>" if tag else made)
            gold.extend([main] * n)

        if rng.random() < 0.6:
            made = menu()
            listed(rng.choice(["nav", "div class='menu'", "header", "nav class='nav'"]), made, made.count("<li>"), 0)
        wrap = rng.choice(["article", "article", "main", "main", "div", "div", "div class='content'", "div id='main'", "div class='post'", "section"])
        body.append(f"<{wrap}>")
        if rng.random() < 0.8:
            add(rng.choice(["h1", "h2"]), line(1, 8), 1)
        for _ in range(rng.randint(2, 7)):
            if rng.random() < 0.5:
                add("p", text(3), 1)
            else:
                listed("", *structure(rng.choice(STRUCTURES), rng, line, sentence), 1)
        body.append(f"</{wrap.split()[0]}>")
        if rng.random() < 0.5:
            made = menu()
            listed(rng.choice(["aside", "div class='sidebar'", "div class='related'", "aside class='widget'"]), made, made.count("<li>"), 0)
        # calendars, rates, tables of links: beside the article they are no part of it
        for _ in range(rng.choice([0, 1, 1, 2])):
            made, n = structure(rng.choice(["table", "table", "ul", "dl"]), rng, line, sentence)
            if rng.random() < 0.4:
                made = re.sub(r"(<td>|<li>|<dd>)([^<]*)", r'\1<a href="/x">\2</a>', made)
            listed(rng.choice(["aside", "div class='sidebar'", "div class='widget'", "div class='menu'", "footer", "div class='footer'", "nav"]), made, n, 0)
        if rng.random() < 0.7:
            made = menu()
            listed(rng.choice(["footer", "div id='footer'"]), *(("&copy; " + line(1, 6), 1) if rng.random() < 0.6 else (made, made.count("<li>"))), 0)
    else:
        body.append("<table><tr>")
        add("td class='menu'", links("<br>"), 0)
        body.append(rng.choice(["<td class='content'>", "<td id='main'>", "<td>"]))
        for _ in range(rng.randint(2, 9)):
            add("p", text(4), 1)
        if rng.random() < 0.3:
            made, n = structure(rng.choice(["ul", "ol", "table"]), rng, line, sentence)
            body.append(made)
            gold.extend([1] * n)
        body.append("</td>")
        if rng.random() < 0.5:
            add("td class='sidebar'", links("<br>"), 0)
        body.append("</tr><tr>")
        add("td class='footer'", "&copy; " + line(1, 6), 0)
        body.append("</tr></table>")
    return "<html><head><title>" + line(1, 5) + "</title></head><body>" + "".join(body) + "</body></html>", gold


def labelled_pages(n: int, seed: int = 11, families: tuple[str, ...] = ("portal",)) -> list[tuple[str, list[int]]]:
    """Invented pages with the label of each leaf block. Half are portals, whose main text sits in article, main, or named
    or bare div, if that family is asked for; the rest are dealt to the other families."""
    rng = random.Random(seed)
    syllables = "an be cion der er ge heit in la men no or pa que ra sch ti un ver wo é ü ñ".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    line = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b))).capitalize()

    def sentence(a: int = 1, b: int = 30) -> str:
        return line(a, b) + rng.choice(["."] * 8 + ["!", "?", "", ",", "&hellip;", " &amp; " + word() + "."])

    def menu(tag: str, named: str) -> tuple[str, int]:
        k = rng.randint(2, 9)
        if rng.random() < 0.7:
            return f"<{tag}{named}><ul>" + "".join(f'<li><a href="/{word()}">{line(1, 2)}</a></li>' for _ in range(k)) + f"</ul></{tag}>", k
        return f"<{tag}{named}>" + " ".join(f'<a href="/{word()}">{line(1, 2)}</a>' for _ in range(k)) + f"</{tag}>", 1

    def aside(names: list[str], tags: list[str], a: int = 1, b: int = 20) -> tuple[str, int]:
        tag, name, k = rng.choice(tags), rng.choice(names), rng.randint(1, 3)
        named = f' {rng.choice(["class", "class", "id"])}="{name}"' if tag in ("div", "section", "p", "ul", "span") or rng.random() < 0.5 else ""
        if tag == "p" or rng.random() < 0.4:
            return f"<{tag}{named}>{sentence(a, b)}</{tag}>", 1
        inner = rng.choice(["p", "div", "li"])
        return f"<{tag}{named}>" + "".join(f"<{inner}>{sentence(a, b)}</{inner}>" for _ in range(k)) + f"</{tag}>", k

    def paragraph() -> str:
        text = " ".join(sentence() for _ in range(rng.choice([1, 1, 1, 2, 3, 5])))
        if rng.random() < 0.2:
            text += f' <a href="/x">{line(1, 4)}</a> ' + sentence()
        kind = rng.random()
        return f"<p><b>{text}<br>" if kind < 0.1 else f"<p>{text}" if kind < 0.15 else f"<blockquote>{text}</blockquote>" if kind < 0.18 else f"<h2>{line(1, 9)}</h2>" if kind < 0.25 else f"<ul><li>{text}</li></ul>" if kind < 0.28 else f"<p>{text}</p>"

    out = []
    others = tuple(f for f in families if f != "portal")
    for k in range(n):
        if others and (k % 2 or "portal" not in families):
            out.append(_other_page(others[k // 2 % len(others)], rng, line, sentence))
            continue
        body, gold = [], []

        def add(piece: tuple[str, int], main: int = 0, body: list = body, gold: list = gold) -> None:
            body.append(piece[0])
            gold.extend([main] * piece[1])

        adverts = lambda: aside(["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "ad-slot"], ["div", "div", "aside", "section"])
        notices = lambda: aside(["cookie", "cookie-notice", "notice", "consent", "newsletter", "alert", "paywall", "subscribe"], ["div", "div", "section", "aside"])
        if rng.random() < 0.3:
            add(notices())
        if rng.random() < 0.4:
            tag = rng.choice(["header", "header", "div"])
            body.append(f"<{tag}" + (' class="site-header"' if tag == "div" or rng.random() < 0.3 else "") + ">")
            add((f"<h1>{line(1, 4)}</h1>" if rng.random() < 0.4 else f"<p>{line(1, 8)}</p>", 1))
            if rng.random() < 0.5:
                add(menu("nav", ""))
            body.append(f"</{tag}>")
        if rng.random() < 0.8:
            add(menu(*rng.choice([("nav", ""), ("nav", ' class="menu"'), ("div", ' class="menu"'), ("div", ' id="nav"'), ("div", ' role="navigation"')])))
        if rng.random() < 0.5:
            body.append(f"<!-- {word()} -->")
            add(adverts())
        wrap = rng.choice(["<article>", "<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="main">', '<div class="article-body">', '<div class="post">', '<section class="story">', "<div>"])
        body.append(wrap)
        if rng.random() < 0.85:
            add((f"<h1>{line(1, 12)}</h1>", 1), 1)
        for _ in range(rng.randint(1, 12)):
            piece = paragraph()
            add((piece, 1), 1)
            if rng.random() < 0.06:
                add(adverts())
            if rng.random() < 0.03:
                add(aside(["share", "related", "social", "tags"], ["div", "ul", "aside"], 1, 6))
        comments = rng.random() < 0.35
        inside = comments and rng.random() < 0.3
        close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", wrap)))
        if not inside:
            body.append(close)
        if comments:
            tag = rng.choice(["section", "div", "aside", "ol"])
            body.append(f'<{tag} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comment-list", "reader-comments", "discussion", "replies"])}">')
            for _ in range(rng.randint(1, 5)):
                inner = rng.choice(["p", "div", "li"])
                add((f'<{inner} class="comment">{sentence(1, 40)}</{inner}>' if rng.random() < 0.7 else f"<{inner}>{sentence(1, 40)}</{inner}>", 1))
            body.append(f"</{tag}>")
        if inside:
            body.append(close)
        if rng.random() < 0.35:
            add(aside(["sidebar", "widget", "related", "side", "trending", "social"], ["aside", "div", "div"]))
        if rng.random() < 0.25:
            add((f"<form><label>{line(1, 5)}</label> <input name=q></form>" if rng.random() < 0.5 else f"<form class='search'><p>{line(1, 6)}</p></form>", 1))
        if rng.random() < 0.3:
            add(notices())
        if rng.random() < 0.85:
            tag, named = rng.choice([("footer", ""), ("footer", ""), ("footer", ' class="footer"'), ("div", ' id="footer"'), ("div", ' class="site-footer"')])
            add((f"<{tag}{named}>{rng.choice(['&copy; ', '&copy; ', ''])}{word()}.example &middot; {sentence(2, 12)}</{tag}>", 1))
        page = f"<!DOCTYPE html><html><head><title>{line(2, 9)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>" + "".join(body) + rng.choice(["</body></html>", "", "</body></html>"])
        out.append((page, gold))
    return out


TRAINING_PAGES = 1800


@lru_cache(maxsize=8)
def trained(families: tuple[str, ...] = FAMILIES) -> Chain:
    """The chain fitted on ``TRAINING_PAGES`` labelled pages of ``families``; seconds, and the same each time."""
    pages = []
    for page, gold in labelled_pages(TRAINING_PAGES, families=families):
        blocks = leaf_blocks(page)
        if len(blocks) == len(gold):
            pages.append(([own for _, own in blocks], gold))
    return fit(pages)


def main_text(page: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(page, chain.features)
    return "\n".join(text for (text, _), label in zip(blocks, chain.decode([own for _, own in blocks]), strict=True) if label)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    chain = chain or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h, chain) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
