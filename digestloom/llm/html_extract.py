"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (runs of text between block tags) in page order. Each block has features of its
ancestors' tags, classes and ids and of its text; a chain of two states, main text or not, is scored by the CRF and
decoded by Viterbi. The CRF is trained on the driver by stochastic gradient on labelled pages that ``training_pages``
writes from a fixed seed: many layouts with menus, headers, notices, adverts, forms, comments and footers. Pages are
read in one narrow pass.

Defined results: null, empty or text-free html gives an empty text; broken markup is read as far as it goes (an
unclosed tag ends with the page, a stray closing tag is skipped); repeated rows give equal rows; other columns are
ignored.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

PAGES, EPOCHS, SEED = 300, 6, 11
SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_main long"

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(script|style|noscript|template|svg|iframe|object|title|select|textarea|math|canvas)\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*>)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# HTML's own kinds of elements.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s",
    "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br", "input", "nobr", "ruby", "rt", "rp",
}
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}}
ENDS_P = {"div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "aside", "nav", "header", "footer", "form", "pre", "blockquote", "figure", "dl", "hr", "main", "fieldset"}
SPACE, DIGIT = re.compile(r"\s+"), re.compile(r"\d")
NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    """A leaf block: its text, its ancestors' marks (None where only their score is wanted) and the last of them, the
    characters in links, and the sum of the ancestors' weights."""

    text: str
    marks: tuple[str, ...] | None
    last: str
    linked: int
    score: float


class Ancestors:
    """The open elements. Their marks are kept once each, in order of opening, so that opening and closing an element
    costs its own marks only, however deep it stands."""

    def __init__(self, weights: dict[str, float] | None) -> None:
        self.weights, self.score = weights, 0.0
        self.open: list[tuple[str, int, float]] = []
        self.names: Counter[str] = Counter()
        self.marks: list[str] = []
        self.known: set[str] = set()

    def push(self, name: str, marks: list[str]) -> None:
        self.open.append((name, len(self.marks), self.score))
        self.names[name] += 1
        for m in marks:
            if m not in self.known:
                self.known.add(m)
                self.marks.append(m)
                if self.weights is not None:
                    self.score += self.weights.get(m, 0.0)

    def pop(self) -> str:
        name, at, self.score = self.open.pop()
        self.names[name] -= 1
        self.known.difference_update(self.marks[at:])
        del self.marks[at:]
        return name


def blocks(page: str, weights: dict[str, float] | None = None) -> list[Block]:
    """The leaf blocks in page order, references decoded; with ``weights``, ancestors are scored instead of listed."""
    out: list[Block] = []
    above = Ancestors(weights)
    text: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if not text:
            return
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            out.append(Block(whole, tuple(above.marks) if weights is None else None, above.marks[-1] if above.marks else "", min(linked, len(whole)), above.score))
        text.clear()
        linked = 0

    for m in TAG.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            linked += (m.start() - at) * bool(in_link)
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if m[2] else 1
            elif name == "br":
                text.append(" ")
            continue
        flush()
        in_link = 0
        if m[2]:
            if above.names[name]:
                while above.pop() != name:
                    pass
        else:
            closed = CLOSES.get(name) or ({"p"} if name in ENDS_P else ())
            while above.open and above.open[-1][0] in closed:
                above.pop()
            if name not in VOID and not m[4].rstrip().endswith("/"):
                marks = {f"<{name}>"}
                if m[4]:
                    for a in ATTRIBUTE.finditer(m[4]):
                        marks |= {f"{kind}:{w}" for w in NAME.findall((a[2] or a[3] or a[4] or "").lower()) for kind in (a[1].lower()[:5], "any")}
                above.push(name, sorted(marks))
    if at < len(page):
        tail = page[at:]
        # A tag that the page's end cuts off is no text.
        text.append(tail[: tail.rfind("<")] if "<" in tail and ">" not in tail[tail.rfind("<") :] and re.match(r"<[/a-zA-Z!]", tail[tail.rfind("<") :]) else tail)
    flush()
    return out


HINTS = re.compile(r"©|\b(?:cookies?|subscribe|newsletter|advert\w*|sponsored|comments?|reply|copyright|rights reserved|sign in|log in|share|related|menu|privacy)\b", re.I)


def own_features(block: Block, k: int, n: int) -> list[str]:
    """What block number ``k`` of ``n`` shows besides its ancestors' marks; shares are of the whole text."""
    text, size = block.text, len(block.text)
    out = ["bias", f"parent {block.last}", f"size {min(9, size.bit_length())}", f"links {block.linked * 4 // max(size, 1)}", f"place {10 * k // n}"]
    if text[-1] in ".!?…\"'»”":
        out.append("sentence end")
    if text.count(". ") >= 2:
        out.append("sentences")
    if 40 * sum(map(len, HINTS.findall(text))) >= size:
        out.append("hint")
    if 4 * len(DIGIT.findall(text)) > size:
        out.append("digits")
    return out


def features(block: Block, k: int, n: int) -> list[str]:
    return [*block.marks, *own_features(block, k, n)]


class Chain:
    """A two-state linear-chain CRF: weights by feature and state, and transitions."""

    def __init__(self) -> None:
        self.w: dict[str, float] = {}
        self.t = [[0.0, 0.0], [0.0, 0.0]]

    def scores(self, page: list[list[str]]) -> list[float]:
        get = self.w.get
        return [sum(get(f, 0.0) for f in block) for block in page]

    def decode(self, scores: list[float]) -> list[int]:
        """Viterbi: 1 for main text. A block's score counts for state 1, state 0 scores 0."""
        if not scores:
            return []
        t, best, back = self.t, (0.0, 0.0), []
        for k, s in enumerate(scores):
            if not k:
                best = (0.0, s)
                continue
            to = []
            step = []
            for y in (0, 1):
                a, b = best[0] + t[0][y], best[1] + t[1][y]
                step.append(int(b > a))
                to.append(max(a, b) + s * y)
            best = (to[0], to[1])
            back.append(step)
        y = int(best[1] > best[0])
        path = [y]
        for step in reversed(back):
            y = step[y]
            path.append(y)
        return path[::-1]

    def marginals(self, s: list[float]) -> tuple[list[float], list[list[list[float]]]]:
        """(each block's probability of state 1, each pair of neighbours' probabilities by their states), by
        forward-backward in logs."""
        n, t = len(s), self.t
        f = [(0.0, s[0])]
        for k in range(1, n):
            f.append(tuple(_add(f[-1][0] + t[0][y], f[-1][1] + t[1][y]) + s[k] * y for y in (0, 1)))
        b = [(0.0, 0.0)]
        for k in range(n - 1, 0, -1):
            b.append(tuple(_add(t[y][0] + b[-1][0], t[y][1] + s[k] + b[-1][1]) for y in (0, 1)))
        b.reverse()
        z = _add(*f[-1])
        pairs = [[[math.exp(f[k - 1][x] + t[x][y] + s[k] * y + b[k][y] - z) for y in (0, 1)] for x in (0, 1)] for k in range(1, n)]
        return [math.exp(f[k][1] + b[k][1] - z) for k in range(n)], pairs

    def fit(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, seed: int = SEED) -> Chain:
        """AdaGrad on the log-likelihood; marginals by forward-backward in logs."""
        rng = random.Random(seed)
        seen: dict[str, float] = {}
        seen_t = [[1e-6, 1e-6], [1e-6, 1e-6]]
        pages = list(pages)
        for _ in range(epochs):
            rng.shuffle(pages)
            for xs, ys in pages:
                t = self.t
                single, pairs = self.marginals(self.scores(xs))
                for k, block in enumerate(xs):
                    g = ys[k] - single[k]
                    if abs(g) > 1e-4:
                        for name in block:
                            w = self.w.get(name, 0.0)
                            step = g - decay * w
                            seen[name] = seen.get(name, 1e-6) + step * step
                            self.w[name] = w + rate * step / math.sqrt(seen[name])
                    if k:
                        for x in (0, 1):
                            for y in (0, 1):
                                step = (ys[k - 1] == x and ys[k] == y) - pairs[k - 1][x][y]
                                seen_t[x][y] += step * step
                                t[x][y] += 0.1 * rate * step / math.sqrt(seen_t[x][y])
        return self


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


MAIN, REST = "main", "rest"


def training_pages(n: int = PAGES, seed: int = SEED, broken: bool = True) -> Iterator[tuple[str, list[str]]]:
    """(html, the main blocks' texts in order) of ``n`` invented pages of many layouts; ``broken``: with headings in
    unclosed bold, and every third page a plain blog's."""
    rng = random.Random(seed)
    syllables = ["ta", "ro", "mi", "sel", "un", "dor", "ka", "ler", "ön", "fi", "va", "gré", "st", "ing", "pa", "ñe", "zu", "ber"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: words(3, 16).capitalize() + rng.choice(".....!?")
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    pick = rng.choice

    for number in range(n):
        main: list[str] = []

        def keep(text: str) -> str:
            main.append(SPACE.sub(" ", text).strip())
            return html.escape(text, quote=pick([True, False]))

        def links(a: int, b: int) -> str:
            return "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(rng.randint(a, b)))

        def menu() -> str:
            body = f"<ul>{links(3, 9)}</ul>"
            return pick([f"<nav>{body}</nav>", f"<nav>{body}</nav>", f'<div class="{pick(["menu", "nav", "navbar", "navigation", "topbar", "breadcrumb"])}">{body}</div>', f'<ul id="menu">{links(3, 8)}</ul>', f'<div role="navigation">{body}</div>'])

        def header() -> str:
            inner = pick([f"<h1>{words(1, 4)}</h1>", f"<p>{words(1, 6)}</p>", f'<div class="logo"><a href="/">{words(1, 2)}</a></div><p>{sentence()}</p>'])
            return pick([f"<header>{inner}</header>", f'<div id="header" class="{pick(["site-header", "masthead", "banner"])}">{inner}</div>', ""])

        def advert() -> str:
            name = pick(["ad", "ads", "advert", "ad-box", "sponsored", "promo", "banner-ad"])
            return pick([f'<div class="{name}">{prose(1, 3)}</div>', f'<div class="{name}"><p>{prose(1, 2)}</p></div>', f'<aside class="{name}"><p>{prose(1, 3)}</p></aside>', f'<section id="{name}">{prose(1, 2)}</section>', f'<ins class="{name}">{prose(1, 2)}</ins>' * 0])

        def notice() -> str:
            name = pick(["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "modal", "popup", "newsletter", "subscribe", "paywall"])
            return pick([f'<div class="{name}"><p>{pick(["We use cookies.", "Subscribe to our newsletter.", ""])} {prose(1, 3)}</p><button>OK</button></div>', f'<div id="{name}">{prose(1, 3)}</div>', f'<dialog class="{name}"><p>{prose(1, 2)}</p></dialog>'])

        def side() -> str:
            inner = pick([f"<h3>{words(1, 3)}</h3><ul>{links(2, 7)}</ul>", f"<p>{prose(1, 4)}</p>", f"<h4>{words(1, 3)}</h4><p>{prose(1, 3)}</p><p>{prose(1, 2)}</p>"])
            return pick([f"<aside>{inner}</aside>", f'<div class="{pick(["sidebar", "widget", "related", "side", "recommended", "rail"])}">{inner}</div>', f'<div id="sidebar">{inner}</div>', f'<section class="related">{inner}</section>'])

        def form() -> str:
            return pick([f'<form action="/s"><label>{words(1, 4)}</label><input name="q"><button>{word()}</button></form>', f'<form class="{pick(["search", "login", "signup", "contact"])}"><p>{prose(1, 2)}</p><fieldset><legend>{words(1, 2)}</legend><label>{words(1, 2)}<input></label></fieldset><button>{word()}</button></form>', f'<div class="search-form"><form><p>{sentence()}</p></form></div>'])

        def comments() -> str:
            one = lambda: pick([f'<div class="comment"><p class="author">{words(1, 2)}</p><p>{prose(1, 4)}</p></div>', f'<li class="comment"><b>{word()}</b> {prose(1, 3)}</li>', f"<article class=\"comment\"><p>{prose(1, 4)}</p></article>"])
            body = "".join(one() for _ in range(rng.randint(1, 5)))
            return pick([f'<section class="comments"><h2>{pick(["Comments", words(1, 2)])}</h2>{body}</section>', f'<div id="comments">{body}</div>', f'<ol class="{pick(["comment-list", "replies", "discussion", "responses"])}">{body}</ol>', f'<div class="user-comments">{body}</div>'])

        def share() -> str:
            return pick([f'<div class="{pick(["share", "social", "tags", "byline-links"])}"><a href="#">{word()}</a> <a href="#">{word()}</a></div>', ""])

        def footer() -> str:
            return pick([f"<footer>&copy; {word()}.example &middot; {sentence()}</footer>", f"<footer><p>&copy; {words(1, 3)}</p><ul>{links(2, 5)}</ul></footer>", f'<div class="{pick(["footer", "site-footer", "bottom", "copyright", "legal"])}"><p>{pick(["Copyright", "All rights reserved.", ""])} {prose(1, 3)}</p></div>', f'<div id="footer">{prose(1, 2)}</div>'])

        def body(inner: list) -> str:
            parts = []
            title = words(2, 10)
            shown = pick([True, True, False])
            if shown:
                parts.append(f"<h1>{keep(title)}</h1>")
            if rng.random() < 0.5 and broken:
                # A heading in unclosed bold, then a break.
                parts.append(f"<p><b>{keep(title + '.')}<br>")
            for _ in range(rng.randint(1, 9)):
                kind = rng.random()
                if kind < 0.68:
                    parts.append(f"<p>{keep(prose(1, 7))}" + pick(["</p>", "</p>", "</p>", ""]))
                elif kind < 0.74:
                    level = pick("234")
                    parts.append(f"<h{level}>{keep(words(1, 6))}</h{level}>")
                elif kind < 0.79:
                    parts.append("<ul>" + "".join(f"<li>{keep(words(2, 12))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
                elif kind < 0.84:
                    parts.append(f"<blockquote>{keep(prose(1, 3))}</blockquote>")
                elif kind < 0.88:
                    parts.append("<table><tr>" + "".join(f"<td>{keep(words(1, 5))}</td>" for _ in range(rng.randint(2, 5))) + "</tr></table>")
                elif kind < 0.92:
                    parts.append(f"<pre>{keep(words(3, 20))}</pre>")
                elif broken:
                    parts.append(f"<p><b>{keep(sentence())}<br>")
                if inner and rng.random() < 0.25:
                    parts.append(inner.pop()())
            return "".join(parts)

        inside = [x for x in (advert, share, side, comments, notice) if rng.random() < 0.3]
        wrap = pick(["<article>{}</article>"] * 6 + ["<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="content"><div class="post">{}</div></div>', '<div class="entry-content">{}</div>', '<div id="main" class="article-body">{}</div>', '<section class="story">{}</section>', "<div>{}</div>"])
        top = [x for x in (menu, menu, header, advert, notice, form, side) if rng.random() < 0.45]
        end = [x for x in (side, comments, comments, advert, form, footer, footer, notice, menu) if rng.random() < 0.4]
        if broken and number % 3 == 0:
            top, end, inside = [menu, advert], [footer], []
        rng.shuffle(inside)
        before = "".join(f() for f in top)
        middle = wrap.replace("{}", body(inside) + "".join(f() for f in inside))
        after = "".join(f() for f in end)
        head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{words(1, 6)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        yield f"{head}<body>{before}{middle}{after}</body></html>", main


def labelled(page: str, main: list[str]) -> tuple[list[list[str]], list[int]]:
    """Features and labels: a block is main text if it is the next of ``main``."""
    found, labels, left = blocks(page), [], list(main)
    for block in found:
        labels.append(int(block.text in left))
        if labels[-1]:
            left.remove(block.text)
    return [features(b, k, len(found)) for k, b in enumerate(found)], labels


def train(n: int = PAGES, seed: int = SEED) -> Chain:
    return Chain().fit([x for page, main in training_pages(n, seed) if (x := labelled(page, main))[0]])


def main_text(page: str, model: Chain) -> tuple[str, int, int]:
    """(main text, blocks, main blocks)."""
    found, get = blocks(page, model.w), model.w.get
    states = model.decode([b.score + sum(get(f, 0.0) for f in own_features(b, k, len(found))) for k, b in enumerate(found)])
    kept = [b.text for b, y in zip(found, states) if y]
    return " ".join(kept), len(found), len(kept)


def extract(pages: DataFrame, model: Chain | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_main of every page."""
    weights = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [main_text(x or "", weights) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array([g[0] for g in got], pa.string()), *(pa.array(x, pa.int64()) for x in ([len(g[0]) for g in got], [g[1] for g in got], [g[2] for g in got]))],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
