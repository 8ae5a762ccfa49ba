"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements. Every node has a hidden state:
content, something else, or a frame around both; parent-child potentials say how states go on along the tree, node
potentials what content and the rest look like (tag, words in class and id, share
of linked text, length, sentence ends). A sum-product pass from the leaves up and
one from the root down give each node's exact marginal; the text runs of nodes
whose marginal is at least a half are the main text.

Both kinds of potentials are counted, with Laplace smoothing, from labelled
pages: layouts with menus, headers, footers, sidebars, notices, adverts, forms
and comments around, between and inside articles (``labelled_pages``).
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 800
#: Fixed values of HTML: what is never text (RAW: its content holds no tags), and which elements make blocks.
RAW = frozenset("script style textarea iframe title".split())
SILENT = frozenset("noscript template svg object select button head audio video canvas".split())
#: Silent elements that hold none of their own name: a second start tag means that the first one wasn't closed.
FLAT = frozenset("select button head".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split())
#: A start tag of the key ends an open element of the value (within the nearest block around).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}}
#: Words in class, id and role, by what they hint at.
HINTS = {
    "content": "article content post entry story main body text articlebody prose reading",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager tabs toc skip topics",
    "head": "header masthead topbar banner branding logo sitehead",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar side aside widget related recommended popular trending more promo teaser rail",
    "notice": "cookie cookies consent notice gdpr alert modal popup overlay newsletter subscribe signup privacy warning dialog message",
    "advert": "ad ads advert advertisement advertising sponsor sponsored adsense dfp",
    "comment": "comment comments disqus reply replies respond discussion reader feedback",
    "share": "share sharing social follow like rating",
    "form": "form search login contact poll survey",
}
_HINT = {w: kind for kind, line in HINTS.items() for w in line.split()}
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S)
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|data-y|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Block tree of a page: ``parent`` and ``observed`` per node (parents come
    first), and its text runs (node, text)."""

    def __init__(self, source: str) -> None:
        self.parent, self.tags, self.hints, self.label, self.inside = [-1], ["html"], [frozenset()], [None], [False]
        self.words, self.linked, self.stops, self.runs = [0], [0], [0], []
        self.open = [0]  # nodes
        self.pending: list[str] = []
        self.links = 0
        self._parse(source)

    def _parse(self, source: str) -> None:
        tags, at, n = self._tags(source), 0, len(source)
        i = 0
        while i < len(tags):
            begin, end, name, closing, attributes = tags[i]
            i += 1
            if begin > at:
                self._text(source[at:begin])
            at = end
            if name in SILENT:
                if not closing and not attributes.endswith("/"):
                    i = self._after_silent(tags, i, name)
                    # up to the end tag's end, or to the block that ends an unclosed element
                    at = tags[i - 1][1] if i and tags[i - 1][2] == name and tags[i - 1][3] else tags[i][0] if i < len(tags) else n
            elif name == "a":
                self.links = max(0, self.links + (-1 if closing else 1))
            elif name in BLOCK:
                self._flush()
                self._close(name) if closing else self._start(name, attributes)
            elif name == "br" or name in VOID:
                self.pending.append(" ")
        if at < n:
            self._text(source[at:])
        self._flush()

    @staticmethod
    def _tags(source: str) -> list[tuple[int, int, str, bool, str]]:
        """(begin, end, name, is an end tag, attributes) of the tags; comments and raw
        elements with their content have no name. An unclosed raw element goes on to
        the end of the page, but for a title, which is no more than its tag."""
        out, at = [], 0
        for m in _TAG.finditer(source):
            if m.start() < at:
                continue  # inside a raw element
            at, name = m.end(), (m.group(2) or m.group(5) or "").lower()
            closing, attributes = bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
            if name in RAW:
                if not closing and not attributes.endswith("/"):
                    over = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    at = over.end() if over else at if name == "title" else len(source)
                name = ""
            out.append((m.start(), at, name, closing, attributes))
        return out

    def _after_silent(self, tags: list, i: int, name: str) -> int:
        """The tag at which text goes on after the start tag ``i`` - 1 of a silent
        element: behind its end tag. If the block around it ends first, or the page, the
        element wasn't closed and ends at the next block."""
        around, inner, depth, first_block = {self.tags[v] for v in self.open}, [], 1, len(tags)
        for k in range(i, len(tags)):
            _, _, tag, closing, _ = tags[k]
            if tag == name:
                depth += -1 if closing else 1
                if not depth:
                    return k + 1
                if not closing and name in FLAT:
                    return min(first_block, k)
            elif tag in BLOCK:
                first_block = min(first_block, k)
                if name == "head" and tag == "body":
                    return k
                if not closing:
                    inner.append(tag)
                elif tag in inner:
                    while inner.pop() != tag:
                        pass
                elif tag in around:
                    return first_block
        return first_block if first_block < len(tags) or name != "head" else i

    def _text(self, raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        self.pending.append(text)
        if self.links:
            self.linked[self.open[-1]] += len(text.split())

    def _flush(self) -> None:
        if not self.pending:
            return
        text = " ".join("".join(self.pending).split())
        self.pending = []
        if text:
            node = self.open[-1]
            self.words[node] += text.count(" ") + 1
            self.stops[node] += text[-1] in ".!?:;\"”»…"
            self.runs.append((node, text))

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            if name == "body" and "body" in self.tags or name == "html":
                return
        if name != "hr":
            self._pop_p()
        ends = ENDS.get(name)
        if ends:
            for i in range(len(self.open) - 1, 0, -1):
                tag = self.tags[self.open[i]]
                if tag in SCOPE[name]:
                    break
                if tag in ends:
                    del self.open[i:]
                    break
        if name == "hr":
            return
        found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTR.findall(attributes)} if attributes else {}
        hints = {_HINT[p.lower()] for k in ("class", "id", "role") if k in found for p in _PART.findall(found[k]) if p.lower() in _HINT}
        style = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style:
            hints.add("hidden")
        above = self.open[-1]
        self.parent.append(above)
        self.tags.append(name)
        self.hints.append(frozenset(hints))
        self.label.append({"1": 1, "0": 0}.get(found.get("data-y"), self.label[above]))
        self.inside.append(self.inside[above] or name in ("article", "main"))
        self.words.append(0)
        self.linked.append(0)
        self.stops.append(0)
        self.open.append(len(self.parent) - 1)
        self.links = 0

    def _pop_p(self) -> None:
        """A block ends an open paragraph."""
        if self.tags[self.open[-1]] == "p":
            self.open.pop()
            self.links = 0

    def _close(self, name: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[i]] == name:
                del self.open[i:]
                self.links = 0
                return
            if name == "p" and self.tags[self.open[i]] not in ("p",):
                return  # an end tag without a start

    def observations(self) -> list[list[str]]:
        """The features of every node."""
        below_words, below_links = self.words[:], self.linked[:]
        for v in range(len(self.parent) - 1, 0, -1):
            below_words[self.parent[v]] += below_words[v]
            below_links[self.parent[v]] += below_links[v]
        out = []
        for v, tag in enumerate(self.tags):
            n, own = below_words[v], self.words[v]
            share = below_links[v] / n if n else 0.0
            linked = 0 if share == 0 else 1 if share < 0.34 else 2 if share < 0.75 else 3
            out.append([
                f"tag {tag}{' in' if self.inside[v] else ''} linked {linked}",
                *(f"hint {h}" for h in sorted(self.hints[v])), *(("no hint",) if not self.hints[v] else ()),
                f"own {0 if not own else 1 if own < 4 else 2 if own < 12 else 3 if own < 40 else 4}",
                f"stop {'-' if not own else int(self.stops[v] > 0)}"])
        return out


#: States: not content; content; a container that holds some of both.
REST, CONTENT, FRAME = 0, 1, 2


def states(page: Page) -> list[int]:
    """The labelled state of every node: what isn't content but has content
    below is a frame."""
    out = [y or REST for y in page.label]
    for v in range(len(out) - 1, 0, -1):
        if out[v] in (CONTENT, FRAME) and out[page.parent[v]] == REST:
            out[page.parent[v]] = FRAME
    return out


class TreeModel:
    """Potentials of the three states; fitted by counting.

    ``weight``: feature -> log likelihood per state; ``step``: probability of a
    node's state given its parent's; the root is a frame.
    """

    def __init__(self, weight: dict[str, tuple], step: list[list[float]]) -> None:
        self.weight, self.step = weight, step

    @classmethod
    def fit(cls, pages: list[Page], smooth: float = 0.05) -> TreeModel:
        seen: dict[str, list[float]] = {}
        totals, steps = [0.0] * 3, [[smooth] * 3 for _ in range(3)]
        for page in pages:
            hidden = states(page)
            for v, features in enumerate(page.observations()):
                totals[hidden[v]] += 1
                for f in features:
                    seen.setdefault(f, [smooth] * 3)[hidden[v]] += 1
                if page.parent[v] >= 0:
                    steps[hidden[page.parent[v]]][hidden[v]] += 1
        weight = {f: tuple(math.log(c / (t + 2 * smooth)) for c, t in zip(counts, totals)) for f, counts in seen.items()}
        return cls(weight, [[x / sum(row) for x in row] for row in steps])

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every node: messages up, then down (in logarithms)."""
        exp, log, none = math.exp, math.log, (0.0, 0.0, 0.0)
        t = self.step
        up = []
        for features in page.observations():
            known = [self.weight.get(f, none) for f in features]
            up.append([sum(w[s] for w in known) for s in range(3)])
        message = [none] * len(up)
        for v in range(len(up) - 1, 0, -1):
            most = max(up[v])
            e0, e1, e2 = (exp(x - most) for x in up[v])
            message[v] = m = [log(row[0] * e0 + row[1] * e1 + row[2] * e2) for row in t]
            above = up[page.parent[v]]
            above[0] += m[0]
            above[1] += m[1]
            above[2] += m[2]
        total = [u[:] for u in up]
        total[0][REST] -= 20.0
        total[0][CONTENT] -= 20.0
        for v in range(1, len(up)):
            rest = [x - m for x, m in zip(total[page.parent[v]], message[v])]  # the parent without this child
            most = max(rest)
            e0, e1, e2 = (exp(x - most) for x in rest)
            total[v] = [up[v][s] + log(e0 * t[0][s] + e1 * t[1][s] + e2 * t[2][s]) for s in range(3)]
        out = []
        for x in total:
            most = max(x)
            e = [exp(y - most) for y in x]
            out.append(e[CONTENT] / sum(e))
        return out


def extract(source: str | None, model: TreeModel) -> str:
    """Main text: runs of content nodes in page order, joined by empty lines."""
    if not source:
        return ""
    page = Page(source)
    keep = model.marginals(page)
    return "\n\n".join(text for v, text in page.runs if keep[v] >= 0.5)


# ---- labelled pages ----------------------------------------------------------

def labelled_pages(n: int = TRAINING_PAGES, seed: int = 7) -> list[str]:
    """Pages whose elements say in ``data-y`` whether they are content (1) or
    not (0); elements without the mark are what their parent is."""
    r = random.Random(seed)

    def prose(low: int, high: int) -> str:
        words = ["".join(r.choice("aeiounrstlmd") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
        return " ".join(words).capitalize() + r.choice([".", ".", ".", ".", "!", "", ":"])

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/x">{prose(1, 3)}</a></{tag}>' for _ in range(n))

    def menu() -> str:
        return r.choice([f"<nav data-y=0><ul>{links(r.randint(3, 9))}</ul></nav>", f'<div class="menu" data-y=0><ul>{links(6)}</ul></div>',
                         f'<ul class="nav" data-y=0>{links(5)}</ul>', f'<div id="breadcrumbs" data-y=0>{links(3, "span")}</div>'])

    def advert() -> str:
        return r.choice([f'<div class="ad" data-y=0>{prose(4, 20)}</div>', f'<div class="ads sponsored" data-y=0><p>{prose(4, 20)}</p></div>',
                         f'<aside class="advert" data-y=0><a href="/b">{prose(3, 9)}</a></aside>'])

    def notice() -> str:
        return r.choice([f'<div class="cookie-notice" data-y=0><p>{prose(8, 25)}</p><button>OK</button></div>',
                         f'<div id="newsletter" data-y=0><p>{prose(5, 15)}</p><form><input name="m"></form></div>',
                         f'<section class="consent banner" data-y=0><h2>{prose(2, 4)}</h2><p>{prose(8, 30)}</p></section>',
                         f'<div role="alert" class="notice" data-y=0>{prose(5, 20)}</div>'])

    def form() -> str:
        return f'<form data-y=0><p>{prose(2, 6)}</p><label>{prose(1, 2)}</label><input name="q"><select><option>a</option></select></form>'

    def sidebar() -> str:
        return r.choice([f"<aside data-y=0><h3>{prose(1, 4)}</h3><ul>{links(5)}</ul></aside>",
                         f'<div class="sidebar" data-y=0><div class="widget"><h3>{prose(1, 3)}</h3><p>{prose(5, 30)}</p></div></div>',
                         f'<section class="related" data-y=0><h2>{prose(1, 3)}</h2><ul>{links(4)}</ul></section>'])

    def comments() -> str:
        one = lambda: f'<div class="comment"><p>{prose(3, 40)}</p></div>'
        return r.choice([f'<section class="comments" data-y=0><h2>{prose(1, 2)}</h2>{one()}{one()}</section>',
                         f'<div id="comments" data-y=0><ol><li>{prose(4, 30)}</li><li>{prose(4, 30)}</li></ol>{form()}</div>',
                         f'<ul class="comment-list" data-y=0><li><p>{prose(5, 40)}</p></li></ul>'])

    def block() -> str:
        return r.choices([
            f"<p>{prose(1, 4)}</p>", f"<p>{prose(8, 60)}</p>", f"<p>{prose(5, 30)} <a href='/y'>{prose(1, 3)}</a> {prose(3, 20)}</p>",
            f"<p><b>{prose(5, 40)}<br>", f"<h2>{prose(1, 6)}</h2>", f"<ul><li>{prose(1, 12)}</li><li>{prose(2, 12)}</li></ul>",
            f"<ol><li>{prose(2, 12)}</li></ol>", f"<blockquote><p>{prose(6, 30)}</p></blockquote>", f"<pre>{prose(3, 20)}</pre>",
            f"<table><tr><th>{prose(1, 2)}</th><td>{prose(1, 4)}</td></tr></table>",
            f"<figure><img src='i'><figcaption>{prose(3, 10)}</figcaption></figure>", f"<h3>{prose(1, 5)}</h3>",
            f"<div>{prose(6, 40)}</div>", f"<section><h2>{prose(1, 5)}</h2><p>{prose(8, 40)}</p></section>", f"<dl><dt>{prose(1, 2)}</dt><dd>{prose(2, 9)}</dd></dl>"],
            [6, 12, 4, 3, 3, 2, 1, 1, 1, 1, 1, 1, 2, 1, 1])[0]

    def article() -> str:
        inner = [f"<h1>{prose(2, 9)}</h1>" if r.random() < 0.7 else f"<header><h1>{prose(2, 9)}</h1></header>"]
        for _ in range(r.randint(2, 14)):
            inner.append(block())
            if r.random() < 0.06:
                inner.append(r.choice([advert, sidebar, notice, form])())
        inner = "".join(inner)
        if r.random() < 0.1:
            inner += f"<footer data-y=0><p>{prose(2, 9)}</p></footer>"
        return r.choice([
            f"<article data-y=1>{inner}</article>", f"<article data-y=1>{inner}</article>", f"<main data-y=1>{inner}</main>",
            f"<main data-y=1><article>{inner}</article></main>", f'<div class="content" data-y=1>{inner}</div>',
            f'<div class="post" data-y=1><div class="entry-content">{inner}</div></div>', f'<div id="main-text" data-y=1>{inner}</div>',
            f'<article class="story" data-y=1><div class="article-body">{inner}</div></article>'])

    def header() -> str:
        return r.choice([f"<header data-y=0><h1>{prose(1, 3)}</h1>{menu()}</header>", f'<div class="header" data-y=0><p>{prose(1, 6)}</p></div>',
                         f'<header data-y=0><p>{prose(2, 8)}</p></header>', menu()])

    def footer() -> str:
        return r.choice([f"<footer data-y=0>&copy; {prose(3, 15)}</footer>", f"<footer data-y=0><p>{prose(3, 15)}</p><ul>{links(4)}</ul></footer>",
                         f'<div class="footer" data-y=0>{prose(3, 15)}</div>', f'<div id="copyright" data-y=0><p>{prose(2, 9)}</p></div>'])

    pages = []
    for _ in range(n):
        parts = [header()]
        parts += [f() for f in (notice, menu, advert) if r.random() < 0.5]
        middle = [article()] + [f() for f in (sidebar, comments, advert, form, notice) if r.random() < 0.4]
        if r.random() < 0.3:
            middle.insert(0, sidebar())
        middle = "".join(middle)
        parts.append(r.choice([middle, middle, f'<div class="wrapper">{middle}</div>', f'<div id="page"><div class="row">{middle}</div></div>']))
        parts.append(footer())
        pages.append(f"<!DOCTYPE html><html><head><title>{prose(2, 6)}</title></head><body data-y=0>{''.join(parts)}</body></html>")
    return pages


def trained_model(n: int = TRAINING_PAGES) -> TreeModel:
    return TreeModel.fit([Page(p) for p in labelled_pages(n)])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row: the main text of the whole page,
    empty if there is none, and its code points.

    Null and empty pages have an empty text; broken markup is read as far as it
    goes. Null and repeated ids stay separate rows; an empty table gives no
    rows; other columns are not read.
    """
    fitted = trained_model()
    sent = pages.sparkSession.sparkContext.broadcast((fitted.weight, fitted.step))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = TreeModel(*sent.value)
        for batch in batches:
            texts = [extract(h if isinstance(h, str) else None, model) for h in batch["html"]]
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, url string, text string, n_chars bigint")
