"""The main text of a web page, by ratios of tag paths.

A page is read once into its blocks of text, each under its path of open elements.
Blocks of one path share its ratios: characters of text outside links, and
punctuation, to the number of its blocks. Fused with the ratio of the section they
stand in and smoothed over neighbours there, they give each path a figure; a path
whose figure is below a share of the page's mean (weighted by text) is no content.
Article prose has long, punctuated blocks under few paths; menus, buttons and
notices don't.

What an element says of itself weighs in: text of `article` and `main` counts for more,
and for the more the page has of it, the less the rest counts. Elements that are by
their meaning no article (menus, scripts), and sections whose class, id or role
says so, never become candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The share of the page's mean that a path's figure must reach, and the weights of a block and its two neighbours.
SHARE, NEAR, HERE = 0.2, 0.25, 0.5
#: What text that is marked as an article counts for, and what links may hold of a path's text at most.
MARKED, LINKED = 4.0, 0.5

#: Fixed values of the markup language: elements whose inside isn't markup, those that stand in a line but hold no text of it, and those that begin a block.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
MUTE = frozenset("svg math object audio video canvas button label select noscript template datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section"
    " summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open one of the first kind, looked for up to one of the second.
IMPLIED = {
    "li": ("li", "ul ol menu dir section article table td"),
    "dt": ("dt dd", "dl section article table td"),
    "dd": ("dt dd", "dl section article table td"),
    "tr": ("tr", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("caption thead tbody tfoot", "table"),
    "thead": ("caption", "table"),
    "tfoot": ("thead tbody", "table"),
    "body": ("head", "html"),
}
#: What the end of an element doesn't reach beyond; those of a table only look up to the table.
SCOPE = frozenset("table td th caption".split())
TABLE = frozenset("tbody thead tfoot tr td th caption".split())
#: Elements that hold no article text; those that mark it; parts of a section; headings.
NEVER = frozenset("head nav footer aside menu search legend dialog".split())
PROSE = frozenset("article main".split())
PART = frozenset("p h1 h2 h3 h4 h5 h6 li ol ul dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption hgroup address".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words by which the class or id of a section says that it is no article, and roles that do.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promos promotion banner"
    " comment comments commentlist disqus respond reply replies sidebar widget widgets menu menus nav navbar navigation breadcrumb"
    " breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing sharebar social related recommended recommendations trending"
    " toolbar pagination pager copyright disclaimer legal search skiplink hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())

_MARKUP = re.compile(
    r"<(?:!--(?:-?>|(?P<comment>.*?)(?:--!?>|\Z))|(?P<bogus>[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>=\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。！，：；？।؟،]")


class Element:
    """An open element. State 0 may hold content, 1 only if nothing else does, 2 never does.

    `section` is that of the elements in it, `home` that of its own text: a `div` with text
    stands for a paragraph of the section around it.
    """

    __slots__ = ("name", "path", "section", "home", "state", "prose", "titled")

    def __init__(self, name: str, path: int, section: int, home: int, state: int, prose: bool, titled: bool) -> None:
        self.name, self.path, self.section, self.home = name, path, section, home
        self.state, self.prose, self.titled = state, prose, titled


def _unwanted(values: dict[str, str]) -> set[str]:
    """The unwanted words in class and id, but for what the element is said not to have, or just to have beside it."""
    out = set()
    for token in f"{values.get('class', '')} {values.get('id', '')}".split():
        said = [w.lower() for w in _WORD.findall(token)]
        out.update(w for i, w in enumerate(said) if w in UNWANTED and (not i or said[i - 1] not in ("has", "with", "no", "without", "not")))
    return out


def _opened(name: str, values: dict[str, str], path: int, section: int, parent: Element) -> Element:
    state, titled = 0, parent.titled
    if name in NEVER or "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(values.get("style", "")):
        state = 2 if name not in ("html", "body") else 0
    elif name in PROSE:
        state = int(bool(UNWANTED.intersection(values.get("class", "").lower().split())))
    elif name not in ("html", "body", *HEADING):
        words = _unwanted(values) if values else set()
        if name == "header" or words == {"header"}:
            state, titled = 1, parent.prose  # an article's own header has its title
        elif name == "form" or words or values.get("role", "").strip().lower() in ROLES:
            state = 1
    above = parent.state
    if above == 1 and (name in HEADING and titled or not state and (name == "main" or name == "article" and parent.name == "form")):
        above = 0
    home = parent.section if name == "div" else section
    return Element(name, path, section, home, max(state, above), parent.prose or name in PROSE, titled)


class Block:
    """The text of a block, and how many of its characters are linked."""

    __slots__ = ("of", "text", "linked")

    def __init__(self, of: Element, text: str, linked: int) -> None:
        self.of, self.text, self.linked = of, text, linked


class _Reader:
    """Open elements while a page is read from start to end."""

    def __init__(self) -> None:
        self.stack = [Element("", 0, 0, 0, 0, False, False)]
        self.open: dict[str, int] = {}
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.sections = self.linked = self.link = 0

    def text(self, text: str) -> None:
        if self.stack[-1].name == "head" and not text.isspace():
            self.pop()
        text = unescape(text) if "&" in text else text
        self.pieces.append(text)
        if self.link:
            self.linked += len(text)

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(self.stack[-1], text, min(self.linked, len(text))))
            self.pieces, self.linked = [], 0

    def pop(self) -> None:
        self.open[self.stack.pop().name] -= 1
        if self.link > len(self.stack):  # a link ends with the element it began in
            self.link = 0

    def close(self, names: tuple[str, ...], within: frozenset[str]) -> None:
        """End the innermost element of these names, and what is open in it, unless one of `within` is further in."""
        if not any(self.open.get(n) for n in names):
            return
        depth = len(self.stack) - 1
        while depth and self.stack[depth].name not in names:
            if self.stack[depth].name in within:
                return
            depth -= 1
        while len(self.stack) > max(depth, 1):
            self.pop()

    def start(self, name: str, rest: str) -> None:
        self.flush()
        if self.stack[-1].name == "p" or self.stack[-1].name == "head" or name in HEADING and self.stack[-1].name in HEADING:
            self.pop()
        if name in IMPLIED:
            self.close(*_IMPLIED[name])
        if name in ("html", "body") and self.open.get(name):
            return
        values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest else {}
        parent, label = self.stack[-1], name
        if name not in PART:
            self.sections += 1
            first = (values.get("class") or values.get("id") or "").split()
            label = f"{name}.{first[0].rstrip('0123456789-_')}" if first else name
        path = self.paths.setdefault((parent.path, label), len(self.paths) + 1)
        self.stack.append(_opened(name, values, path, parent.section if name in PART else self.sections, parent))
        self.open[name] = self.open.get(name, 0) + 1

    def end(self, name: str) -> None:
        self.flush()
        if name in HEADING and name != "hgroup":
            self.close(_HEADINGS, SCOPE)
        elif name not in ("html", "body"):
            self.close((name,), _TABLE_ONLY if name in TABLE else frozenset() if name == "table" else SCOPE)


_IMPLIED = {name: (tuple(closed.split()), frozenset(within.split())) for name, (closed, within) in IMPLIED.items()}
_TABLE_ONLY, _HEADINGS = frozenset(["table"]), tuple(sorted(HEADING - {"hgroup"}))


def blocks(html: str) -> list[Block]:
    """The blocks of text of a page in order, with white space as single spaces."""
    page = _Reader()
    mute, inner = "", 0  # the element whose text is left out, and how many blocks are open in it
    at, n = 0, len(html)
    while at < n:
        to = html.find("<", at)
        if to != at and not mute:
            page.text(html[at : to if to >= 0 else n])
        if to < 0:
            break
        m = _MARKUP.match(html, to)
        if m is None:  # a lone sign
            if not mute:
                page.text("<")
            at = to + 1
            continue
        at = m.end()
        if m["name"] is None:  # a comment or a declaration
            continue
        if html[at - 1] != ">":  # the page ends amid a tag
            break
        name, ends = m["name"].lower(), bool(m["end"])
        if name in RAW and not ends:
            found = _RAW_END[name].search(html, at)
            at = found.end() if found else n
        elif mute:
            if ends and name == mute:
                mute = ""
            elif name in BLOCK:
                inner += -1 if ends else 1
                if inner < 0 and page.open.get(name):  # it was never ended
                    mute = ""
                    page.end(name)
        elif name in MUTE:
            if not ends and not m["rest"].endswith("/"):
                mute, inner = name, 0
        elif name in BLOCK:
            page.end(name) if ends else page.start(name, m["rest"])
        elif name == "a":
            page.link = 0 if ends else len(page.stack)
        elif name == "br":
            page.text(" ")
        elif name == "hr":
            page.end("p")
    page.flush()
    return page.blocks


def content(found: list[Block]) -> np.ndarray:
    """Which of a page's blocks are content, by the figures of their paths."""
    kept = np.zeros(len(found), bool)
    for allowed in (0, 1):
        at = [i for i, b in enumerate(found) if b.of.state <= allowed]
        if at and not kept.any():
            kept[at] = selected([found[i] for i in at])
    return kept


def selected(found: list[Block]) -> np.ndarray:
    chars = np.array([len(b.text) for b in found], float)
    own = chars - np.array([b.linked for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in found], float) * (own / chars)
    path = np.unique([b.of.path for b in found], return_inverse=True)[1]
    section = np.unique([b.of.home for b in found], return_inverse=True)[1]
    prose = np.array([b.of.prose for b in found])

    def figure(group: np.ndarray) -> np.ndarray:
        """The ratios of text and of punctuation to the number of blocks, fused, for each block's group."""
        count = np.bincount(group)
        return (np.bincount(group, own) / count * (1 + np.sqrt(np.bincount(group, marks) / count)))[group]

    fused = np.sqrt(figure(path) * figure(section))
    same = section[1:] == section[:-1]
    total, weight = HERE * fused, np.full(len(found), HERE)
    total[1:] += NEAR * fused[:-1] * same
    total[:-1] += NEAR * fused[1:] * same
    weight[1:] += NEAR * same
    weight[:-1] += NEAR * same
    smooth = total / weight
    by_path = (np.bincount(path, smooth) / np.bincount(path))[path]
    mean = np.average(smooth, weights=own) if own.any() else np.inf
    marked = own[prose].sum() / max(own.sum(), 1)
    by_path = by_path * np.where(prose, MARKED, (1 - marked) ** 2)
    linked = (np.bincount(path, chars - own) / np.bincount(path, chars))[path]
    return (by_path >= SHARE * mean) & (linked <= LINKED)


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    kept = content(found)
    return "\n".join([b.text for b, k in zip(found, kept.tolist()) if k])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages`.

    `text` has the article's blocks in page order, one on a line; it is empty for a NULL or empty
    page and where there is no article. Repeated rows and NULL ids stay; an empty table gives an
    empty result. Other columns aren't read. Pages are read whole, of any length; of a page with equal
    figures everywhere all candidates stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            cols = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    kept = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return kept.mapInArrow(run, "page_id long, url string, text string, n_chars long")
