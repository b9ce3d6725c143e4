"""The main text of web pages by the distribution of text over line blocks.

1. Strip: markup is read once from left to right. Every block element makes a line of text; scripts, styles, comments
   and the like make none. A line is *muted*, its length counts as 0, where its place says that it is no article text:
   inside menus, headers, footers, sidebars, notices, adverts, forms and reader comments, by element, role, or a word of
   ``class`` and ``id``. In a page that marks its article (``article``, ``main``, role ``main``) all lines outside it are
   muted too; in another page, lines that are mostly links.
2. Window: the lengths of ``WINDOW`` consecutive lines are summed for every line.
3. Surge and dive: text surges where the sum rises over the threshold and ends where it dives to 0. What lies between is
   kept, without its muted lines. The threshold is 0 where an article is marked, since its markup says what belongs to
   it; else ``SURGE`` code points, or the largest sum if none is above that.

White space (that of Unicode, no-break spaces included) is turned into one space inside a line, ``br`` and table cells
count as white space, character references are decoded as HTML 5 says. A header inside an article keeps its headings.
An unclosed comment or script hides the rest of the page, as it does in browsers.

A null or empty page, one without text, or one with muted text only, gives an empty text. Repeated rows each get their
own. Nothing is cut: a page of any length is one task's row, read in one pass. Extra columns are ignored by ``digest``;
``extract`` carries columns of any name in the struct ``page``.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
SURGE = 86
OUTPUT_CHARS = 1 << 19

# Element names of HTML and words that mark what is no article text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table caption tbody tfoot thead tr ul".split()
)
#: Their content is no markup up to the end tag, and no text of the page.
RAW = frozenset("script style title textarea noframes noembed iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MUTED = frozenset(
    "aside audio button canvas datalist dialog footer form head header math menu nav noscript object search select svg "
    "template video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split()
)
NOISE = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright disclaimer disqus footer form header login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notices pagination popup promo promotion related replies reply respond "
    "rightbar leftbar share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: A word before a noise word that turns it into a remark on the layout.
LAYOUT = frozenset("has no with without".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ROUGH_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]++))""")
_WORDS = re.compile(r"[A-Za-z0-9]+")


def _noise(name: str, rest: str) -> tuple[bool, str]:
    """Does an element's ``role``, ``class``, ``id`` or a hiding attribute mute it; and its role."""
    if "=" not in rest:
        return bool(re.search(r"\shidden\b", rest)), ""
    given: dict[str, str] = {}
    for found in _ATTRIBUTE.finditer(rest):
        given.setdefault(found[1].lower(), references.unescape(found[2] or found[3] or found[4] or ""))
    role = given.get("role", "").strip().lower()
    if role in ROLES or given.get("aria-hidden", "").lower() == "true" or re.search(r"\shidden(?=[\s/]|$)", rest):
        return True, role
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        return True, role
    if name in ("html", "body"):
        return False, role
    for value in (given.get("class", ""), given.get("id", "")):
        for token in value.split():
            words = [w.lower() for w in _WORDS.findall(re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", token))]
            if any(w in NOISE and not (i and words[i - 1] in LAYOUT) for i, w in enumerate(words)):
                return True, role
    return False, role


class _Element:
    """An open element: what it mutes, and the inline elements open inside it."""

    __slots__ = ("name", "kind", "inline", "open")

    def __init__(self, name: str, kind: str):
        self.name, self.kind = name, kind
        self.inline: list[tuple[str, str]] = []
        self.open: dict[str, int] = {}


class Stripper:
    """One pass over the markup of a page; ``lines`` are (text, muted, inside the article, code points of links)."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, bool, bool, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.stack = [_Element("", "")]
        self.names: dict[str, int] = {}
        # Open elements by kind: "muted" by name or role, "noise" by a word, "article", "heading", "header" in an article.
        self.depth = dict.fromkeys(("", "muted", "noise", "article", "heading", "header", "a"), 0)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        linked, self.linked = self.linked, 0
        if text:
            d = self.depth
            muted = d["muted"] + d["noise"] > 0 or (d["header"] > 0 and not d["heading"])
            self.lines.append((text, muted, d["article"] > 0, linked))

    def text(self, raw: str) -> None:
        decoded = references.unescape(raw) if "&" in raw else raw
        self.parts.append(decoded)
        if self.depth["a"]:
            self.linked += len(decoded.strip())

    def _kind(self, name: str, rest: str) -> str:
        noise, role = _noise(name, rest)
        if name in HEADINGS:
            return "noise" if noise else "heading"
        if name in ("article", "main") or role == "main":
            return "noise" if noise and name != "main" and role != "main" else "article"
        if name == "header" and self.depth["article"] and not noise:
            return "header"
        return "muted" if name in MUTED else "noise" if noise else ""

    def _pop_inline(self, holder: _Element) -> str:
        name, kind = holder.inline.pop()
        holder.open[name] -= 1
        self.depth[kind] -= 1
        return name

    def _pop(self) -> str:
        holder = self.stack.pop()
        while holder.inline:
            self._pop_inline(holder)
        self.depth[holder.kind] -= 1
        self.names[holder.name] -= 1
        return holder.name

    def start(self, name: str, rest: str) -> None:
        if name in BLOCKS:
            self.flush()
            if self.stack[-1].name == "p" or (self.stack[-1].name == name and name in ("li", "dt", "dd", "option", "tr")):
                self._pop()  # implied end tag
            if name in VOID:
                return
            kind = self._kind(name, rest)
            if kind == "article" and name != "article" and self.depth["noise"]:
                # The main part of the page: what was muted around it for a word of its class was no noise.
                for holder in self.stack:
                    if holder.kind == "noise":
                        self.depth["noise"] -= 1
                        holder.kind = ""
                        self.depth[""] += 1
            self.stack.append(_Element(name, kind))
            self.names[name] = self.names.get(name, 0) + 1
            self.depth[kind] += 1
        elif name in VOID or name in ("td", "th"):
            self.parts.append(" ")
        elif not rest.endswith("/"):
            kind = "a" if name == "a" else self._kind(name, rest)
            kind = "" if kind == "article" else kind
            if kind in ("muted", "noise"):
                self.flush()
            holder = self.stack[-1]
            holder.inline.append((name, kind))
            holder.open[name] = holder.open.get(name, 0) + 1
            self.depth[kind] += 1

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
            if self.names.get(name):
                while self._pop() != name:
                    pass
        elif name in ("td", "th"):
            self.parts.append(" ")
        else:
            holder = self.stack[-1]
            if holder.open.get(name):
                if self.depth["muted"] or self.depth["noise"]:
                    self.flush()
                while self._pop_inline(holder) != name:
                    pass

    def feed(self, page: str) -> list[tuple[str, bool, bool, int]]:
        at, tag = 0, _TAG
        while at < len(page):
            found = _MARKUP.search(page, at)
            if not found:
                break
            if found.start() > at:
                self.text(page[at : found.start()])
            at = found.start()
            if page.startswith("<!--", at):
                # "<!-->" and "<!--->" are whole comments
                end = page.find("-->", at + 2)
                at = len(page) if end < 0 else end + 3
                continue
            if page[at + 1] in "!?" or (page[at + 1] == "/" and not page[at + 2 : at + 3].isalpha()):
                end = page.find(">", at)
                at = len(page) if end < 0 else end + 1
                continue
            match = tag.match(page, at)
            if not match:
                # A quote that never ends: from here on quotes are not heeded, so that nothing is read twice.
                tag = _ROUGH_TAG
                match = tag.match(page, at)
                if not match:
                    at = len(page)
                    break
            at, name = match.end(), match[2].lower()
            if match[1]:
                self.end(name)
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                close = page.find(">", end.end()) if end else -1
                at = len(page) if close < 0 else close + 1
            elif name == "plaintext":
                break
            else:
                self.start(name, match[3])
        if at < len(page):
            self.text(page[at:])
        self.flush()
        return self.lines


def between_surge_and_dive(sizes: np.ndarray, threshold: int, window: int = WINDOW) -> np.ndarray:
    """A flag for each line: True from a surge of the window sums over the threshold to the next dive to 0."""
    n = len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    sums = total[np.minimum(np.arange(n) + window, n)] - total[:n]
    if n and sums.max() > 0:
        threshold = min(threshold, int(sums.max()) - 1)
    # Runs of positive sums end where the sum dives to 0; a run counts from its first sum over the threshold.
    run = np.cumsum(sums == 0)
    first = np.full(int(run[-1]) + 1 if n else 0, n)
    over = np.flatnonzero(sums > threshold)
    np.minimum.at(first, run[over], over)
    return (np.arange(n) >= first[run]) & (sums > 0) & (sizes > 0) if n else np.zeros(0, bool)


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by an empty line."""
    lines = Stripper().feed(page) if page else []
    marked = any(inside and not muted for _, muted, inside, _ in lines)
    sizes = np.array(
        [
            0 if muted or (not inside if marked else 2 * linked > len(text)) else len(text)
            for text, muted, inside, linked in lines
        ],
        np.int64,
    )
    kept = between_surge_and_dive(sizes, 0 if marked else SURGE)
    return "\n\n".join(lines[i][0] for i in np.flatnonzero(kept))


def extract(pages: DataFrame, html: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``page``, the given columns (or all) as a struct, and ``text``. No shuffle; results leave in small batches."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            start = size = 0
            for at, page in enumerate(batch.column("html")):
                texts.append(main_text(page.as_py()))
                size += len(texts[-1])
                if size >= OUTPUT_CHARS or at + 1 == batch.num_rows:
                    part = batch.column("page").slice(start, len(texts))
                    yield pa.RecordBatch.from_arrays([part, pa.array(texts, pa.string())], ["page", "text"])
                    texts, start, size = [], at + 1, 0

    columns = pages.columns if columns is None else columns
    fields = [pages.schema[name] for name in columns]
    schema = T.StructType([T.StructField("page", T.StructType(fields), False), T.StructField("text", T.StringType(), False)])
    page = F.struct(*(pages[name] for name in columns)).alias("page")
    return pages.select(page, pages[html].cast("string").alias("html")).mapInArrow(read, schema)


def digest(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    found = extract(pages, columns=["page_id", "url"])
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))
