"""Main text of web pages, by removal of what a host's pages share.

1. Every page is read into elements (`Page`). Each element's subtree has a hash of its tag, class words, text and
   subtrees, and a slot: the tags and class words on its path from the root, without long numbers.
2. Spark counts, per host, on how many different pages each (slot, subtree) occurs. Pages of a host with the same article
   count once, so copies of an article don't make a template of it.
3. A subtree is a host's template if it is on `SHARE` of the host's pages, `MIN_PAGES` at least. A slot is one if
   `RECURRING` of the subtrees found there are on two pages or more: menus and adverts that rotate are each on few
   pages, but hardly any is on one alone. A second pass deletes template subtrees, and whatever stands in a template slot.
   Templates are kept as two lists of hashes per host and looked up by host.
4. What recurs too rarely to be told that way goes by what its markup says: scripts, styles, forms, landmarks (`nav`, `header`,
   `footer`, `aside` and their roles), hidden elements and class words such as `advert`, `cookie` or `comments`.
5. A page that marks its article (`article`, `main`, role or itemprop) gives the article only. The article itself is never
   deleted; inside it subtrees go by `SHARE` and markup alone, so a passage that many articles quote stays.

Texts: character references are decoded, white space inside a block becomes one space, blocks are joined by one line feed;
`br` and table cells are white space, rows of a table are blocks. Open tags are closed as browsers do.

Defined cases: a null or empty html, or one without article text, gives an empty text. A null url has host "", and such
pages share no templates. A page cut off in a tag loses that tag only. Repeated rows are reported each; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship, written

MIN_PAGES = 4
SHARE = 0.5
RECURRING = 0.8

# Element names of HTML by role, and words that sites use for what is not the article.
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody tfoot thead tr ul""".split())
CELL = {"td", "th"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
NEVER = RAW | set("""head noscript template object svg canvas audio video map nav aside footer form button select datalist
    input dialog menu search""".split())
SCOPES = {"article", "main"}
ROLES = set("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar
    tablist""".split())
WORDS = set("""ad ads adslot adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promos
    promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars sidenav aside widget widgets
    footer masthead topbar toolbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
    subscription signup signin login register share sharing social related recommended recommendations comment
    comments disqus discussion respond replies pagination pager skiplink copyright""".split())
HEADERS = {"header"}
OPENERS = {"has", "with", "no", "is", "not", "without", "hide", "show"}

_TOKEN = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""",
                    re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)(?![\w-])"""
                        r"""(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_BREAK, _SPACE = "\n", " "


@lru_cache(1 << 14)
def _slot(above: int, tag: str, words: str) -> int:
    return int.from_bytes(blake2b(f"{above} {tag} {words}".encode(), digest_size=8).digest(), "big", signed=True)


@lru_cache(1 << 14)
def _says_aside(name: str, header: bool) -> bool:
    """Does a class or id name, such as `site-footer` or `comments_area`, name something beside the article?"""
    parts = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
    if not parts or parts[0] in OPENERS:
        return False
    known = WORDS | HEADERS if header else WORDS
    return parts[0] in known or parts[-1] in known


class Page:
    """Elements of one page, in the order they start. Texts and breaks are in `pieces`; an element's are a run of them."""

    def __init__(self, html: str):
        self.tags, self.parents, self.names, self.marks = ["#root"], [-1], [""], [{}]
        self.slots, self.starts, self.ends, self.full = [0], [0], [0], [False]
        self.digests: list[bytes] = [b""]
        self.pieces: list[str] = []
        self._hashes = [blake2b(digest_size=8)]
        self._open, self._opened = [0], {}
        self._read(html)
        while self._open:
            self._close()

    def _start(self, tag: str, names: str, marks: dict[str, str]) -> None:
        above = self._open[-1]
        if tag in BLOCK:
            self.pieces.append(_BREAK)
        elif tag in CELL:
            self.pieces.append(_SPACE)
        number = len(self.tags)
        words = re.sub(r"\d{3,}", "", names)
        self.tags.append(tag)
        self.parents.append(above)
        self.names.append(names)
        self.marks.append(marks)
        self.slots.append(_slot(self.slots[above], tag, words))
        self.starts.append(len(self.pieces))
        self.ends.append(0)
        self.full.append(False)
        self.digests.append(b"")
        self._hashes.append(blake2b(f"{tag} {words}".encode(), digest_size=8))
        self._open.append(number)
        self._opened[tag] = self._opened.get(tag, 0) + 1

    def _close(self) -> None:
        number = self._open.pop()
        tag = self.tags[number]
        self._opened[tag] = self._opened.get(tag, 1) - 1
        self.ends[number] = len(self.pieces)
        self.digests[number] = self._hashes[number].digest()
        self._hashes[number] = None
        if self._open and self.full[number]:
            above = self._open[-1]
            self.full[above] = True
            self._hashes[above].update(self.digests[number])
        if tag in BLOCK:
            self.pieces.append(_BREAK)
        elif tag in CELL:
            self.pieces.append(_SPACE)

    def _close_to(self, tags: set[str] | tuple, stop: set[str]) -> None:
        """Close the innermost open element of `tags`, and all inside, unless one of `stop` is met first."""
        if not any(self._opened.get(t) for t in tags):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in tags:
                while len(self._open) > depth:
                    self._close()
                return
            if tag in stop:
                return

    def _before(self, tag: str) -> None:
        """Close what a start tag ends by itself."""
        if tag in BLOCK:
            self._close_to(("p",), BLOCK | CELL)
        if tag == "li":
            self._close_to(("li",), {"ul", "ol", "menu", "table", "article", "section"})
        elif tag in ("dt", "dd"):
            self._close_to(("dt", "dd"), {"dl", "table"})
        elif tag in CELL:
            self._close_to(CELL, {"tr", "table"})
        elif tag == "tr":
            self._close_to(("tr",), {"table"})
        elif tag in ("tbody", "thead", "tfoot"):
            self._close_to(("tbody", "thead", "tfoot"), {"table"})
        elif tag in ("option", "optgroup"):
            self._close_to(("option",), {"select", "datalist"})

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if not text.isspace():
            above = self._open[-1]
            self.full[above] = True
            self._hashes[above].update(" ".join(text.split()).encode("utf-8", "replace"))

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            token = _TOKEN.search(html, at)
            if token is None:
                self._text(html[at:])
                return
            if token.start() > at:
                self._text(html[at:token.start()])
            at = token.end()
            name = token.group(2)
            if name is None:
                continue
            name = name.lower()
            if token.group(1):
                self._end(name)
                continue
            attributes = token.group(3)
            names, marks = "", {}
            if len(attributes) > 3:
                for key, value in _ATTRIBUTE.findall(attributes):
                    key, value = key.lower(), value.strip("\"'")
                    if key in ("class", "id"):
                        names += " " + value
                    elif key != "style":
                        marks[key] = value.lower()
                    elif re.search(r"display\s*:\s*none", value, re.I):
                        marks["hidden"] = ""
            if name in VOID:
                if name == "br":
                    self.pieces.append(_SPACE)
                elif name == "hr":
                    self._before(name)
                    self.pieces.append(_BREAK)
                continue
            if name in RAW:
                end = _END[name].search(html, at)
                at = end.start() if end else size
                continue
            if name == "body" and "body" in self.tags or name == "html" and "html" in self.tags:
                continue
            if name in BLOCK or name in CELL or name in NEVER or names or marks:
                self._before(name)
                self._start(name, names.strip(), marks)

    def _end(self, name: str) -> None:
        if name in ("body", "html") or not self._opened.get(name):
            return
        if name in BLOCK or name in CELL or name in NEVER:
            self._close_to((name,), {"body", "html"} if name in ("table", "tr", "tbody", "thead", "tfoot", *CELL) else
                           {"body", "html", "table", "td", "th", "caption"})
        else:
            self._close_to((name,), BLOCK | CELL)

    def _aside(self, number: int, in_scope: bool) -> bool:
        """Does the element's own markup say that it isn't the article?"""
        tag, marks = self.tags[number], self.marks[number]
        if tag in NEVER or tag in HEADERS and not in_scope:
            return True
        if tag in ("html", "body"):
            return False
        if "hidden" in marks or marks.get("aria-hidden") == "true" or marks.get("role") in ROLES:
            return True
        return any(_says_aside(n, not in_scope) for n in self.names[number].split())

    def _is_scope(self, number: int, main: bool) -> bool:
        tag, marks = self.tags[number], self.marks[number]
        if main:
            return tag == "main" or marks.get("role") == "main"
        return tag == "article" or marks.get("role") == "article" or marks.get("itemprop") == "articlebody"

    def scopes(self) -> list[int]:
        """The outermost elements marked as the article, inside `main` if there is one; else `main`; else nothing."""
        found: dict[bool, list[int]] = {}
        for main in (True, False):
            covered, kept = [False] * len(self.tags), []
            for number in range(1, len(self.tags)):
                above = self.parents[number]
                covered[number] = covered[above] or self._aside(number, True)
                if not covered[number] and self.full[number] and self._is_scope(number, main):
                    kept.append(number)
                    covered[number] = True
            found[main] = kept
        articles = [a for a in found[False] if not found[True] or any(
            self.starts[m] <= self.starts[a] and self.ends[a] <= self.ends[m] for m in found[True])]
        return articles or found[True]

    def subtrees(self) -> tuple[set[tuple[int, int]], int]:
        """(slot, subtree) of all elements with text but the article and what holds it; and the article's own hash."""
        scopes = self.scopes()
        holds = self._holders(scopes)
        found = {(self.slots[n], int.from_bytes(self.digests[n], "big", signed=True))
                 for n in range(1, len(self.tags)) if self.full[n] and n not in holds}
        own = blake2b(b"".join(self.digests[n] for n in scopes or [0]), digest_size=8).digest()
        return found, int.from_bytes(own, "big", signed=True)

    def _holders(self, scopes: list[int]) -> set[int]:
        held = {0} | {n for n in range(1, len(self.tags)) if self.tags[n] in ("html", "body")}
        for number in scopes:
            while number > 0:
                held.add(number)
                number = self.parents[number]
        return held

    def text(self, subtrees: set[int], slots: set[int]) -> str:
        """The article without a host's template `subtrees` and whatever stands in its template `slots`."""
        scopes = self.scopes()
        holds, first = self._holders(scopes), set(scopes)
        inside, gone = [False] * len(self.tags), [False] * len(self.tags)
        keep = bytearray(len(self.pieces))
        for number in scopes or [0]:
            keep[self.starts[number]:self.ends[number]] = b"\1" * (self.ends[number] - self.starts[number])
        for number in range(1, len(self.tags)):
            above = self.parents[number]
            inside[number] = inside[above] or number in first
            gone[number] = gone[above] or number not in holds and (
                int.from_bytes(self.digests[number], "big", signed=True) in subtrees
                or not inside[number] and self.slots[number] in slots
                or self._aside(number, inside[number]))
            if gone[number] and not gone[above]:
                keep[self.starts[number]:self.ends[number]] = bytes(self.ends[number] - self.starts[number])
        blocks, block, borders = [], [], {self.starts[n] for n in scopes}
        for at, (kept, piece) in enumerate(zip(keep, self.pieces)):
            if at in borders or kept and piece is _BREAK:
                blocks.append("".join(block))
                block = []
            if kept and piece is not _BREAK:
                block.append(piece)
        blocks.append("".join(block))
        texts = (" ".join(b.split()) for b in blocks)
        return "\n".join(t for t in texts if t)


def host(url: Column) -> Column:
    """Lower-case host of a URL with a scheme, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, slot, subtree, article for every subtree of every page, each once; slot and subtree 0 stand for the page."""
    names = ["host", "slot", "subtree", "article"]
    for batch in batches:
        rows = set()
        for at, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            found, own = Page(html.as_py() or "").subtrees()
            rows.add((at, 0, 0, own))
            rows.update((at, slot, subtree, own) for slot, subtree in found)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))], names)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, subtrees, slots in zip(batch.column(0), batch.column(1), batch.column(2)):
            texts.append(Page(html.as_py() or "").text(set(subtrees.as_py() or ()), set(slots.as_py() or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(3, batch.num_columns)] + [pa.array(texts, pa.string())],
            batch.schema.names[3:] + ["text"])


def templates(pages: DataFrame) -> DataFrame:
    """host, subtrees, slots: what recurs on each host. One row for each host that has templates."""
    ship(pages.sparkSession)
    rows = pages.select(host(F.col("url")).alias("host"), "html").where("host <> ''").mapInArrow(
        _counted, "host string, slot long, subtree long, article long")
    once = rows.distinct()
    found = written(once.groupBy("host", "slot", "subtree").agg(F.count("*").alias("pages")), "pages-subtrees")
    hosts = found.where("slot = 0 and subtree = 0").select("host", F.col("pages").alias("all_pages"))
    common = (found.where(f"slot <> 0 and pages >= {MIN_PAGES}").groupBy("host", "subtree")
              .agg(F.max("pages").alias("pages")).join(hosts, "host").where(F.col("pages") >= SHARE * F.col("all_pages"))
              .groupBy("host").agg(F.collect_list("subtree").alias("subtrees")))
    slots = (found.where("slot <> 0").groupBy("host", "slot").agg(
        F.sum("pages").alias("seen"), F.sum(F.when(F.col("pages") > 1, F.col("pages"))).alias("recurring"))
        .where((F.col("seen") >= MIN_PAGES) & (F.col("recurring") >= RECURRING * F.col("seen")))
        .groupBy("host").agg(F.collect_list("slot").alias("slots")))
    return written(common.join(slots, "host", "full"), "pages-templates")


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    known = templates(pages)
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(known, "host", "left")
    page_id = pages.schema["page_id"].dataType.simpleString()
    found = rows.select("html", "subtrees", "slots", "page_id", "url").mapInArrow(
        _extracted, f"page_id {page_id}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
