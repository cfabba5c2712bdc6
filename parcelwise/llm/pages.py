"""Main text of web pages by consensus host paths.

Every page is read into blocks of text and the containers they stand in. A container's score is the text of its blocks
less that of their links, and most of its inner containers' scores. From the best container of a page it is climbed to
the enclosing article, or as far as mostly unlinked text is added (a title, a lead); the page votes for that container's
generalised path (tags and classes from the root, digits removed). Spark counts the votes by host; pages are then read
again and cut at their host's winning paths. A page that has none of them, or no text there, uses its own best.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.components import stored
from parcelwise.llm.urls import url_host

#: A host's paths count down to this share of its votes, at most PATHS of them.
SHARE, PATHS = 0.1, 3
#: Hosts up to this many are sent to every task; more are joined by a shuffle.
BROADCAST_HOSTS = 200_000
#: Part of an inner container's score that its outer one gets.
INHERIT = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.DOTALL
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noframes noembed".split())
CONTAINERS = frozenset("html body main article section div td blockquote center figure details".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre table thead tbody tfoot tr caption figcaption address hr summary hgroup "
    "header footer nav aside form fieldset legend menu dialog".split()
)
DROPPED = frozenset(
    "head title script style noscript template iframe noframes noembed object embed svg canvas audio video map math nav "
    "footer aside form button select option textarea input dialog menu xmp".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion nav "
    "navbar navigation menu footer sidebar aside notice notices alert cookie cookies consent gdpr banner comment comments "
    "commentlist disqus reply replies respond share sharing social related recommended breadcrumb breadcrumbs newsletter "
    "subscribe subscription popup modal overlay login signup widget widgets toolbar masthead pagination pager search".split()
)
#: Elements with such a part in a longer name are kept if they hold at least this share of the page's unlinked text:
#: MOST if the name begins with it (comment-list), else HALF (content-with-sidebar).
HALF, MOST = 0.5, 0.9
#: Only outside an article, where they hold its title.
DROPPED_OUTSIDE = frozenset(("header", "contentinfo"))
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
_FENCES = frozenset("html body table ul ol dl div section article main td th form nav header footer aside".split())


def _dropped(tag: str, attributes: str, in_article: bool) -> float:
    """From which share of the page's unlinked text on an element is kept: 0 always, 2 never."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return 0
    if _HIDDEN.search(attributes):
        return 2
    share = 0.0
    for kind, *values in _NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            parts = re.split(r"[-_:]+", name)
            if parts[0] in ("no", "has", "with", "without", "is"):
                continue
            if tag == "article" and not DROPPED_NAMES.intersection(parts[:1] + parts[-1:]):
                continue
            names = DROPPED_NAMES if in_article else DROPPED_NAMES | DROPPED_OUTSIDE
            if names.issuperset(parts):
                return 2
            if not names.isdisjoint(parts):
                share = max(share, MOST if parts[0] in names else HALF)
    return share


def _step(tag: str, attributes: str) -> str:
    names = []
    for kind, *values in _NAMES.findall(attributes) if attributes else ():
        if kind.lower() == "class":
            names = sorted({re.sub(r"\d+", "", n) for n in "".join(values).lower().split()} - {""})
    return ".".join([tag, *names])


class Outline:
    """Containers (path, outer one, score) and blocks (container, text) of a page, in order.

    Elements whose names leave doubt are left out at first; if one holds enough text, the page is read again with it.
    """

    def __init__(self, html: str) -> None:
        self._read(html, frozenset())
        if self.doubts:
            total = self.plain[0] + sum(d[2] for d in self.doubts)
            for d in reversed(self.doubts):  # inner ones stand after outer ones
                if d[0] >= 0:
                    self.doubts[d[0]][2] += d[2]
            kept = frozenset(k for k, (_, share, plain) in enumerate(self.doubts) if plain and plain >= share * total)
            if kept:
                self._read(html, kept)

    def _read(self, html: str, kept: frozenset) -> None:
        self.doubts: list[list] = []  # outer one, share from which it is kept, unlinked text
        self.paths, self.tags, self.outer, self.scores = [""], [""], [-1], [0.0]
        self.plain, self.linked = [0], [0]  # with that of inner containers
        self.blocks: list[tuple[int, str]] = []
        self._text: list[str] = []
        self._plain = self._linked = 0
        # open elements: tag, container, dropped, in a link, in an article, doubt, in a dropped element without doubt
        stack = [("", 0, False, False, False, -1, False)]
        at = 0
        while True:
            found = _TOKEN.search(html, at)
            text = html[at : found.start() if found else len(html)]
            if text:
                self._add(text, stack[-1])
            if not found:
                break
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:
                self._close(tag, stack)
                continue
            attributes = found[3]
            if tag in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag in BLOCKS and tag != "hr" and any(e[0] == "p" for e in stack):
                self._close("p", stack)
            if tag in CLOSES:
                self._imply(CLOSES[tag], stack)
            top = stack[-1]
            if tag in BLOCKS:
                self._flush(top[1])
            elif tag in ("br", "td", "th", "img", "wbr") and not top[2] and tag != "wbr":
                self._text.append(" ")
            if tag in VOID:
                continue
            share = 2 if top[6] else _dropped(tag, attributes, top[4])
            dropped, doubt = top[2] or share == 2, top[5]
            if 0 < share < 2:
                self.doubts.append([doubt, share, 0])
                doubt = len(self.doubts) - 1
                dropped |= doubt not in kept
            inside = top[1]
            if tag in CONTAINERS and not dropped:
                self.paths.append(f"{self.paths[inside]}/{_step(tag, attributes)}")
                self.tags.append(tag)
                self.outer.append(inside)
                self.scores.append(0.0)
                self.plain.append(0)
                self.linked.append(0)
                inside = len(self.paths) - 1
            stack.append((tag, inside, dropped, top[3] or tag == "a", top[4] or tag in ("article", "main"), doubt, share == 2))
        self._flush(stack[-1][1])
        for k in range(len(self.paths) - 1, 0, -1):  # inner containers stand after outer ones
            self.scores[self.outer[k]] += INHERIT * max(0.0, self.scores[k])
            self.plain[self.outer[k]] += self.plain[k]
            self.linked[self.outer[k]] += self.linked[k]

    def _add(self, text: str, top: tuple) -> None:
        if not top[2]:
            text = unescape(text)
            self._text.append(text)
            if top[3]:
                self._linked += len(text)
            else:
                self._plain += len(text)
        elif not top[6] and not top[3]:
            self.doubts[top[5]][2] += len(unescape(text)) if text.strip() else 0

    def _flush(self, container: int) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((container, text))
                self.scores[container] += self._plain - self._linked
                self.plain[container] += self._plain
                self.linked[container] += self._linked
            self._text, self._plain, self._linked = [], 0, 0

    def _close(self, tag: str, stack: list) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                if any(e[0] in BLOCKS for e in stack[k:]):
                    self._flush(stack[-1][1])
                del stack[k:]
                return
            if stack[k][0] in _FENCES and tag not in BLOCKS | CONTAINERS:
                return

    def _imply(self, tags: set, stack: list) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                self._flush(stack[-1][1])
                del stack[k:]
                return
            if stack[k][0] in _FENCES and stack[k][0] not in tags:
                return

    def best(self) -> int:
        """The container with the best score, the outermost of several, or what encloses it: its outermost article, else
        the outermost container below the body that adds text to it which is mostly unlinked."""
        best = max(range(len(self.scores)), key=lambda k: (self.scores[k], -k))
        around, article = best, None
        k = best
        while k > 0:
            tag = self.tags[k]
            if tag == "article":
                article = k
            plain, linked = self.plain[k] - self.plain[best], self.linked[k] - self.linked[best]
            if tag not in ("html", "body") and plain > linked and plain > self.plain[around] - self.plain[best]:
                around = k
            k = self.outer[k]
        return around if article is None else article

    def text(self, paths: list[str]) -> str:
        """The blocks in the containers of the first path with text, else in the page's own best."""
        for path in (*paths, None):
            inside = [False] * len(self.paths)
            own = self.best() if path is None else -1
            for k, p in enumerate(self.paths):
                inside[k] = p == path or k == own or (self.outer[k] >= 0 and inside[self.outer[k]])
            found = [text for container, text in self.blocks if inside[container]]
            if found:
                return "\n".join(found)
        return ""


def votes(pages: DataFrame) -> DataFrame:
    """host, path, n: the pages of a host whose best container has the path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict = {}
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
                outline = Outline(html.as_py() or "")
                best = outline.best()
                if outline.scores[best] > 0:
                    counts[host, outline.paths[best]] = counts.get((host, outline.paths[best]), 0) + 1
            hosts, paths = [k[0] for k in counts], [k[1] for k in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(counts.values(), pa.int64())],
                ["host", "path", "n"],
            )

    found = pages.select(url_host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, n long")
    return found.groupBy("host", "path").agg(F.sum("n").alias("n"))


def winners(counted: DataFrame) -> DataFrame:
    """host, paths: a host's paths with at least SHARE of its votes, most votes first, PATHS at most."""
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    strong = counted.join(total, "host").where(F.col("n") >= SHARE * F.col("total"))  # 1 / SHARE a host at most
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))
    top = strong.withColumn("k", rank).where(F.col("k") <= PATHS)
    return top.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("k", "path"))).path.alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text.

    A null or empty html has no text. Pages without a host (a null url or one without ``://``) vote together. Markup
    that is never closed ends with the page. Rows may repeat: each votes and is extracted; other columns are ignored.
    """
    paths = stored(winners(votes(pages)), "host-paths")
    few = paths.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Outline(html.as_py() or "").text(own or [])
                for html, own in zip(batch.column("html"), batch.column("paths").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    hosted = pages.select("page_id", "url", "html", url_host(F.col("url")).alias("host"))
    joined = hosted.join(F.broadcast(paths) if few else paths, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
