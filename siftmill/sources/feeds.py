"""Feeds as a table function: a scanner that reads RSS 2.0, RSS 1.0 and Atom documents up to and beyond their faults.

A document is joined laterally with its entries, so that it may give thousands of rows and none is lost when a later one is broken."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmill.functions import dates, extract, text
from siftmill.functions.markup import without

# Elements by preference, names as feeds write them.
RSS_TAGS = {
    "title": ("title", "dc:title", "rss:title"), "link": ("feedburner:origLink", "link", "rss:link"), "description": ("description", "rss:description", "dc:description", "summary"),
    "date": ("pubDate", "dc:date", "dcterms:issued", "dcterms:created", "dcterms:modified", "published", "atom:published", "updated", "atom:updated", "a10:updated", "prism:publicationDate"),
}
ATOM_TAGS = {"title": ("title", "atom:title"), "description": ("summary", "atom:summary"), "date": ("published", "atom:published", "issued", "updated", "atom:updated", "modified", "dc:date")}
SCHEMA = "format string, feed_title string, n int, title string, link string, published string, description string, error string"
#: Prefixes of these namespaces are read as the usual ones, whatever a document calls them.
NAMESPACES = {"http://www.w3.org/2005/Atom": "atom", "http://purl.org/dc/elements/1.1/": "dc", "http://purl.org/dc/terms/": "dcterms", "http://purl.org/rss/1.0/": "rss", "http://www.w3.org/1999/02/22-rdf-syntax-ns#": "rdf"}

_EVENT = re.compile(r"<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<![A-Za-z][^>]*>|<(/?)([A-Za-z_][\w.:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(/?)>", re.S)
_ATTR = re.compile(r"([\w.:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
_BLOCK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|section|article|blockquote)\b[^>]*>", re.I)
_UNSEEN = re.compile(r"<(script|style|noscript|iframe|svg)\b.*?</\1\s*>|<!--.*?-->", re.I | re.S)


class Element:
    """A node: its name with a known prefix, attributes, and in ``parts`` texts and nodes as they come. ``base``: what links are relative to."""

    __slots__ = ("attrs", "base", "name", "parts", "raw")

    def __init__(self, name: str, attrs: dict[str, str], base: str | None, raw: str = ""):
        self.name, self.attrs, self.base, self.parts, self.raw = name, attrs, base, [], raw or name

    def text(self) -> str:
        return "".join(p if isinstance(p, str) else f" {p.text()} " for p in self.parts)

    def nodes(self, *names: str) -> Iterator[Element]:
        """Children of these names, name by name."""
        for n in names:
            yield from (p for p in self.parts if isinstance(p, Element) and n in (p.name, p.raw))

    def first(self, names: tuple[str, ...]) -> tuple[Element | None, str]:
        """The first child by preference that has words, and these."""
        for e in self.nodes(*names):
            if words := plain(e.text()):
                return e, words
        return None, ""


def plain(s: str) -> str:
    """Words of an element: markup in it, escaped or not, is taken off."""
    return " ".join(re.sub("<[^>]*>", "", html.unescape(_BLOCK.sub(" ", _UNSEEN.sub(" ", s)))).replace("​", "").split())


def described(s: str, metadata: re.Pattern | None) -> str:
    """Words of a description: markup that is escaped once or twice is undone, elements whose class says that they are no
    summary go with all that they hold."""
    if re.search(r"&lt;/?[a-z][^&]{0,200}&gt;", s, re.I):
        s = html.unescape(s)
    if metadata and metadata.search(s):
        s = without(s, lambda _, attrs: bool((m := re.search(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", attrs, re.I)) and metadata.search(m[1] or m[2] or "")))
    return plain(s)


def resolved(link: str | None, base: str | None) -> str | None:
    try:
        u = urljoin(base or "", " ".join((link or "").split()))
        parts = urlsplit(u)
        return u if link and parts.scheme in ("http", "https") and parts.netloc else None
    except ValueError:
        return None


def attributes(raw: str) -> dict[str, str]:
    return {k: html.unescape(a or b or "") for k, a, b in _ATTR.findall(raw)}


def entries(raw: str, base: str | None) -> tuple[str | None, str, list[Element], bool]:
    """Format, title, entries and whether the document ended in order. Elements that are not closed end with their parent; an
    entry also ends where the next begins."""
    kind, title, done, whole = None, "", [], True
    way: list[Element] = []
    spaces: dict[str, str] = {}
    at = 0

    def shut(n: int) -> None:
        nonlocal title
        while len(way) > n:
            e = way.pop()
            local = e.name.rpartition(":")[2]
            if local in ("item", "entry") and kind:
                done.append(e)
            elif way:
                if local == "title" and not title and way[-1].name.rpartition(":")[2] in ("channel", "feed"):
                    title = plain(e.text())
                way[-1].parts.append(e)

    for m in _EVENT.finditer(raw):
        if way and m.start() > at:
            way[-1].parts.append(html.unescape(raw[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            if way:
                way[-1].parts.append(m[1])
            continue
        if not m[3]:
            continue
        prefix, _, local = m[3].rpartition(":")
        if not kind and not m[2] and local in ("rss", "feed", "RDF"):
            kind = {"rss": "rss", "feed": "atom", "RDF": "rdf"}[local]
        if not kind:
            continue
        if m[2]:  # an end: of the nearest element of that name; others in it were left open
            i = next((i for i in range(len(way) - 1, -1, -1) if way[i].raw == m[3]), None)
            if i is None:
                whole = False
                continue
            whole &= i == len(way) - 1
            shut(i)
            continue
        attrs = attributes(m[4])
        for k, v in attrs.items():
            if k.startswith("xmlns:") and v in NAMESPACES:
                spaces[k[6:]] = NAMESPACES[v]
        if local in ("item", "entry"):
            open_at = next((i for i, e in enumerate(way) if e.name.rpartition(":")[2] == local), None)
            if open_at is not None:
                whole = False
                shut(open_at)
        up = way[-1].base if way else base
        name = f"{spaces.get(prefix, prefix)}:{local}" if prefix else local
        way.append(Element(name, attrs, resolved(attrs["xml:base"], up) or up if "xml:base" in attrs else up, m[3]))
        if m[4].rstrip().endswith("/") or m[5]:
            shut(len(way) - 1)
    whole &= not way
    shut(0)
    return kind, title, done, whole


def rss_link(e: Element) -> str | None:
    """The link element, an Atom link to the page itself, a guid that is an address and not said to be none, the item's own name."""
    _, words = e.first(RSS_TAGS["link"])
    found = [words] if words else []
    found += [x.attrs.get("href") for x in e.nodes("atom:link", "atom10:link") if x.attrs.get("rel", "alternate") in ("", "alternate")]
    for g in list(e.nodes("guid"))[:1]:
        if g.attrs.get("isPermaLink", "true").lower() != "false" and re.match("https?://", plain(g.text()), re.I):
            found.append(plain(g.text()))
    found.append(e.attrs.get("rdf:about"))
    return next((u for f in found if (u := resolved(f, e.base))), None)


def atom_link(e: Element) -> str | None:
    """The page itself, as HTML if it is given so; else another link that is no feed, reply, edit or enclosure; else an id that is an address."""
    best: list[tuple[int, str]] = []
    for x in e.nodes("link", "atom:link"):
        u = resolved(x.attrs.get("href") or plain(x.text()), x.base)
        rel, kind = x.attrs.get("rel", "alternate").lower() or "alternate", x.attrs.get("type", "").lower()
        if u and rel == "alternate":
            best.append((0 if not kind or "html" in kind else 1, u))
        elif u and rel not in ("self", "replies", "edit", "enclosure"):
            best.append((1, u))
    if best:
        return min(best, key=lambda b: b[0])[1]
    _, own = e.first(("id", "atom:id"))
    return resolved(own, e.base) if re.match("https?://", own, re.I) else None


def scanned(raw: str | None, base: str | None, metadata: str | None) -> Iterator[tuple]:
    """Rows of ``SCHEMA``: one for each entry, and one with ``error`` for a document that is no feed or does not end in order."""
    classes = re.compile(metadata) if metadata else None
    kind, title, found, whole = entries((raw or "").lstrip("﻿ \t\r\n"), base)
    for n, e in enumerate(found):
        tags = ATOM_TAGS if kind == "atom" else RSS_TAGS
        if kind == "atom":  # a nested source has the title and link of another feed
            e.parts = [p for p in e.parts if not (isinstance(p, Element) and p.name.rpartition(":")[2] == "source")]
        (d, _), (_, when), (_, own) = e.first(tags["description"]), e.first(tags["date"]), e.first(tags["title"])
        told = d.text() if d else ""
        if not when and kind != "atom" and "time" in told.lower():
            m = re.search(r"<time\b[^>]*\bdatetime\s*=\s*[\"']([^\"']+)", told if re.search(r"<time\b", told, re.I) else html.unescape(told), re.I)
            when = m[1] if m else ""
        yield kind, title, n, own, atom_link(e) if kind == "atom" else rss_link(e), when or None, described(told, classes), None
    if not kind:
        yield None, None, None, None, None, None, None, "no feed"
    elif not whole:
        yield kind, title, None, None, None, None, None, "not in order"


class FeedEntries:
    """The table function: ``xml, base, metadata`` -> rows of ``SCHEMA``."""

    def eval(self, xml: str, base: str, metadata: str):
        yield from scanned(xml, base, metadata)


def feed_table(df: DataFrame, xml: str = "xml", base: str | None = "base", metadata: str | None = None) -> DataFrame:
    """``df`` (columns with a document and the address it came from) joined laterally with its entries (``SCHEMA``)."""
    scan = F.udtf(FeedEntries, returnType=SCHEMA)
    at = F.col(base).outer() if base else F.lit(None).cast("string")
    return df.lateralJoin(scan(F.col(xml).outer(), at, F.lit(metadata).cast("string")))


def feed_candidates(df: DataFrame, xml: str = "xml", base: str | None = "base", words: int = 60, metadata: str | None = None) -> DataFrame:
    """Entries with ``ts, date_status, date_only`` of their date and the ``lead``: the description without a copy of the title before it."""
    rows = feed_table(df, xml, base, metadata).withColumn("_d", dates.feed_date(F.col("published")))
    lead = text.lead(extract.without_headline(F.coalesce("description", F.lit("")), F.coalesce("title", F.lit(""))), words)
    return rows.withColumns({"ts": F.col("_d.ts"), "date_status": F.col("_d.status"), "date_only": F.col("_d.date_only"), "lead": lead}).drop("_d", xml)
