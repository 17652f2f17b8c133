"""Markup: entities, balanced elements, titles, headings, refresh targets; signs of a missing page or an access wall."""

import html
import re
import unicodedata
from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftmill.functions import url
from siftmill.functions.text import collapse, strip_html

_TAG = re.compile(r"<(/?)([A-Za-z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CHROME = ("nav", "header", "footer", "aside")
#: Wording of pages that answer with success though there is nothing; a parameter of ``soft404``.
MISSING = r"(?:page|article|document|content) (?:you (?:are|were) looking for )?(?:(?:was |could )?not (?:be )?found|does not exist|no longer (?:exists|available)|is (?:missing|gone|no longer available)|(?:has been|was) (?:removed|deleted|moved))|nothing (?:was )?found (?:at|on) this (?:address|location|page)"
#: What a title or heading of at most six words says beside.
BARE = r"(?:^|[^0-9])404(?:[^0-9]|$)|^not found$"
#: Signs of a wall: hosts, titles of at most eight words, and paths where addresses that are gone end.
WALL_HOST, WALL_TITLE = r"^(?:unblock|captcha|challenge|verify|botcheck)\.", r"(?:^|[^a-z])(?:request access|access denied|just a moment|attention required|are you a (?:human|robot)|verify you are human)(?:[^a-z]|$)"
HOME = r"^/(?:[a-z]{2}(?:[-_][a-z]{2,4})?/?)?(?:(?:index|default|home)(?:\.(?:html?|aspx?|php))?)?/?$"
ENDS = (("error_page", r"(?:^|/)(?:404|(?:page[-_]?)?not[-_]?found|errors?|missing)(?:\.[a-z0-9]+)?(?:/|$)"), ("search_page", r"^/(?:[a-z]{2}/)?(?:search|find)(?:\.[a-z0-9]+)?/?$"))
#: (reason, pattern of a path in lower case).
WALLS = (("login", r"/(?:login|signin|sign-in|sso|auth)(?:[/.]|$)"), ("consent", r"/(?:consent|cookie-wall)(?:[/.]|$)"), ("subscribe", r"/(?:subscribe|paywall|register)(?:[/.]|$)"))
_HIDDEN = r"(?is)<head>.*?</head>|<head .*?</head>|<script.*?</script>|<style.*?</style>|<[^>]*>"


def without(markup: str, unwanted: Callable[[str, str], bool]) -> str:
    """``markup`` less the elements for which ``unwanted(name, attributes)`` holds, with all that they hold, elements of the
    same name included. An element that is never closed goes to the end."""
    out, at, name, depth = [], 0, None, 0
    for m in _TAG.finditer(markup):
        tag = m[2].lower()
        if tag in VOID or m[3].endswith("/"):
            continue
        if name is None:
            if not m[1] and unwanted(tag, m[3]):
                out.append(markup[at : m.start()])
                name, depth = tag, 1
        elif tag == name:
            depth += -1 if m[1] else 1
            if not depth:
                name, at = None, m.end()
    return " ".join(out if name else [*out, markup[at:]])


@F.pandas_udf(StringType())
def decode_entities(s: pd.Series) -> pd.Series:
    """Named and numeric entities; numbers of the C1 range as Windows-1252."""
    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def decompose(s: pd.Series) -> pd.Series:
    """Compatibility forms taken apart, marks dropped."""
    return s.map(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)), na_action="ignore")


@F.pandas_udf(StringType())
def resolve(link: pd.Series, base: pd.Series) -> pd.Series:
    """An absolute http or https address; null for others and for what can't be read."""

    def one(a, b):
        try:
            out = urljoin(b or "", a.strip()) if a else None
        except ValueError:
            return None
        return out if out and re.match(r"https?://[^/?#]", out, re.IGNORECASE) else None

    return pd.Series([one(a, b) for a, b in zip(link, base, strict=True)], dtype=object)


def remove_elements(c: Column, *names: str, marked: str | None = None) -> Column:
    """Elements of these names, or whose class or role matches ``marked``, go with their content."""
    pattern = re.compile(rf"(?:class|role)\s*=\s*[\"']?[^\"'>]*(?:{marked})", re.IGNORECASE) if marked else None

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: without(x, lambda tag, attrs: tag in names or bool(pattern and pattern.search(attrs))), na_action="ignore")

    return run(c)


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def element_text(c: Column) -> Column:
    """Text of an element, with entities decoded before and after its tags go."""
    return collapse(decode_entities(strip_html(decode_entities(c))))


def spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r]+", " "))


def title(c: Column) -> Column:
    return spaced(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1))


def headings(c: Column, level: int = 1) -> Column:
    found = F.regexp_extract_all(c, F.lit(rf"(?is)<h{level}[^>]*>(.*?)</h{level}>"), F.lit(1))
    return F.filter(F.transform(found, lambda h: spaced(F.regexp_replace(h, "<[^>]*>", ""))), lambda h: h != "")


def main_text(c: Column) -> Column:
    """Text without navigation, headers, footers and asides."""
    return strip_html(remove_elements(c, *CHROME, marked="navigation|banner|contentinfo|sidebar"))


def opening(c: Column, n: int = 200) -> Column:
    return F.substring(spaced(F.regexp_replace(c, _HIDDEN, " ")), 1, n)


def refresh_target(c: Column) -> Column:
    """Address of a refresh in the head; empty without one."""
    tag = F.regexp_extract(c, r"(?is)<meta[^>]*http-equiv\s*=\s*[\"']?refresh[^>]*>", 0)
    return F.regexp_extract(tag, r"(?is)url\s*=\s*([^\"'>\s]+)", 1)


def content_kind(mime: Column) -> Column:
    m = F.lower(F.trim(F.regexp_extract(mime, "^([^;]*)", 1)))
    return F.when(m.isin("text/html", "application/xhtml+xml"), "html").when(m == "application/pdf", "pdf").when(m.rlike("(/|[+])(json)$"), "json").when(m.rlike("(/|[+])xml$"), "xml").when(m.startswith("text/"), "text").when(m == "", None).otherwise("other")


def soft404(c: Column, missing: str = MISSING) -> Column:
    """Where a page says that it is missing: its title, any of its headings, or its whole text; null if it doesn't. Short titles and
    headings also say so with a bare number."""
    says = lambda x: F.lower(x).rlike(missing)
    short = lambda x: says(x) | (F.lower(x).rlike(BARE) & (F.size(F.split(x, " ")) <= 6))
    heads = F.concat(headings(c, 1), headings(c, 2))
    return F.when(short(title(c)), "title").when(F.exists(heads, short), "heading").when(says(spaced(F.regexp_replace(c, _HIDDEN, " "))), "text")


def wall_reason(asked: Column, final: Column, page_title: Column, redirects: Column) -> Column:
    """Why an answer with success is no page: ``wall_host`` or ``wall_title`` (a short one) of a check of visitors; after a redirect, the
    ``home`` page where another was asked for, an ``error_page`` or ``search_page``, or a ``parent`` of the address on its own site.
    The query that names the page, kept through the redirect, speaks for the page. Null if it may be the page."""
    a, f = F.lower(url.path(asked)), F.lower(url.path(final))
    trim = lambda p: F.regexp_replace(F.regexp_replace(p, r"/(?:index|default)\.(?:html?|aspx?|php)$", ""), "/+$", "")
    telling = lambda u: F.filter(url.query_params(u), lambda p: ~url.is_tracking(p, url.host(u)))
    kept = (F.size(telling(asked)) > 0) & (F.size(F.array_except(telling(asked), telling(final))) == 0)
    was_home = a.rlike(HOME) & (F.size(telling(asked)) == 0)
    t = F.lower(F.coalesce(page_title, F.lit("")))
    out = F.when(url.host(final).rlike(WALL_HOST), "wall_host").when(t.rlike(WALL_TITLE) & (F.size(F.split(t, r"\s+")) <= 8), "wall_title")
    moved = redirects > 0
    out = out.when(moved & ~was_home & f.rlike(HOME) & ~kept, "home")
    for name, pattern in ENDS:
        out = out.when(moved & f.rlike(pattern) & ~a.rlike(pattern), name)
    return out.when(moved & url.same_site(asked, final) & (trim(f) != "") & F.startswith(trim(a), F.concat(trim(f), F.lit("/"))) & ~kept, "parent")


def access_wall(asked: Column, final: Column) -> Column:
    """Why ``final``, where a request for ``asked`` ended, is not the page: the kind of wall, or ``home`` if a deep
    address ended at the root; null if it may be the page."""
    a, f = F.lower(url.path(asked)), F.lower(url.path(final))
    out = F.when((F.length(F.regexp_replace(a, "/", "")) > 0) & (F.length(F.regexp_replace(f, "/", "")) == 0), "home")
    for reason, pattern in reversed(WALLS):
        out = F.when(f.rlike(pattern) & ~a.rlike(pattern), reason).otherwise(out)
    return out
