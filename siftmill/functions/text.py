"""Text scalars: Column in, Column out."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse(c: Column) -> Column:
    """Format characters removed, any run of white space one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\p{Cf}", ""), r"(?U)\s+", " "))


def strip_html(c: Column) -> Column:
    """Text of markup: script, style and comments go, block tags become spaces, other tags nothing."""
    c = F.regexp_replace(c, r"(?is)<(script|style|noscript|iframe|svg)\b.*?</\1\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|section|article|blockquote)\b[^>]*>", " ")
    return collapse(F.regexp_replace(c, r"(?s)<[^>]*>", ""))


def words(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[ \t\n\r]+"), lambda w: w != "")


def lead(c: Column, n: int, skip: int = 0) -> Column:
    """Words ``skip + 1`` to ``skip + n``; an ellipsis follows if more come."""
    w = words(c)
    return F.concat(F.array_join(F.slice(w, skip + 1, n), " "), F.when(F.size(w) > skip + n, "…").otherwise(""))


def typographic(c: Column) -> Column:
    for curly, plain in zip("‘’“”–—", "''\"\"--", strict=True):  # a chain of searches is far cheaper than translate
        c = F.replace(c, F.lit(curly), F.lit(plain))
    return c


def search_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(typographic(c)), r"[ \t\n\r]+", " "))


def word_count(c: Column) -> Column:
    """Runs of letters and digits with inner apostrophes (straight or curly), dots and hyphens."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"[\p{L}\p{N}]+(?:['’.-][\p{L}\p{N}]+)*"))


def tokens(c: Column, least: int = 2) -> Column:
    """Sorted distinct lower-case words of letters and digits, pure numbers and short ones left out."""
    w = F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_sort(F.array_distinct(F.filter(w, lambda x: (F.length(x) >= least) & ~x.rlike(r"^[0-9]+$"))))


def stem(w: Column) -> Column:
    n = F.length(w)
    cut = lambda k: F.substr(w, F.lit(1), n - k)
    return F.when((n > 4) & w.endswith("ies"), F.concat(cut(3), F.lit("y"))).when((n > 5) & w.endswith("ing"), cut(3)).when((n > 4) & w.endswith("ed"), cut(2)).when((n > 3) & w.endswith("s") & ~w.rlike("(ss|us|is)$"), cut(1)).otherwise(w)


def ngrams(w: Column, n: int) -> Column:
    """All runs of ``n`` elements of a word array, joined by spaces; empty if there are fewer."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def half_up(c: Column, digits: int) -> Column:
    """Rounds the binary value half up: ``floor(x * k + 0.5) / k``."""
    k = float(10**digits)
    return F.floor(c * k + 0.5) / k


def jaccard(a: Column, b: Column) -> Column:
    """0 if either set is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def story_tokens(c: Column, stop: tuple[str, ...] = ()) -> Column:
    """Sorted distinct stems by which stories are compared: without identifiers of vulnerabilities, stop words, pure numbers
    and words of one character."""
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"cve-[0-9]{4}-[0-9]{4,}", " ")
    w = F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda x: (F.length(x) >= 2) & ~x.rlike("^[0-9]+$") & (~x.isin(*stop) if stop else F.lit(True)))
    return F.array_sort(F.array_distinct(F.transform(w, stem)))


def plural(n: Column, one: str, many: str | None = None) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).otherwise(many or f"{one}s"))


def capital(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def label(key: Column, names: dict[str, str]) -> Column:
    """The name of a key; the key itself, with spaces for underscores and a capital, if it has none."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(known[key], capital(F.replace(key, F.lit("_"), F.lit(" "))))


def first_shared_run(words: Column, other: Column, n: int = 8) -> Column:
    """The first run of ``n`` words that the array ``other`` of such runs has; null without one."""
    return F.get(F.filter(ngrams(words, n), lambda g: F.array_contains(other, g)), 0)
