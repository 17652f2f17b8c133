"""Registered queries of stories that are alike: pages by title and heading."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftmill.operators import stories
from siftmill.plans.queries import query, read


def pages(spark, sf_dir):
    html = F.col("html")
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    heading = F.regexp_replace(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", "")
    return read(spark, sf_dir, "pages").select("page_id", title.alias("title"), heading.alias("heading"))


def links(spark, sf_dir):
    return stories.linked(stories.prepared(pages(spark, sf_dir), "page_id", ["title", "heading"]), "page_id")


_STEM = "CASE WHEN length(w) > 4 AND w LIKE '%ies' THEN left(w, -3) || 'y' WHEN length(w) > 5 AND w LIKE '%ing' THEN left(w, -3) WHEN length(w) > 4 AND w LIKE '%ed' THEN left(w, -2) WHEN length(w) > 3 AND w LIKE '%s' AND NOT regexp_matches(w, '(ss|us|is)$') THEN left(w, -1) ELSE w END"
_SET = r"list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(regexp_replace(lower({0}), 'cve-[0-9]{{4}}-[0-9]{{4,}}', ' ', 'g'), '[^\p{{L}}\p{{N}}]+'), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+$')), lambda w: " + _STEM + ")))"
_CLEAN = r"regexp_replace(regexp_replace(w, '[''.]+$', ''), '(?i)''s$', '')"
_NAMES = rf"""list_sort(list_distinct(list_filter(list_transform(ws, lambda w, i: CASE WHEN length({_CLEAN}) >= 2 AND (
  (regexp_matches({_CLEAN}, '^[\p{{Lu}}\p{{N}}&-]{{2,10}}$') AND regexp_matches({_CLEAN}, '\p{{Lu}}'))
  OR (regexp_matches({_CLEAN}, '^[\p{{L}}-]+$') AND regexp_matches({_CLEAN}, '^..*\p{{Lu}}') AND regexp_matches({_CLEAN}, '\p{{Ll}}'))
  OR (regexp_matches({_CLEAN}, '\p{{L}}') AND regexp_matches({_CLEAN}, '\p{{N}}'))
  OR (regexp_matches({_CLEAN}, '^\p{{Lu}}\p{{Ll}}') AND length({_CLEAN}) > 2 AND i > 1 AND len(list_filter(ws, lambda x: length(x) > 3 AND regexp_matches(x, '^\p{{Lu}}'))) <= 0.6 * len(list_filter(ws, lambda x: length(x) > 3 AND regexp_matches(x, '^\p{{L}}'))))) THEN lower({_CLEAN}) END), lambda x: x IS NOT NULL)))"""
FIGURES = r"""list_sort(list_distinct(list_transform(list_filter(list_transform(regexp_extract_all(lower(regexp_replace(coalesce({0}, ''), '(?i)\bCVE-[0-9]{{4}}-[0-9]{{4,}}\b', ' ', 'g')), '[0-9][0-9,]*(?:\.[0-9]+)?(?:\s?(?:%|per cent|\p{{L}}+))?'),
  lambda m: {{'n': replace(regexp_extract(m, '^[0-9,]+(?:\.[0-9]+)?'), ',', ''), 'u': CASE trim(substr(m, length(regexp_extract(m, '^[0-9,]+(?:\.[0-9]+)?')) + 1)) WHEN '%' THEN '%' WHEN 'percent' THEN '%' WHEN 'per cent' THEN '%' WHEN 'million' THEN 'm' WHEN 'm' THEN 'm' WHEN 'billion' THEN 'b' WHEN 'bn' THEN 'b' WHEN 'trillion' THEN 't' WHEN 'k' THEN 'k' WHEN 'tb' THEN 'tb' WHEN 'gb' THEN 'gb' ELSE '' END}}),
  lambda x: x.u <> '' OR (regexp_matches(x.n, '^0*[1-9][0-9]{{2,}}') AND NOT regexp_matches(x.n, '^(19|20)[0-9]{{2}}$'))), lambda x: regexp_replace(x.n, '\.0+$', '') || x.u)))"""
_JACCARD = "list_max(flatten(list_transform(x.vs, lambda u: list_transform(y.vs, lambda v: len(list_intersect(u, v)) / (len(u) + len(v) - len(list_intersect(u, v)))))))"
_CVES = "list_distinct(list_transform(regexp_extract_all(full_text, '(?i)CVE-[0-9]{4}-[0-9]{4,}'), lambda x: upper(x)))"
STORIES = rf"""WITH RECURSIVE p AS (SELECT page_id, t, h, t || ' . ' || h AS full_text FROM (SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t, regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g') AS h FROM pages)),
q AS (SELECT *, regexp_extract_all(replace(regexp_replace(full_text, '(?i)\bCVE-[0-9]{{4}}-[0-9]{{4,}}\b', ' ', 'g'), '’', ''''), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}&''.-]*[\p{{L}}\p{{N}}]|[\p{{L}}\p{{N}}]') AS ws FROM p),
d AS (SELECT page_id, list_sort(list_distinct(list_filter([{_SET.format("t")}, {_SET.format("h")}], lambda s: len(s) > 0))) AS vs, {_NAMES} AS ns, {FIGURES.format("full_text")} AS fs, {_CVES} AS cs FROM q),
c AS (SELECT *, min(page_id) OVER (PARTITION BY vs, ns, fs, list_sort(cs)) AS rep, count(*) OVER (PARTITION BY vs, ns, fs, list_sort(cs)) AS copies FROM d),
s AS (SELECT x.page_id AS x, y.page_id AS y, coalesce({_JACCARD}, 0) AS j, len(list_intersect(x.ns, y.ns)) AS names, len(list_intersect(x.fs, y.fs)) AS figures, len(list_intersect(x.cs, y.cs)) AS cves, least(len(x.cs), len(y.cs)) AS few FROM c x, c y),
r AS (SELECT *, floor(least(1, greatest(j + 0.12::DOUBLE * least(names, 3) + 0.08::DOUBLE * least(figures, 2), CASE WHEN cves = 0 THEN 0 WHEN few <= 2 THEN 0.9 ELSE 0.6 END)) * 100 + 0.5) / 100 AS score FROM s),
l AS (SELECT *, CASE WHEN score >= 0.55 THEN 'likely' WHEN score >= 0.35 THEN 'possible' ELSE 'none' END AS level FROM r)"""


@query(STORIES + " SELECT x AS a, y AS b, floor(j * 100 + 0.5) / 100 AS jaccard, names, figures, cves, score, level FROM l WHERE level <> 'none' AND x < y AND x IN (SELECT rep FROM c) AND y IN (SELECT rep FROM c)")
def story_pairs(spark, sf_dir):
    n = [F.col(c).cast("long").alias(c) for c in ("names", "figures", "cves")]
    return links(spark, sf_dir).pairs.select("a", "b", "jaccard", *n, "score", "level")


@query(STORIES + " SELECT page_id, rep, copies, score, level FROM c JOIN l ON x = page_id AND y = page_id")
def story_members(spark, sf_dir):
    return links(spark, sf_dir).members


@query(STORIES + ", e AS (SELECT x, y FROM l WHERE x <> y AND level = 'likely'), w AS (SELECT x AS node, y AS m FROM e UNION SELECT w.node, e.y FROM w JOIN e ON w.m = e.x) SELECT node, least(node, min(m)) AS root FROM w GROUP BY node")
def story_clusters(spark, sf_dir):
    return stories.story_clusters(links(spark, sf_dir), "page_id")


@query(STORIES + " SELECT * FROM (SELECT x AS page_id, y AS match, score, level, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS rank FROM l WHERE x <> y AND level <> 'none') WHERE rank <= 5")
def story_matches(spark, sf_dir):
    return stories.best_matches(links(spark, sf_dir), "page_id")


@query(STORIES + """, e AS (SELECT x, y FROM l WHERE x <> y AND level = 'likely' AND x % 2 = 1 AND y % 2 = 1), w AS (SELECT x AS node, y AS m FROM e UNION SELECT w.node, e.y FROM w JOIN e ON w.m = e.x),
g AS (SELECT node, least(node, min(m)) AS cluster FROM w GROUP BY node), b AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS n FROM l WHERE level <> 'none' AND x % 2 = 1 AND y % 2 = 0)
SELECT page_id, cluster, array_to_string(best, ',') AS archive, array_to_string(alike, ',') AS alike FROM c LEFT JOIN g ON node = page_id LEFT JOIN (SELECT x, list(y ORDER BY n) AS best FROM b WHERE n <= 5 GROUP BY x) ON x = page_id
LEFT JOIN (SELECT u, list(v ORDER BY score DESC, v) AS alike FROM (SELECT DISTINCT i.rep AS u, o.lead AS v, score FROM (SELECT rep, min(page_id) AS lead FROM c WHERE page_id % 2 = 1 GROUP BY rep) i JOIN l ON l.x = i.lead JOIN (SELECT rep, min(page_id) AS lead FROM c WHERE page_id % 2 = 1 GROUP BY rep) o ON o.lead = l.y WHERE i.rep <> o.rep AND level <> 'none') GROUP BY u) ON u = c.rep
WHERE page_id % 2 = 1""")
def story_hints(spark, sf_dir):
    p = pages(spark, sf_dir)
    h = stories.story_hints(links(spark, sf_dir), p.where("page_id % 2 = 1"), p.where("page_id % 2 = 0"), "page_id")
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["id"].cast("string")), ",")
    return h.select("page_id", "cluster", ids("archive_matches").alias("archive"), ids("alike").alias("alike"))
