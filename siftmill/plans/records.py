"""Registered queries of nested records, filtered lists, feeds and references, over rows that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftmill.operators import nested, readmodel, structure
from siftmill.plans.queries import query, read
from siftmill.sources import feeds

# ---- filtered lists

_MARKS = "list_filter(['money', 'license', 'list', 'long'], lambda x: (x = 'money' AND regexp_matches(text, '[$£€]')) OR (x = 'license' AND contains(text, 'license')) OR (x = 'list' AND contains(text, ' | ')) OR (x = 'long' AND length(text) > 2000))"


def marked(spark, sf_dir):
    t = F.col("text")
    own = {"money": t.rlike("[$£€]"), "license": t.contains("license"), "list": t.contains(" | "), "long": F.length(t) > 2000}
    marks = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in own.items()]))
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source", marks.alias("marks"))


@query(f"""WITH d AS (SELECT lang, coalesce({_MARKS}, []) AS marks, source FROM documents), f AS (SELECT *, (CASE WHEN list_has_any(marks, ['license', 'long']) THEN 0 ELSE 1 END) AS m, (CASE WHEN lang IN ('en', 'de') THEN 0 ELSE 2 END) AS l FROM d)
SELECT 'facet' AS kind, 'marks' AS name, v AS value, count(*) AS n FROM (SELECT unnest(marks) AS v FROM f WHERE l = 0) GROUP BY v UNION ALL SELECT 'facet', 'lang', lang, count(*) FROM f WHERE m = 0 GROUP BY lang
UNION ALL SELECT 'facet', 'source', source, count(*) FROM f WHERE m + l = 0 GROUP BY source UNION ALL SELECT 'only', CASE WHEN m > 0 THEN 'marks' ELSE 'lang' END, NULL, count(*) FROM f WHERE m + l IN (1, 2) GROUP BY 2
UNION ALL SELECT 'section', source, CASE WHEN m + l = 0 THEN 'shown' ELSE 'hidden' END, count(*) FROM f GROUP BY ALL UNION ALL SELECT 'total', NULL, NULL, count(*) FROM f WHERE m + l = 0""")
def array_facets(spark, sf_dir):
    return readmodel.list_view(marked(spark, sf_dir), {"marks": ["license", "long"], "lang": ["en", "de"], "source": []}, "source")


# ---- nested records


def turns_as_items(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return c.withColumn("roles", F.transform("turns", lambda t: t["role"]))


RULES = [
    nested.Rule("role", "turns[].role", nested.one_of("user", "assistant")), nested.Rule("text", "turns[].text", nested.matches(r"[.!?]\s*$"), "warning"),
    nested.Rule("few", "turns", nested.sized(3, 8)), nested.Rule("starts", "roles", lambda r: F.get(r, 0) == "user", when="size(turns) > 4"),
]


@query(r"""WITH o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT 'role' AS rule, 'error' AS severity, conv_id::VARCHAR AS entity, 'turns[' || i || '].role' AS field FROM o WHERE role NOT IN ('user', 'assistant') OR role IS NULL
UNION ALL SELECT 'text', 'warning', conv_id::VARCHAR, 'turns[' || i || '].text' FROM o WHERE NOT coalesce(regexp_matches(text, '[.!?]\s*$'), false)
UNION ALL SELECT DISTINCT 'few', 'error', conv_id::VARCHAR, 'turns' FROM o WHERE n < 3 OR n > 8 UNION ALL SELECT 'starts', 'error', conv_id::VARCHAR, 'roles' FROM o WHERE i = 0 AND n > 4 AND role IS DISTINCT FROM 'user'""")
def nested_violations(spark, sf_dir):
    return nested.violations(turns_as_items(spark, sf_dir), "conv_id", RULES).drop("message")


@query("""WITH c AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM conversations)
SELECT conv_id, '$.turns[' || min(i) || '].role' AS path, 'changed' AS change FROM c WHERE conv_id % 3 = 0 AND i >= 1 AND role <> 'user' GROUP BY conv_id""")
def nested_differences(spark, sf_dir):
    items = turns_as_items(spark, sf_dir)
    hide = F.transform("turns", lambda t, i: F.struct(t["turn"].alias("turn"), F.when((F.col("conv_id") % 3 == 0) & (i >= 1), "user").otherwise(t["role"]).alias("role"), t["text"].alias("text")))
    before, after = (items.select("conv_id", F.to_json(F.struct(c.alias("turns"))).alias("doc")) for c in (F.col("turns"), hide))
    return structure.first_difference(before, after, "conv_id", "doc").select("conv_id", "path", "change")


# ---- feeds


def as_feeds(spark, sf_dir):
    """Documents as RSS, twenty to a feed; every seventh entry is not closed."""
    d = read(spark, sf_dir, "documents")
    told = F.regexp_replace(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), r"[^\p{L}\p{N} .,]", " ")
    item = F.concat(F.lit("<item><title>"), F.coalesce("source", F.lit("none")), F.lit(" "), F.col("doc_id").cast("string"), F.lit("</title><link>/d/"), F.col("doc_id").cast("string"), F.lit("</link><dc:date>2026-01-02T03:04:05Z</dc:date><description>"), told, F.lit("</description>"), F.when(F.col("doc_id") % 7 == 0, "").otherwise("</item>"))
    g = d.select(F.floor(F.col("doc_id") / 20).alias("feed"), F.struct("doc_id", item.alias("x")).alias("s")).groupBy("feed").agg(F.array_sort(F.collect_list("s")).alias("l"))
    return g.select("feed", F.lit("https://feeds.test/rss.xml").alias("base"), F.concat(F.lit("<rss><channel><title>F</title>"), F.array_join(F.transform("l", lambda s: s["x"]), ""), F.lit("</channel></rss>")).alias("xml"))


@query("SELECT doc_id // 20 AS feed, 'https://feeds.test/d/' || doc_id AS link, coalesce(source, 'none') || ' ' || doc_id AS title, '2026-01-02 03:04:05' AS at FROM documents")
def scanned_feeds(spark, sf_dir):
    out = feeds.feed_candidates(as_feeds(spark, sf_dir)).where("error IS NULL")
    return out.select("feed", "link", "title", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
