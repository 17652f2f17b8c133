"""Registered queries of archives: paged answers that Spark records from the given documents, agencies, records, entries for the past, items and ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.operators import publish, readmodel
from siftmill.plans.queries import query, read
from siftmill.session import checkpointing
from siftmill.sources import entries, paged

BASE, HOSTS = "https://rules.test/api", r"^rules\.test$"


def agency_sources(spark, sf_dir):
    """A registry with a feed for each source and each language of the documents; two feeds name the same language, the later under another id."""
    d = read(spark, sf_dir, "documents")
    feed = lambda slug: F.concat(F.lit("https://rules.test/f?conditions%5Bagencies%5D%5B%5D="), F.url_encode(slug))
    row = lambda position, mark, slug: [F.lit(position).alias("position"), F.concat(F.lit(mark), slug).alias("id"), F.concat(F.lit("P "), slug).alias("publication"), feed(slug).alias("url"), F.lit("US").alias("region"), F.lit(12).alias("lead_words"), F.lit(True).alias("enabled")]
    source, lang = F.coalesce("source", F.lit("none")), F.concat(F.lit("lang-"), F.col("lang"))
    langs = d.where("lang IS NOT NULL")
    return d.select(*row(0, "s-", source)).union(langs.select(*row(2, "a-", lang))).union(langs.select(*row(1, "l-", lang))).distinct()


def recorded_rules(spark, sf_dir):
    """Recorded answers and queries: documents as rules, a query for each source and quarter of the ids, 400 ids to a page. One quarter
    is refused from its second page on, one ends in an answer that is no JSON, one leads elsewhere."""
    k, a = F.col("doc_id"), F.coalesce("source", F.lit("none"))
    d = read(spark, sf_dir, "documents").withColumns({"a": a, "q": k % 4, "w": F.floor(k / 400)})
    slug = lambda s: F.struct(s.alias("slug"))
    listed = F.array(slug(F.lit("unlisted")), slug(F.when(k % 3 == 0, F.concat(F.lit("lang-"), F.col("lang"))).otherwise(F.col("a"))))
    rule = F.struct(
        F.when(k % 23 != 0, F.concat(F.lit("Rule "), k.cast("string"))).alias("title"), F.when(k % 5 == 0, "Notice").otherwise("Rule").alias("type"), F.col("text").alias("abstract"),
        F.concat(F.when(k % 17 == 0, "https://other.test/").otherwise("https://rules.test/"), k.cast("string")).alias("html_url"), F.date_add(F.lit("2026-01-01").cast("date"), (k % 40).cast("int")).alias("publication_date"),
        k.cast("string").alias("document_number"), listed.alias("agencies"),
    )
    pages = d.groupBy("a", "q", "w").agg(F.collect_list(rule).alias("results"))  # 400 ids at most
    by = Window.partitionBy("a", "q").orderBy("w")
    numbers = pages.select("a", "q", "w").withColumns({"page": F.row_number().over(by) - 1, "last": F.lead("w").over(by).isNull()})
    start = F.concat(F.lit(f"{BASE}?agency="), F.url_encode("a"), F.lit("&quarter="), F.col("q").cast("string"))
    at = lambda p: F.concat(start, F.when(p > 0, F.concat(F.lit("&page="), p.cast("string"))).otherwise(""))
    onward = F.when(~F.col("last"), at(F.col("page") + 1)).when(F.col("q") == 2, "https://other.test/api")
    rows = pages.join(numbers, ["a", "q", "w"])
    refused, broken = (F.col("q") == 3) & (F.col("page") > 0), (F.col("q") == 1) & (F.col("page") == 2)
    body = F.when(~refused, F.concat(F.when(broken, "<").otherwise(""), F.to_json(F.struct(F.size("results").alias("count"), onward.alias("next_page_url"), "results"))))
    checkpointing(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/recorded-{uuid.uuid4().hex}"
    recording = paged.record(rows.select(at(F.col("page")).alias("address"), F.when(refused, 503).otherwise(200).alias("status"), body.alias("body")), paged.Recording(folder))
    starts = d.select(F.concat_ws("/", "a", F.col("q").cast("string")).alias("agency"), start.alias("address")).distinct()
    return recording, starts


def _rules(spark, sf_dir):
    recording, starts = recorded_rules(spark, sf_dir)
    pages = paged.answers(spark, starts, recording, pages=1_000_000)
    known = paged.agencies(agency_sources(spark, sf_dir), HOSTS)
    first, until = (F.lit(d).cast("date") for d in ("2026-01-01", "2026-02-01"))
    return pages, paged.rule_rows(pages, known, F.regexp_replace("agency", "/[0-9]$", ""), first, until, HOSTS)


_READ = """d AS (SELECT doc_id, text, lang, coalesce(source, 'none') AS a, doc_id % 4 AS q, doc_id // 400 AS w FROM documents), n AS (SELECT *, dense_rank() OVER (PARTITION BY a, q ORDER BY w) - 1 AS page FROM d),
r AS (SELECT *, a || '/' || q AS agency, CASE WHEN doc_id % 17 = 0 OR doc_id % 23 = 0 THEN 'invalid' WHEN doc_id % 5 = 0 THEN 'not_rule' WHEN doc_id % 40 >= 31 THEN 'out_of_window' END AS skipped,
  NOT (q = 3 AND page > 0) AND NOT (q = 1 AND page > 1) AS got, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda x: x <> '') AS ws FROM n)"""


@query(f"""WITH {_READ} SELECT agency, page::INT AS page, doc_id::VARCHAR AS document_number, CASE WHEN doc_id % 3 = 0 AND lang IS NOT NULL THEN 'l-lang-' || lang ELSE 's-' || a END AS source_id, 's-' || a AS found_in,
array_to_string(ws[1:12], ' ') || CASE WHEN len(ws) > 12 THEN '…' ELSE '' END AS lead, skipped FROM r WHERE got""")
def paged_rules(spark, sf_dir):
    return _rules(spark, sf_dir)[1].select("agency", "page", "document_number", "source_id", "found_in", "lead", "skipped")


@query(f"""WITH {_READ} SELECT agency, CASE WHEN q = 0 OR (q = 3 AND max(page) = 0) OR (q = 1 AND max(page) < 2) THEN 'ok' ELSE 'failed' END AS status, count(DISTINCT page) FILTER (got) AS pages, count(*) FILTER (page = 0) AS api_count,
  count(*) FILTER (got AND skipped IS NULL) AS in_window, count(*) FILTER (got AND skipped = 'invalid') AS invalid, count(*) FILTER (got AND skipped = 'not_rule') AS not_rule, count(*) FILTER (got AND skipped = 'out_of_window') AS out_of_window,
  CASE WHEN q = 3 AND max(page) > 0 THEN 'HTTP 503' WHEN q = 1 AND max(page) > 1 THEN 'not JSON' WHEN q = 2 THEN 'next page elsewhere' END AS error FROM r GROUP BY agency, q""")
def paged_report(spark, sf_dir):
    return paged.report(*_rules(spark, sf_dir))


@query("""SELECT coalesce(source, 'none') AS slug, 's-' || coalesce(source, 'none') AS source_id FROM documents UNION SELECT 'lang-' || lang, 'l-lang-' || lang FROM documents WHERE lang IS NOT NULL""")
def registry_agencies(spark, sf_dir):
    return paged.agencies(agency_sources(spark, sf_dir), HOSTS).select("slug", "source_id")


@query("""SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'no_object' WHEN doc_id % 7 = 0 THEN 'no_document' WHEN doc_id % 6 = 0 THEN 'other_document' WHEN doc_id % 10 = 3 THEN 'other_number' WHEN doc_id % 10 = 4 THEN 'no_date'
WHEN doc_id % 28 <> doc_id % 27 THEN 'other_date' END AS problem FROM documents""")
def record_problems(spark, sf_dir):
    k = F.col("doc_id")
    day = lambda n: F.concat(F.lit("2026-03-"), F.lpad((k % n + 1).cast("string"), 2, "0"))
    number = F.concat(F.lit("2026-"), k.cast("string"))
    at = lambda n: F.concat(F.lit("https://www.federalregister.gov/documents/"), F.replace(day(28), F.lit("-"), F.lit("/")), F.lit("/"), n)
    html = F.when(k % 7 == 0, "https://example.org/x").when(k % 6 == 0, at(F.concat(number, F.lit("0")))).otherwise(F.concat(at(number), F.lit("/a-title")))
    doc = F.to_json(F.struct(html.alias("html_url"), F.when(k % 10 == 3, "2026-x").otherwise(number).alias("document_number"), F.when(k % 10 == 4, "soon").otherwise(day(28)).alias("publication_date"), "text"))
    body = F.when(k % 11 == 0, F.concat(F.lit("["), doc, F.lit("]"))).otherwise(doc)
    return read(spark, sf_dir, "documents").select("doc_id", paged.record_problem(at(number), body, day(27).cast("date")).alias("problem"))


# ---- entries for the past, items as archived, ranges


def past_rows(spark, sf_dir):
    """Documents as entries for January 2026, with faults by id, and a registry that has some of their hosts, one behind a paywall."""
    k = F.col("doc_id")
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.when(k % 29 == 0, "http://").otherwise("https://"), F.when(k % 4 == 0, "sub.").otherwise(""), F.concat(F.lit("n"), (k % 5).cast("string")), F.lit(".test/"), k.cast("string")).alias("url"),
        F.when(k % 31 != 0, F.concat(F.lit(" P "), F.coalesce("source", F.lit("none")))).alias("publication"), F.when(k % 3 == 0, "news").otherwise("regulator").alias("source_class"), F.concat(F.lit("Item  "), k.cast("string")).alias("headline"), F.col("text").alias("lead"),
        F.concat(F.lit("2026-"), F.when(k % 37 == 0, "02").otherwise("01"), F.lit("-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.when(k % 2 == 0, "").when(k % 5 == 0, "T00:00:00Z").otherwise("T15:30:00+00:00")).alias("published"),
        (k % 7 == 0).alias("paywalled"), F.when(k % 41 == 0, "rumour").otherwise("search").alias("discovery_mode"), F.lit(None).cast("string").alias("notes"),
    )
    sources = [("a", "https://n1.test/feed", True, "US", 4, "trade", True), ("b", "https://n2.test/feed", False, "EU", 8, None, None), ("c", "https://www.n3.test/feed", True, "US", None, None, False)]
    return rows, spark.createDataFrame(sources, "id string, url string, paywalled boolean, region string, lead_words int, tier string, enabled boolean")


@query("""WITH e AS (SELECT doc_id, doc_id % 5 = 1 AS wall, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda x: x <> '') AS ws, doc_id % 2 = 0 OR doc_id % 5 = 0 AS dated, doc_id % 37 = 0 AS late FROM documents),
f AS (SELECT *, CASE WHEN wall AND doc_id % 4 <> 0 THEN 4 WHEN doc_id % 5 = 2 AND doc_id % 4 <> 0 THEN 8 WHEN wall OR doc_id % 7 = 0 THEN 30 ELSE 60 END AS most FROM e)
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN CASE doc_id % 5 WHEN 1 THEN 'a' WHEN 2 THEN 'b' END END AS source_id, wall OR doc_id % 7 = 0 AS paywalled, CASE WHEN dated THEN 'date' ELSE 'time' END AS published_precision, array_to_string(ws[1:most], ' ') || CASE WHEN len(ws) > most THEN '…' ELSE '' END AS lead,
  CASE WHEN doc_id % 5 = 1 AND doc_id % 3 = 0 AND doc_id % 4 <> 0 THEN 'trade' END AS tier, array_to_string(list_filter([CASE WHEN doc_id % 29 = 0 THEN 'url' END, CASE WHEN doc_id % 31 = 0 THEN 'publication' END, CASE WHEN doc_id % 41 = 0 THEN 'discovery_mode' END, CASE WHEN late THEN 'late' END], lambda x: x IS NOT NULL), ',') AS problems,
  array_to_string(list_filter([CASE WHEN doc_id % 2 = 1 AND doc_id % 5 = 0 THEN 'midnight' END, CASE WHEN wall AND doc_id % 7 <> 0 THEN 'walled' END, CASE WHEN len(ws) > most THEN 'lead_cut' END], lambda x: x IS NOT NULL), ',') AS notices FROM f""")
def past_entries(spark, sf_dir):
    rows, sources = past_rows(spark, sf_dir)
    start, until = (F.lit(d).cast("timestamp") for d in ("2026-01-01 05:00:00", "2026-02-01 05:00:00"))
    out = entries.past_entries(rows, sources, start, until, ("news", "regulator"))
    return out.select("doc_id", "source_id", "paywalled", "published_precision", "lead", "tier", F.array_join("problems", ",").alias("problems"), F.array_join("notices", ",").alias("notices"))


@query("""SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN NULL ELSE min(text) END AS validation_question, CASE WHEN conv_id % 3 = 0 THEN max(text) END AS awareness_rationale, count(*) AS sources, false AS backfilled FROM conversations GROUP BY conv_id""")
def final_items(spark, sf_dir):
    k = F.col("conv_id")
    told = F.struct("role", "turn", F.lit(None).cast("string").alias("none"))
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min("text").alias("validation_question"), F.max("text").alias("awareness_rationale"), F.collect_list(told).alias("l"))
    drafts = c.select(
        k.alias("item_id"), F.lit("2026-01-02T06:00:00-05:00").alias("timestamp"), F.lit("s").alias("section"), F.lit("c").alias("claim"), F.array(F.lit("d")).alias("domains"), F.lit("news").alias("source_class"), F.when(k % 3 == 0, "awareness_only").otherwise("process").alias("mechanism"),
        F.transform("l", lambda x: F.struct(x["role"].alias("domain"), x["role"].alias("text"), x["turn"].alias("n"))).alias("interpretation"), "validation_question", F.lit("i").alias("candidate_issue_statement"), "awareness_rationale",
        F.transform("l", lambda x: F.struct(x["role"].alias("publication"), x["role"].alias("url"), x["none"].alias("headline"), x["none"].alias("published"), x["none"].alias("source_class"), x["turn"].alias("n"))).alias("sources"), F.lit(None).cast("string").alias("update_of"), F.array(k).alias("candidate_ids"),
    )
    return publish.final_items(drafts).select(F.col("item_id").alias("conv_id"), "validation_question", "awareness_rationale", F.size("sources").cast("long").alias("sources"), "backfilled")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1996-06-30'")
def runs_in_range(spark, sf_dir):
    k = F.col("o_orderkey")
    runs = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(k % 9 == 0, "-0700").when(k % 2 == 0, "-0600").otherwise("-1800")).alias("run_id"))
    # 06:00 and 18:00 Eastern of the first and last day
    since, until = (F.lit(d).cast("timestamp") for d in ("1996-03-01 11:00:00", "1996-06-30 22:00:00"))
    return readmodel.runs_between(runs, "run_id", since, until).select("o_orderkey")


@query("SELECT event_id FROM events WHERE ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 8 DAY AND (SELECT max(ts) FROM events) - INTERVAL 2 DAY")
def recent_items(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    now = e.agg((F.max("ts") - F.make_dt_interval(F.lit(3))).alias("now"))
    return readmodel.recent_archive(e.crossJoin(F.broadcast(now)), "ts", F.col("now"), 5).select("event_id")
