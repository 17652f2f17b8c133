"""Registered queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.functions import dates, text, url
from siftmill.functions.text import half_up
from siftmill.operators import checks, prefilter, readmodel, score, similar, state, stories
from siftmill.operators.prefilter import Profile, Rules, Term

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- candidates and their scores

CANDIDATES = "c AS (SELECT doc_id, source, substr(coalesce(text, ''), 1, 100) AS title, substr(coalesce(text, ''), 101) AS lead, doc_id % 7 = 3 AS seen FROM documents)"
RULES = Rules(
    terms=(
        Term("domain", "rights", 3.0, "license", "strong"), Term("domain", "rights", 2.0, "copyright"), Term("domain", "rights", 1.0, "free", "weak"), Term("domain", "money", 3.0, "re:[$£€]", "strong"),
        Term("materiality", "scope", 2.0, "that"), Term("materiality", "scope", 1.0, "from"), Term("materiality", "formal", 3.0, "with"), Term("sector", "all", 2.0, "this"), Term("sector", "all", 1.0, "and"),
        Term("enterprise", "all", 2.0, "cs:The"), Term("noise", "shouting", 2.0, "re:!!"), Term("noise", "offers", 3.0, "buy"),
    ),
    profiles={"standard": Profile(3.0, noise=("shouting",)), "strict": Profile(4.0, True, ("shouting", "offers")), "lenient": Profile(2.0)},
    gated=("formal",), roundups=(("table", r" \| "),), marketing=(("shouting", "!!", None),),
)


def _hit(weight: float, word: str = "", symbol: str = "", case: str = "(?i)") -> str:
    p = symbol or rf"{case}(^|[^\p{{L}}\p{{N}}]){word}([^\p{{L}}\p{{N}}]|$)"
    return f"CASE WHEN regexp_matches(title, '{p}') THEN {weight} WHEN regexp_matches(lead, '{p}') THEN {weight * 0.5} ELSE 0.0 END::DOUBLE"


# no two terms of a component can overlap, so that plain sums give what the choice among hits gives
_SCORED = rf"""WITH {CANDIDATES}, h AS (SELECT *, CASE WHEN source IS NULL THEN 'lenient' WHEN length(source) % 2 = 0 THEN 'strict' ELSE 'standard' END AS profile,
  least({_hit(3, "license")} + {_hit(2, "copyright")} + {_hit(1, "free")}, 6) AS rights, {_hit(3, symbol="[$£€]")} AS money, regexp_matches(title, '(?i)(^|[^\p{{L}}\p{{N}}])license([^\p{{L}}\p{{N}}]|$)|[$£€]') AS strong,
  greatest({_hit(2, "that")}, {_hit(1, "from")}) AS scope, {_hit(3, "with")} AS formal, least({_hit(2, "this")} + {_hit(1, "and")}, 5) AS sector, least({_hit(2, "The", case="")}, 2) AS enterprise, {_hit(2, symbol="!!")} AS shouting, {_hit(3, "buy")} AS offers FROM c),
p AS (SELECT *, least(CASE WHEN rights >= 2 THEN rights ELSE 0 END + CASE WHEN money >= 2 THEN money ELSE 0 END, 8)::DOUBLE AS domain, least(scope + CASE WHEN rights >= 2 OR money >= 2 THEN formal ELSE 0 END, 6)::DOUBLE AS materiality,
  CASE profile WHEN 'strict' THEN shouting + offers WHEN 'standard' THEN shouting ELSE 0 END::DOUBLE AS noise FROM h),
s AS (SELECT *, floor((domain + materiality + sector + enterprise - noise) * 10 + 0.5) / 10 AS score FROM p),
r AS (SELECT *, CASE WHEN seen THEN 'seen' WHEN contains(title, ' | ') THEN 'roundup' WHEN profile <> 'lenient' AND contains(title, '!!') THEN 'marketing' WHEN rights < 2 AND money < 2 THEN 'off_domain'
  WHEN profile = 'strict' AND NOT strong THEN 'below_threshold' WHEN score < CASE profile WHEN 'strict' THEN 4.0 WHEN 'standard' THEN 3.0 ELSE 2.0 END THEN 'below_threshold' END AS reason FROM s)"""


def candidates(spark, sf_dir) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return read(spark, sf_dir, "documents").select("doc_id", "source", F.substring(t, 1, 100).alias("title"), F.expr("substring(coalesce(text, ''), 101)").alias("lead"), (F.col("doc_id") % 7 == 3).alias("seen"))


def profiled(spark, sf_dir) -> DataFrame:
    """Candidates with the profile of their source: lenient without one, strict where its name has an even length."""
    profile = F.when(F.col("source").isNull(), "lenient").when(F.length("source") % 2 == 0, "strict").otherwise("standard")
    return candidates(spark, sf_dir).withColumns({"profile": profile, "url": F.lit("https://documents.test/")})


def staged_one(spark, sf_dir) -> DataFrame:
    return prefilter.stage_one(profiled(spark, sf_dir), RULES)


@query(_SCORED + " SELECT source, count(*) AS input, count_if(NOT seen) AS unseen, count_if(reason IS NULL) AS passed FROM r GROUP BY source")
def stage1_funnel(spark, sf_dir):
    return score.funnel(staged_one(spark, sf_dir))


@query(_SCORED + " SELECT doc_id, domain, materiality, sector, enterprise, noise, score FROM r")
def score_components(spark, sf_dir):
    return prefilter.scores(profiled(spark, sf_dir), RULES).select("doc_id", "domain", "materiality", "sector", "enterprise", "noise", "score")


@query(_SCORED + " SELECT doc_id, reason FROM r")
def drop_reason_first_match(spark, sf_dir):
    return staged_one(spark, sf_dir).select("doc_id", "reason")


@query(_SCORED + " SELECT coalesce(reason, 'passed') AS reason, count(*) AS n FROM r GROUP BY 1")
def stage1_counts(spark, sf_dir):
    return staged_one(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("passed")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(_SCORED + ", q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM r WHERE reason IS NULL) SELECT source, doc_id, score, rank FROM q WHERE rank <= 5")
def top_survivors(spark, sf_dir):
    kept = staged_one(spark, sf_dir).where("reason IS NULL")
    return readmodel.top_k(kept, "source", [F.desc("score"), F.col("doc_id")], 5).select("source", "doc_id", "score", "rank")


@query("SELECT doc_id, array_to_string(w[1:25], ' ') || CASE WHEN len(w) > 25 THEN '…' ELSE '' END AS lead FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM documents)")
def lead_words(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.lead(F.col("text"), 25).alias("lead"))


# ---- URLs

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_PARAMS = "list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '')"
_TRACKED = "regexp_matches(lower(regexp_extract(p, '^([^=]*)', 1)), '^(utm_[a-z0-9_]*|fbclid|gclid|mc_[a-z0-9_]*|cmpid|cmp|ito|sr_share|smid|partner|ref|[a-z]+-[0-9a-f]{6,})$')"
_PORT = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]*:([0-9]+)', 1)"
_NORM = f"""CASE WHEN regexp_matches(url, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]') THEN 'https://' || {_HOST} || CASE WHEN {_PORT} IN ('', '80', '443') THEN '' ELSE ':' || {_PORT} END ||
  regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), '/$', '') ||
  CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END"""
_PAGES = f"u AS (SELECT page_id, url, coalesce(array_to_string(list_filter({_PARAMS}, lambda p: NOT {_TRACKED}), '&'), '') AS kept FROM pages), n AS (SELECT page_id, url, {_NORM} AS norm FROM u)"


@query(f"WITH {_PAGES} SELECT page_id, norm AS url_normalised, 'c-' || substr(sha256(norm), 1, 10) AS candidate_id FROM n")
def url_normalise(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", url.normalise(u).alias("url_normalised"), url.candidate_id(u).alias("candidate_id"))


@query(f"WITH {_PAGES} SELECT norm AS url_normalised, min(page_id) AS page_id, list_sort(list(DISTINCT page_id) FILTER (page_id <> m)) AS also_in FROM (SELECT *, min(page_id) OVER (PARTITION BY norm) AS m FROM n) WHERE norm IS NOT NULL GROUP BY norm".replace("list_sort(list(", "coalesce(list_sort(list(").replace("<> m)) AS", "<> m)), []) AS"))
def in_run_dedup_first_wins(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", url.normalise(F.col("url")).alias("url_normalised"))
    return state.first_wins(pages, "url_normalised", ["page_id"], "page_id")


@query(f"WITH h AS (SELECT string_split({_HOST}, '.') AS l FROM pages), d AS (SELECT CASE WHEN array_to_string(l[-2:], '.') IN {url.TWO_LABEL!r} THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM h) SELECT domain, count(*) AS n FROM d GROUP BY domain")
def registrable_domain_counts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(url.registrable(url.host(F.col("url"))).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT page_id, len(list_filter({_PARAMS}, lambda p: {_TRACKED}))::INT AS n_tracking, len({_PARAMS})::INT AS n_params FROM pages")
def tracking_params(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", F.size(url.tracking_params(u)).alias("n_tracking"), F.size(url.query_params(u)).alias("n_params"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[ \\t\\n\\r]+', ' ', 'g')) AS title FROM pages")
def html_title(spark, sf_dir):
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return read(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace(title, r"[ \t\n\r]+", " ")).alias("title"))


@query()
def html_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("text"))


# ---- slots, windows, ledger

_ET = "timezone('America/New_York', timezone('UTC', ts))"
_SLOT = f"CASE WHEN hour({_ET}) < 6 THEN strftime({_ET} - INTERVAL 1 DAY, '%Y-%m-%d') || '-1800' ELSE strftime({_ET}, '%Y-%m-%d') || CASE WHEN hour({_ET}) >= 18 THEN '-1800' WHEN hour({_ET}) >= 14 THEN '-1400' WHEN hour({_ET}) >= 10 THEN '-1000' ELSE '-0600' END END"
_AFTER = f"CASE WHEN {_ET}::TIME <= TIME '06:00:00' THEN strftime({_ET}, '%Y-%m-%d') || '-0600' WHEN {_ET}::TIME <= TIME '10:00:00' THEN strftime({_ET}, '%Y-%m-%d') || '-1000' WHEN {_ET}::TIME <= TIME '14:00:00' THEN strftime({_ET}, '%Y-%m-%d') || '-1400' WHEN {_ET}::TIME <= TIME '18:00:00' THEN strftime({_ET}, '%Y-%m-%d') || '-1800' ELSE strftime({_ET} + INTERVAL 1 DAY, '%Y-%m-%d') || '-0600' END"


@query(f"SELECT event_id, {_SLOT} AS slot FROM events")
def slot_assign(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", dates.slot_of(F.col("ts")).alias("slot"))


@query(f"SELECT {_SLOT} AS slot, event_type, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total FROM events GROUP BY ALL")
def slot_counts(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy(dates.slot_of(F.col("ts")).alias("slot"), "event_type").agg(F.count(F.lit(1)).alias("n"), text.half_up(F.sum("value"), 2).alias("total"))


@query(f"SELECT event_id, {_AFTER} AS slot FROM events")
def slot_at_or_after(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", dates.slot_at_or_after(F.col("ts")).alias("slot"))


@query("SELECT strftime(timezone('America/New_York', timezone('UTC', o_orderdate)), '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY month")
def et_month_groups(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(dates.et_month(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT span, event_type, count(*) AS n FROM events, (VALUES ('24h', 24), ('7d', 168), ('30d', 720)) s(span, h) WHERE ts >= (SELECT max(ts) FROM events) - to_hours(h) GROUP BY span, event_type")
def window_report(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now"))
    return readmodel.windows(events.crossJoin(F.broadcast(now)), "ts", F.col("now"), {"24h": 24, "7d": 168, "30d": 720}, "event_type")


@query("SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-01 12:00:00' AND user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-01 12:00:00')")
def seen_anti_join(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return state.unseen(e.where("ts >= '2024-01-01 12:00:00'").select("user_id").distinct(), e.where("ts < '2024-01-01 12:00:00'").select("user_id").distinct(), "user_id")


_LEDGER = "l AS (SELECT user_id, min(ts) AS first_seen FROM events WHERE ts < TIMESTAMP '2024-01-01 12:00:00' GROUP BY user_id), n AS (SELECT user_id, min(ts) AS first_seen FROM events WHERE ts >= TIMESTAMP '2024-01-01 12:00:00' GROUP BY user_id)"


@query(f"WITH {_LEDGER}, b AS (SELECT * FROM l UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM l)) SELECT * FROM b WHERE first_seen >= TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 30 DAY")
def seen_upsert_ttl(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    first = lambda df: df.groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    return state.upsert_ledger(first(e.where("ts < '2024-01-01 12:00:00'")), first(e.where("ts >= '2024-01-01 12:00:00'")), "user_id", "first_seen", F.lit("2024-01-31 06:00:00").cast("timestamp_ntz"), 30)


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, count(*) AS n FROM events GROUP BY user_id")
def history_newest_per_key(spark, sf_dir):
    return state.newest(read(spark, sf_dir, "events").select("user_id", "ts", "event_id"), "user_id", "ts", "event_id")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events WHERE value IS NOT NULL) WHERE n <= 20")
def undated_cap(spark, sf_dir):
    return state.capped(read(spark, sf_dir, "events").where("value IS NOT NULL"), "event_type", ["ts", "event_id"], 20).select("event_type", "event_id")


@query("SELECT event_id, p.key AS pass_key FROM events JOIN (SELECT strftime(d, '%Y-%m-%d') AS key, d AS a, d + INTERVAL 3 DAY AS b FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 3 DAY)) AS d)) p ON ts >= p.a AND ts < p.b")
def pass_calendar_join(spark, sf_dir):
    days = spark.sql("SELECT date_format(d, 'yyyy-MM-dd') AS pass_key, CAST(d AS timestamp_ntz) AS a, CAST(d + INTERVAL 3 DAY AS timestamp_ntz) AS b FROM (SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 3 DAY)) AS d)")
    e = read(spark, sf_dir, "events")  # a calendar of ten fixed passes
    return e.join(F.broadcast(days), (e["ts"] >= days["a"]) & (e["ts"] < days["b"])).select("event_id", "pass_key")


@query("SELECT event_type, key, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props::JSON)) AS key FROM events WHERE props IS NOT NULL) GROUP BY ALL")
def props_json_extract(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("props IS NOT NULL")
    return e.select("event_type", F.explode(F.json_object_keys("props")).alias("key")).groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH s AS (SELECT {_SLOT} AS slot, event_id, event_type FROM events) SELECT event_id, event_type, slot FROM s WHERE slot = (SELECT max(slot) FROM s)")
def latest_edition(spark, sf_dir):
    s = read(spark, sf_dir, "events").select(dates.slot_of(F.col("ts")).alias("slot"), "event_id", "event_type")
    return s.join(F.broadcast(s.agg(F.max("slot").alias("slot"))), "slot").select("event_id", "event_type", "slot")


# ---- read model

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("""WITH o AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT 'status' AS facet, status AS value, count(*) AS n FROM o WHERE priority IN ('1-URGENT', '2-HIGH') GROUP BY status
UNION ALL SELECT 'priority', priority, count(*) FROM o WHERE status IN ('O') GROUP BY priority
UNION ALL SELECT 'segment', segment, count(*) FROM o WHERE status IN ('O') AND priority IN ('1-URGENT', '2-HIGH') GROUP BY segment""")
def facet_counts_exclude_self(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    o = o.join(c, o["o_custkey"] == c["c_custkey"]).select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"))
    return readmodel.facets(o, {"status": ["O"], "priority": ["1-URGENT", "2-HIGH"], "segment": []})


@query("SELECT o_orderpriority AS section, count_if(o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAY) AS week, max(o_orderdate) AS last FROM orders GROUP BY section")
def section_last_seen(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    o = o.crossJoin(F.broadcast(o.agg(F.max("o_orderdate").alias("now"))))
    return o.groupBy(F.col("o_orderpriority").alias("section")).agg(F.count_if(F.col("o_orderdate") >= F.col("now") - F.make_dt_interval(F.lit(7))).alias("week"), F.max("o_orderdate").alias("last"))


@query("SELECT v.p AS priority, v.ord, coalesce(n, 0) AS n FROM (VALUES " + ", ".join(f"('{p}', {i})" for i, p in enumerate([*PRIORITIES, "6-NONE"])) + ") v(p, ord) LEFT JOIN (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) o ON o.p = v.p")
def run_stats_zero_filled(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "priority")
    return readmodel.zero_filled(o, "priority", [*PRIORITIES, "6-NONE"], F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(*) AS n, CASE WHEN count(*) <> 0 THEN floor(count_if(value > 50) / count(*) * 1000 + 0.5) / 1000 END AS rate FROM events GROUP BY event_type")
def conversion_ratios(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), readmodel.ratio(F.count_if(F.col("value") > 50), F.count(F.lit(1))).alias("rate"))


_J = "j AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'GL_QUALITY' WHEN toxic = 1 THEN 'GL_TOXIC' ELSE 'CS_PASS' END AS code FROM labels)"


def judgments(spark, sf_dir):
    return read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, "GL_QUALITY").when(F.col("toxic") == 1, "GL_TOXIC").otherwise("CS_PASS").alias("code"))


@query(f"WITH {_J} SELECT lang, code, count(*) AS n FROM documents JOIN j USING (doc_id) GROUP BY ALL")
def reason_tally(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return d.join(judgments(spark, sf_dir), "doc_id").groupBy("lang", "code").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_J} SELECT source, count(*) AS survivors, count_if(code = 'CS_PASS') AS passed, floor(count_if(code = 'CS_PASS') / count(*) * 1000 + 0.5) / 1000 AS rate FROM documents LEFT JOIN j USING (doc_id) GROUP BY source")
def per_source_yield(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source").join(judgments(spark, sf_dir), "doc_id", "left")
    passed = F.count_if(F.col("code") == "CS_PASS")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("survivors"), passed.alias("passed"), readmodel.ratio(passed, F.count(F.lit(1))).alias("rate"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_judgments(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id").join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT o_orderkey, strftime(o_orderdate, '%y%m%d') || '-' || CASE WHEN n < 10 THEN '0' ELSE '' END || n::VARCHAR AS item_id FROM (SELECT *, row_number() OVER (PARTITION BY o_orderdate::DATE ORDER BY o_orderpriority, o_orderstatus, o_orderkey) AS n FROM orders)")
def rank_ids(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    out = readmodel.rank_ids(o, "day", [F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")], F.date_format("day", "yyMMdd"))
    return out.select("o_orderkey", "item_id")


@query("SELECT 'rank' AS rule, 'error' AS severity, strftime(o_orderdate, '%Y-%m-%d') AS entity, 'day' AS field, count(*)::VARCHAR AS message FROM orders GROUP BY entity HAVING count(*) > 99")
def rank_id_violations(spark, sf_dir):
    return checks.crowded(read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")), "day", 99, "rank")


_SNAP = "SELECT o_orderkey, o_orderstatus, o_totalprice"


@query(f"""WITH a AS ({_SNAP}, o_orderkey AS pos FROM orders), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 103 = 0 THEN -1 ELSE o_orderkey END AS pos FROM orders WHERE o_orderkey % 97 <> 0)
SELECT * FROM (SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_orderstatus <> b.o_orderstatus THEN 'changed' WHEN a.pos <> b.pos THEN 'moved' END AS change FROM a LEFT JOIN b USING (o_orderkey)) WHERE change IS NOT NULL""")
def append_only_diff(spark, sf_dir):
    a = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderkey").alias("pos"))
    k = F.col("o_orderkey")
    b = a.where(k % 97 != 0).withColumns({"o_orderstatus": F.when(k % 101 == 0, "X").otherwise(F.col("o_orderstatus")), "pos": F.when(k % 103 == 0, -1).otherwise(k)})
    return state.append_only_diff(a, b, "o_orderkey", "pos")


@query("SELECT o_orderkey, count(l_orderkey) AS claimed FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey HAVING count(l_orderkey) NOT BETWEEN 1 AND 5")
def run_item_crosscheck(spark, sf_dir):
    claims = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("c"))
    n = F.coalesce("c", F.lit(0))
    return read(spark, sf_dir, "orders").select("o_orderkey").join(claims, "o_orderkey", "left").where(~n.between(1, 5)).select("o_orderkey", n.alias("claimed"))


@query("SELECT label, count(*) AS n, count_if(length(text) > 2000) AS long FROM (SELECT unnest(list_filter(['money', 'license', 'list'], lambda x: (x = 'money' AND regexp_matches(text, '[$£€]')) OR (x = 'license' AND contains(text, 'license')) OR (x = 'list' AND contains(text, ' | ')))) AS label, text FROM documents) GROUP BY label")
def multi_label_domain_rows(spark, sf_dir):
    t = F.col("text")
    labels = F.array_compact(F.array(F.when(t.rlike("[$£€]"), F.lit("money")), F.when(t.contains("license"), F.lit("license")), F.when(t.contains(" | "), F.lit("list"))))
    d = read(spark, sf_dir, "documents").select(F.explode(labels).alias("label"), F.length("text").alias("len"))
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("len") > 2000).alias("long"))


# ---- text checks and similarity


@query("SELECT conv_id, turn, regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}]+(?:[''.-][\\p{L}\\p{N}]+)*') AS w FROM conversations".replace("SELECT conv_id, turn, regexp", "SELECT conv_id, turn, len(regexp").replace(") AS w", "))::INT AS n_words, len(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}]+(?:[''.-][\\p{L}\\p{N}]+)*')) > 40 AS over"))
def word_limits(spark, sf_dir):
    n = text.word_count(F.col("text"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", n.alias("n_words"), (n > 40).alias("over"))


_GRAMS = "list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))"
_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


@query(f"WITH d AS (SELECT doc_id, unnest({_GRAMS}) AS g FROM (SELECT doc_id, {_WORDS} AS w FROM documents) WHERE len(w) >= 8), b AS (SELECT DISTINCT unnest({_GRAMS}) AS g FROM (SELECT {_WORDS} AS w FROM benchmark) WHERE len(w) >= 8) SELECT doc_id, count(*) AS shared FROM (SELECT DISTINCT doc_id, g FROM d) JOIN b USING (g) GROUP BY doc_id")
def ngram_guard(spark, sf_dir):
    def grams(df):
        w = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")
        return df.withColumn("w", w).withColumn("g", F.explode(F.array_distinct(text.ngrams(F.col("w"), 8))))

    d, b = grams(read(spark, sf_dir, "documents")), grams(read(spark, sf_dir, "benchmark")).select("g").distinct()
    b = F.broadcast(b) if b.count() <= 500_000 else b  # then no run of a document is shuffled
    return d.select("doc_id", "g").join(b, "g", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"))


_TOK = "t AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+$'))) AS w FROM documents)"
_PAIR = f"WITH RECURSIVE {_TOK}, u AS (SELECT doc_id, len(w) AS n, unnest(w) AS x FROM t), i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2), p AS (SELECT a, b, floor(k / (na + nb - k) * 100 + 0.5) / 100 AS jaccard FROM i WHERE k / (na + nb - k) >= 0.55)"


def likely_links(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("tokens"))
    return similar.jaccard_links(d, "doc_id", "tokens", 0.55)


def likely_pairs(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("tokens"))
    return similar.jaccard_pairs(d, "doc_id", "tokens", 0.55)


@query(_PAIR + " SELECT * FROM p")
def pair_jaccard_likely(spark, sf_dir):
    return likely_pairs(spark, sf_dir)


@query(_PAIR + ", e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r AS (SELECT a AS node, b AS m FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.m = e.a) SELECT node, least(node, min(m)) AS root FROM r GROUP BY node")
def components(spark, sf_dir):
    members, links = likely_links(spark, sf_dir)
    return similar.clusters(links.select("a", "b").union(members.where("doc_id != rep")))


@query(_PAIR + " SELECT a, b, jaccard, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY jaccard DESC, b) AS rank FROM p) WHERE rank <= 5")
def topk_matches(spark, sf_dir):
    return readmodel.top_k(likely_pairs(spark, sf_dir), "a", [F.desc("jaccard"), F.col("b")], 5)


@query(_PAIR + ", e AS (SELECT * FROM p UNION ALL SELECT b, a, jaccard FROM p) SELECT a, b, jaccard, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY jaccard DESC, b) AS rank FROM e) WHERE rank <= 5")
def topk_matches_both_ways(spark, sf_dir):
    members, links = likely_links(spark, sf_dir)
    members = members.withColumns({"copies": F.lit(None).cast("long"), "score": F.lit(1.0), "level": F.lit("likely")})
    pairs = links.select("a", "b", half_up(F.col("jaccard"), 2).alias("score"), F.lit("likely").alias("level"))
    none = members.limit(0).select(F.lit("").alias("address"), "doc_id")
    best = stories.best_matches(stories.Links(members, pairs, none), "doc_id", 5)
    return best.select(F.col("doc_id").alias("a"), F.col("match").alias("b"), F.col("score").alias("jaccard"), "rank")


@query(_PAIR.replace("p AS (", "g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(w)) AS rep FROM t WHERE len(w) > 0), p AS (") + " SELECT * FROM p WHERE a IN (SELECT rep FROM g) AND b IN (SELECT rep FROM g)")
def representative_pairs(spark, sf_dir):
    """The likely pairs between representatives of equal token sets, without their copies."""
    _, links = likely_links(spark, sf_dir)
    return links.select("a", "b", half_up(F.col("jaccard"), 2).alias("jaccard"))


@query(f"WITH {_TOK} SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(w)) AS rep FROM t WHERE len(w) > 0")
def representatives(spark, sf_dir):
    return likely_links(spark, sf_dir)[0]
