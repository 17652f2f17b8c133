"""Registered queries of collecting, judging, passes over the past, and the read model."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftmill.functions import dates
from siftmill.operators import backfill, collect, judging, readmodel, similar
from siftmill.plans.queries import _AFTER, _PAGES, _PAIR, _SLOT, _WORDS, likely_pairs, query, read


def at(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ---- collecting


@query("""WITH r AS (SELECT max(o_orderdate) FILTER (o_orderstatus IN ('F', 'O')) - INTERVAL 6 HOUR AS start FROM orders)
SELECT greatest(start, TIMESTAMP '1999-01-01' - INTERVAL 72 HOUR) AS since, CASE WHEN start IS NULL THEN 'no run' WHEN start < TIMESTAMP '1998-12-29' THEN 'floor' ELSE 'run' END AS basis FROM r""")
def collection_window(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "published").when(F.col("o_orderstatus") == "O", "silent").otherwise("failed")
    runs = read(spark, sf_dir, "orders").withColumn("status", status)
    return collect.default_since(runs, "status", "o_orderdate", "o_orderdate", at("1999-01-01 00:00:00"))


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN event_id % 11 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'implausible' ELSE 'undated' END
  WHEN event_id % 3 = 0 THEN CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-20' THEN 'future' WHEN strftime(ts, '%Y-%m-%d') < '2024-01-10' THEN 'old' ELSE 'inside' END
  WHEN ts > TIMESTAMP '2024-01-21' THEN 'future' WHEN ts < TIMESTAMP '2024-01-10 12:00:00' THEN 'old' ELSE 'inside' END AS status FROM events) GROUP BY status""")
def window_status_counts(spark, sf_dir):
    when = F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp"))
    status = F.when(F.col("event_id") % 2 == 0, "implausible").otherwise("missing")
    now, since = (F.lit(s).cast("timestamp") for s in ("2024-01-20 00:00:00", "2024-01-10 12:00:00"))
    w = collect.window_status(when, F.col("event_id") % 3 == 0, status, since, now)
    return read(spark, sf_dir, "events").groupBy(w.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id FROM pages WHERE contains(lower(url), '/es/') OR contains(lower(url), 'pills')")
def excluded_addresses(spark, sf_dir):
    patterns = F.array(F.lit("/ES/"), F.lit("Pills"))
    return read(spark, sf_dir, "pages").where(collect.excluded(F.col("url"), patterns)).select("page_id")


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 AND try_cast('2024-' || lpad((page_id % 14)::VARCHAR, 2, '0') || '-' || lpad((page_id % 33)::VARCHAR, 2, '0') AS DATE) IS NOT NULL
  THEN '2024-' || lpad((page_id % 14)::VARCHAR, 2, '0') || '-' || lpad((page_id % 33)::VARCHAR, 2, '0') END AS day FROM pages""")
def dates_in_addresses(spark, sf_dir):
    n = lambda k: F.lpad((F.col("page_id") % k).cast("string"), 2, "0")
    host = F.when(F.col("page_id") % 2 == 0, "news.example.eu").otherwise("example.com")
    u = F.concat(F.lit("https://"), host, F.lit("/items/x-2024-"), n(14), F.lit("-"), n(33), F.lit("_en?id="), F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", collect.path_date(u, {r"(^|\.)example\.eu$": r"-(\d{4})-(\d{2})-(\d{2})_[a-z]{2}$"}).alias("day"))


@query("SELECT doc_id, doc_id % 31 + 1 <= 18 AS reposted FROM documents")
def reposts(spark, sf_dir):
    lead = F.concat(F.coalesce("source", F.lit("x")), F.lit(": a speech, Paris, "), (F.col("doc_id") % 31 + 1).cast("string"), F.lit(" September 2023."))
    return read(spark, sf_dir, "documents").select("doc_id", collect.reposted(lead, F.lit("2023-09-20")).alias("reposted"))


@query("""WITH f AS (SELECT event_type, user_id, min(ts) AS first_at FROM events WHERE user_id IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY first_at, user_id) AS n FROM f)
SELECT event_type, array_to_string(list(user_id ORDER BY n), ',') AS samples FROM r WHERE n <= 2 GROUP BY event_type""")
def first_samples(spark, sf_dir):
    s = collect.samples(read(spark, sf_dir, "events"), "event_type", "user_id", "ts")
    return s.select("event_type", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


@query("""WITH t AS (SELECT count(*) AS sources, count_if(event_type IN ('click', 'view')) AS ok, count_if(event_type = 'error') AS failed, count_if(event_type = 'signup') AS manual, sum(event_id % 5)::BIGINT AS entries FROM events)
SELECT *, ok * 2 < ok + failed AS unhealthy FROM t""")
def fetch_totals(spark, sf_dir):
    status = F.when(F.col("event_type").isin("click", "view"), "ok").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "manual")
    report = read(spark, sf_dir, "events").select(status.alias("status"), (F.col("event_id") % 5).alias("entries"))
    t = collect.fetch_totals(report, "status", "entries")
    return t.withColumn("unhealthy", collect.unhealthy(t))


# ---- judging

_LABELLED = "l AS (SELECT doc_id FROM labels UNION ALL SELECT doc_id + 100000000 FROM labels WHERE doc_id % 50 = 0 UNION ALL SELECT doc_id FROM labels WHERE doc_id % 40 = 0)"


def _v(rule: str, entity: str, field: str, message: str, rest: str, severity: str = "error") -> str:
    return f"SELECT '{rule}' AS rule, '{severity}' AS severity, ({entity})::VARCHAR AS entity, '{field}' AS field, ({message})::VARCHAR AS message {rest}"


@query(f"WITH {_LABELLED} " + _v("unjudged", "doc_id", "doc_id", "doc_id", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l)") + " UNION ALL "
       + _v("no_survivor", "doc_id", "doc_id", "doc_id", "FROM l WHERE doc_id NOT IN (SELECT doc_id FROM documents)") + " UNION ALL " + _v("judged_twice", "doc_id", "doc_id", "count(*)", "FROM l GROUP BY doc_id HAVING count(*) > 1"))
def judged_once(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id")
    judgments = labels.unionAll(labels.where("doc_id % 50 = 0").selectExpr("doc_id + 100000000")).unionAll(labels.where("doc_id % 40 = 0"))
    return judging.judged_once(read(spark, sf_dir, "documents"), judgments, "doc_id")


_JUDGED = """j AS (SELECT o_orderkey AS candidate_id, CASE WHEN o_orderkey % 5 < 2 THEN 'cluster_merged' WHEN o_orderkey % 5 = 2 THEN 'repeat' ELSE 'new' END AS dedup, o_orderkey // 3 AS match_id,
  CASE WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'fail' END AS verdict, o_orderpriority AS reason_code, o_orderstatus AS section, CASE WHEN o_orderkey % 4 < 3 THEN o_orderkey // 10 END AS draft FROM orders)"""


def _judgments(spark, sf_dir):
    k = F.col("o_orderkey")
    dedup = F.when(k % 5 < 2, "cluster_merged").when(k % 5 == 2, "repeat").otherwise("new")
    verdict = F.when(F.col("o_orderstatus") == "F", "pass").otherwise("fail")
    return read(spark, sf_dir, "orders").select(
        k.alias("candidate_id"), dedup.alias("dedup"), F.floor(k / 3).alias("match_id"), verdict.alias("verdict"), F.col("o_orderpriority").alias("reason_code"), F.col("o_orderstatus").alias("section"),
        F.when(k % 4 < 3, F.floor(k / 10)).alias("draft"),
    )


@query(f"WITH {_JUDGED}, m AS (SELECT j.*, l.candidate_id AS lead, l.dedup AS ld, l.verdict AS lv, l.reason_code AS lc, l.section AS ls, l.draft AS lf, l.candidate_id IS NULL OR j.match_id = j.candidate_id AS bare FROM j LEFT JOIN j l ON l.candidate_id = j.match_id WHERE j.dedup = 'cluster_merged') "
       + " UNION ALL ".join([_v("cluster_lead", "candidate_id", "match_id", "match_id", "FROM m WHERE bare"), _v("lead_is_member", "candidate_id", "match_id", "match_id", "FROM m WHERE NOT bare AND ld = 'cluster_merged'"),
                             *[_v("carries_lead", "candidate_id", a, b, f"FROM m WHERE NOT bare AND {a} IS DISTINCT FROM {b}") for a, b in (("verdict", "lv"), ("reason_code", "lc"), ("section", "ls"), ("draft", "lf"))]]))
def cluster_members(spark, sf_dir):
    return judging.cluster_members(_judgments(spark, sf_dir))


@query(f"WITH {_JUDGED}, n AS (SELECT draft, count(*) AS pointing, count_if(verdict = 'pass' AND dedup = 'new') AS primaries FROM j GROUP BY draft), d AS (SELECT DISTINCT o_orderkey // 9 AS draft FROM orders), x AS (SELECT d.draft, coalesce(pointing, 0) AS pointing, coalesce(primaries, 0) AS primaries FROM d LEFT JOIN n USING (draft)) "
       + _v("one_primary", "draft", "draft", "primaries", "FROM x WHERE primaries <> 1") + " UNION ALL " + _v("unreferenced", "draft", "draft", "pointing", "FROM x WHERE pointing = 0"))
def draft_primaries(spark, sf_dir):
    drafts = read(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 9).alias("draft")).distinct()
    return judging.draft_primaries(drafts, _judgments(spark, sf_dir))


_DRAFTS = "p AS (SELECT page_id // 3 AS draft, page_id FROM pages), e AS (SELECT * FROM p UNION ALL SELECT DISTINCT draft, draft * 3 + 4 FROM p)"


def _drafts(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    other = pages.select((F.col("page_id") - 5).alias("page_id"), F.col("url").alias("other"))
    p = pages.withColumn("draft", F.floor(F.col("page_id") / 3)).join(other.where("page_id % 4 = 0"), "page_id", "left")
    return p.groupBy("draft").agg(F.concat(F.collect_list("page_id"), F.array(F.first("draft") * 3 + 4)).alias("ids"), F.concat(F.collect_list("url"), F.collect_list("other")).alias("sources"))


@query(f"WITH {_DRAFTS} " + _v("unknown_candidate", "draft", "page_id", "page_id", "FROM e WHERE page_id NOT IN (SELECT page_id FROM pages)") + " UNION ALL "
       + _v("two_owners", "page_id", "page_id", "count(DISTINCT draft)", "FROM e GROUP BY page_id HAVING count(DISTINCT draft) > 1"))
def owned_once(spark, sf_dir):
    return judging.owned_once(_drafts(spark, sf_dir), "ids", read(spark, sf_dir, "pages"), "draft", "page_id")


@query(f"WITH {_PAGES}, {_DRAFTS}, own AS (SELECT DISTINCT draft, norm FROM e JOIN n USING (page_id)), used AS (SELECT draft, page_id FROM p UNION ALL SELECT draft, page_id + 5 FROM p WHERE page_id % 4 = 0) "
       + _v("no_provenance", "u.draft", "sources", "n.url", "FROM used u JOIN n USING (page_id) WHERE (u.draft, n.norm) NOT IN (SELECT (draft, norm) FROM own)"))
def provenance(spark, sf_dir):
    return judging.provenance(_drafts(spark, sf_dir), "ids", "sources", read(spark, sf_dir, "pages"), "draft", "page_id")


_SEEN = "s AS (SELECT url, norm, page_id FROM n WHERE url IS NOT NULL)"
_BAD_ITEM = "page_id % 6 = 1"


@query(f"WITH {_PAGES}, {_SEEN} " + " UNION ALL ".join([
    _v("normalised", "url", "url", "url", "FROM s WHERE norm IS DISTINCT FROM url", "warning"), _v("first_seen", "url", "first_seen", "NULL", "FROM s WHERE page_id % 9 = 0"),
    _v("run_id", "url", "run_id", "'2024-01-05-0700'", "FROM s WHERE page_id % 7 = 0"), _v("verdict", "url", "verdict", "'maybe'", "FROM s WHERE page_id % 5 = 0"), _v("item_id", "url", "item_id", "'2024-01-05-1'", f"FROM s WHERE {_BAD_ITEM}")]))
def ledger_violations(spark, sf_dir):
    k = F.col("page_id")
    seen = read(spark, sf_dir, "pages").where("url IS NOT NULL").select(
        "url", F.when(k % 9 != 0, F.lit("2024-01-05")).alias("first_seen"), F.when(k % 7 == 0, "2024-01-05-0700").otherwise("2024-01-05-0600").alias("run_id"), F.when(k % 5 == 0, "maybe").otherwise("pass").alias("verdict"),
        F.when(k % 6 == 1, "2024-01-05-1").when(k % 6 == 2, "2024-01-05-1800-101").alias("item_id"),
    )
    return judging.ledger_checks(seen)


@query("""WITH s AS (SELECT * FROM (VALUES ('de', 0), ('en', 1), ('es', 2), ('none', 3), ('fr', 4)) v(lang, ord)), j AS (SELECT lang, quality, doc_id FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 <> 0)
SELECT s.lang, s.ord::INT AS ord, count(doc_id) AS tested, coalesce(count_if(quality = 1), 0) AS passed FROM s LEFT JOIN j ON j.lang = s.lang GROUP BY ALL""")
def stage_two_by_section(spark, sf_dir):
    j = read(spark, sf_dir, "documents").select("doc_id", "lang").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    j = j.select("lang", F.when(F.col("doc_id") % 3 == 0, "cluster_merged").otherwise("new").alias("dedup"), F.when(F.col("quality") == 1, "pass").otherwise("fail").alias("verdict"))
    return judging.stage_two(j, ["de", "en", "es", "none"], "lang")


_RANK = "CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END"


@query(f"SELECT 'source_order' AS rule, 'error' AS severity, user_id::VARCHAR AS entity, 'event_id' AS field, event_id::VARCHAR AS message FROM (SELECT *, {_RANK} AS k, max({_RANK}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS worst FROM events) WHERE worst > k")
def source_order(spark, sf_dir):
    t = F.col("event_type")
    rank = F.when(t == "click", 0).when(t == "view", 1).when(t == "purchase", 2).otherwise(3)
    return judging.ranked_order(read(spark, sf_dir, "events"), "user_id", "event_id", rank, "source_order")


# ---- the read model

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]


@query("""WITH v AS (SELECT * FROM (VALUES """ + ", ".join(f"('{p}', {i})" for i, p in enumerate(PRIORITIES)) + """) v(o_orderpriority, ord)), n AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_orderstatus = 'F')::INT DESC, o_orderdate DESC, o_orderkey) AS k FROM orders),
l AS (SELECT o_orderpriority, array_to_string(list(o_orderkey ORDER BY k), ',') AS items FROM r WHERE k <= 10 GROUP BY 1)
SELECT v.o_orderpriority, v.ord::INT AS ord, coalesce(n, 0) AS n, coalesce(items, '') AS items FROM v LEFT JOIN n USING (o_orderpriority) LEFT JOIN l USING (o_orderpriority)""")
def board(spark, sf_dir):
    b = readmodel.board(read(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES, "o_orderkey", F.col("o_orderstatus") == "F", "o_orderdate", 10)
    return b.withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query("SELECT o_orderdate, o_orderkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1997-03-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def last_before_range(spark, sf_dir):
    return readmodel.last_before(read(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_orderpriority"), "o_orderdate", at("1997-03-01 00:00:00"), "o_orderkey")


@query("SELECT greatest(TIMESTAMP '2000-01-01', (SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events)) AS now")
def effective_now(spark, sf_dir):
    return readmodel.effective_now(at("2000-01-01 00:00:00"), (read(spark, sf_dir, "orders"), "o_orderdate"), (read(spark, sf_dir, "events"), "ts"))


@query("""WITH c AS (SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count_if(event_type = 'purchase') AS applied, count_if(event_type = 'error') AS failed, count_if(event_type = 'click') AS hidden FROM events GROUP BY 1)
SELECT hour, CASE WHEN hidden > 0 THEN 'hidden' WHEN applied > 0 THEN 'nothing_passed' WHEN failed > 0 THEN 'runs_failed' ELSE 'no_runs' END AS reason FROM c""")
def empty_reasons(spark, sf_dir):
    n = lambda v: F.count_if(F.col("event_type") == v)
    c = read(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(n("purchase").alias("applied"), n("error").alias("failed"), n("click").alias("hidden"))
    return c.select("hour", readmodel.empty_reason(F.col("applied"), F.col("failed"), F.col("hidden")).alias("reason"))


@query(f"WITH s AS (SELECT DISTINCT {_SLOT} AS slot FROM events) SELECT slot, lag(slot) OVER (ORDER BY slot) AS previous, max(slot) OVER () AS latest, slot < max(slot) OVER () AS superseded FROM s")
def run_neighbours(spark, sf_dir):
    return readmodel.neighbours(read(spark, sf_dir, "events").select(dates.slot_of(F.col("ts")).alias("slot")).distinct(), "slot")


_TOTALS = """t AS (SELECT count_if(o_orderstatus = 'F') AS published, count_if(o_orderstatus = 'O') AS silent, count_if(o_orderstatus NOT IN ('F', 'O')) AS failed,
  coalesce(sum(o_orderkey % 50) FILTER (o_orderstatus IN ('F', 'O')), 0)::BIGINT AS unseen, coalesce(sum(o_orderkey % 17) FILTER (o_orderstatus IN ('F', 'O')), 0)::BIGINT AS stage1 FROM orders)"""


def _totals(spark, sf_dir):
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    status = readmodel.run_status(F.when(s == "F", "published").when(s == "O", "silent").otherwise(s))
    return readmodel.calibration_totals(read(spark, sf_dir, "orders").select(status.alias("status"), (k % 50).alias("unseen"), (k % 17).alias("stage1")), "status", "unseen", "stage1")


@query(f"WITH {_TOTALS} SELECT * FROM t")
def calibration_totals(spark, sf_dir):
    return _totals(spark, sf_dir)


@query(f"WITH {_TOTALS} SELECT 'mechanism_share' AS warning, floor(published / (published + silent) * 1000 + 0.5) / 1000 AS value FROM t WHERE floor(published / (published + silent) * 1000 + 0.5) / 1000 > 0.4 UNION ALL SELECT 'stage1_pass', floor(stage1 / unseen * 1000 + 0.5) / 1000 FROM t WHERE floor(stage1 / unseen * 1000 + 0.5) / 1000 > 0.25")
def calibration_warnings(spark, sf_dir):
    return readmodel.calibration_warnings(_totals(spark, sf_dir), readmodel.ratio(F.col("published"), F.col("published") + F.col("silent")))


_REASONS = ["NEAR A2/k_one: close", "[M3] NEAR C3: none", "low [alt EV:B1f/k_two]", "NEAR R3f/k_two: so [alt CS:B1f/k_two]", "so NEAR A2/k_one: no [alt EV:B1]"]
_REASON = "CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(_REASONS)) + " END"


@query("""WITH c AS (SELECT doc_id % 5 AS k, count(*) AS m FROM documents GROUP BY 1), x AS (SELECT * FROM (VALUES (0, 'element', 'A2/k_one'), (0, 'knob', 'k_one'), (1, 'element', 'C3'), (1, 'fixed', 'C3'), (2, 'alt', 'B1f/k_two'),
  (2, 'knob', 'k_two'), (3, 'element', 'R3f/k_two'), (3, 'alt', 'B1f/k_two'), (3, 'knob', 'k_two')) v(k, kind, name)) SELECT kind, name, sum(m)::BIGINT AS n FROM x JOIN c USING (k) GROUP BY ALL""")
def near_misses(spark, sf_dir):
    log = read(spark, sf_dir, "documents").select(F.expr(_REASON).alias("reason"))
    return readmodel.near_misses(log, "reason")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def missing_logs(spark, sf_dir):
    runs = read(spark, sf_dir, "orders").withColumn("survivors", F.col("o_orderkey") % 3)
    return readmodel.missing_logs(runs, read(spark, sf_dir, "lineitem").where("l_quantity > 40").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "survivors")


# ---- passes over the past


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def unjudged_in_window(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return backfill.unjudged(o, "o_orderkey", "o_orderdate", at("1997-01-01 00:00:00"), at("1998-01-01 00:00:00"), lines.where("l_returnflag = 'R'"), lines.where("l_quantity > 45")).select("o_orderkey")


@query("WITH j AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey // 4 END AS draft FROM orders WHERE o_orderstatus <> 'F') SELECT o_orderkey, CASE WHEN draft IS NOT NULL THEN dense_rank() OVER (ORDER BY draft) - 1 END::INT AS draft FROM j")
def remapped_drafts(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    j = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.floor(F.col("o_orderkey") / 4)).alias("draft"))
    return backfill.remapped(j, o.where("o_orderstatus = 'F'"), "o_orderkey", "draft").select("o_orderkey", "draft")


@query("SELECT DISTINCT url FROM pages WHERE url IS NOT NULL AND (page_id % 3 = 0 OR page_id % 4 = 1)")
def urls_to_verify(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    items = p.where("page_id % 3 = 0").groupBy(F.floor(F.col("page_id") / 9).alias("item")).agg(F.collect_list("url").alias("sources"))
    return backfill.urls_to_verify(items, "sources", p, "url", F.col("page_id") % 4 == 1)


@query(f"""WITH w AS (SELECT event_id, ts, {_AFTER} AS slot FROM events), u AS (SELECT *, timezone('UTC', timezone('America/New_York', strptime(slot, '%Y-%m-%d-%H%M'))) AS begins FROM w)
SELECT event_id, CASE WHEN begins >= TIMESTAMP '2024-01-08 20:00:00' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08 20:00:00' THEN '2024-01-08-1400' ELSE slot END AS slot FROM u""")
def slots_in_window(spark, sf_dir):
    t = [F.lit(s).cast("timestamp") for s in ("2024-01-05 00:00:00", "2024-01-08 20:00:00")]
    return read(spark, sf_dir, "events").select("event_id", backfill.slot_in_window(F.col("ts").cast("timestamp"), *t, F.lit("2024-01-08-1400")).alias("slot"))


@query(f"WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM d WHERE len(w) >= 12), f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g) SELECT doc_id, min(first) AS earlier FROM g JOIN f USING (g) WHERE doc_id > first GROUP BY doc_id")
def repeats_earlier(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("ord"), F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("words"))
    return backfill.repeats_earlier(d, "doc_id", "ord", "words")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'unjudged' END AS verdict, (o_orderkey % 2)::INT AS part FROM orders")
def audit_rows(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("verdict", F.col("o_orderstatus"))
    return backfill.audit_rows(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), "o_orderkey")


# ---- hints against an archive: odd documents are survivors, even ones the archive


@query(_PAIR + """, e AS (SELECT * FROM p UNION ALL SELECT b, a, jaccard FROM p), s AS (SELECT * FROM e WHERE a % 2 = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY jaccard DESC, b) AS n FROM s WHERE b % 2 = 0), m AS (SELECT a, array_to_string(list(b ORDER BY jaccard DESC, b), ',') AS archive FROM best WHERE n <= 5 GROUP BY a),
c AS (SELECT a, array_to_string(list(b ORDER BY jaccard DESC, b), ',') AS others FROM s WHERE b % 2 = 1 GROUP BY a),
r AS (SELECT a AS node, b AS m FROM s WHERE b % 2 = 1 UNION SELECT r.node, s.b FROM r JOIN s ON r.m = s.a WHERE s.b % 2 = 1), k AS (SELECT node, least(node, min(m)) AS root FROM r GROUP BY node),
nm AS (SELECT node, 'k' || dense_rank() OVER (ORDER BY root)::VARCHAR AS cluster FROM k)
SELECT doc_id, cluster, coalesce(archive, '') AS archive, coalesce(others, '') AS others FROM documents LEFT JOIN m ON m.a = doc_id LEFT JOIN c ON c.a = doc_id LEFT JOIN nm ON nm.node = doc_id WHERE doc_id % 2 = 1""")
def hints(spark, sf_dir):
    s = read(spark, sf_dir, "documents").where("doc_id % 2 = 1").select("doc_id", F.col("doc_id").alias("ord"))
    h = similar.hints(s, likely_pairs(spark, sf_dir).select("a", "b", F.col("jaccard").alias("score"), F.lit("likely").alias("level")), "doc_id")
    ids = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x["id"].cast("string")), ","), F.lit(""))
    return h.select("doc_id", "cluster", ids("archive_matches").alias("archive"), ids("candidate_matches").alias("others"))
