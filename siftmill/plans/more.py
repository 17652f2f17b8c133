"""Further registered queries: extraction, page checks, violations, publishing, chains, feed dates, stream state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siftmill.functions import dates, extract, markup, text, url
from siftmill.functions.text import half_up
from siftmill.operators import backfill, checks, lexicon, prefilter, publish, readmodel, similar, state, stories
from siftmill.plans.queries import _ET, _HOST, _J, _PAIR, _PARAMS, _SLOT, _SCORED, RULES, candidates, judgments, likely_pairs, profiled, query, read
from siftmill.plans.stories import FIGURES
from siftmill.session import checkpointing
from siftmill.streaming import ledger

# ---- texts


def _numbers(t: str) -> str:
    return FIGURES.format(t)


@query(f"SELECT doc_id, len(n)::INT AS n, array_to_string(n, '|') AS numbers FROM (SELECT doc_id, {_numbers('text')} AS n FROM documents)")
def distinctive_numbers(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", extract.numbers(F.col("text")).alias("n"))
    return d.select("doc_id", F.size("n").alias("n"), F.array_join("n", "|").alias("numbers"))


@query(_PAIR + f", m AS (SELECT doc_id, {_numbers('text')} AS n FROM documents) SELECT p.a, p.b, least(len(list_intersect(x.n, y.n)), 2)::INT AS shared, floor(least(1.0, p.jaccard + least(len(list_intersect(x.n, y.n)), 2) * 0.08) * 100 + 0.5) / 100 AS score FROM p JOIN m x ON x.doc_id = p.a JOIN m y ON y.doc_id = p.b")
def shared_number_bonus(spark, sf_dir):
    n = read(spark, sf_dir, "documents").select("doc_id", extract.numbers(F.col("text")).alias("n"))
    p = likely_pairs(spark, sf_dir).join(n.toDF("a", "x"), "a").join(n.toDF("b", "y"), "b")
    p = p.withColumn("shared", F.least(F.size(F.array_intersect("x", "y")), F.lit(2)))
    none = F.lit(0)
    return p.select("a", "b", "shared", similar.pair_score(F.col("jaccard"), none, F.col("shared"), none, none, F.lit(False)).alias("score"))


@query()
def scored_pairs(spark, sf_dir):
    """Possible and likely pairs of whole documents, between representatives of copies."""
    t = F.col("text")
    words = F.filter(F.array(text.tokens(t)), lambda x: F.size(x) > 0)
    d = read(spark, sf_dir, "documents").select("doc_id", words.alias("variants"), extract.proper_nouns(t).alias("names"), extract.numbers(t).alias("figures"), extract.cves(t).alias("cves"), F.array().cast("array<string>").alias("urls"))
    return stories.linked(d, "doc_id").pairs


@query(f"SELECT conv_id, turn, lower(regexp_extract(coalesce(text, ''), '{extract._SPEAKER}', 1)) AS word FROM conversations")
def first_person_lint(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", extract.first_person(F.col("text")).alias("word"))


_SHORTLESS = f"regexp_replace(coalesce(text, ''), '{extract._SHORT}', '\\1\\2', 'g')"


@query(f"SELECT doc_id, len(regexp_extract_all({_SHORTLESS}, '{extract._STOP.replace(chr(39), chr(39) * 2)}'))::INT AS n FROM documents")
def extra_sentences(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", extract.extra_sentences(F.col("text")).alias("n"))


@query()
def proper_nouns(spark, sf_dir):
    names = read(spark, sf_dir, "documents").select("lang", F.explode(extract.proper_nouns(F.col("text"))).alias("name"))
    return names.groupBy("lang", "name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source, count(*) AS n FROM documents WHERE contains(trim(regexp_replace(lower(translate(text, '‘’“”–—', '''''\"\"--')), '[ \\t\\n\\r]+', ' ', 'g')), 'license') GROUP BY source")
def search_documents(spark, sf_dir):
    d = readmodel.search(read(spark, sf_dir, "documents"), text.search_key(F.col("text")), " License ")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(_SCORED + " SELECT doc_id, profile, score >= CASE profile WHEN 'strict' THEN 4.0 WHEN 'standard' THEN 3.0 ELSE 2.0 END AS passed FROM r")
def profile_threshold_pass(spark, sf_dir):
    s = prefilter.scores(profiled(spark, sf_dir), RULES)
    least = F.coalesce(*[F.when(F.col("profile") == n, p.threshold) for n, p in RULES.profiles.items()])
    return s.select("doc_id", "profile", (F.col("score") >= least).alias("passed"))


# ---- pages

_SPACED = "trim(regexp_replace({}, '[ \\t\\n\\r]+', ' ', 'g'))"
_TITLE = _SPACED.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
_SAYS = "regexp_matches(lower({0}), '(?:page|article|document|content) (?:you (?:are|were) looking for )?(?:(?:was |could )?not (?:be )?found|does not exist|no longer (?:exists|available)|is (?:missing|gone|no longer available)|(?:has been|was) (?:removed|deleted|moved))|nothing (?:was )?found (?:at|on) this (?:address|location|page)')"
_BRIEF = "(" + _SAYS + " OR (regexp_matches(lower({0}), '(?:^|[^0-9])404(?:[^0-9]|$)|^not found$') AND len(string_split({0}, ' ')) <= 6))"
_HEADS = "list_transform(list_concat(regexp_extract_all(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), regexp_extract_all(html, '(?is)<h2[^>]*>(.*?)</h2>', 1)), lambda h: trim(regexp_replace(regexp_replace(h, '<[^>]*>', '', 'g'), '[ \\t\\n\\r]+', ' ', 'g')))"
_SEEN = _SPACED.format("regexp_replace(html, '(?is)<head>.*?</head>|<head .*?</head>|<script.*?</script>|<style.*?</style>|<[^>]*>', ' ', 'g')")


@query(f"SELECT page_id, CASE WHEN {_BRIEF.format(_TITLE)} THEN 'title' WHEN len(list_filter({_HEADS}, lambda h: {_BRIEF.format('h')})) > 0 THEN 'heading' WHEN {_SAYS.format(_SEEN)} THEN 'text' END AS says_missing FROM pages")
def soft404_flags(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", markup.soft404(F.col("html")).alias("says_missing"))


_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(f"SELECT page_id, CASE WHEN regexp_matches({_HOST}, '{url.RELAYS}') THEN 'relay' WHEN regexp_matches(lower({_PATH}), '(?:^|/)amp(?:/|$)') THEN 'amp' WHEN len(list_filter({_PARAMS}, lambda p: regexp_matches(lower(p), '^(?:url|u|redirect|dest|target)=https?(?::|%3a)'))) > 0 THEN 'redirect' END AS reason FROM pages")
def disallowed_addresses(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", url.disallowed(F.col("url")).alias("reason"))


@query()
def main_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", markup.main_text(F.col("html")).alias("text"), F.size(markup.headings(F.col("html"), 2)).alias("n_headings"))


# ---- time

_NEXT = "CASE WHEN substr(slot, 12, 2) = '18' THEN strftime(substr(slot, 1, 10)::DATE + INTERVAL 1 DAY, '%Y-%m-%d') || '-0600' ELSE substr(slot, 1, 11) || CASE substr(slot, 12, 2) WHEN '06' THEN '1000' WHEN '10' THEN '1400' ELSE '1800' END END"


@query(f"SELECT DISTINCT slot, {_NEXT} AS next FROM (SELECT {_SLOT} AS slot FROM events)")
def slot_next(spark, sf_dir):
    s = read(spark, sf_dir, "events").select(dates.slot_of(F.col("ts")).alias("slot")).distinct()
    return s.select("slot", dates.next_slot(F.col("slot")).alias("next"))


@query("SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS at, 'ok' AS status FROM events")
def feed_date_round_trip(spark, sf_dir):
    d = dates.feed_date(F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" EST")))
    return read(spark, sf_dir, "events").select("event_id", d.alias("d")).select("event_id", F.date_format("d.ts", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("d.status").alias("status"))


@query("SELECT event_id, strftime(CASE WHEN event_id % 3 = 0 THEN timezone('UTC', timezone('America/New_York', date_trunc('day', ts)::TIMESTAMP + INTERVAL 18 HOUR)) ELSE ts END, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def publication_instants(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select("event_id", F.date_format(dates.publication_instant(F.col("ts"), F.col("event_id") % 3 == 0), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"SELECT event_id, strftime({_ET}, '%Y-%m') AS pass_key FROM events WHERE strftime({_ET}, '%Y-%m') BETWEEN '2024-01' AND '2024-02'")
def month_pass_join(spark, sf_dir):
    e, p = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), backfill.months(spark, "2024-01", "2024-02")
    return e.join(F.broadcast(p), (e["ts"] >= p["start"]) & (e["ts"] < p["until"])).select("event_id", "pass_key")  # two passes


@query("SELECT event_type, count(*) AS input, count_if(value IS NULL) AS undated, count_if(value IS NOT NULL AND ts >= since) AS in_window, count_if(value IS NOT NULL AND ts < since) AS old FROM events, (SELECT max(ts) - INTERVAL 72 HOUR AS since FROM events) GROUP BY event_type")
def collection_counters(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    e = e.crossJoin(F.broadcast(e.agg((F.max("ts") - F.make_dt_interval(F.lit(0), F.lit(72))).alias("since"))))
    dated, late = F.col("value").isNotNull(), F.col("ts") >= F.col("since")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("input"), F.count_if(~dated).alias("undated"), F.count_if(dated & late).alias("in_window"), F.count_if(dated & ~late).alias("old"))


@query("SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL")
def stream_first_seen(spark, sf_dir):
    checkpointing(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    schema = read(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").where("user_id IS NOT NULL")  # a pattern: as such a stream reads a single file too
    return ledger.dedup_to_table(spark, rows.select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", f"{folder}/out", f"{folder}/state").select("user_id")


# ---- checks, publishing, chains

STATUSES = ["F", "O"]


@query("""WITH o AS (SELECT * FROM orders)
SELECT 'status' AS rule, 'error' AS severity, o_orderkey::VARCHAR AS entity, 'o_orderstatus' AS field, o_orderstatus AS message FROM o WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL
UNION ALL SELECT 'priority', 'warning', o_orderkey::VARCHAR, 'o_orderpriority', o_orderpriority FROM o WHERE NOT coalesce(regexp_matches(o_orderpriority, '^[1-3]-'), false)
UNION ALL SELECT 'customer', 'error', o_orderkey::VARCHAR, 'o_custkey', o_custkey::VARCHAR FROM o WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'unique', 'error', l_orderkey::VARCHAR, 'l_orderkey', count(*)::VARCHAR FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def order_violations(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    rules = [("status", "error", "o_orderstatus", F.col("o_orderstatus").isin(STATUSES)), ("priority", "warning", "o_orderpriority", F.col("o_orderpriority").rlike("^[1-3]-"))]
    solvent = read(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return checks.collected(checks.row_checks(o, "o_orderkey", rules), checks.references(o, "o_orderkey", "o_custkey", solvent, "c_custkey", "customer"), checks.unique(read(spark, sf_dir, "lineitem"), "l_orderkey"))


@query("SELECT conv_id::VARCHAR AS entity, rule, 'warning' AS severity, 'text' AS field, regexp_extract(text, p, 0) AS message FROM conversations, (VALUES ('figure', '[0-9]+'), ('long_word', '\\p{L}{14,}')) r(rule, p) WHERE regexp_matches(text, p)")
def conversation_lint(spark, sf_dir):
    return checks.text_lint(read(spark, sf_dir, "conversations"), "conv_id", ["text"], [("figure", "warning", "[0-9]+"), ("long_word", "warning", r"\p{L}{14,}")])


@query(f"WITH {_J} SELECT doc_id, source, coalesce(code, 'unjudged') AS verdict FROM documents LEFT JOIN j USING (doc_id)")
def run_log_rows(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source")
    return publish.log_rows(d, judgments(spark, sf_dir).withColumnRenamed("code", "verdict"), "doc_id")


@query(f"WITH {_J}, l AS (SELECT coalesce(code, 'unjudged') AS v FROM documents LEFT JOIN j USING (doc_id)) SELECT count(*) AS fetched, count_if(v <> 'unjudged') AS judged, count_if(v = 'CS_PASS') AS published FROM l")
def run_funnel(spark, sf_dir):
    v = F.col("verdict")
    return publish.funnel(run_log_rows(spark, sf_dir), fetched=F.lit(True), judged=v != "unjudged", published=v == "CS_PASS")


_STEM = "strftime(o_orderdate, '%y%m%d')"


@query(f"WITH o AS (SELECT o_orderkey, {_STEM} AS stem FROM orders), old AS (SELECT stem, count(*) AS top FROM o WHERE o_orderkey % 2 = 0 GROUP BY stem), n AS (SELECT o_orderkey, stem, (row_number() OVER (PARTITION BY stem ORDER BY o_orderkey) + coalesce(top, 0))::INT AS number FROM o LEFT JOIN old USING (stem) WHERE o_orderkey % 2 = 1) SELECT o_orderkey, number, stem || '-' || CASE WHEN number < 10 THEN '0' ELSE '' END || number::VARCHAR AS item_id FROM n")
def ids_with_offset(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyMMdd").alias("stem"))
    old = readmodel.rank_ids(o.where("o_orderkey % 2 = 0"), "stem", [F.col("o_orderkey")], F.col("stem")).withColumnRenamed("nn", "number")
    return publish.offset_ids(o.where("o_orderkey % 2 = 1"), old, "stem", "number", [F.col("o_orderkey")]).select("o_orderkey", "number", "item_id")


_UP = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey // 3 END"


@query(f"WITH RECURSIVE o AS (SELECT o_orderkey AS k, {_UP} AS up FROM orders), e AS (SELECT k, up FROM o WHERE up IN (SELECT k FROM o)), c AS (SELECT k, k AS cur, 0 AS hops FROM o UNION ALL SELECT c.k, e.up, c.hops + 1 FROM c JOIN e ON e.k = c.cur WHERE e.up <> e.k) SELECT k AS o_orderkey, arg_max(cur, hops) AS root, max(hops)::INT AS hops FROM c GROUP BY k")
def chain_root(spark, sf_dir):
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 7 != 0, F.floor(k / 3)).alias("up"))
    return similar.chain_root(o.withColumn("up", F.when(F.col("up") != k, F.col("up"))), "o_orderkey", "up")


@query(f"SELECT o_orderkey, CASE WHEN r.k IS NULL THEN 'unknown' WHEN r.at > o_orderdate THEN 'later' END AS ref_problem FROM (SELECT *, {_UP} AS up FROM orders) o LEFT JOIN (SELECT o_orderkey AS k, o_orderdate AS at FROM orders) r ON r.k = o.up WHERE o.up IS NOT NULL")
def reference_problems(spark, sf_dir):
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.when(k % 7 != 0, F.floor(k / 3)).alias("up"))
    return publish.resolved(o, "up", o.drop("up"), "o_orderkey", "o_orderdate").where("up IS NOT NULL").select("o_orderkey", "ref_problem")


@query("SELECT o_orderpriority AS section, count_if(o_orderstatus = 'O') AS shown, count_if(o_orderstatus <> 'O') AS hidden FROM orders WHERE o_totalprice >= 1000 GROUP BY section")
def sections_with_hidden(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "section")
    return readmodel.sections(o, "section", F.col("o_totalprice") >= 1000, F.col("o_orderstatus") == "O")


@query("WITH n AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM n) SELECT lang, source, n, total::BIGINT AS total, floor(n / total * 1000 + 0.5) / 1000 AS share FROM t WHERE n >= 2 AND n > total * 0.05 AND lang IS NOT NULL")
def dominant_sources(spark, sf_dir):
    return readmodel.shares(read(spark, sf_dir, "documents"), ["lang"], "source", 0.05).select("lang", "source", "n", "total", "share")


@query("SELECT event_type, max(user_id) AS latest_user, count(DISTINCT user_id)::INT AS n, floor(avg(user_id) * 100 + 0.5) / 100 AS mean FROM events GROUP BY event_type")
def check_histories(spark, sf_dir):
    h = backfill.check_history(read(spark, sf_dir, "events").select("event_type", "user_id").distinct(), "event_type", "user_id")
    mean = read(spark, sf_dir, "events").groupBy("event_type").agg(half_up(F.avg("user_id"), 2).alias("mean"))
    return h.select("event_type", F.col("latest.user_id").alias("latest_user"), F.size("history").alias("n")).join(mean, "event_type")


# ---- vocabulary and snapshots

TERMS = {"licens*": 3.0, "that": 1.0, "with": 1.0, "from": 1.0}
_TERM = " UNION ALL ".join(f"SELECT '{t}' AS term, count(*) AS n FROM documents WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}]){t.rstrip('*')}{'[\\p{L}]*' if t.endswith('*') else ''}(?:[^\\p{{L}}\\p{{N}}]|$)')" for t in TERMS)


@query(f"SELECT * FROM ({_TERM}) WHERE n > 0")
def lexicon_hits(spark, sf_dir):
    return lexicon.term_counts(read(spark, sf_dir, "documents"), "text", TERMS)


@query("SELECT event_type, count(DISTINCT array_to_string(list_transform(list_sort(json_keys(props::JSON)), lambda k: k || '=' || coalesce(json_extract_string(props::JSON, '$.\"' || k || '\"'), '')), '&')) AS n FROM events WHERE props IS NOT NULL GROUP BY event_type")
def distinct_props(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("props IS NOT NULL")
    return e.groupBy("event_type").agg(F.countDistinct(state.canonical(F.col("props"))).alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'o_orderstatus' ELSE 'o_orderpriority' END AS field, CASE WHEN o_orderkey % 101 = 0 THEN o_orderstatus ELSE o_orderpriority END AS was, 'X' AS now FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0")
def first_differences(spark, sf_dir):
    k, a = F.col("o_orderkey"), read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = a.withColumns({"o_orderstatus": F.when(k % 101 == 0, "X").otherwise(F.col("o_orderstatus")), "o_orderpriority": F.when(k % 103 == 0, "X").otherwise(F.col("o_orderpriority"))})
    return state.first_difference(a, b, "o_orderkey")
