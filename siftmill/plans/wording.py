"""Registered queries of rules of wording: conversations as items with nested notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftmill.operators import lint
from siftmill.operators.lint import SpanRule
from siftmill.plans.queries import query, read

#: (name, pattern, before, after, unless, severity); patterns that Java and RE2 read alike.
RULES = (
    ("figure", "[0-9]+", r"[.,][0-9]*$", "^[%.,]", None, "warning"),
    ("shout", r"\p{Lu}{2,}", None, r"^[\p{L}\p{N}]", "^(?:EN|DE)$", "error"),
    ("sentence_in", r"[.!?]\s+In\s+\p{L}+", None, None, r"In\s+(?:the|der|le)$", "warning"),
)


def items(spark, sf_dir):
    """A row for each conversation: its first text as the claim, all of its turns as notes."""
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("notes"))
    return c.withColumn("claim", F.get("notes", 0)["text"])


def _sql() -> str:
    parts = []
    for name, p, before, after, unless, severity in RULES:
        ok = [f"NOT regexp_matches(ahead, '{before}')" if before else "true", f"NOT regexp_matches(rest, '{after}')" if after else "true", f"NOT regexp_matches(word, '{unless}')" if unless else "true"]
        parts.append(f"""SELECT '{name}' AS rule, '{severity}' AS severity, conv_id, field, arg_min(word, i) AS message, min(length(ahead)) + 1 AS start FROM
  (SELECT *, substr(text, length(ahead) + length(word) + 1) AS rest FROM (SELECT conv_id, field, text, i, split_part(ps[i], chr(2), 1) AS word, replace(array_to_string(ps[1:i - 1], ''), chr(2), '') AS ahead
  FROM (SELECT *, unnest(range(2, len(ps) + 1)) AS i FROM (SELECT *, string_split(regexp_replace(text, '({p})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS ps FROM t)))) WHERE {' AND '.join(ok)} GROUP BY conv_id, field""")
    return " UNION ALL ".join(parts)


_ITEMS = "o AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS n FROM conversations), t AS (SELECT conv_id, 'notes[' || n || '].text' AS field, text FROM o WHERE text IS NOT NULL UNION ALL SELECT conv_id, 'claim', text FROM o WHERE n = 0 AND text IS NOT NULL)"


@query(f"WITH {_ITEMS} SELECT rule, severity, conv_id::VARCHAR AS entity, field, message, start::INT AS start FROM ({_sql()})")
def nested_wording(spark, sf_dir):
    rules = [SpanRule(n, p, severity, cased=True, before=b, after=a, unless=u) for n, p, b, a, u, severity in RULES]
    return lint.spans(lint.texts(items(spark, sf_dir), "conv_id", ["claim", "notes[].text"]), "conv_id", rules)


_CONTENT = r"list_distinct(list_transform(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda w: length(regexp_replace(w, '([^s])s$', '\1')) >= 4), lambda w: regexp_replace(w, '([^s])s$', '\1')))"


@query(f"""WITH {_ITEMS}, w AS (SELECT conv_id, n, {_CONTENT} AS w FROM o WHERE text IS NOT NULL), c AS (SELECT conv_id, w AS c FROM w WHERE n = 0),
a AS (SELECT w.conv_id, n, len(list_intersect(c, w)) / least(len(c), len(w)) AS share FROM w JOIN c ON c.conv_id = w.conv_id WHERE least(len(c), len(w)) > 0)
SELECT 'restates' AS rule, 'warning' AS severity, conv_id::VARCHAR AS entity, 'notes[' || n || '].text' AS field, 'claim ' || floor(share * 100 + 0.5)::INT AS message FROM a WHERE share >= 0.7""")
def notes_that_restate(spark, sf_dir):
    t = lint.texts(items(spark, sf_dir), "conv_id", ["claim", "notes[].text"])
    return lint.restated(t, "conv_id", "claim", "notes.text").where("rule = 'restates'")
