"""Query registry of the core library: name -> callable, name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundcheck.functions import calc, documents, text as tx
from groundcheck.operators import audits, briefs, claims, coverage, integrity, reviews, segments, selection, triage
from groundcheck.plans import tables
from groundcheck.plans.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


#: The same claims as ``tables`` cuts, in SQL.
_CLAIMS = r"""
d AS (SELECT doc_id, source AS run_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT run_id, doc_id, length(text) AS len,
  substr(text, CAST(floor(length(text) / 2.0) AS INTEGER) + 1, 80) || CASE WHEN doc_id % 5 = 0 THEN ' altered' ELSE '' END AS quote,
  CASE WHEN doc_id % 7 = 0 THEN 'missing' ELSE CAST(doc_id AS VARCHAR) END AS segment_id FROM d),
f AS (SELECT DISTINCT run_id, length(text) AS value FROM d WHERE doc_id % 3 = 0),
j AS (SELECT c.*, d.text, d.doc_id IS NOT NULL AS found, trim(regexp_replace(c.quote, '\s+', ' ', 'g')) AS q,
  EXISTS (SELECT 1 FROM f WHERE f.run_id = c.run_id AND f.value = c.len) AS fact
  FROM c LEFT JOIN d ON d.run_id = c.run_id AND CAST(d.doc_id AS VARCHAR) = c.segment_id),
n AS (SELECT *, len(list_filter([TRY_CAST(replace(x, ',', '') AS DOUBLE) FOR x IN regexp_extract_all(coalesce(text, ''), '\d[\d,]*(?:\.\d+)?')], lambda v: abs(v) = len)) > 0 AS told FROM j),
i AS (
  SELECT run_id, doc_id AS claim_index, 'schema' AS "check" FROM n WHERE NOT found
  UNION ALL SELECT run_id, doc_id, 'exact_quote' FROM n WHERE found AND (q = '' OR NOT contains(trim(regexp_replace(text, '\s+', ' ', 'g')), q))
  UNION ALL SELECT run_id, doc_id, 'numeric' FROM n WHERE found AND NOT fact AND NOT told)
"""


@query("WITH" + _CLAIMS + 'SELECT "check", count(*) AS n FROM i GROUP BY "check"')
def claim_issue_counts(spark, sf_dir):
    """Flagship: issues per check over claims cut from every document."""
    docs = table(spark, sf_dir, "documents")
    found = claims.issues(tables.claims(docs), tables.evidence(docs), tables.no_pages(docs), tables.financials(docs))
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query("WITH" + _CLAIMS + 'SELECT run_id, claim_index, "check" FROM i')
def claim_issues(spark, sf_dir):
    """Every issue of every claim."""
    docs = table(spark, sf_dir, "documents")
    return claims.issues(tables.claims(docs), tables.evidence(docs), tables.no_pages(docs), tables.financials(docs)).select("run_id", "claim_index", "check")


@query("WITH" + _CLAIMS + "SELECT c.run_id, count(DISTINCT c.doc_id) AS claims, CAST(coalesce(max(k.n), 0) AS BIGINT) AS issues, coalesce(max(k.n), 0) = 0 AS ok FROM c LEFT JOIN (SELECT run_id, count(*) AS n FROM i GROUP BY run_id) k ON k.run_id = c.run_id GROUP BY c.run_id")
def claims_gate(spark, sf_dir):
    """Verdict of every run."""
    docs = table(spark, sf_dir, "documents")
    own = tables.claims(docs)
    return claims.gate(own, claims.issues(own, tables.evidence(docs), tables.no_pages(docs), tables.financials(docs)))


@query(r"SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS folded, sha256(coalesce(text, '')) AS sha256, strlen(coalesce(text, '')) AS byte_length FROM documents")
def folded_hashes(spark, sf_dir):
    """Folded text, hash and byte length of every document."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalize_whitespace(text).alias("folded"), tx.sha256_hex(text).alias("sha256"), F.octet_length(text).cast("long").alias("byte_length"))


@query(r"SELECT doc_id, regexp_replace(text, '[\x{00AD}\x{0600}-\x{0605}\x{061C}\x{06DD}\x{070F}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}]|[\x00-\x08\x0b-\x1f\x7f]', '', 'g') AS clean FROM documents")
def invisible_stripped(spark, sf_dir):
    """Documents without invisible and control characters."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.strip_invisible(F.col("text")).alias("clean"))


@query(r"""SELECT doc_id, v, count(*) AS n FROM (SELECT doc_id, unnest(list_distinct([TRY_CAST(replace(x, ',', '') AS DOUBLE) FOR x IN regexp_extract_all(regexp_replace(coalesce(text, ''), '[^0-9,.]', ' ', 'g'), '\d[\d,]*(?:\.\d+)?')])) AS v FROM documents) GROUP BY doc_id, v""")
def document_numbers(spark, sf_dir):
    """Absolute values of the numbers in every document."""
    docs = table(spark, sf_dir, "documents")
    values = F.array_distinct(F.transform(tx.numbers(F.coalesce("text", F.lit(""))), lambda v: F.abs(v)))
    return docs.select("doc_id", F.explode(values).alias("v")).groupBy("doc_id", "v").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS total FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_totalprice, coalesce(abs(m.total - o_totalprice) < 1e-6, false) AS grounded FROM orders LEFT JOIN m ON l_orderkey = o_orderkey""")
def numeric_grounding(spark, sf_dir):
    """Whether an order's price is grounded in what its lines add up to."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2).alias("total"))
    known = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("total").alias("known"))
    return table(spark, sf_dir, "orders").join(known, "o_orderkey", "left").select("o_orderkey", "o_totalprice", tx.grounded(F.col("o_totalprice").cast("double"), F.col("known")).alias("grounded"))


@query("""WITH y AS (SELECT year(o_orderdate) AS y, sum(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1)
SELECT a.y, round(a.v / b.v - 1, 6) AS growth, round(a.v / a.n, 4) AS ratio, abs((a.v / b.v - 1) - round(a.v / b.v - 1, 2)) <= greatest(0.005, 0.01 * abs(a.v / b.v - 1)) AS ok FROM y a JOIN y b ON b.y = a.y - 1""")
def recomputed_ratios(spark, sf_dir):
    """Growth of yearly order value, recomputed against a rounded assertion."""
    per = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("double")).alias("v"), F.count(F.lit(1)).alias("n"))
    both = per.join(per.select((F.col("y") + 1).alias("y"), F.col("v").alias("p")), "y")
    growth = calc.recompute(F.lit("yoy_growth"), F.create_map(F.lit("current"), F.col("v"), F.lit("prior"), F.col("p")))
    ratio = calc.recompute(F.lit("margin"), F.create_map(F.lit("numerator"), F.col("v"), F.lit("denominator"), F.col("n").cast("double")))
    return both.select("y", F.round(growth, 6).alias("growth"), F.round(ratio, 4).alias("ratio"), calc.within_tolerance(growth, F.round(growth, 2)).alias("ok"))


@query("""SELECT l_partkey, l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS "end" FROM (
SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, coalesce(CAST(o_orderdate AS VARCHAR), ''), l_orderkey, l_linenumber) AS n
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey) WHERE n = 1""")
def point_in_time_facts(spark, sf_dir):
    """For every part the latest shipment, of the earliest order."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("end"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("string").alias("filed"))
    facts = lines.join(orders, "l_orderkey", "left").withColumnsRenamed({"l_orderkey": "unit_pos", "l_linenumber": "entry_pos"})
    return selection.point_in_time(facts, ["l_partkey"]).select("l_partkey", F.col("unit_pos").alias("l_orderkey"), F.col("entry_pos").alias("l_linenumber"), "end")


@query("""SELECT k AS kind, count(*) AS n FROM (SELECT CASE WHEN days BETWEEN 80 AND 100 THEN 'quarter' WHEN days BETWEEN 170 AND 190 THEN 'half_year' WHEN days BETWEEN 260 AND 280 THEN 'nine_months' WHEN days BETWEEN 355 AND 375 THEN 'full_year' ELSE 'other' END AS k
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey)) GROUP BY k""")
def period_kinds(spark, sf_dir):
    """Kinds of the periods between order and shipment."""
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = tx.period_type(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date"))
    return joined.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, count(*) FILTER (WHERE s <> 'post_event') AS kept, count(*) FILTER (WHERE s = 'post_event') AS excluded FROM (
SELECT c_custkey, CASE WHEN o_orderdate IS NULL THEN 'undated' WHEN CAST(o_orderdate AS DATE) > DATE '1997-06-30' THEN 'post_event' ELSE 'pre_event' END AS s FROM customer LEFT JOIN orders ON o_custkey = c_custkey) GROUP BY c_custkey""")
def date_guard_counts(spark, sf_dir):
    """Orders kept and excluded by a cutoff; customers without orders have an undated row."""
    hits = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("o_orderdate").cast("string").alias("published_date"))
    return selection.guard_counts(selection.date_guard(hits, F.to_date(F.lit("1997-06-30"))), "c_custkey")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY coalesce(value, -1) DESC, event_id) AS o FROM (SELECT *, CAST(ts AS DATE) AS d FROM events)),
r AS (SELECT *, row_number() OVER (PARTITION BY d, event_type ORDER BY o) AS rk, min(o) OVER (PARTITION BY d, event_type) AS f FROM o),
u AS (SELECT *, row_number() OVER (PARTITION BY d, user_id ORDER BY rk, f) AS u FROM r WHERE user_id IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY rk, f) AS selected FROM u WHERE u = 1)
SELECT CAST(d AS VARCHAR) AS day, event_id, selected FROM s WHERE selected <= 15""")
def round_robin_selection(spark, sf_dir):
    """Every day's 15 events, in turn from the event types, each user once."""
    events = table(spark, sf_dir, "events").withColumns({"day": F.col("ts").cast("date").cast("string"), "u": F.col("user_id").cast("string"), "none": F.lit(None).cast("string")})
    return selection.round_robin(events, 15, run="day", url="u", score="value", pos="event_id", select_key="event_type", cls="none").select("day", "event_id", "selected")


@query(r"""WITH l AS (SELECT doc_id, n - 1 AS line_no, lines[n] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS lines FROM documents))),
b AS (SELECT *, trim(regexp_replace(line, '\s+', ' ', 'g')) = '' AS blank FROM l),
i AS (SELECT *, regexp_matches(line, '^\s*(?:[-*+]|\d+\.)\s+') AS item, regexp_matches(line, '^\s*#+\s') AS head FROM b),
g AS (SELECT *, sum(CASE WHEN blank OR head OR item THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM i)
SELECT doc_id, count(DISTINCT g) AS units, CAST(sum(length(line)) AS BIGINT) AS chars FROM g WHERE NOT blank AND NOT head GROUP BY doc_id""")
def brief_units(spark, sf_dir):
    """Grounding units of every document and the characters in their lines."""
    units = briefs.grounding_units(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("run_id"), F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n").alias("text")), "run_id")
    return units.groupBy(F.col("run_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("units"), F.sum(F.length(F.replace("body", F.lit("\n"), F.lit("")))).alias("chars"))


@query(r"""WITH t AS (SELECT conv_id, turn, upper(substr(coalesce(role, 'unknown'), 1, 1)) || lower(substr(coalesce(role, 'unknown'), 2)) AS speaker, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS text FROM conversations),
q AS (SELECT conv_id, min(turn) AS first_qa FROM t WHERE regexp_matches(lower(text), 'go to q&a|move over to q&a|open the line for q&a|q&a session commences|begin the question-and-answer session') GROUP BY 1)
SELECT t.conv_id, 'seg-' || CASE WHEN row_number() OVER w < 10000 THEN lpad(CAST(row_number() OVER w AS VARCHAR), 4, '0') ELSE CAST(row_number() OVER w AS VARCHAR) END AS id, CASE WHEN turn > first_qa THEN 'qa' ELSE 'prepared' END AS section, speaker, text FROM t LEFT JOIN q ON q.conv_id = t.conv_id WHERE text <> '' WINDOW w AS (PARTITION BY t.conv_id ORDER BY turn)""")
def segmented_conversations(spark, sf_dir):
    """Conversations as transcripts: turns become speaker lines, segments come back."""
    turns = table(spark, sf_dir, "conversations")
    lines = turns.select("conv_id", F.col("turn").alias("line_no"), F.concat(F.initcap(F.coalesce("role", F.lit("unknown"))), F.lit(": "), F.translate(F.coalesce("text", F.lit("")), "\r\n", "  ")).alias("line"))
    return segments.segments(lines, "conv_id").select("conv_id", "id", "section", "speaker", "text")


@query("""SELECT conv_id, turn, lag(text, 1) OVER w AS previous, lag(text, 2) OVER w AS earlier FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def preceding_turns(spark, sf_dir):
    """Every turn with the two before it."""
    turns = table(spark, sf_dir, "conversations").withColumn("said", F.struct("text"))
    rows = segments.preceding_turns(turns, "conv_id", "turn", "said")
    n = F.size("context")
    return rows.select("conv_id", "turn", F.when(n > 0, F.element_at("context", -1)["text"]).alias("previous"), F.when(n > 1, F.element_at("context", -2)["text"]).alias("earlier"))


#: Character references as HTML reads them: the longest name that begins one, with or without its semicolon where
#: both are listed, or a number.
_NAMES = ", ".join("('{}', '{}')".format(n, v.replace("'", "''")) for n, v in html5.items())
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
INVISIBLE_SQL = r"\p{Cf}|[\x00-\x08\x0b-\x1f\x7f]"


def referenced(source: str) -> str:
    """CTEs that end in ``u``: ``source`` (nodes and other columns) with the references in its nodes read."""
    return rf"""names(name, told) AS (VALUES {_NAMES}),
refs AS (SELECT DISTINCT unnest(regexp_extract_all(x, '{_REFERENCE}')) AS ref FROM (SELECT unnest(nodes) AS x FROM {source})),
numbers AS (SELECT ref, CASE WHEN regexp_matches(ref, '^&#[xX]') THEN TRY_CAST('0x' || regexp_extract(ref, '^&#[xX]0*([0-9a-fA-F]+)', 1) AS BIGINT) ELSE TRY_CAST(regexp_extract(ref, '[0-9]+') AS BIGINT) END AS n FROM refs WHERE starts_with(ref, '&#')),
said AS (SELECT ref, CASE WHEN n IS NULL OR n = 0 OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN chr(65533)
 WHEN n BETWEEN 128 AND 159 THEN ['€', chr(129), '‚', 'ƒ', '„', '…', '†', '‡', 'ˆ', '‰', 'Š', '‹', 'Œ', chr(141), 'Ž', chr(143), chr(144), '‘', '’', '“', '”', '•', '–', '—', '˜', '™', 'š', '›', 'œ', chr(157), 'ž', 'Ÿ'][n - 127]
 WHEN n < 9 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE chr(CAST(n AS INTEGER)) END AS told FROM numbers
 UNION ALL SELECT ref, coalesce(max_by(told || substr(ref, length(name) + 2), length(name)), ref) FROM refs LEFT JOIN names ON starts_with(substr(ref, 2), name) WHERE NOT starts_with(ref, '&#') GROUP BY ref),
m AS (SELECT map(list(ref), list(told)) AS m FROM said),
u AS (SELECT {source}.* REPLACE (list_filter(list_transform(nodes, lambda x: string_split_regex(x, '{_REFERENCE}')[1] || array_to_string(list_transform(regexp_extract_all(x, '{_REFERENCE}'), lambda r, i: m[r] || string_split_regex(x, '{_REFERENCE}')[i + 1]), '')), lambda x: x <> '') AS nodes) FROM {source}, m)"""


_PAGE_TEXT = rf"""p AS (SELECT page_id, list_filter(string_split_regex(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', '<br>', 'g'), '(?s)<!--.*?-->|</?[a-zA-Z!][^>]*>'), lambda x: x <> '') AS nodes FROM pages),
{referenced("p")},
t AS (SELECT page_id, array_to_string([CASE WHEN regexp_full_match(x, '[ \n\t\f\r]+') THEN CASE WHEN contains(x, chr(10)) THEN chr(10) ELSE ' ' END ELSE x END FOR x IN nodes], chr(10)) AS raw FROM u),
s AS (SELECT page_id, regexp_replace(raw, '{INVISIBLE_SQL}', '', 'g') AS text FROM t)"""
_FINDINGS = " + ".join(f"len(regexp_extract_all(text, '(?i){pattern}'))" for pattern in documents.INJECTION_PATTERNS)


@query(f"WITH {_PAGE_TEXT} SELECT page_id, text, CAST(coalesce({_FINDINGS}, 0) AS INTEGER) AS findings FROM s")
def sanitized_pages(spark, sf_dir):
    """Text of every page without markup and invisible characters, and its injection findings."""
    pages = table(spark, sf_dir, "pages").select("page_id", documents.sanitize(F.col("html"), True).alias("text"))
    return pages.select("page_id", "text", F.size(documents.scan_for_injection(F.col("text"), most=None)).alias("findings"))


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def coverage_difference(spark, sf_dir):
    """Documents without labels and labels without documents."""
    return coverage.difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS run_id, CAST(o_orderkey AS VARCHAR) AS id FROM orders),
r AS (SELECT run_id, id, CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN 'skipped' WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'claims_extracted' ELSE 'deliberately_immaterial' END AS outcome, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN '' ELSE 'said' END AS reason FROM e WHERE CAST(id AS BIGINT) % 13 <> 0)
SELECT message, count(*) AS n FROM (
SELECT 'missing from the receipt' AS message FROM e WHERE CAST(id AS BIGINT) % 13 = 0 AND run_id IN (SELECT run_id FROM r)
UNION ALL SELECT 'section is missing: ' || count(*) || ' unaccounted for' FROM e WHERE run_id NOT IN (SELECT run_id FROM r) GROUP BY run_id
UNION ALL SELECT 'outcome must be claims_extracted or deliberately_immaterial' FROM r WHERE outcome = 'skipped'
UNION ALL SELECT 'extracted without claim ids' FROM r WHERE outcome = 'claims_extracted' AND CAST(id AS BIGINT) % 3 <> 0
UNION ALL SELECT 'unknown claim id(s): claim-none' FROM r WHERE CAST(id AS BIGINT) % 3 = 0
UNION ALL SELECT 'immaterial with claim ids' FROM r WHERE outcome = 'deliberately_immaterial' AND CAST(id AS BIGINT) % 3 = 0
UNION ALL SELECT 'immaterial without a reason' FROM r WHERE outcome = 'deliberately_immaterial' AND reason = '') GROUP BY message""")
def coverage_receipts(spark, sf_dir):
    """Orders as evidence of their customers, and a receipt that leaves some out."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    evidence = orders.select(F.col("o_custkey").cast("string").alias("run_id"), F.lit("segments").alias("section"), key.cast("string").alias("id"))
    outcome = F.when(key % 11 == 0, "skipped").when(key % 2 == 0, coverage.EXTRACTED).otherwise(coverage.IMMATERIAL)
    receipt = orders.where(key % 13 != 0).select(F.col("o_custkey").cast("string").alias("run_id"), F.lit("segments").alias("section"), key.cast("string").alias("id"), outcome.alias("outcome"), F.when(key % 3 == 0, F.array(F.lit("claim-none"))).otherwise(F.array().cast("array<string>")).alias("claim_ids"), F.when(key % 5 == 0, "").otherwise("said").alias("reason"))
    found = coverage.coverage_issues(receipt, evidence, tables.claims(table(spark, sf_dir, "documents")))
    return found.groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH a AS (SELECT doc_id, lang, source FROM documents WHERE doc_id % 17 <> 3), b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS lang, source FROM documents WHERE doc_id % 19 <> 5)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.lang IS DISTINCT FROM b.lang OR a.source IS DISTINCT FROM b.source""")
def record_diff(spark, sf_dir):
    """Documents against a perturbed copy: added, removed and changed records."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    old = docs.where(F.col("doc_id") % 17 != 3)
    new = docs.where(F.col("doc_id") % 19 != 5).withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "xx").otherwise(F.col("lang")))
    return reviews.claim_diff(old, new, ["doc_id"], ["lang", "source"]).select("doc_id", "change")


@query("""SELECT user_id AS run_id, event_type AS stage, count(*) AS attempts, count(*) FILTER (WHERE value < 30) AS rejections, greatest(count(*) - 1, 0) AS retries, arg_max(CASE WHEN value < 10 THEN 'rejected' WHEN value < 20 THEN 'blocked' WHEN value < 30 THEN 'failed' ELSE 'passed' END, event_id) AS outcome FROM events GROUP BY 1, 2""")
def attempt_rollup(spark, sf_dir):
    """Events as attempts of stages: rejections, retries, last outcome."""
    attempts = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), F.col("event_id").alias("attempt"), F.when(F.col("value") < 10, "rejected").when(F.col("value") < 20, "blocked").when(F.col("value") < 30, "failed").otherwise("passed").alias("outcome"))
    return audits.attempt_rollup(attempts)


@query("""SELECT user_id, count(*) FILTER (WHERE s = 'info') AS info, count(*) FILTER (WHERE s = 'low') AS low, count(*) FILTER (WHERE s = 'medium') AS medium, count(*) FILTER (WHERE s = 'high') AS high, count(*) FILTER (WHERE s = 'critical') AS critical
FROM (SELECT user_id, CASE WHEN event_id % 5 = 0 THEN 'info' WHEN event_id % 5 = 1 THEN 'low' WHEN event_id % 5 = 2 THEN 'medium' WHEN event_id % 5 = 3 THEN 'high' ELSE 'critical' END AS s FROM events) GROUP BY user_id""")
def severity_pivot(spark, sf_dir):
    """Findings by severity, one column each."""
    named = F.element_at(F.array(*[F.lit(s) for s in reviews.SEVERITIES]), (F.col("event_id") % 5 + 1).cast("int"))
    return audits.severity_counts(table(spark, sf_dir, "events").select("user_id", named.alias("severity")), ["user_id"])


@query("""SELECT event_type, CAST(ts AS DATE) AS date, min(value) AS low, max(value) AS high, arg_min(value, event_id) AS open, arg_max(value, event_id) AS close, count(*) AS row_count FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def daily_series(spark, sf_dir):
    """Daily bars of every event type. An event without a value has no price and makes no bar."""
    events = table(spark, sf_dir, "events").where("value is not null").withColumn("date", F.col("ts").cast("date"))
    counts = selection.series_summary(events, ["event_type", "date"]).select("event_type", "date", "row_count")
    bars = events.groupBy("event_type", "date").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.min_by("value", "event_id").alias("open"), F.max_by("value", "event_id").alias("close"))
    return bars.join(counts, ["event_type", "date"])


_ANSWERS = "(SELECT event_id, user_id, ((event_id * 37) % 101) / 100.0 AS noul FROM events)"


@query(f"""SELECT CAST(accept AS DOUBLE) AS accept, count(*) FILTER (WHERE noul < accept) AS flagged, count(*) FILTER (WHERE noul < accept AND noul < 0.5) AS defect, count(*) FILTER (WHERE noul < accept AND noul >= 0.5) AS "check" FROM {_ANSWERS}, (VALUES (0.8), (0.7), (0.6)) t(accept) GROUP BY accept""")
def triage_sweep(spark, sf_dir):
    """Flagged answers under three acceptance thresholds."""
    return triage.sweep(_answers(spark, sf_dir), [triage.Thresholds(accept=a) for a in (0.8, 0.7, 0.6)]).select("accept", "flagged", "defect", "check")


@query(f"""WITH a AS {_ANSWERS}, c AS (SELECT *, event_id % 6 = 5 AS failed FROM a), w AS (SELECT user_id, event_id, failed, unnest([noul, 1 - noul, 0.6]) AS p FROM c)
SELECT user_id AS run_id, count(DISTINCT event_id) AS audited, count(*) FILTER (WHERE NOT failed AND p < 0.7) AS flagged, count(*) FILTER (WHERE NOT failed AND p < 0.5) AS defect, count(*) FILTER (WHERE NOT failed AND p >= 0.5 AND p < 0.7) AS "check" FROM w GROUP BY user_id""")
def triage_counts(spark, sf_dir):
    """Calls of three questions each, some of them failed, and what is flagged of their answers, by run."""
    p = ((F.col("event_id") * 37) % 101) / F.lit(100.0)
    none = lambda t: F.lit(None).cast(t)
    answer = lambda x: F.struct(F.lit("noul").alias("type"), x.alias("noul"), none("string").alias("choice"), none("double").alias("confidence"), none("map<string,double>").alias("probabilities"), none("double").alias("score"), none("map<string,string>").alias("legend"))
    asked = F.create_map(F.lit("claim_text_traceable"), answer(p), F.lit("period_correct"), answer(1 - p), F.lit("value__a"), answer(F.lit(0.6)))
    subject = F.col("event_id").cast("string")
    calls = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), subject.alias("subject"), subject.alias("claim_id"), subject.alias("generation_id"), F.when(F.col("event_id") % 6 == 5, "error").otherwise("ok").alias("status"), asked.alias("answers"))
    return triage.counts(calls, triage.triage(triage.answers_of(calls)))


def _answers(spark, sf_dir):
    none = {"choice": "string", "expected": "string", "confidence": "double", "probabilities": "map<string,double>", "score": "double", "legend": "map<string,string>"}
    noul = ((F.col("event_id") * 37) % 101) / F.lit(100.0)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.lit("noul").alias("type"), noul.alias("noul"), *[F.lit(None).cast(t).alias(c) for c, t in none.items()])


@query("""SELECT CAST(c_custkey AS VARCHAR) AS run_id, class, select_key, query FROM (
SELECT c_custkey, 'consensus' AS class, 'consensus' AS select_key, c_name || ' consensus' AS query FROM customer
UNION ALL SELECT c_custkey, 'peer', n_name, n_name || ' against ' || c_name FROM customer JOIN nation ON n_nationkey <> c_nationkey AND n_regionkey = (SELECT n2.n_regionkey FROM nation n2 WHERE n2.n_nationkey = c_nationkey))""")
def expanded_queries(spark, sf_dir):
    """Search templates filled for every customer and the other nations of its region."""
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    companies = customers.select(F.col("c_custkey").cast("string").alias("run_id"), F.col("c_name").alias("company"), F.lit("").alias("ticker"), F.lit("").alias("event_id"))
    own = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    peers = customers.join(own, "c_nationkey").join(nations, "n_regionkey").where(F.col("c_nationkey") != F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("run_id"), F.col("n_name").alias("peer"), F.col("n_nationkey").alias("peer_pos"))
    templates = [("consensus", 0, "{company} consensus"), ("peer", 1, "{peer} against {company}")]
    return selection.expand_queries(companies, templates, peers).select("run_id", "class", "select_key", "query")


@query(r"""SELECT doc_id, regexp_matches(text, '[$€£]\s?\d|\d\s?%|\d[\d,]*(\.\d+)?\s*(thousand|million|billion|trillion|bps|basis\s+points)\b|\bper\s+cent\b', 'i') AS financial, regexp_matches(text, '\b(every|all (four|three|of the)|none of|no (peer|bank|competitor)s?|each of the)\b', 'i') AS universal, length(text) - length(replace(text, '$', '')) AS dollars FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\\$', ' ', 'g') AS text FROM documents)""")
def prose_flags(spark, sf_dir):
    """Financial figures, universal quantifiers and bare dollar signs of all texts."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return docs.select("doc_id", tx.has_financial_figure(F.col("text")).alias("financial"), tx.has_universal_quantifier(F.col("text")).alias("universal"), tx.unescaped_dollars(F.col("text"))["n"].alias("dollars"))


@query("""SELECT run_id, category, "first", n, row_number() OVER (PARTITION BY run_id ORDER BY "first") AS place FROM (SELECT source AS run_id, lang AS category, min(doc_id) AS "first", count(*) AS n FROM documents GROUP BY 1, 2)""")
def card_categories(spark, sf_dir):
    """Signal cards: a run's categories, their place, first claim and how many lines they have."""
    docs = table(spark, sf_dir, "documents")
    none = {c: "string" for c in ("status", "classification", "speaker", "quote", "segment_id", "web_evidence_id")} | {"caveats": "array<string>"}
    own = docs.select(F.col("source").alias("run_id"), F.col("lang").alias("category"), F.col("doc_id").alias("claim_index"), F.lit("fact").alias("claim_text"), *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    runs = docs.select(F.col("source").alias("run_id")).distinct().select("run_id", F.col("run_id").alias("ticker"), F.lit("e").alias("event_id"), F.lit("now").alias("generated_at"))
    card = audits.signal_card(own, runs).where("part = 0 and place > 0").groupBy(F.col("ticker").alias("run_id"), "category", "place").agg(F.min("claim_index").alias("first"), F.count(F.lit(1)).alias("n"))
    return card.select("run_id", "category", "first", "n", F.col("place").cast("long").alias("place"))



@query("""WITH m AS (SELECT source AS run_id, doc_id AS d, CASE doc_id % 13 WHEN 0 THEN '../' || doc_id WHEN 1 THEN 'a/./../' || doc_id WHEN 2 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS path FROM documents)
SELECT run_id, path, 'path is empty or leaves the run' AS message FROM m WHERE d % 13 IN (0, 2)
UNION ALL SELECT run_id, path, 'file is missing' FROM m WHERE d % 13 NOT IN (0, 2) AND d % 10 = 3
UNION ALL SELECT run_id, path, 'length differs' FROM m WHERE d % 13 NOT IN (0, 2) AND d % 10 <> 3 AND d % 11 IN (4, 5)
UNION ALL SELECT run_id, path, 'hash differs' FROM m WHERE d % 13 NOT IN (0, 2) AND d % 10 <> 3 AND d % 9 IN (0, 1, 2)""")
def manifest_integrity(spark, sf_dir):
    """Documents as files against a manifest with some wrong or missing hashes, lengths and paths."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("run_id"), d, d.cast("string").alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    told = F.when(d % 13 == 0, F.concat(F.lit("../"), "path")).when(d % 13 == 1, F.concat(F.lit("a/./../"), "path")).when(d % 13 == 2, "").otherwise(F.col("path"))
    sha = F.when(d % 9 == 0, "0").when(d % 9 == 1, F.upper(F.sha2("content", 256))).when(d % 9 > 2, F.sha2("content", 256))
    length = F.when(d % 11 == 4, F.octet_length("content") + 1).when(d % 11 != 5, F.octet_length("content"))
    manifest = docs.select("run_id", told.alias("path"), sha.alias("sha256"), length.alias("byte_length"))
    return integrity.manifest_issues(manifest, docs.where(d % 10 != 3).select("run_id", "path", "content"))


@query("""SELECT doc_id AS run_id, NOT (doc_id % 7 = 0 OR doc_id % 5 = 1) AS fresh, CASE WHEN doc_id % 7 = 0 AND doc_id % 5 = 1 THEN 'claims,lang' WHEN doc_id % 7 = 0 THEN 'lang' WHEN doc_id % 5 = 1 THEN 'claims' ELSE '' END AS stale FROM documents""")
def stale_inputs(spark, sf_dir):
    """Recorded hashes against current ones: one changed for every seventh run, one unrecorded for every fifth."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("run_id"), F.coalesce("lang", F.lit("")).alias("lang"))
    r, lang = F.col("run_id"), F.sha2("lang", 256)
    recorded = docs.select(r, F.when(r % 5 == 1, F.create_map(F.lit("lang"), lang)).otherwise(F.create_map(F.lit("lang"), lang, F.lit("claims"), F.sha2(r.cast("string"), 256))).alias("input_hashes"))
    now = docs.select(r, F.lit("lang").alias("name"), F.when(r % 7 == 0, "changed").otherwise(lang).alias("sha256"))
    now = now.unionByName(docs.select(r, F.lit("claims").alias("name"), F.sha2(r.cast("string"), 256).alias("sha256")))
    return integrity.staleness(recorded, now, ["claims", "lang"]).select("run_id", "fresh", F.array_join("stale", ",").alias("stale"))


@query("""WITH l AS (SELECT o_custkey AS c, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'O') AS ok FROM orders GROUP BY 1),
d AS (SELECT c_custkey, c_custkey % 3 AS k, c_custkey % 5 = 0 AS mute, coalesce(n, 0) AS n, coalesce(ok, 0) AS ok FROM customer LEFT JOIN l ON c = c_custkey)
SELECT message, count(*) AS n FROM (SELECT 'log has another ticker' AS message FROM d WHERE n > 0 AND c_custkey % 7 = 2 UNION ALL SELECT 'decision has no reason' FROM d WHERE mute UNION ALL SELECT 'used without a successful lookup' FROM d WHERE k = 0 AND ok = 0
UNION ALL SELECT 'attempted_failed needs lookups and no success' FROM d WHERE k = 1 AND (n = 0 OR ok > 0) UNION ALL SELECT 'not used but looked up' FROM d WHERE k = 2 AND n > 0) GROUP BY message""")
def price_decisions(spark, sf_dir):
    """Customers' decisions against their orders as a lookup log."""
    k = F.col("c_custkey")
    decisions = table(spark, sf_dir, "customer").select(k.alias("run_id"), F.element_at(F.array(F.lit("used"), F.lit("attempted_failed"), F.lit("not_used")), (k % 3 + 1).cast("int")).alias("decision"), F.when(k % 5 == 0, " ").otherwise("said").alias("reason"))
    log = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_custkey") % 7 != 2, "ACM").alias("ticker"), F.when(F.col("o_orderstatus") == "O", "ok").otherwise("error").alias("status"), F.lit("acm").alias("own_ticker"))
    return integrity.price_issues(decisions, log).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT source AS run_id, CAST(doc_id AS VARCHAR) AS subject, CASE WHEN doc_id % 13 = 0 THEN 'pre_replay' WHEN doc_id % 6 = 1 THEN 'unreplayable' WHEN doc_id % 4 <> 0 THEN 'match' WHEN doc_id % 8 = 0 THEN 'mismatch_builder' ELSE 'mismatch_input' END AS outcome FROM documents""")
def replayed_calls(spark, sf_dir):
    """Logged state hashes against rebuilt ones."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("run_id"), d, d.cast("string").alias("subject"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    logged = docs.select("run_id", "subject", F.when(d % 13 != 0, F.col("h")).alias("state_hash"), F.lit("b1").alias("builder_hash"))
    rebuilt = docs.where(d % 6 != 1).select("run_id", "subject", F.when(d % 4 == 0, "other").otherwise(F.col("h")).alias("state_hash"), F.when(d % 8 == 0, "b2").otherwise("b1").alias("builder_hash"))
    return integrity.replay(logged, rebuilt)


@query("""WITH c AS (SELECT o_custkey AS run_id, o_orderkey AS id FROM orders), l AS (SELECT * FROM c WHERE id % 7 <> 0 UNION ALL SELECT * FROM c WHERE id % 9 = 0 AND id % 7 <> 0 UNION ALL SELECT run_id, id + 1000000000 FROM c WHERE id % 50 = 1)
SELECT run_id, kind, count(*) AS n FROM (SELECT run_id, 'not accounted for' AS kind FROM c WHERE id % 7 = 0 AND run_id % 11 <> 3
UNION ALL SELECT run_id, 'receipt is missing' FROM (SELECT DISTINCT run_id FROM c WHERE run_id % 11 = 3)
UNION ALL SELECT run_id, 'in more than one bucket' FROM c WHERE id % 50 = 1 AND id % 3 = 0 AND run_id % 11 <> 3
UNION ALL SELECT run_id, 'in more than one bucket' FROM c WHERE id % 9 = 0 AND id % 7 <> 0 AND run_id % 11 <> 3 UNION ALL SELECT run_id, 'absent from the claims' FROM c WHERE id % 50 = 1 AND run_id % 11 <> 3) GROUP BY run_id, kind""")
def review_receipts(spark, sf_dir):
    """Orders as claims of their customers; a receipt that leaves out, doubles and invents some."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("k"))
    k = F.col("k")
    kept = orders.where(k % 7 != 0)
    listed = kept.select("run_id", F.lit("reviewed_ok").alias("bucket"), k.cast("string").alias("claim_id"))
    listed = listed.unionByName(kept.where(k % 9 == 0).select("run_id", F.lit("unverifiable").alias("bucket"), k.cast("string").alias("claim_id")))
    unknown = orders.where(k % 50 == 1).select("run_id", F.lit("reviewed_ok").alias("bucket"), (k + 1000000000).cast("string").alias("claim_id"))
    listed = listed.unionByName(unknown).unionByName(unknown.where(k % 3 == 0)).where("run_id % 11 <> 3")
    reports = orders.select("run_id").distinct().select("run_id", F.lit("full").alias("mode"), F.lit(1).alias("unverified_items"), (F.col("run_id") % 11 != 3).alias("has_receipt"))
    findings = spark.createDataFrame([], "run_id long, list_name string, idx int, severity string, artifact string, passage string, evidence string, recommendation string")
    found = reviews.receipt_issues(reports, listed, findings, orders.select("run_id", k.cast("string").alias("id")))
    ids = F.split(F.regexp_replace(F.regexp_replace("message", "^[^:]*: ", ""), " and (\\d+) more$", ""), ", ")
    more = F.coalesce(F.regexp_extract("message", " and (\\d+) more$", 1).try_cast("long"), F.lit(0))
    return found.select("run_id", F.regexp_extract("message", "^([^:]*)", 1).alias("kind"), (F.size(ids) + more).alias("n"))


@query("""WITH f AS (SELECT o_custkey, count(*) AS n, bool_or(o_orderkey % 5 >= 2) AS over_low, bool_or(o_orderkey % 5 >= 3) AS over_medium FROM orders WHERE o_orderkey % 6 = 0 GROUP BY 1),
r AS (SELECT c_custkey AS run_id, c_custkey % 3 AS v, coalesce(n, 0) AS n, coalesce(over_low, false) AS l, coalesce(over_medium, false) AS m FROM customer LEFT JOIN f ON o_custkey = c_custkey)
SELECT run_id, message FROM (SELECT run_id, 'pass with a finding above low' AS message FROM r WHERE v = 0 AND l UNION ALL SELECT run_id, 'warnings with a finding above medium' FROM r WHERE v = 1 AND m
UNION ALL SELECT run_id, 'warnings without a finding or unverified item' FROM r WHERE v = 1 AND n = 0 UNION ALL SELECT run_id, 'fail without a high or critical finding' FROM r WHERE v = 2 AND NOT m)""")
def verdict_checks(spark, sf_dir):
    """Customers' verdicts against the severities of some of their orders."""
    named = F.element_at(F.array(*[F.lit(s) for s in reviews.SEVERITIES]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    findings = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 6 == 0).select(F.col("o_custkey").alias("run_id"), named.alias("severity"))
    verdict = F.element_at(F.array(F.lit("pass"), F.lit("pass_with_warnings"), F.lit("fail")), (F.col("c_custkey") % 3 + 1).cast("int"))
    reports = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"), verdict.alias("verdict"), F.lit(1).alias("source_checks"), F.lit(1).alias("process_findings"), F.lit(0).alias("unverified_items"))
    return reviews.verdict_issues(reports, findings).select("run_id", "message")


@query("""SELECT user_id AS run_id, event_id AS key FROM events WHERE event_id % 4 <> 0 AND (event_id % 3 = 0 OR user_id % 10 <> 0)""")
def open_triage(spark, sf_dir):
    """Events as triage items: every fourth is settled, some runs settle all of tier check."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_id"), F.col("event_id").cast("string").alias("key"), F.when(F.col("event_id") % 3 == 0, "defect").otherwise("check").alias("severity"))
    settled = events.where(F.col("event_id") % 4 == 0).select("run_id", "key", F.lit("fixed").alias("action"))
    groups = events.where(F.col("run_id") % 10 == 0).select("run_id").distinct().select("run_id", F.lit("check-tier").alias("key"), F.lit("accepted").alias("action"))
    return triage.open_items(events, settled.unionByName(groups)).select("run_id", F.col("key").cast("long").alias("key"))


@query("""WITH x AS (SELECT doc_id, trim(unnest(string_split(coalesce(text, ''), chr(10)))) AS line FROM documents) SELECT DISTINCT line FROM x WHERE line <> '' AND doc_id % 2 = 1 AND line NOT IN (SELECT line FROM x WHERE doc_id % 2 = 0)""")
def new_lessons(spark, sf_dir):
    """Lines of odd documents that no even document has, once each."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    return audits.new_lessons(lines.where("doc_id % 2 = 1"), lines.where("doc_id % 2 = 0"))


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1""")
def first_hits(spark, sf_dir):
    """The first event of every user and type."""
    hits = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "run_id", "event_type": "query", "event_id": "pos"})
    return selection.first_per_query(hits).select(F.col("run_id").alias("user_id"), F.col("query").alias("event_type"), F.col("pos").alias("event_id"))


@query("""WITH p AS (SELECT l_partkey, l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 80 AND 100 AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
w AS (SELECT *, bool_or(q) OVER (PARTITION BY l_partkey) AS has FROM p) SELECT l_partkey, count(*) AS n FROM w WHERE q OR NOT has GROUP BY 1""")
def facts_in_period(spark, sf_dir):
    """Lines of a part whose period is a quarter, or all of them where none is."""
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    facts = joined.select("l_partkey", F.col("o_orderdate").cast("string").alias("start"), F.col("l_shipdate").cast("string").alias("end"))
    return selection.in_period(selection.with_period(facts), ["l_partkey"], kind="quarter").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT source AS run_id, count(*) AS pages, count(*) FILTER (WHERE doc_id % 3 = 0) AS cited, CASE WHEN count(*) FILTER (WHERE doc_id % 3 = 0) = 0 THEN 'no page is cited' WHEN count(*) FILTER (WHERE doc_id % 3 = 0) <= 0.5 * count(*) THEN 'few pages are cited' END AS advisory FROM documents GROUP BY 1""")
def evidence_use(spark, sf_dir):
    """Runs that cite few of their pages."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("run_id"), F.col("doc_id"), F.col("doc_id").cast("string").alias("id"))
    return claims.evidence_use(docs.select("run_id", "id"), docs.where("doc_id % 3 = 0").select("run_id", F.col("id").alias("web_evidence_id")))


@query("""SELECT source AS run_id, doc_id AS claim_index, CASE WHEN doc_id % 4 = 0 THEN 'none' WHEN doc_id % 4 = 1 THEN 'self' ELSE 'unknown' END AS kind FROM documents WHERE doc_id % 4 < 3""")
def inference_citations(spark, sf_dir):
    """Inferences that cite nothing, themselves or an unknown claim."""
    d = F.col("doc_id")
    own = F.concat(F.lit("claim-"), d.cast("string"))
    cited = F.when(d % 4 == 0, F.array().cast("array<string>")).when(d % 4 == 1, F.array(own)).when(d % 4 == 2, F.array(own, F.lit("claim-none"))).otherwise(F.array(F.lit("claim-3x")))
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("run_id"), d.alias("claim_index"), own.alias("id"), F.lit(claims.INFERENCE).alias("classification"), cited.alias("inferred_from"))
    known = rows.select("run_id").distinct().select("run_id", F.lit(-5).cast("long").alias("claim_index"), F.lit("claim-3x").alias("id"), F.lit("reported_fact").alias("classification"), F.array().cast("array<string>").alias("inferred_from"))
    found = claims.inference_problems(rows.unionByName(known))
    kind = F.when(F.col("message").contains("unknown"), "unknown").when(F.col("message").contains("itself"), "self").otherwise("none")
    return found.select("run_id", "claim_index", kind.alias("kind"))


@query("""SELECT o_custkey AS run_id, count(*) AS rounds, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed_rounds, count(*) FILTER (WHERE o_totalprice > 200000) AS escalations, arg_max(CASE WHEN o_orderstatus = 'F' THEN 'fail' ELSE 'pass' END, o_orderkey) AS verdict FROM orders GROUP BY 1""")
def round_rollup(spark, sf_dir):
    """Orders as review rounds of their customers."""
    rounds = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("round"), F.when(F.col("o_orderstatus") == "F", "fail").otherwise("pass").alias("verdict"), (F.col("o_totalprice") > 200000).alias("escalated"))
    return audits.round_rollup(rounds)


@query("""SELECT user_id AS run_id, count(*) AS calls, count(*) FILTER (WHERE event_id % 5 <> 0) AS ok, round(coalesce(sum(value), 0), 4) AS cost, count(*) FILTER (WHERE event_id % 2 = 0) AS windowed FROM events GROUP BY 1""")
def audit_runs(spark, sf_dir):
    """Events as logged calls: successes, cost and windowed ones by run."""
    e = F.col("event_id")
    answers = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.when(e % 5 != 0, "ok").otherwise("error").alias("status"), F.col("value").alias("cost"), (e % 2 == 0).alias("windowed"))
    return audits.audit_runs(answers).withColumn("cost", F.round("cost", 4))


@query("""SELECT doc_id, length(text) - length(replace(text, '$', '')) AS signs, sha256(replace(replace(text, chr(92) || '$', '$'), '$', chr(92) || '$')) AS escaped FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def escaped_currency(spark, sf_dir):
    """All texts, their bare dollar signs escaped."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return docs.select("doc_id", (F.length("text") - F.length(F.replace("text", F.lit("$"), F.lit("")))).alias("signs"), F.sha2(tx.escape_currency(F.col("text")), 256).alias("escaped"))


@query(r"""WITH d AS (SELECT doc_id, source AS run_id, coalesce(lang, 'None') AS section, coalesce(text, '') AS text FROM documents),
c AS (SELECT d.*, substr(text, CAST(floor(length(text) / 2.0) AS INTEGER) + 1, 80) || CASE WHEN doc_id % 5 = 0 THEN ' altered' ELSE '' END AS quote FROM d WHERE doc_id % 7 <> 0),
e AS (SELECT *, regexp_replace(quote, '[^\x20-\x7E]|["\\]', '', 'g') AS plain FROM c)
SELECT run_id, 'claim-' || doc_id AS id, 5 AS questions, sha256('CALL CONTEXT: ' || run_id || ' e earnings call, event date 2026-07-14.' || chr(10) || chr(10) || 'SOURCE SEGMENT (' || doc_id || ', ' || section || '):' || chr(10) || text || chr(10) || chr(10)
 || 'EXTRACTED CLAIM RECORD — audit each field separately:' || chr(10) || '{' || chr(10) || '  "classification": "reported_fact",' || chr(10) || '  "claim_text": "Length was ' || length(text) || ' in FY2026. \u20ac",' || chr(10) || '  "quote": "' || plain || '",' || chr(10)
 || '  "values": {' || chr(10) || '    "length": ' || length(text) || ',' || chr(10) || '    "half": ' || length(text) // 2 || '.5' || chr(10) || '  },' || chr(10) || '  "inferred_from": []' || chr(10) || '}' || chr(10)) AS state_hash FROM e""")
def audit_questions(spark, sf_dir):
    """What a model would be asked of every claim cut from the documents: the request's text, byte for byte."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    own = tables.claims(docs).withColumn("quote", F.regexp_replace("quote", "[^\\x20-\\x7E]|[\"\\\\]", ""))
    n = F.regexp_extract("claim_text", r"(\d+) in", 1).cast("long")
    own = own.withColumns({"claim_text": F.concat("claim_text", F.lit(" €")), "values": F.concat(F.lit('{"length": '), n.cast("string"), F.lit(', "half": '), F.expr("cast(regexp_extract(claim_text, '([0-9]+) in', 1) as bigint) div 2").cast("string"), F.lit(".50}"))})
    quoted = F.concat(F.lit('"'), F.col("quote"), F.lit('"'))
    raw = F.concat(F.lit('{"id": "x", "classification": "reported_fact", "claim_text": "'), F.col("claim_text"), F.lit('", "quote": '), quoted, F.lit(', "segment_id": "s", "values": '), F.col("values"), F.lit(', "speaker": null, "inferred_from": []}'))
    own = own.withColumn("raw", raw).where("segment_id <> 'missing'")
    runs = docs.select(F.col("source").alias("run_id")).distinct().select("run_id", F.col("run_id").alias("ticker"), F.lit("e").alias("event_id"), F.lit("2026-07-14").alias("event_date"))
    passages = docs.select(F.col("source").alias("run_id"), F.col("doc_id").cast("string").alias("id"), F.coalesce("lang", F.lit("None")).alias("section"), text.alias("text"))
    found = triage.state_hash(triage.audit_states(own, passages, tables.no_pages(docs), triage.call_context(runs)))
    return found.select("run_id", "id", (F.size("questions") - 1).alias("questions"), "state_hash")


@query("""SELECT 'd' || doc_id AS "key", p AS pattern, CASE WHEN p = 'jailbreak' THEN 2 ELSE 1 END AS n FROM documents, (VALUES ('jailbreak'), ('system prompt')) v(p) WHERE doc_id % 10 = 0""")
def injection_findings(spark, sf_dir):
    """Injection patterns in documents, every tenth of which has some planted, and in pages, counted."""
    planted = F.when(F.col("doc_id") % 10 == 0, " JailBreak the system prompt, jailbreak").otherwise("")
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), F.concat(F.coalesce("text", F.lit("")), planted).alias("text"))
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("key"), F.col("html").alias("text"))
    return documents.injection_counts(docs.unionByName(pages), "key", "text")


@query()
def brief_figures(spark, sf_dir):
    """Documents as briefs that cite their own claim: figures it does not hold, and citations."""
    docs = table(spark, sf_dir, "documents")
    own = tables.claims(docs).withColumn("run_id", F.col("id"))
    texts = docs.select(F.concat(F.lit("claim-"), F.col("doc_id").cast("string")).alias("run_id"), F.concat(F.coalesce("text", F.lit("")), F.lit(" [claim-"), F.col("doc_id").cast("string"), F.lit("]")).alias("text"))
    found = briefs.number_issues(texts, own).select("run_id", "check", "message")
    return found.unionByName(briefs.citation_issues(texts, own).select("run_id", "check", "message")).unionByName(briefs.dollar_issues(texts))
