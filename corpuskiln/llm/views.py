"""What SQL can express of operators that it can't express whole: their own results, in fewer columns or at another parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm import jaccard, linededup, media, urlfilter


def jaccard_links(spark, sf_dir: str) -> DataFrame:
    """Of op2: how many documents, and how many other sets of shingles, a document is linked to."""
    return jaccard.op2_jaccard_join(spark, sf_dir).select("doc_id", F.col("n_links").cast("long").alias("n_links"), F.col("n_text_links").cast("long").alias("n_text_links"), (F.col("class_size") > 1).alias("linked"))


def media_payloads(spark, sf_dir: str) -> DataFrame:
    """Of op3: the payload as it is read back."""
    return media.op3_media_columns(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def equal_lines(spark, sf_dir: str) -> DataFrame:
    """op7 without edits: lines equal to an earlier one."""
    found = linededup.line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), edits=0)
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"), F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"))


def url_rules(spark, sf_dir: str) -> DataFrame:
    """Of op9: host, path and rule, and the verdict where a rule decides."""
    found = urlfilter.op9_url_filter(spark, sf_dir)
    return found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict"))


_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\\x{80}-\\x{10FFFF}]+')"
LINKS_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))) END AS s FROM d),
n AS (SELECT s, count(*) AS weight, min(doc_id) AS node FROM s GROUP BY s),
x AS (SELECT node, len(s) AS size, unnest(s) AS one FROM n),
c AS (SELECT a.node AS a, b.node AS b, any_value(a.size) AS m, any_value(b.size) AS n, count(*) AS common FROM x a JOIN x b ON a.one = b.one AND a.node <> b.node GROUP BY ALL),
l AS (SELECT a, count(*) AS links, sum(n.weight) AS docs FROM c JOIN n ON n.node = c.b WHERE common * 1000 >= 800 * (c.m + c.n - common) GROUP BY a)
SELECT s.doc_id, (coalesce(l.docs, 0) + n.weight - 1)::BIGINT AS n_links, coalesce(l.links, 0)::BIGINT AS n_text_links, coalesce(l.docs, 0) + n.weight > 1 AS linked
FROM s JOIN n ON n.s = s.s LEFT JOIN l ON l.a = n.node
"""
PAYLOADS_SQL = """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
p AS (SELECT doc_id, octet_length(raw) AS n, raw || unhex(repeat('00', (greatest(1, (octet_length(raw) + 63) // 64) * 64 - octet_length(raw))::INT)) AS payload FROM t)
SELECT doc_id, n::BIGINT AS n_bytes, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256 FROM p
"""
#: White space beyond ASCII.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
EQUAL_LINES_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS nth FROM documents),
u AS (SELECT doc_id, nth, trim(regexp_replace(lower(line), '{_SPACE}', ' ', 'g'), ' ') AS unit FROM l),
r AS (SELECT *, unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, nth) > 1 AS gone FROM u)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, coalesce(string_agg(nth::VARCHAR, ',' ORDER BY nth) FILTER (gone), '') AS dropped FROM r GROUP BY doc_id
"""
RULES_SQL = r"""
WITH p AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://((?s:.*))$', 1) AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT page_id, arg_max(h || rules.p, length(h || rules.p)) AS rule, arg_max(verdict, length(h || rules.p)) AS verdict FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY page_id)
SELECT q.page_id, host, path, rule, verdict FROM q LEFT JOIN f USING (page_id)
"""
