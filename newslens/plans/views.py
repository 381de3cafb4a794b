"""Domain views over the standard tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..runtime import ship

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Place names by nation key: what the nations of the tables, which have no names of their own, stand for. Some have several names, one has none.
PLACES = ("Algeria", "Argentina", "Brazil", "Canada", "Egypt", "Ethiopia", "France", "Germany", "India", "Indonesia", "Iran", "Iraq", "Japan", "Jordan", "Kenya", "Morocco", "Mozambique", "Peru", "UK", "Romania", "Saudi Arabia", "Vietnam", "Russia", "Britain", "nowhere")
_PLACE = f"(CASE n.n_nationkey {' '.join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(PLACES))} END)"

VIEWS: dict[str, str] = {
    "feed_entries": f"""SELECT d.doc_id AS id, d.doc_id AS seq, CAST(d.doc_id % 25 AS INT) AS flashpoint_id, p.url AS url,
  substring(d.text, 1, 60) AS title, d.lang AS language, concat(d.source, '.example.com') AS domain, {_PLACE} AS sourcecountry,
  CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.text END AS content, d.text AS description, DATE '2024-01-01' + CAST(d.doc_id % 30 AS INT) AS dt
FROM documents d LEFT JOIN pages p ON p.page_id = CAST(floor(d.doc_id / 4) AS BIGINT) LEFT JOIN nation n ON n.n_nationkey = d.doc_id % 25""",
    "feed_entry_jobs": """SELECT feed_entry_id, run_id, status, is_duplicate, failure_reason, extraction_method, fetch_duration_ms FROM (
  SELECT CAST(floor(event_id / 10) AS BIGINT) AS feed_entry_id, concat('run_', CAST(user_id % 5 AS STRING)) AS run_id,
    CASE event_type WHEN 'view' THEN 'extracted' WHEN 'click' THEN 'embedded' WHEN 'purchase' THEN 'summarized' WHEN 'signup' THEN 'skipped_duplicate' ELSE 'failed' END AS status,
    event_type = 'signup' AS is_duplicate,
    CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'no_text' WHEN 1 THEN 'paywall' WHEN 2 THEN 'js_required' ELSE 'http_error' END END AS failure_reason,
    CASE WHEN event_type <> 'error' THEN CASE event_id % 4 WHEN 0 THEN 'article_scope' WHEN 1 THEN 'densest_block' WHEN 2 THEN 'stop_words' ELSE 'whole_body' END END AS extraction_method,
    CAST(floor(value * 10) AS INT) AS fetch_duration_ms,
    row_number() OVER (PARTITION BY CAST(floor(event_id / 10) AS BIGINT), user_id % 5 ORDER BY event_id) AS rn FROM events) t WHERE rn = 1""",
    "feed_entry_vectors": "SELECT vec_id AS feed_entry_id, label AS flashpoint_id, embedding FROM embeddings",
    "processing_runs": """SELECT concat('run_', CAST(o_orderkey AS STRING)) AS run_id, CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'completed' ELSE 'partial' END AS status,
  CAST(o_orderdate AS DATE) AS target_date, o_orderdate AS started_at FROM orders""",
    "raw_entities": f"""SELECT CAST(floor(c.c_custkey / 3) AS BIGINT) AS feed_entry_id, CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'PER' WHEN 'BUILDING' THEN 'ORG' WHEN 'MACHINERY' THEN 'LOC' WHEN 'HOUSEHOLD' THEN 'MISC' ELSE 'DATE' END AS entity_group,
  CASE WHEN c.c_custkey % 2 = 0 THEN lower({_PLACE}) ELSE {_PLACE} END AS word, abs(c.c_acctbal) / 10000 AS score FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    # names that the texts hold: the first words of benchmark passages, each of which stands for a place
    "gazetteer": f"""SELECT name, CASE item % 5 WHEN 0 THEN 'PER' WHEN 1 THEN 'ORG' WHEN 2 THEN 'MISC' ELSE 'LOC' END AS entity_group, {_PLACE} AS place FROM (
  SELECT name, min(item_id) AS item FROM (SELECT item_id, regexp_extract(text, CASE item_id % 3 WHEN 0 THEN '^([^ ]+)' WHEN 1 THEN '^([^ ]+ [^ ]+)' ELSE '^([^ ]+ [^ ]+ [^ ]+)' END, 1) AS name FROM benchmark) b GROUP BY name) g
  JOIN nation n ON n.n_nationkey = g.item % 25""",
    "html_variants": """SELECT page_id, url, CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN concat(html, '<div>Subscribe to continue</div>') WHEN 2 THEN concat(html, '<div class="cookie-banner"></div>')
  WHEN 3 THEN '<html><body><div id="app"></div><script>window.__NUXT__={}</script></body></html>'
  WHEN 4 THEN concat('<meta property="og:image" content="https://img.example.com/', CAST(page_id AS STRING), '.jpg">', html, '<img src="/a/1.png"><img src="//cdn.example.com/pixel.gif">') ELSE html END AS html FROM pages""",
    "places": f"SELECT n.n_nationkey AS nation, {_PLACE} AS place FROM nation n",
    "flashpoints": "SELECT CAST(n_nationkey AS INT) AS id, n_name AS title, DATE '2024-01-01' + CAST(n_nationkey % 7 AS INT) AS created_at FROM nation",
    # clusters are computed in cluster_assignments and news_clusters; these members stand in for the relational queries on them
    "cluster_members": """SELECT vec_id AS feed_entry_id, label AS flashpoint_id, CAST(vec_id % 7 AS INT) AS cluster_no, round(1 - (vec_id % 90) / 100.0D, 4) AS similarity FROM embeddings""",
    "topics": """SELECT CAST(floor(event_id / 10) AS BIGINT) AS feed_entry_id, CASE event_id % 6 WHEN 0 THEN 'politics' WHEN 1 THEN 'sport' WHEN 2 THEN 'conflict, war and peace' WHEN 3 THEN 'health' WHEN 4 THEN 'Weather' ELSE 'unheard of' END AS topic FROM events""",
}


def for_duckdb(sql: str) -> str:
    """The view's SQL where DuckDB writes it differently: double literals."""
    return re.sub(r"(\d+\.\d+)D\b", r"\1::DOUBLE", sql)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view, or one of the standard tables, as a DataFrame."""
    ship(spark)
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    used = {x: spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in TABLES if re.search(rf"\b(?:FROM|JOIN) {x}\b", sql)}
    text = re.sub(r"\b(FROM|JOIN) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], sql.replace("{", "{{").replace("}", "}}"))
    return spark.sql(text, **used)


def oracle(sql: str) -> str:
    """SQL over domain views, with the views it names as common table expressions."""
    used = [x for x in VIEWS if re.search(rf"\b{x}\b", sql)]
    if not used:
        return sql
    head = ", ".join(f"{x} AS ({for_duckdb(VIEWS[x])})" for x in used)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {head}, {body[len('WITH'):]}"
    return f"WITH {head} {body}"
