"""More queries over the driver's tables, and their SQL: scalars, ordered windows, roles, routing, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import text
from quillmesh.operators import stories
from quillmesh.plans.queries import query
from quillmesh.streaming import incremental


@query(r"""WITH s AS (SELECT doc_id, left(trim(regexp_replace(lower(split_part(coalesce(text, ''), chr(10), 1)), '[^a-z0-9]+', '-', 'g'), '-'), 28) AS s FROM documents)
SELECT doc_id, CASE WHEN s = '' THEN 'x' ELSE s END AS slug FROM s""", "documents")
def slugs(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text.slug(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)).alias("slug"))


@query(r"""WITH c AS (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS c FROM documents)
SELECT doc_id, CASE WHEN length(c) > 80 THEN rtrim(left(c, 79)) || '…' ELSE c END AS snippet FROM c""", "documents")
def snippets(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text.clip(F.col("text"), 80).alias("snippet"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages", "pages")
def escaped_pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", text.html_escape(F.col("html")).alias("escaped"))


@query(r"""WITH t AS (SELECT conv_id, turn, regexp_extract_all(text, '\d+(?:[.,]\d+)*') AS nums, replace(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), ',', '') AS said FROM conversations)
SELECT conv_id, turn, len(nums) > 0 AND len(list_filter(nums, lambda n: NOT contains(said, replace(n, ',', '')))) = 0 AS grounded FROM t WHERE said IS NOT NULL""", "conversations")
def grounded_numbers(conversations: DataFrame) -> DataFrame:
    said = F.lag("text").over(W.partitionBy("conv_id").orderBy("turn"))
    return conversations.withColumn("said", said).where("said IS NOT NULL").select("conv_id", "turn", text.number_in_text(F.col("text"), F.col("said")).alias("grounded"))


@query("SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS question FROM conversations", "conversations")
def carried_questions(conversations: DataFrame) -> DataFrame:
    upto = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    return conversations.select("conv_id", "turn", "role", F.last(F.when(F.col("role") == "user", F.col("text")), ignorenulls=True).over(upto).alias("question"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS DISTINCT FROM event_type", "events")
def without_repeats(events: DataFrame) -> DataFrame:
    before = F.lag("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return events.withColumn("p", before).where(~F.col("p").eqNullSafe(F.col("event_type"))).select("event_id", "user_id", "event_type")


@query("SELECT p || ' -> ' || o_orderstatus AS move, count(*) AS n FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) WHERE p <> o_orderstatus GROUP BY ALL", "orders")
def move_histogram(orders: DataFrame) -> DataFrame:
    before = F.lag("o_orderstatus").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    moved = orders.withColumn("p", before).where("p <> o_orderstatus")
    return moved.groupBy(F.concat_ws(" -> ", "p", "o_orderstatus").alias("move")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS messages, count(*) FILTER (value > 50 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY) AS recent FROM events GROUP BY event_type", "events")
def recent_by_segment(events: DataFrame) -> DataFrame:
    newest = events.agg(F.max("ts").alias("newest"))  # one row
    recent = (F.col("value") > 50) & (F.col("ts") >= F.col("newest") - F.expr("INTERVAL 7 DAYS"))
    return events.crossJoin(F.broadcast(newest)).groupBy("event_type").agg(F.count("*").alias("messages"), F.count_if(recent).alias("recent"))


@query("SELECT date_trunc('day', ts) + INTERVAL 1 DAY * k AS window_end, event_type, count(*) AS items FROM events, (VALUES (1), (2)) AS v(k) GROUP BY ALL", "events")
def sliding_windows(events: DataFrame) -> DataFrame:
    return incremental.windows(events, "ts", ["event_type"])


@query(r"SELECT source, CAST(floor(sum(least(n, 1800)) * 1.4) AS BIGINT) + 450 * count(*) AS tokens FROM (SELECT source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n FROM documents) GROUP BY source", "documents")
def token_estimate(documents: DataFrame) -> DataFrame:
    n = F.sum(F.least(text.word_count(F.col("text")), F.lit(1800)))
    return documents.groupBy("source").agg((F.floor(n * F.lit(1.4).cast("double")) + 450 * F.count("*")).cast("long").alias("tokens"))


@query("""WITH c AS (SELECT event_type, user_id, count(DISTINCT date_trunc('day', ts)) AS sources, count(*) AS n, 1 + user_id % 5 AS importance, user_id % 3 > 0 AS told FROM events GROUP BY ALL),
s AS (SELECT *, round_even(2 * sources + importance + n / 10, 2) AS score FROM c), t AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY 2 * sources + importance DESC, score DESC, user_id) AS r FROM s),
a AS (SELECT *, row_number() OVER (PARTITION BY event_type, r > 1 AND sources >= 2 ORDER BY r) AS k FROM t), b AS (SELECT *, CASE WHEN r = 1 THEN 'TOP' WHEN sources >= 2 AND k <= 3 THEN 'TALKED_ABOUT' END AS one FROM a),
q AS (SELECT *, row_number() OVER (PARTITION BY event_type, one IS NULL, told AND importance >= 3, told AND importance <= 2 ORDER BY r) AS k2 FROM b)
SELECT event_type, user_id, score, coalesce(one, CASE WHEN told AND importance >= 3 AND k2 <= 6 THEN 'QUICK_HIT' WHEN told AND importance <= 2 AND k2 <= 2 THEN 'SKIP' END) AS role FROM q""", "events")
def story_roles(events: DataFrame) -> DataFrame:
    rolled = events.groupBy("event_type", "user_id").agg(F.countDistinct(F.date_trunc("day", "ts")).alias("sources"), F.count("*").alias("n"))
    scored = rolled.withColumns({"importance": 1 + F.col("user_id") % 5, "told": F.col("user_id") % 3 > 0}).withColumn("score", stories.score(F.col("sources"), F.col("importance"), F.col("n")))
    return stories.assign_roles(scored, "event_type", "user_id", summary="told").select("event_type", "user_id", "score", "role")


@query("SELECT page_id, CASE WHEN contains(lower(url), 'blog') THEN 'posts' WHEN contains(lower(url), 'news') THEN 'news' WHEN contains(lower(url), '.org') THEN 'org' ELSE 'unmatched' END AS segment FROM pages", "pages")
def routed_pages(pages: DataFrame) -> DataFrame:
    rules = [("blog", "posts"), ("news", "news"), (".org", "org")]
    return pages.select("page_id", text.route(F.col("url"), rules).alias("segment"))
