"""The queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import text
from quillmesh.operators import health

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, *tables: str) -> Callable:
    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])
        ORACLES[f.__name__] = sql
        return f

    return register


@query("""WITH a AS (SELECT event_type, user_id, epoch_us(ts) / 86400e6 AS t FROM events), m AS (SELECT *, (SELECT max(t) FROM a) AS now FROM a), l AS (SELECT * FROM m WHERE t >= now - 45),
g AS (SELECT *, t - lag(t) OVER (PARTITION BY event_type, user_id ORDER BY t) AS gap FROM l), c AS (SELECT event_type, user_id, count(*) AS n, max(now) - max(t) AS silent, list_sort(list(gap) FILTER (gap IS NOT NULL)) AS gaps FROM g GROUP BY ALL HAVING count(*) >= 3)
SELECT event_type, user_id, n AS messages, round(gaps[len(gaps) // 2 + 1], 4) AS usual_days, round(silent, 4) AS silent_days FROM c WHERE silent > greatest(4, 2.5 * gaps[len(gaps) // 2 + 1])""", "events")
def quiet_sources(events: DataFrame) -> DataFrame:
    return health.quiet_sources(events)


@query("SELECT source AS segment, count(*) AS items, count(DISTINCT lang) AS langs, sum(n_chars) AS chars, max(doc_id) AS latest FROM documents GROUP BY source", "documents")
def stats_segments(documents: DataFrame) -> DataFrame:
    return documents.groupBy(F.col("source").alias("segment")).agg(F.count("*").alias("items"), F.countDistinct("lang").alias("langs"), F.sum("n_chars").alias("chars"), F.max("doc_id").alias("latest"))


@query("SELECT user_id, event_type, count(*) AS messages, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY ALL", "events")
def stats_senders(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id", "event_type").agg(F.count("*").alias("messages"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 30)", "orders", "lineitem")
def capture_new_ids(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    known = lineitem.where("l_quantity > 30")
    return orders.join(known, orders.o_orderkey == known.l_orderkey, "left_anti").select("o_orderkey")


@query("SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1", "events")
def upsert_latest(events: DataFrame) -> DataFrame:
    newest = events.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", "ts"), F.struct("ts", "event_id")).alias("x"))
    return newest.select("user_id", "x.*")


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 0", "documents", "labels")
def left_join_residual(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return documents.join(labels.where("toxic = 0"), "doc_id", "left").select("doc_id", "quality")


@query("SELECT n_name, count(*) AS items, count(DISTINCT o_orderkey) AS stories FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name", "lineitem", "orders", "customer", "nation")
def fourway_story_items(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    # one row an order before the joins, so that the large side is counted where it lies
    items = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("n").alias("items"), F.count("*").alias("stories"))


@query(r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS words, round_even(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) / 230, 1) AS minutes FROM documents", "documents")
def word_counts(documents: DataFrame) -> DataFrame:
    n = text.word_count(F.col("text"))
    return documents.select("doc_id", n.alias("words"), text.reading_minutes(n).alias("minutes"))


@query("SELECT md5(text) AS digest, min(doc_id) AS canonical, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1", "documents")
def dedupe_exact(documents: DataFrame) -> DataFrame:
    return documents.where("text IS NOT NULL").groupBy(F.md5(F.encode("text", "UTF-8")).alias("digest")).agg(F.min("doc_id").alias("canonical"), F.count("*").alias("copies")).where("copies > 1")


@query("SELECT lang, word, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents) GROUP BY ALL", "documents")
def doc_freq(documents: DataFrame) -> DataFrame:
    words = documents.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})")))).alias("word"), "doc_id")
    return words.groupBy("lang", "word").agg(F.count("*").alias("df"))


@query("SELECT conv_id, count(*) AS turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS prompt FROM conversations GROUP BY conv_id", "conversations")
def transcript_prompts(conversations: DataFrame) -> DataFrame:
    line = F.concat("role", F.lit(": "), "text")
    parts = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    return conversations.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("prompt"))


@query("SELECT event_type, event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 10", "events")
def latest_n(events: DataFrame) -> DataFrame:
    r = F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id")))
    return events.withColumn("r", r).where("r <= 10").select("event_type", "event_id", "user_id", "ts")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS items, count(DISTINCT user_id) AS sources FROM events GROUP BY ALL", "events")
def cluster_window(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("items"), F.countDistinct("user_id").alias("sources"))
