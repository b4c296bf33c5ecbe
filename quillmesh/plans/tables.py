"""Queries over keyed tables, addresses and flags, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import rules, urls
from quillmesh.functions import text as tx
from quillmesh.operators import archive, stories
from quillmesh.plans.items import _NORM, _TITLE
from quillmesh.plans.queries import query
from quillmesh.sources import mail
from quillmesh.sources import tables as small

_HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"
_KEYS = "(?i)^(" + "|".join([*(p + ".*" for p in rules.TRACKING_PREFIXES), *(k + "(=.*)?" for k in rules.TRACKING_KEYS)]) + ")$"
_LINE = "split_part(coalesce(text, ''), chr(10), 1)"
_N = r"len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> ''))"


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


@query(f"""WITH p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u, url FROM pages), s AS (SELECT *, array_to_string(list_filter(string_split(split_part(u, '?', 2), '&'), lambda x: x <> '' AND NOT regexp_matches(x, {_q(_KEYS)})), '&') AS q FROM p)
SELECT page_id, regexp_replace({_HOST}, '^www\\.', '') AS domain, CASE WHEN NOT contains(u, '?') THEN u WHEN q = '' THEN split_part(u, '?', 1) ELSE split_part(u, '?', 1) || '?' || q END AS canonical FROM s""", "pages")
def canonical_urls(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", urls.domain_col(F.col("url")).alias("domain"), urls.without_tracking(F.col("url")).alias("canonical"))


_KIND = f"""CASE WHEN starts_with(lower(url), 'mailto:') THEN 'mailto' WHEN regexp_matches(regexp_replace({_HOST}, ':.*$', ''), {_q(rules.SOCIAL_HOST)}) THEN 'social' WHEN regexp_matches(regexp_replace({_HOST}, ':.*$', ''), {_q(rules.TRACKER_HOST)})
OR regexp_replace({_HOST}, ':.*$', '') = 'substack.com' OR regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*/redirect/|/ss/c/|/CL0/)') THEN 'tracked' ELSE 'source' END"""


@query(f"SELECT page_id, {_KIND} AS kind, {_KIND} <> 'source' OR " + " OR ".join(f"ends_with('.' || regexp_replace({_HOST}, '^www\\.', ''), '.{d}')" for d in rules.NEWSLETTER_DOMAINS) + " AS of_newsletter FROM pages", "pages")
def link_kinds(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", urls.kind_col(F.col("url")).alias("kind"), urls.of_newsletter_col(F.col("url")).alias("of_newsletter"))


@query(f"""WITH f AS (SELECT doc_id, source, {_LINE} AS s, text, {_N} AS n FROM documents) SELECT doc_id, CASE WHEN (trim(regexp_replace(s, '\\s+', ' ', 'g')) = '' OR regexp_matches(s, {_q(rules.CONFIRM)})) AND n < 250 THEN 0 ELSE 1 END AS is_issue,
CAST(regexp_matches(s, {_q(rules.PROMO_SUBJECT)}) AND n <= 200 AS INTEGER) AS is_promo, CAST(regexp_matches(s, {_q(rules.SPONSOR_LABEL)}) OR regexp_matches(left(coalesce(text, ''), 200), {_q(rules.SPONSOR_BODY)}) AS INTEGER) AS is_sponsor FROM f""", "documents")
def message_flags(documents: DataFrame) -> DataFrame:
    n, subject = F.size(tx.words(F.col("text"))), F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    return documents.select("doc_id", tx.is_issue(subject, n).alias("is_issue"), tx.is_promo(subject, F.ceil(n / 100)).alias("is_promo"), tx.is_sponsor(F.lit(None).cast("string"), subject, F.col("text")).alias("is_sponsor"))


@query(f"""SELECT doc_id, {_NORM.format(_LINE)} AS norm_title, {_TITLE.format(_LINE)} AS title, array_to_string(list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '')[1:30], ' ') || CASE WHEN {_N} > 30 THEN ' …' ELSE '' END AS first_words,
trim(split_part(split_part(split_part({_LINE}, ' – ', 1), ' from ', 1), '@', 1)) AS newsletter, regexp_replace(replace(regexp_replace({_LINE}, '\\[([^\\]]*)\\]\\(([^)]*)\\)', '\\1 <\\2>', 'g'), '**', ''), '^#+\\s*', '') AS plain FROM documents""", "documents")
def item_texts(documents: DataFrame) -> DataFrame:
    line = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    return documents.select("doc_id", tx.norm(line).alias("norm_title"), tx.clean_title(line).alias("title"), tx.first_words(F.col("text"), 30, " …").alias("first_words"), tx.newsletter_name(line).alias("newsletter"), tx.markdown_to_text(line).alias("plain"))


@query(r"""WITH s AS (SELECT doc_id, source, left(trim(regexp_replace(lower(coalesce(source, 'x')), '[^a-z0-9]+', '-', 'g'), '-'), 28) AS s FROM documents)
SELECT doc_id, concat_ws('/', source, strftime(DATE '2026-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d'), CASE WHEN s = '' THEN 'x' ELSE s END || '__' || doc_id || '.eml') AS path FROM s""", "documents")
def archive_paths(documents: DataFrame) -> DataFrame:
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string")
    return documents.select("doc_id", mail.archive_path(F.col("source"), day, F.col("source"), F.col("doc_id").cast("string")).alias("path"))


@query("SELECT user_id AS sender_email, event_type AS sender_name, CAST(user_id % 3 AS VARCHAR) AS to_address, count(*) AS n, max(CAST(event_id AS VARCHAR)) AS sample FROM events WHERE value < 50 GROUP BY ALL", "events")
def unmatched_top(events: DataFrame) -> DataFrame:
    own = events.select(F.col("user_id").alias("sender_email"), F.col("event_type").alias("sender_name"), (F.col("user_id") % 3).cast("string").alias("to_address"), F.col("event_id").cast("string").alias("subject"), F.when(F.col("value") < 50, "unmatched").otherwise("mail").alias("segment"))
    return archive.unmatched(own)


@query("SELECT event_type AS segment, user_id AS sender_email, count(*) AS n, max(ts) AS last FROM events WHERE value > 20 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 14 DAY GROUP BY ALL", "events")
def sender_health(events: DataFrame) -> DataFrame:
    newest = events.agg(F.max("ts").alias("_m"))  # one row
    own = events.crossJoin(F.broadcast(newest)).select(F.col("event_type").alias("segment"), F.col("user_id").alias("sender_email"), F.col("ts").alias("sent_date"), (F.col("value") > 20).cast("int").alias("is_issue"), "_m")
    return archive.by_sender(own, F.col("_m") - F.expr("INTERVAL 14 DAYS"))


@query("SELECT event_type AS segment, count(*) AS scanned, count(*) FILTER (o_orderkey IS NULL) AS added, count(o_orderkey) AS known FROM events LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) ON event_id = o_orderkey GROUP BY ALL", "events", "orders")
def capture_counts(events: DataFrame, orders: DataFrame) -> DataFrame:
    return archive.capture_counts(events.select(F.col("event_id").alias("gmail_id"), F.col("event_type").alias("segment")), orders.select(F.col("o_orderkey").alias("gmail_id")))


@query("""SELECT d.doc_id AS gmail_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars >= 100 AND d.text IS NOT NULL AND coalesce(l.toxic, 0) = 0 AND l.quality IS DISTINCT FROM 1 AND d.lang IN ('en', 'de')""", "documents", "labels")
def split_worklist(documents: DataFrame, labels: DataFrame) -> DataFrame:
    own = documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("gmail_id"), (F.col("n_chars") >= 100).cast("int").alias("is_issue"), F.col("text").alias("raw_eml_path"), F.when(F.col("toxic") == 1, "x").alias("duplicate_of"),
        F.when(F.col("quality") == 1, "done").when(F.col("quality") == 0, "failed").otherwise("pending").alias("split_status"), F.col("lang").alias("segment"), F.col("doc_id").alias("sent_date"),
    )
    return archive.to_split(own, ["en", "de"]).select("gmail_id")


@query("""SELECT d.doc_id AS item_id FROM documents d WHERE d.doc_id % 7 <> 0 AND d.doc_id % 5 < 3 AND d.doc_id % 11 <> 0 AND d.source IS NOT NULL AND d.doc_id >= 10 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1 AND l.toxic = 0)""", "documents", "labels")
def extract_worklist(documents: DataFrame, labels: DataFrame) -> DataFrame:
    kind = F.when(F.col("doc_id") % 5 == 0, "story").when(F.col("doc_id") % 5 == 1, "essay").when(F.col("doc_id") % 5 == 2, "teaser").otherwise("intro")
    items = documents.select(F.col("doc_id").alias("item_id"), F.col("doc_id").alias("gmail_id"), (F.col("doc_id") % 7 == 0).cast("int").alias("is_sponsor"), kind.alias("kind"), F.col("source").alias("segment"), F.col("doc_id").alias("sent_date"), F.lit(1).alias("position"))
    messages = documents.select(F.col("doc_id").alias("gmail_id"), F.when(F.col("doc_id") % 11 == 0, 1).alias("is_promo"), F.lit(None).cast("string").alias("duplicate_of"))
    done = labels.select(F.col("doc_id").alias("item_id"), F.col("quality").cast("string").alias("prompt_version"), F.when(F.col("toxic") == 1, "failed").alias("error"))
    return archive.to_extract(items.where("segment IS NOT NULL"), messages, done, "1", since="10").select("item_id")


@query("SELECT k, v FROM (SELECT o_orderkey AS k, o_totalprice AS v FROM orders UNION ALL SELECT e.event_id, min(e.value) FROM events e WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = e.event_id) GROUP BY e.event_id)", "orders", "events")
def insert_or_ignore(orders: DataFrame, events: DataFrame) -> DataFrame:
    return archive.insert_new(orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")), events.select(F.col("event_id").alias("k"), F.col("value").alias("v")), ["k"])


@query("""SELECT o_orderkey AS k, o_orderdate AS first_at, CASE WHEN e.event_id IS NULL THEN o_orderstatus ELSE e.event_type END AS status FROM orders LEFT JOIN events e ON e.event_id = o_orderkey
UNION ALL SELECT event_id, ts, event_type FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders)""", "orders", "events")
def upsert_draft(orders: DataFrame, events: DataFrame) -> DataFrame:
    table = orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("first_at"), F.col("o_orderstatus").alias("status"))
    return archive.upsert(table, events.select(F.col("event_id").alias("k"), F.col("ts").alias("first_at"), F.col("event_type").alias("status")), ["k"], keep=("first_at",))


@query("SELECT l_orderkey AS parent, l_linenumber AS position, 0 AS again FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT o_orderkey, 1, 1 FROM orders WHERE o_orderstatus = 'F'", "lineitem", "orders")
def replace_children(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    table = lineitem.select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("position"), F.lit(0).alias("again"))
    return archive.replace_children(table, orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("parent"), F.lit(1).alias("position"), F.lit(1).alias("again")), ["parent"])


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN l.toxic = 1 THEN 'failed' ELSE 'done' END AS split_status, CASE WHEN l.toxic = 0 THEN 'roundup' END AS split_shape, CASE WHEN l.toxic = 1 THEN 'no body' END AS split_error FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""", "documents", "labels")
def split_status(documents: DataFrame, labels: DataFrame) -> DataFrame:
    messages = archive.conform(documents.select(F.col("doc_id").alias("gmail_id")), archive.MESSAGES)
    outcome = labels.select(F.col("doc_id").cast("string").alias("gmail_id"), F.lit("roundup").alias("split_shape"), F.lit(0).alias("is_promo"), F.when(F.col("toxic") == 1, "no body").alias("split_error"))
    return archive.split_outcome(messages, outcome).select(F.col("gmail_id").cast("long").alias("doc_id"), "split_status", "split_shape", "split_error")


_OLD = "SELECT doc_id, source AS old_segment, CASE WHEN doc_id % 4 = 0 THEN lang ELSE source END AS new_segment, n_chars % 2 AS old_is_issue, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars % 2 END AS new_is_issue FROM documents"


def _changes(documents: DataFrame) -> DataFrame:
    old = documents.select(F.col("doc_id").alias("gmail_id"), F.col("source").alias("segment"), F.lit("k").alias("source_key"), (F.col("n_chars") % 2).alias("is_issue"), "lang")
    new = old.select("gmail_id", F.when(F.col("gmail_id") % 4 == 0, F.col("lang")).otherwise(F.col("segment")).alias("segment"), "source_key", F.when(F.col("gmail_id") % 9 == 0, 0).otherwise(F.col("is_issue")).alias("is_issue"))
    return archive.rerouted(old, new)


@query(f"SELECT doc_id, old_segment, new_segment, old_is_issue, new_is_issue FROM ({_OLD}) WHERE old_segment IS DISTINCT FROM new_segment OR old_is_issue IS DISTINCT FROM new_is_issue", "documents")
def reindexed(documents: DataFrame) -> DataFrame:
    return _changes(documents).select(F.col("gmail_id").alias("doc_id"), "old_segment", "new_segment", "old_is_issue", "new_is_issue")


@query(f"SELECT concat_ws(' -> ', old_segment, new_segment) AS move, count(*) AS n FROM ({_OLD}) WHERE old_segment IS DISTINCT FROM new_segment GROUP BY ALL", "documents")
def reindex_moves(documents: DataFrame) -> DataFrame:
    return archive.moves(_changes(documents))


@query("""WITH m AS (SELECT event_type, user_id, event_id, ts, json_extract_string(props, '$.' || (json_keys(props)[1])) AS v FROM events) SELECT event_type AS segment, user_id AS story, count(DISTINCT event_id % 4) AS sources, max(1 + event_id % 5) AS importance, count(*) AS items FROM m
WHERE event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""", "events", "orders")
def issue_stories(events: DataFrame, orders: DataFrame) -> DataFrame:
    items = events.select(F.col("event_id").alias("item_id"), F.col("event_type").alias("segment"), F.lit("k").alias("source_key"), F.concat(F.lit("Paper "), (F.col("event_id") % 4).cast("string"), F.lit(" – daily")).alias("sender_name"), F.concat(F.lit("Title "), F.col("event_id").cast("string")).alias("title"), F.lit("body").alias("body"), F.col("ts").alias("sent_date"), F.lit(None).cast("string").alias("summary"), (1 + F.col("event_id") % 5).cast("int").alias("importance"))
    key = F.concat_ws("|", "event_type", F.col("user_id").cast("string"))
    heads = events.select(F.col("event_type").alias("segment"), F.lit(0).alias("window_end"), key.alias("story"), F.lit("h").alias("headline"), F.lit(1.0).alias("score"), "user_id").distinct()
    members = events.select(key.alias("story"), F.col("event_id").alias("item_id"))
    none = items.select("segment", "source_key", F.lit("no such title").alias("norm_title")).limit(1)
    out = stories.load(heads.drop("user_id"), members, items, orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("item_id")), none)
    return out.select("segment", F.substring_index("story", "|", -1).cast("long").alias("story"), "sources", "importance", F.size("items").cast("long").alias("items"))


@query("""SELECT event_id, CAST(CAST(ts AS DATE) + CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 32 ELSE 9 END AS DATE) AS next_check, strftime(ts, '%A, %-d %B %Y') AS label, strftime(ts, '%B %-d, %Y') AS card FROM events""", "events")
def cadence_dates(events: DataFrame) -> DataFrame:
    often = F.when(F.col("event_type") == "click", "daily").when(F.col("event_type") == "view", "monthly").otherwise("rarely")
    return events.select("event_id", tx.next_check(F.to_date("ts"), often).alias("next_check"), tx.date_label(F.col("ts")).alias("label"), tx.card_date(F.col("ts")).alias("card"))


@query(r"""WITH u AS (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations WHERE role = 'user'), k AS (SELECT * FROM u WHERE t <> '' AND NOT starts_with(t, '<') AND NOT contains(lower(t), 'system-reminder') AND NOT starts_with(lower(t), 'caveat:')),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM k) SELECT conv_id AS session, position, CASE WHEN length(t) > 140 THEN rtrim(left(t, 140)) || '…' ELSE t END AS text FROM r WHERE position <= 40""", "conversations")
def user_turns(conversations: DataFrame) -> DataFrame:
    line = F.to_json(F.struct(F.col("role").alias("type"), F.struct(F.array(F.struct(F.lit("text").alias("type"), "text")).alias("content")).alias("message")))
    return small.user_prompts(conversations.select(F.col("conv_id").alias("session"), F.col("turn").alias("at"), line.alias("line")))


@query("SELECT key, count(*) AS asked, count(*) FILTER (hit) AS hits FROM (SELECT e.event_type AS key, o.o_orderkey IS NOT NULL AS hit FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id) GROUP BY key", "events", "orders")
def cache_lookup(events: DataFrame, orders: DataFrame) -> DataFrame:
    j = events.join(orders.select(F.col("o_orderkey").alias("event_id"), F.lit(True).alias("_hit")), "event_id", "left")
    return j.groupBy(F.col("event_type").alias("key")).agg(F.count("*").alias("asked"), F.count("_hit").alias("hits"))


@query("SELECT doc_id, source, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) = 1", "documents")
def latest_by_key(documents: DataFrame) -> DataFrame:
    return archive.latest(documents.select("doc_id", "source", "lang", "n_chars"), ["source"], ["n_chars", "doc_id"]).select("doc_id", "source", "lang", "n_chars")
