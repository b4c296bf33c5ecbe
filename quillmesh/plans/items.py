"""Queries about items and stories: documents stand for items (language: segment, first line: title), forty minutes apart, so
that a window of 48 hours holds seventy-two of them; every window of the table is computed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx
from quillmesh.operators import duplicates, similarity
from quillmesh.plans.queries import ORACLES, QUERIES, query

_NORM = r"""trim(regexp_replace(translate(lower({0}), '’‘“”–—', '''''""--'), '\s+', ' ', 'g'))"""
_TITLE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '(?i)\(\s*\d+\s*minute read\s*\)|\((github repo|website|sponsor)\)', '', 'g'), '^[^\p{{L}}\p{{N}}_"''“‘$]+', ''), '\s+', ' ', 'g'), '^[ :–-]+|[ :–-]+$', '', 'g')"""
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(rules.STOP))
_FOLD = "list_transform(list_filter(regexp_extract_all({0}, '" + rules.TOKEN + "'), lambda t: NOT list_contains([" + _STOP + "], t) AND (length(t) > 1 OR regexp_matches(t, '^[0-9]$'))), lambda t: CASE WHEN length(t) > 4 AND ends_with(t, 's') AND NOT ends_with(t, 'ss') THEN left(t, length(t) - 1) ELSE t END)"
_WORDS = r"list_filter(string_split_regex(coalesce({0}, ''), '\s+'), lambda w: w <> '')"


def _tokens(x: str) -> str:
    return _FOLD.format(_NORM.format(x))


_ITEMS = f"""items AS (SELECT doc_id AS item_id, lang AS segment, doc_id // 72 AS win, source AS source_key, {_TITLE.format("split_part(coalesce(text, ''), chr(10), 1)")} AS title,
array_to_string({_WORDS.format("text")}[1:120], ' ') AS extra, text FROM documents)"""
_TF = f"""long AS (SELECT segment, win, item_id, unnest({_tokens("title")}) AS token, 2 AS w FROM items UNION ALL SELECT segment, win, item_id, unnest({_tokens("extra")}), 1 FROM items),
tf0 AS (SELECT segment, win, item_id, token, sum(w) AS tf FROM long GROUP BY ALL), tf AS (SELECT * FROM tf0 WHERE item_id IN (SELECT item_id FROM tf0 GROUP BY item_id HAVING sum(tf) >= 3))"""
_VECTORS = """bg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY item_id DESC) AS r FROM items) WHERE r <= 3000),
bgn AS (SELECT segment, count(*) AS bn FROM bg GROUP BY segment), bgt AS (SELECT DISTINCT segment, item_id, unnest(list_concat({0}, {1})) AS token FROM bg), bgd AS (SELECT segment, token, count(*) AS bdf FROM bgt GROUP BY ALL),
n AS (SELECT t.segment, win, n, bn, bn > n AS big FROM (SELECT segment, win, count(DISTINCT item_id) AS n FROM tf GROUP BY ALL) t LEFT JOIN bgn ON t.segment IS NOT DISTINCT FROM bgn.segment),
d AS (SELECT segment, win, token, count(*) AS df FROM tf GROUP BY ALL),
raw AS (SELECT tf.segment, tf.win, tf.item_id, tf.token, (1 + ln(tf.tf)) * (ln((1 + n + CASE WHEN coalesce(big, false) THEN bn ELSE 0 END) / (1 + df + CASE WHEN coalesce(big, false) THEN coalesce(bdf, 0) ELSE 0 END)) + 1) AS w
FROM tf JOIN d USING (segment, win, token) JOIN n USING (segment, win) LEFT JOIN bgd ON bgd.segment = tf.segment AND bgd.token = tf.token),
vec AS (SELECT segment, win, item_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM raw)""".format(_tokens("title"), _tokens("extra"))


def items_of(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("item_id"), F.col("doc_id").cast("string").alias("gmail_id"), F.col("lang").alias("segment"), F.floor(F.col("doc_id") / 72).alias("window_end"), F.col("source").alias("source_key"),
        F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("title"), F.col("text").alias("body"), F.col("doc_id").alias("sent_date"), F.lit(0).alias("is_sponsor"),
    )


@query(f"WITH {_ITEMS} SELECT item_id AS doc_id, title, len({_tokens('text')}) AS n_tokens, md5(array_to_string({_tokens('text')}, ' ')) AS digest FROM items WHERE text IS NOT NULL", "documents")
def item_tokens(documents: DataFrame) -> DataFrame:
    t = tx.tokens(F.col("text"))
    return documents.where("text IS NOT NULL").select("doc_id", tx.clean_title(F.substring_index("text", "\n", 1)).alias("title"), F.size(t).cast("long").alias("n_tokens"), F.md5(F.array_join(t, " ").cast("binary")).alias("digest"))


@query(f"WITH {_ITEMS}, {_TF} SELECT item_id, token, CAST(tf AS BIGINT) AS tf FROM tf", "documents")
def term_frequency(documents: DataFrame) -> DataFrame:
    return similarity.term_frequency(similarity.docs(items_of(documents))).select("item_id", "token", F.col("tf").cast("long").alias("tf"))


@query(f"WITH {_ITEMS}, {_TF}, {_VECTORS} SELECT segment, token, bdf AS df FROM bgd", "documents")
def background_df(documents: DataFrame) -> DataFrame:
    return similarity.background(items_of(documents))[0]


def _vectors(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    items = items_of(documents).where("segment IS NOT NULL")
    own = similarity.docs(items)
    return similarity.weights(similarity.term_frequency(own), *similarity.background(items)), own


@query(f"WITH {_ITEMS}, {_TF}, {_VECTORS} SELECT item_id, token, round(w, 6) AS w FROM vec", "documents")
def tfidf_weights(documents: DataFrame) -> DataFrame:
    return _vectors(documents)[0].select("item_id", "token", F.round("w", 6).alias("w"))


@query(f"""WITH {_ITEMS}, {_TF}, {_VECTORS}, rec AS (SELECT segment, source_key, {_NORM.format("title")} AS t FROM items WHERE title <> '' GROUP BY ALL HAVING count(*) >= 3),
fresh AS (SELECT i.item_id, i.source_key FROM items i LEFT JOIN rec r ON i.segment = r.segment AND i.source_key = r.source_key AND {_NORM.format("i.title")} = r.t WHERE r.t IS NULL), v AS (SELECT vec.*, source_key FROM vec JOIN fresh USING (item_id))
SELECT a.item_id AS a, b.item_id AS b, round(sum(a.w * b.w), 6) AS s FROM v a JOIN v b ON a.segment = b.segment AND a.win = b.win AND a.token = b.token AND a.item_id < b.item_id AND a.source_key IS DISTINCT FROM b.source_key GROUP BY ALL HAVING sum(a.w * b.w) >= 0.18""", "documents")
def similar_pairs(documents: DataFrame) -> DataFrame:
    return similarity.similar(*_fresh(documents), rules.THRESHOLD).select("a", "b", F.round("s", 6).alias("s"))


def _fresh(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    items = items_of(documents).where("segment IS NOT NULL")
    own = similarity.docs(items, recurring=similarity.recurring_titles(items))
    return similarity.weights(similarity.term_frequency(own), *similarity.background(items)), own


def story_groups(documents: DataFrame) -> DataFrame:
    """Stories of every window, rolled up. Grouping depends on the pairs' order: tested against brute force, without SQL."""
    vectors, own = _fresh(documents)
    return similarity.rollup(similarity.stories(similarity.linked_pairs(vectors, own), own), own)


QUERIES["story_groups"] = lambda spark, sf_dir: story_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query(f"""WITH {_ITEMS} SELECT segment, source_key, {_NORM.format("title")} AS norm_title, count(DISTINCT item_id) AS issues FROM items WHERE {_NORM.format("title")} <> '' GROUP BY ALL HAVING count(DISTINCT item_id) >= 3""", "documents")
def recurring_titles(documents: DataFrame) -> DataFrame:
    return similarity.recurring_titles(items_of(documents))


@query(f"""WITH {_ITEMS}, g AS (SELECT i.*, 1 + item_id % 5 AS imp, split_part(coalesce(text, ''), chr(10), 1) AS raw, min(item_id) OVER (PARTITION BY segment, win, title) AS story FROM items i WHERE segment IS NOT NULL)
SELECT segment, win AS window_end, story, min(item_id) AS first_seen, max(item_id) AS last_seen, count(DISTINCT source_key) AS source_count, count(*) AS items, max(imp) AS importance,
arg_min(CASE WHEN raw = '' THEN '(untitled)' ELSE raw END, (-imp, CAST(len({_WORDS.format("raw")}) < 5 AS INTEGER), length(raw), item_id)) AS headline, round_even(2 * count(DISTINCT source_key) + max(imp) + count(*) / 10, 2) AS score FROM g GROUP BY ALL""", "documents")
def story_rollup(documents: DataFrame) -> DataFrame:
    own = similarity.docs(items_of(documents).where("segment IS NOT NULL")).withColumn("importance", 1 + F.col("item_id") % 5)
    groups = own.groupBy("segment", "window_end", "clean_title").agg(F.min("item_id").alias("story"))
    members = own.select("segment", "window_end", "clean_title", "item_id").join(groups, ["segment", "window_end", "clean_title"]).drop("clean_title")
    return similarity.rollup(members, own)


@query("""WITH RECURSIVE m AS (SELECT event_id AS id, user_id AS k, epoch_us(ts) / 1e6 AS t, 100 + CAST(floor(value) AS BIGINT) % 30 AS w, event_type = 'unmatched' AS odd FROM events),
r AS (SELECT id, k, t, w, odd, id AS c, false AS hit, 0 AS i FROM m UNION ALL
SELECT id, k, t, w, odd, c2, id <> c2 AND abs(t - ct) <= 10800 AND abs(w - cw) <= 0.1 * greatest(w, cw), i + 1 FROM (SELECT *, first_value(id) OVER z AS c2, first_value(t) OVER z AS ct, first_value(w) OVER z AS cw FROM r WHERE NOT hit AND (i = 0 OR id <> c) WINDOW z AS (PARTITION BY k ORDER BY odd, t, id)))
SELECT id AS event_id, c AS duplicate_of FROM r WHERE hit""", "events")
def duplicate_messages(events: DataFrame) -> DataFrame:
    words = (100 + F.floor("value").cast("long") % 30).cast("int")
    own = events.select(F.col("event_id").alias("gmail_id"), F.col("user_id").cast("string").alias("sender_email"), F.lit("One  Subject").alias("subject"), F.col("ts").alias("sent_date"), words.alias("word_count"), F.col("event_type").alias("segment"))
    return duplicates.duplicates(own).select(F.col("gmail_id").alias("event_id"), "duplicate_of")


@query(r"""WITH g AS (SELECT item_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS t FROM benchmark), b AS (SELECT DISTINCT unnest(list_transform(range(1, len(w) - 9), lambda i: array_to_string(w[i:i + 10], ' '))) AS run, item_id FROM (SELECT item_id, regexp_extract_all(t, '[a-z0-9$%'']+') AS w FROM g) WHERE len(w) >= 11),
d AS (SELECT doc_id, regexp_extract_all(trim(regexp_replace(translate(lower(text), '’‘“”–—', '''''""--'), '\s+', ' ', 'g')), '[a-z0-9$%'']+') AS w FROM documents WHERE text IS NOT NULL), r AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 9), lambda i: array_to_string(w[i:i + 10], ' '))) AS run FROM d WHERE len(w) >= 11)
SELECT doc_id, item_id, count(*) AS runs FROM r JOIN b USING (run) GROUP BY ALL""", "documents", "benchmark")
def copied_runs(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    runs = documents.where("text IS NOT NULL").select("doc_id", F.explode(tx.ngrams(F.col("text"))).alias("run"))
    met = runs.join(benchmark.select("item_id", F.explode(tx.ngrams(F.col("text"))).alias("run")), "run")
    return met.distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("runs"))  # an id may have two texts


assert "story_groups" not in ORACLES
