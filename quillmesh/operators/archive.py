"""The archive's tables: work lists, counters, keyed writes, routing done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from quillmesh.functions import rules



def _schema(columns: str) -> StructType:
    types, out = {"string": StringType(), "int": IntegerType(), "double": DoubleType()}, StructType()
    for c in columns.split(", "):
        name, kind = c.split()
        out = out.add(name, types[kind])
    return out


MESSAGES = _schema(
    "gmail_id string, thread_id string, segment string, source_key string, newsletter string, publisher string, sender_name string, sender_email string, to_address string, subject string, sent_date string, received_date string, "
    "is_issue int, labels string, snippet string, list_id string, list_unsubscribe string, sending_platform string, has_html int, has_text int, raw_eml_path string, clean_text_path string, raw_html_path string, word_count int, "
    "reading_minutes double, has_attachments int, content_hash string, capture_backend string, ingested_at string, split_status string, enrich_status string, is_promo int, split_shape string, split_error string, duplicate_of string"
)
DEFAULTS = {"split_status": "pending", "enrich_status": "pending", "is_promo": 0, "is_sponsor": 0, "kind": "story", "status": "draft"}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the schema's columns in its order; those that are missing get their default, or null."""
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(DEFAULTS.get(f.name))).cast(f.dataType).alias(f.name) for f in schema])


def dedupable(messages: DataFrame) -> DataFrame:
    return messages.where("raw_eml_path IS NOT NULL AND sender_email IS NOT NULL")


def to_split(messages: DataFrame, segments: list[str] = (), ids: list[str] = (), redo: bool = False, limit: int | None = None) -> DataFrame:
    """Issues that wait for splitting, undated first, then by date: those named, or the pending and failed of the segments."""
    own = messages.where("is_issue = 1 AND raw_eml_path IS NOT NULL AND duplicate_of IS NULL")
    if ids:
        own = own.where(F.col("gmail_id").isin(*ids))
    else:
        own = own if redo else own.where(F.col("split_status").isin("pending", "failed"))
        own = own.where(F.col("segment").isin(*segments)) if segments else own
    own = own.orderBy(F.asc_nulls_first("sent_date"), "gmail_id")
    return own.limit(limit) if limit else own


def told(items: DataFrame, messages: DataFrame) -> DataFrame:
    """Items that are news of their own: no adverts or intros, of messages that neither repeat nor promote."""
    good = messages.where("duplicate_of IS NULL AND coalesce(is_promo, 0) = 0").select("gmail_id")
    return items.where("is_sponsor = 0 AND kind IN ('story', 'essay', 'teaser')").join(good, "gmail_id", "left_semi")


def to_extract(items: DataFrame, messages: DataFrame, enrichment: DataFrame, version: str, segments: list[str] = (), since: str | None = None, ids: list[int] = (), redo: bool = False, limit: int | None = None) -> DataFrame:
    """Items to extract from, the latest first: those named, or those that the version has not done without an error."""
    own = told(items, messages)
    if ids:
        own = own.where(F.col("item_id").isin(*ids))
    else:
        own = own.where(F.col("segment").isin(*segments)) if segments else own
        own = own.where(F.col("sent_date") >= F.lit(since)) if since else own
        done = enrichment.where((F.col("prompt_version") == version) & F.col("error").isNull()).select("item_id")
        own = own if redo else own.join(done, "item_id", "left_anti")
    own = own.orderBy(F.desc("sent_date"), "position", "item_id")
    return own.limit(limit) if limit else own


def long_enough(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items that are extracted from, and those that are too short."""
    return items.where(F.col("word_count") >= rules.ITEM_WORDS), items.where(F.col("word_count") < rules.ITEM_WORDS)


def unmatched(messages: DataFrame) -> DataFrame:
    """Mail that no rule routes, by sender and address, the most first, with the greatest subject."""
    own = messages.where("segment = 'unmatched'").groupBy("sender_email", "sender_name", "to_address").agg(F.count("*").alias("n"), F.max("subject").alias("sample"))
    return own.orderBy(F.desc("n"), "sender_email", "sender_name", "to_address")


def by_segment(messages: DataFrame, cutoff: Column) -> DataFrame:
    recent = (F.col("is_issue") == 1) & (F.col("sent_date") >= cutoff)
    return messages.groupBy("segment").agg(F.count("*").alias("n"), F.count_if(F.coalesce(recent, F.lit(False))).alias("recent")).orderBy("segment")


def by_sender(messages: DataFrame, cutoff: Column) -> DataFrame:
    own = messages.where((F.col("is_issue") == 1) & (F.col("sent_date") >= cutoff))
    return own.groupBy("segment", "sender_email").agg(F.count("*").alias("n"), F.max("sent_date").alias("last")).orderBy("segment", F.desc("n"), "sender_email")


def capture_counts(found: DataFrame, known: DataFrame) -> DataFrame:
    """By segment: scanned, new and already known messages."""
    marked = found.join(known.select("gmail_id", F.lit(1).alias("_k")).distinct(), "gmail_id", "left")
    return marked.groupBy("segment").agg(F.count("*").alias("scanned"), F.count_if(F.col("_k").isNull()).alias("added"), F.count("_k").alias("known"))


def insert_new(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table and the rows whose key it lacks; of equal new keys one. The first stays."""
    return table.unionByName(rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The table with rows replaced or added by key; columns of `keep` stay as they are where the key is known."""
    # many partitions, not put together again: a task sorts both sides of its part. The table follows, unless the rows are sent to it
    own = rows.repartition(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).dropDuplicates(keys)
    if keep:
        old = table.select(*keys, *[F.col(c).alias(f"_{c}") for c in keep])
        own = own.join(old, keys, "left").withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in keep}).drop(*[f"_{c}" for c in keep])
    return table.join(own.select(*keys), keys, "left_anti").unionByName(own.select(*table.columns))


def replace_children(table: DataFrame, rows: DataFrame, parent: list[str], parents: DataFrame | None = None) -> DataFrame:
    """The table with all rows of the given parents (those of the new rows, if none are given) replaced by the new rows."""
    gone = (parents if parents is not None else rows).select(*parent).distinct()
    return table.join(gone, parent, "left_anti").unionByName(rows.select(*table.columns))


def latest(table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return table.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in table.columns if c not in keys]), F.struct(*order)).alias("_x")).select(*keys, "_x.*")


def last_runs(log: DataFrame, n: int = 5) -> DataFrame:
    return log.orderBy(F.desc("id")).limit(n)


def rerouted(messages: DataFrame, again: DataFrame) -> DataFrame:
    """Messages whose segment, source or kind comes out otherwise when derived again: old and new values."""
    names = ("segment", "source_key", "is_issue")
    j = messages.select("gmail_id", *[F.col(c).alias(f"old_{c}") for c in names]).join(again.select("gmail_id", *[F.col(c).alias(f"new_{c}") for c in names]), "gmail_id")
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    return j.where(~same)


def moves(changes: DataFrame) -> DataFrame:
    """How many messages went from one segment to another."""
    own = changes.where(~F.col("old_segment").eqNullSafe(F.col("new_segment")))
    return own.groupBy(F.concat_ws(" -> ", "old_segment", "new_segment").alias("move")).agg(F.count("*").alias("n"))


def with_routing(table: DataFrame, changes: DataFrame) -> DataFrame:
    """Messages or items with the segment and source that their message now has."""
    own = changes.select("gmail_id", F.lit(True).alias("_c"), "new_segment", "new_source_key", "new_is_issue")
    j = table.join(own, "gmail_id", "left")
    for c in ("segment", "source_key", "is_issue"):
        if c in table.columns:
            j = j.withColumn(c, F.when(F.col("_c"), F.col(f"new_{c}")).otherwise(F.col(c)))
    return j.select(*table.columns)


def split_outcome(messages: DataFrame, outcome: DataFrame) -> DataFrame:
    """messages with the status that splitting gave (outcome: gmail_id, split_shape, is_promo, split_error)."""
    own = outcome.select("gmail_id", F.lit(True).alias("_o"), F.col("split_shape").alias("_s"), F.col("is_promo").alias("_p"), F.col("split_error").alias("_e"))
    j = messages.join(own, "gmail_id", "left")
    done = F.col("_o") & F.col("_e").isNull()
    values = {"split_status": F.when(done, "done").when(F.col("_o"), "failed").otherwise(F.col("split_status")), "split_shape": F.when(done, F.col("_s")).otherwise(F.col("split_shape")), "is_promo": F.when(done, F.col("_p")).otherwise(F.col("is_promo")), "split_error": F.when(F.col("_o"), F.col("_e")).otherwise(F.col("split_error"))}
    return j.withColumns(values).select(*messages.columns)


def decide(issues: DataFrame, issue_id: int, approve: bool) -> DataFrame:
    """issues with one draft approved or rejected."""
    return issues.withColumn("status", F.when((F.col("id") == issue_id) & (F.col("status") == "draft"), "approved" if approve else "rejected").otherwise(F.col("status")))


def issue_list(issues: DataFrame, n: int = 20) -> DataFrame:
    """The last issues, with the number of problems that their checks dropped."""
    report = F.from_json("validator_report", "problems_dropped array<string>")
    return issues.withColumn("dropped", F.coalesce(F.size(report["problems_dropped"]), F.lit(0))).orderBy(F.desc("id")).limit(n)


def review(messages: DataFrame, items: DataFrame, n: int = 20) -> DataFrame:
    """The latest split issues with their items as lines, for reading over."""
    last = messages.where("split_status = 'done'").orderBy(F.desc("sent_date"), "gmail_id").limit(n).select("gmail_id", "sender_name", "subject", "sent_date", "split_shape")
    line = F.concat(F.lit("- "), F.coalesce("title", F.lit("(untitled)")), F.when(F.col("is_sponsor") == 1, " [sponsor]").otherwise(""), F.lit(": "), F.array_join(F.slice(F.split(F.coalesce("body", F.lit("")), r"\s+"), 1, 30), " "))
    nested = items.join(F.broadcast(last.select("gmail_id")), "gmail_id").groupBy("gmail_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    return last.join(nested, "gmail_id", "left")


def sections(blocks: DataFrame, key: str, order: str, text: str, is_label: str, is_title: str) -> DataFrame:
    """Rows with the section and the number of the item they stand in, where layouts are simple: the last label and the titles so far."""
    upto = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumns({"section": F.last(F.when(F.col(is_label), F.col(text)), ignorenulls=True).over(upto), "item": F.sum(F.col(is_title).cast("int")).over(upto)})
