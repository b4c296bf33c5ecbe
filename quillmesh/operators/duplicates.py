"""Duplicate messages: the same sender and subject, close in time and alike in length."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx


def duplicates(messages: DataFrame, hours: float = rules.DUPLICATE_HOURS, share: float = rules.DUPLICATE_SHARE) -> DataFrame:
    """gmail_id and duplicate_of of every message that repeats another: messages with one sender and plain subject are taken in
    order (routed ones first, then by date and id); one that lies within `hours` of an earlier canonical copy, and whose number
    of words differs by no more than `share`, repeats the first such copy; else it is canonical itself.

    Undated messages match none, messages without a sender are left out, and equal ids are one message. Copies that are
    further apart than `hours` can't match, so a key's messages are cut into runs wherever they pause for longer. Runs of
    one message are dropped before Python, where the others stream by in order: a task holds a run's canonical copies, and a
    message is held only against those within `hours`, which are few as they differ from each other by more than `share`.
    """
    most = hours * 3600
    dated = messages.where("sender_email IS NOT NULL AND sent_date IS NOT NULL").dropDuplicates(["gmail_id"])
    rows = dated.select("gmail_id", "sender_email", tx.norm_subject(F.col("subject")).alias("about"), (F.unix_micros(F.col("sent_date").cast("timestamp")) / 1e6).alias("at"), F.coalesce("word_count", F.lit(0)).alias("words"), F.coalesce(F.col("segment").isin("unmatched", "ignored"), F.lit(False)).alias("odd"))
    by_time = W.partitionBy("sender_email", "about").orderBy("at", "gmail_id")
    apart = {"_before": F.coalesce(F.col("at") - F.lag("at").over(by_time) > most, F.lit(True)), "_after": F.coalesce(F.lead("at").over(by_time) - F.col("at") > most, F.lit(True))}
    runs = rows.where("at IS NOT NULL").withColumns(apart).withColumn("run", F.sum(F.col("_before").cast("int")).over(by_time)).where("NOT (_before AND _after)").drop("_before", "_after")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, routed, others, start, later, second = None, [], [], 0, 0, False
        for batch in batches:
            ids, of = [], []
            for i, sender, about, run, at, words, odd in zip(*(batch.column(c).to_pylist() for c in ("gmail_id", "sender_email", "about", "run", "at", "words", "odd")), strict=True):
                if (run, sender, about) != now:
                    now, routed, others, start, later, second = (run, sender, about), [], [], 0, 0, False
                if odd and not second:
                    second, start = True, 0  # time begins again
                while start < len(routed) and at - routed[start][1] > most:
                    start += 1
                while later < len(others) and at - others[later][1] > most:
                    later += 1
                first = None
                for k in range(start, len(routed)):
                    c = routed[k]
                    if c[1] - at > most:
                        break
                    if abs(c[2] - words) <= share * max(c[2], words):
                        first = c[0]
                        break
                if first is None and odd:
                    first = next((others[k][0] for k in range(later, len(others)) if abs(others[k][2] - words) <= share * max(others[k][2], words)), None)
                if first is None:
                    (others if odd else routed).append((i, at, words))
                else:
                    ids.append(i)
                    of.append(first)
            kind = batch.schema.field("gmail_id").type
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(of, kind)], ["gmail_id", "duplicate_of"])

    kind = messages.schema["gmail_id"].dataType.simpleString()
    key = ["sender_email", "about", "run"]
    return runs.repartition(*key).sortWithinPartitions(*key, "odd", "at", "gmail_id").mapInArrow(within, f"gmail_id {kind}, duplicate_of {kind}")


def mark(messages: DataFrame, **limits: float) -> DataFrame:
    """messages with duplicate_of computed anew: repeats are skipped, and issues that no longer repeat wait for splitting again."""
    own = messages.drop("duplicate_of").join(duplicates(messages, **limits), "gmail_id", "left")
    back = (F.col("split_status") == "skipped") & (F.col("segment") != "ignored") & (F.col("is_issue") == 1)
    return own.withColumn("split_status", F.when(F.col("duplicate_of").isNotNull(), "skipped").when(back, "pending").otherwise(F.col("split_status")))


def without_items_of_duplicates(items: DataFrame, messages: DataFrame) -> DataFrame:
    """Items (or their links) of messages that repeat none."""
    return items.join(messages.where("duplicate_of IS NOT NULL").select("gmail_id"), "gmail_id", "left_anti")
