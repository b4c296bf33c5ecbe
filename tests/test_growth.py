"""Steps whose work once grew faster than their input, on inputs where that shows."""

import re
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.operators import duplicates, similarity
from quillmesh.plans import items
from quillmesh.plans.queries import QUERIES


def test_runs_of_a_long_text_take_its_words_once(spark):
    words = [f"w{i * i % 9973}" for i in range(20_000)]
    want = {" ".join(words[i : i + 11]) for i in range(len(words) - 10)}
    began = time.time()
    rows = spark.createDataFrame([(" ".join(words),), ("too short",), (None,)], "text string").select(tx.ngrams(F.col("text")).alias("runs")).collect()
    assert time.time() - began < 40
    assert set(rows[0]["runs"]) == want and len(rows[0]["runs"]) == len(want)
    assert rows[1]["runs"] == [] and rows[2]["runs"] == []


def test_runs_of_an_id_with_two_texts_count_once(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text), (1, text + " more")], "doc_id long, text string")
    got = items.copied_runs(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, 7, 2)]


def test_messages_far_apart_and_runs_over_many_batches(spark):
    start = datetime(2026, 1, 1)
    far = [(i, f"s{i % 100}", "Subject", start + timedelta(hours=5 * (i // 100)), 100, "real") for i in range(50_000)]
    one = [(100_000 + i, "one", "Subject", start + timedelta(minutes=i), 100 if i % 2 else 150, "unmatched" if i % 3 == 0 else "real") for i in range(2_000)]
    messages = spark.createDataFrame(far + one, "gmail_id long, sender_email string, subject string, sent_date timestamp, word_count int, segment string")
    want, canon = {}, []
    for i, _, _, at, n, kind in sorted(one, key=lambda r: (r[5] == "unmatched", r[3])):
        of = next((c for c in canon if abs(c[1] - at) <= timedelta(hours=3) and abs(c[2] - n) <= 0.1 * max(c[2], n)), None)
        if of:
            want[i] = of[0]
        else:
            canon.append((i, at, n))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        began = time.time()
        assert {r["gmail_id"]: r["duplicate_of"] for r in duplicates.duplicates(messages).collect()} == want
        assert time.time() - began < 25
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def exploded(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Generate ")


def test_words_are_found_once_for_weights_and_once_for_the_background(spark):
    assert exploded(QUERIES["tfidf_weights"](spark, "/root/testdata/sf0.001")) == 2
    # besides: words, names, and the two sides of the pairs, which are met where their window lies
    pairs = QUERIES["similar_pairs"](spark, "/root/testdata/sf0.001")
    assert exploded(pairs) <= 5
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "(window_end" in plan and not re.search(r"hashpartitioning\([^)]*\b[ab]#", plan)


def test_first_words_of_odd_blanks(spark):
    for n in (1, 2, 3):
        for text in ("", " ", "a", " a", "a ", " a b", "a b ", "  a  b  c ", "a b c d", " a b c\n\nd e "):
            want = " ".join(text.split()[:n]) + ("+" if len(text.split()) > n else "")
            got = spark.createDataFrame([(text,)], "t string").select(tx.first_words(F.col("t"), n, "+")).first()[0]
            assert got == want, (n, text)


def test_stories_read_the_pairs_of_linked_items_only(spark):
    docs = spark.createDataFrame([("s", 1, i, f"src{i}", [], False) for i in range(5)], "segment string, window_end int, item_id long, source_key string, names array<string>, recurring boolean")
    vectors = spark.createDataFrame([("s", 1, 0, "t", 0.6), ("s", 1, 0, "u", 0.8), ("s", 1, 1, "t", 1.0), ("s", 1, 2, "u", 0.1), ("s", 1, 3, "u", 0.1), ("s", 1, 2, "v", 0.1)], "segment string, window_end int, item_id long, token string, w double")
    pairs = similarity.linked_pairs(vectors, docs)
    assert sorted((r["a"], r["b"]) for r in pairs.collect()) == [(0, 1)]
    every = similarity.similar(vectors, docs)
    assert sorted((r["a"], r["b"]) for r in every.collect()) == [(0, 1), (0, 2), (0, 3), (2, 3)]
    told = [{r["item_id"]: r["story"] for r in similarity.stories(p, docs).collect()} for p in (pairs, every)]
    assert told[0] == told[1] == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_upsert_sorts_small_parts(spark):
    plan = QUERIES["upsert_draft"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert re.search(rf"hashpartitioning\(k#\d+L?, {n}\), REPARTITION_BY_NUM", plan)
