"""Mailboxes, model calls, files and streams, with given connections."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillmesh import models
from quillmesh.sources import backends, tables
from quillmesh.streaming import incremental

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors do not have this folder on their path


def test_api_pages_and_decodes():
    asked = []

    def call(path, given):
        asked.append((path, given))
        if path == "messages":
            return {"messages": [{"id": "b"}]} if "pageToken" in given else {"messages": [{"id": "a"}], "nextPageToken": "t"}
        return {"raw": "YT9iPmM"}

    b = backends.ApiBackend(call)
    assert b.list_ids("2026-10-02T00:00:00") == ["a", "b"] and asked[0][1]["q"] == "after:2026/10/02"
    assert list(b.fetch(["a"])) == [("a", b"a?b>c")]


def test_imap_reconnects_and_gives_up():
    class Server:
        def __init__(self, fails):
            self.fails = fails

        def search(self, since):
            return ["3", "20", "1"]

        def fetch(self, uid):
            if self.fails:
                raise EOFError
            return "1234567890", b"raw"

    servers = iter([Server(False), Server(False)])
    b = backends.ImapBackend(lambda: next(servers))
    assert b.list_ids(None) == ["20", "3", "1"]
    b.at.fails = True
    assert list(b.fetch(["3"])) == [("499602d2", b"raw")]
    with pytest.raises(EOFError):
        list(backends.ImapBackend(lambda: Server(True)).fetch(["1"]))


class Fake:
    def list_ids(self, since):
        return [f"m{k}" for k in range(5 if since else 7)]

    def fetch(self, ids):
        yield from ((i, i.encode()) for i in ids)


def test_mailbox_is_a_data_source(spark):
    backends.register(spark, "fakebox", lambda options: Fake())
    known = spark.createDataFrame([("m1",)], "message_id string")
    assert sorted(r["message_id"] for r in backends.new_messages(spark, "fakebox", known).collect()) == ["m0", "m2", "m3", "m4", "m5", "m6"]
    assert backends.new_messages(spark, "fakebox", known, "2026-01-01").count() == 4


def reply(x):
    return 200, {}, json.dumps({"choices": [{"message": {"content": json.dumps(x)}}]})


def test_calls_are_cached_retried_and_paced():
    now, slept, script = [0.0], [], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    c = models.Client(lambda r: script.pop(0), sleep=sleep, clock=lambda: now[0], denied="forbidden")
    script += [(500, {}, "x"), (429, {"retry-after": "3"}, ""), reply({"a": 1})]
    assert c.chat("m", [{"role": "user", "content": "q"}]) == {"a": 1} == c.chat("m", [{"role": "user", "content": "q"}])
    assert c.calls == 3 and c.hits == 1 and 3.5 in slept
    script += [(200, {"x-ratelimit-remaining-tokens": "10", "x-ratelimit-reset-tokens": "1m"}, reply({})[2]), reply({})]
    c.chat("m", [{"role": "user", "content": "r"}])
    c.chat("m", [{"role": "user", "content": "s"}])
    assert max(slept) > 50
    script += [(400, {}, "json mode is not supported"), reply({"b": 2})]
    assert c.chat("n", []) == {"b": 2} and "n" in c.plain
    for bad in ("forbidden-1",):
        with pytest.raises(models.ModelError):
            c.chat(bad, [])
    script += [(401, {}, "no key")]
    with pytest.raises(models.ModelError):
        c.chat("m", [{"role": "user", "content": "t"}])
    script += [(500, {}, "x")] * 4
    with pytest.raises(models.ModelError):
        c.chat("m", [{"role": "user", "content": "u"}])
    assert models.duration("1m2.5s") == 62.5 and models.duration("x") is None
    with pytest.raises(models.ModelError):
        models.parse_object("[1]")
    assert models.better({}, ["p"], lambda p: ({"x": 1}, [])) == ({"x": 1}, [], True) and models.better({"y": 1}, ["p"], lambda p: ({}, ["p", "q"]))[0] == {"y": 1}


def test_replies_stop_where_the_account_fails(spark):
    prompts = spark.createDataFrame([(k, f"k{k}", "s", f"u{k}") for k in range(4)], "item_id int, key string, system string, user string").coalesce(1)
    got = models.replies(prompts, lambda: models.Client(lambda r: (401, {}, "no key"), sleep=lambda s: None), "m", spark.createDataFrame([("k2", "{}")], "key string, reply string"))
    rows = {r["key"]: (r["reply"], r["error"] is None) for r in got.collect()}
    assert rows == {"k0": (None, False), "k1": (None, False), "k2": ("{}", True), "k3": (None, False)}


def test_files(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text("segment,segment_label,subscribe_email,gmail_label\n1-AI,Tech,box+AI@example.com,x\n2-B,Biz,,y\n")
    assert [tuple(r) for r in tables.tag_map(tables.read_csv(spark, str(tmp_path / "f.csv"))).collect()] == [("ai", "1-AI")]
    (tmp_path / "f.xml").write_text('<?xml version="1.0"?><feed xmlns:apps="urn:a"><entry><title>A</title><apps:property name="from" value="a.com"/><apps:property name="label" value="L/1"/></entry></feed>')
    r = tables.read_filters(spark, str(tmp_path / "f.xml")).first()
    assert r["title"] == "A" and r["properties"] == {"from": "a.com", "label": "L/1"}
    (tmp_path / ".env").write_bytes('﻿Q_ONE=me@x.com\r\n# no\r\nQ_TWO="a b"\r\nQ_THREE=new\r\n'.encode())
    monkeypatch.delenv("Q_ONE", raising=False)
    monkeypatch.setenv("Q_THREE", "old")
    assert tables.load_env(str(tmp_path / ".env"))["Q_TWO"] == "a b"
    import os

    assert os.environ["Q_ONE"] == "me@x.com" and os.environ["Q_THREE"] == "old"
    (tmp_path / "c.json").write_text('{"name": "x", "segments": {"overrides": [{"match": "ABC", "segment": "1"}]}}')
    monkeypatch.setenv("QUILLMESH_NAME", "y")
    found = tables.read_settings(str(tmp_path / "c.json"))
    assert found["name"] == "y" and found["segments"]["overrides"][0]["match"] == "abc"
    rows = spark.createDataFrame([("b", "2"), ("a", "1"), ("a", "3")], "segment string, sent_date string")
    assert [tuple(x) for x in tables.export(rows, str(tmp_path / "out")).collect()] == [("a", 2), ("b", 1)]
    assert spark.read.option("header", True).csv(str(tmp_path / "out/emails.csv")).count() == 3
    text, n = tables.replace_all(F.lit("Ab ab"), "AB", "$x")
    assert spark.range(1).select(text.alias("t"), n.alias("n")).first() == ("$x $x", 2)


def test_quiet_senders_alert_once(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    days = [("a", 1), ("b", 1), ("b", 4), ("b", 8), ("b", 12), ("b", 20)]
    rows = spark.createDataFrame(days, "s string, d int").select("s", F.expr("timestamp'2026-01-01' + make_interval(0,0,0,d)").alias("at"))
    for k in range(2):
        rows.where("d <= 8" if k == 0 else "d > 8").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = incremental.quiet_senders(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "s", "at", 5, "1 day")
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert "a" in {r["sender"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    both = incremental.with_retries(spark.createDataFrame([(1, "n")], "k int, v string"), spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string"), "k")
    assert sorted(map(tuple, both.collect())) == [(1, "n"), (2, "o")]
