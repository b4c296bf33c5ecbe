"""The whole run over a small mailbox, with a made-up model: captured, split, extracted, clustered, composed, decided; twice."""

import json
import re
import sys
from datetime import UTC, datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillmesh import app, models
from quillmesh.operators import archive

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors do not have this folder on their path
ROUTING = {"inbox": "box@example.com", "overrides": [], "by_tag": {"ai": "1-AI"}, "fallbacks": [], "ignored": ["spam@bad.com"]}
STORY = "Acme shipped its Lumen model on Monday and cut the price of every call by 40 percent for teams that sign before spring."


def eml(name, to, subject, body, date="Mon, 05 Oct 2026 07:01:00 +0000"):
    html = "<body>" + body + "</body>"
    return f"From: {name} <{name.lower()}@paper.com>\r\nTo: {to}\r\nSubject: {subject}\r\nDate: {date}\r\nMIME-Version: 1.0\r\nContent-Type: text/html; charset=utf-8\r\n\r\n{html}".encode()


def issue(*stories):
    return "".join(f'<h3><a href="https://{u}.org/x">{t}</a></h3><p>{b}</p>' for t, b, u in stories)


OTHER = "Rivers in the north rose after a week of rain, and towns along the valley moved their markets to higher ground."
BOX = {
    "a" * 12: eml("Alpha", "box+ai@example.com", "Acme ships Lumen", issue(("Acme ships the Lumen model and cuts prices", STORY, "alpha"), ("Rivers rise in the north", OTHER, "rivers"))),
    "b" * 12: eml("Beta", "box+ai@example.com", "Lumen arrives", issue(("Lumen model from Acme arrives at lower prices", STORY.replace("shipped", "launched"), "beta"), ("A short guide to gardens", "Plant the bulbs in autumn, water them twice a week, and wait until the soil is warm again in the spring.", "garden"))),
    "c" * 12: eml("Alpha", "box+ai@example.com", "Acme ships Lumen", issue(("Acme ships the Lumen model and cuts prices", STORY, "alpha"), ("Rivers rise in the north", OTHER, "rivers")), "Mon, 05 Oct 2026 08:01:00 +0000"),
    "d" * 12: eml("Spam", "box@example.com", "Buy", "<p>x</p>").replace(b"spam@paper.com", b"spam@bad.com"),
}
NOW = datetime(2026, 10, 5, 12, tzinfo=UTC)


def client():
    def transport(request):
        text = request["messages"][-1]["content"]
        ids = re.findall(r"\[i\d+\]", text)
        if "Lumen" in text and not ids:
            reply = {"summary": "Acme shipped Lumen.", "category": "launch", "importance": 5, "entities": [{"name": "Acme", "type": "company"}, {"name": "Lumen", "type": "model"}, {"name": "Zed", "type": "org"}]}
        elif not ids:
            reply = {"summary": "Something else.", "category": "other", "importance": 2}
        else:
            first = ids[0]
            reply = {"subject": "Acme ships Lumen", "hook": f"Acme has news. {first}", "top_story": {"headline": "Acme ships Lumen", "paragraphs": [f"Acme cut prices by 40 percent. {first} Then Zed left Acme. {first}"]}, "close": "See you."}
        return 200, {}, json.dumps({"choices": [{"message": {"content": json.dumps(reply)}}]})

    return models.Client(transport, sleep=lambda s: None)


@pytest.fixture(scope="module")
def box(spark, tmp_path_factory):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    a = app.Archive(spark, f"file://{tmp_path_factory.mktemp('archive')}")
    found = spark.createDataFrame([(k, bytearray(v)) for k, v in BOX.items()], "message_id string, content binary")
    return a, found


def test_the_run(box):
    a, found = box
    assert app.capture(a, found, ROUTING, NOW, dry_run=True) == {"scanned": 4, "added": 4} and not a.has("messages")
    assert app.capture(a, found, ROUTING, NOW) == {"scanned": 4, "added": 4}
    assert app.capture(a, found, ROUTING, NOW) == {"scanned": 4, "added": 0}
    rows = {r["gmail_id"][0]: r for r in a.read("messages").collect()}
    assert {k: r["segment"] for k, r in rows.items()} == {"a": "1-AI", "b": "1-AI", "c": "1-AI", "d": "ignored"}
    assert rows["c"]["duplicate_of"] == "a" * 12 and rows["c"]["split_status"] == rows["d"]["split_status"] == "skipped"
    assert app.resume_from(a) == "2026-10-02"
    assert app.split(a, ["1-AI"]) == {"roundup": 2}
    assert app.split(a, ["1-AI"]) == {} and app.split(a, ["1-AI"], redo=True) == {"roundup": 2}
    items = a.read("items").collect()
    assert len(items) == 4 and a.read("links").count() == 4
    assert app.extract(a, client, "m", dry_run=True)["items"] == 4
    assert app.extract(a, client, "m") == {"done": 4, "skipped_short": 0, "dropped": 2}
    assert app.extract(a, client, "m")["done"] == 0 and a.read("entities").count() == 4
    told = app.cluster(a, NOW).collect()
    assert sorted(r["source_count"] for r in told) == [1, 1, 2]
    assert [r["headline"] for r in told if r["source_count"] == 2][0].startswith(("Acme", "Lumen"))
    assert app.cluster(a, NOW).count() == 3
    draft = app.compose(a, "1-AI", "2026-10-05", client(), "w", "Digest")
    assert draft["retried"] and any("Zed" in p for p in draft["problems"]) and "Zed" not in draft["text"]
    assert "Acme cut prices by 40 percent." in draft["text"] and "(https://" in draft["text"] and "[i" not in draft["text"]
    a.write("issues", archive.decide(a.read("issues"), draft["id"], True))
    assert app.compose(a, "1-AI", "2026-10-05", client(), "w", "Digest") == {"skipped": "approved"}
    assert archive.issue_list(a.read("issues")).first()["dropped"] >= 1
    routing = ROUTING | {"overrides": [("beta@", "2-B")]}
    assert [(r["old_segment"], r["new_segment"]) for r in app.reindex(a, routing).collect()] == [("1-AI", "2-B")]
    assert a.read("items").where("segment = '2-B'").count() == 2
    assert archive.review(a.read("messages"), a.read("items")).count() == 2
    assert app.quiet(a, NOW).count() == 0


def test_steps_fail_alone_and_runs_exclude_each_other(tmp_path):
    lock = str(tmp_path / "lock")
    out = app.daily(lock, [("one", lambda: 1), ("two", lambda: 1 / 0), ("three", lambda: 3)])
    assert out["one"] == "ok 1" and out["two"].startswith("failed ZeroDivisionError") and out["three"] == "ok 3"
    (tmp_path / "lock").write_text("x")
    with pytest.raises(app.Locked):
        app.daily(lock, [])
    assert app.daily(lock, [], clock=lambda: __import__("time").time() + 4 * 3600) == {}


def test_schema_gains_columns(spark):
    old = spark.createDataFrame([("x", "s")], "gmail_id string, segment string")
    row = archive.conform(old, archive.MESSAGES).first()
    assert row["gmail_id"] == "x" and row["split_status"] == "pending" and row["is_promo"] == 0 and row["subject"] is None
    assert len(archive.conform(old, archive.MESSAGES).columns) == 35
    assert archive.latest(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), ["k"], ["v"]).first()["v"] == 2
    assert archive.sections(spark.createDataFrame([("m", 0, "A", True, False), ("m", 1, "t", False, True), ("m", 2, "b", False, False)], "k string, at int, text string, label boolean, title boolean"), "k", "at", "text", "label", "title").where("section = 'A' AND item = 1").agg(F.count("*")).first()[0] == 2
