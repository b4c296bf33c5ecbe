"""Message files as a table, and incremental runs over growing inputs."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from quillmesh.sources import mail
from quillmesh.streaming import incremental

PLAIN = b"From: =?utf-8?q?Caf=C3=A9?= <News@Example.com>\r\nTo: me+tag@example.com\r\nSubject: =?utf-8?b?w6k=?= one\r\nDate: Mon, 05 Oct 2026 07:01:00 -0400\r\nReceived: by x; Mon, 05 Oct 2026 07:01:02 -0400\r\n\r\nhello\r\n"
MIXED = b'From: a@b.c\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=q\r\n\r\n--q\r\nContent-Type: text/html; charset=nonsense\r\n\r\n<p>x</p>\r\n--q\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment\r\n\r\n%PDF\r\n--q--\r\n'


def test_eml_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one__0123456789abcdef.eml").write_bytes(PLAIN)
    (tmp_path / "in/two.eml").write_bytes(MIXED)
    (tmp_path / "in/empty.eml").write_bytes(b"")
    (tmp_path / "in/other.txt").write_bytes(PLAIN)
    rows = {r["sender_email"]: r for r in mail.read_eml(spark, str(tmp_path)).collect()}
    assert set(rows) == {"news@example.com", "a@b.c"}
    one, two = rows["news@example.com"], rows["a@b.c"]
    assert (one["message_id"], one["sender_name"], one["subject"]) == ("0123456789abcdef", "Café", "é one")
    assert (one["sent"], one["received"]) == ("2026-10-05T11:01:00+00:00", "2026-10-05T11:01:02+00:00")
    assert (one["text"].strip(), one["html"], one["has_attachment"]) == ("hello", None, False)
    assert two["message_id"] == "file-" + two["content_hash"][:16]
    assert (two["html"].strip(), two["sent"], two["has_attachment"]) == ("<p>x</p>", None, True)


def test_only_new_keys(spark):
    known = spark.createDataFrame([("a",)], "message_id string")
    found = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "message_id string, n int")
    assert [tuple(r) for r in mail.add_new(known, found).collect()] == [("b", 2)]
    assert mail.since(datetime(2026, 10, 5, tzinfo=UTC)) == "2026-10-02"


def test_stream_takes_each_key_once_over_runs(spark, tmp_path):
    at = F.timestamp_seconds(F.col("id") % 5 * 60 + 1_700_000_000)
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for _ in range(2):
        spark.range(20).select((F.col("id") % 5).cast("string").alias("k"), at.alias("ts")).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, ts timestamp").parquet(source)
        incremental.run_available(incremental.ingest(stream, "k", "ts"), out, mark)
    assert sorted(r["k"] for r in spark.read.schema("k string").parquet(out).collect()) == list("01234")


def test_rerun_replaces_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, 1), (1, 2), (2, 3)], [(2, 4)]):
        incremental.replace_partitions(spark.createDataFrame(rows, "day int, n int"), path, "day")
    assert sorted((r["day"], r["n"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (1, 2), (2, 4)]
