"""Raw messages: a folder of .eml files as a table, one Python stage for MIME alone."""

from __future__ import annotations

import email
import email.policy
import email.utils
import re
from collections.abc import Iterator
from datetime import UTC, datetime
from email.header import decode_header, make_header

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx
from quillmesh.sources import blocks

_HEADERS = tuple(dict.fromkeys([*(h for h, _, _ in rules.PLATFORMS), "X-Mailer", *rules.TAG_HEADERS]))
_FIELDS = ("sender_name", "sender_email", "recipients", "to_address", "subject", "list_id", "sent", "received", "html", "text", "visible")
_DDL = "message_id string, content_hash string, " + ", ".join(f"{f} string" for f in _FIELDS) + ", has_attachment boolean, headers map<string,string>"
_ANGLE = re.compile(r"<\s*([^<>\s]+@[^<>\s]+)\s*>")


def utc(value: str | None) -> str | None:
    """An RFC 2822 date as ISO UTC; without a zone it is UTC; null if it is no date."""
    try:
        at = email.utils.parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    return (at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC).isoformat()


def _decoded(value: str) -> str:
    try:
        return str(make_header(decode_header(value))) if "=?" in value else value
    except (ValueError, LookupError):
        return value


def sender(header: str) -> tuple[str, str]:
    """Name and address of a From header; an address in angle brackets wins over what the parser makes of an odd name."""
    name, address = email.utils.parseaddr(header)
    m = _ANGLE.search(header)
    return (header[: m.start()].strip().strip('"').strip(), m[1]) if m and m[1].lower() != address.lower() else (name, address)


def read_message(raw: bytes) -> dict:
    """The fields of one message: headers decoded, first html and first text body; undecodable bytes are replaced."""
    m = email.message_from_bytes(raw, policy=email.policy.default)
    out: dict = dict.fromkeys(_FIELDS) | {"has_attachment": False}
    raw_from = next((" ".join(str(v).split()) for k, v in m.raw_items() if k.lower() == "from"), "")
    (name, address), (raw_name, raw_address) = sender(str(m["From"] or "").strip()), sender(raw_from)
    chosen = raw_address if "@" in raw_address else address
    out["sender_email"] = chosen.lower()
    out["sender_name"] = (name if name and address.lower() == chosen.lower() else _decoded(raw_name)) or chosen.lower()
    to = str((m.get_all("Delivered-To") or [m["To"] or ""])[0])
    out["to_address"] = ", ".join(a for _, a in email.utils.getaddresses([to])) or to
    out["headers"] = {h: "\n".join(str(v).strip() for v in m.get_all(h) or []) for h in _HEADERS if m[h] is not None}
    out["recipients"] = ", ".join(str(m[h]) for h in ("Delivered-To", "X-Original-To", "To", "Cc") if m[h])
    out["subject"], out["list_id"] = str(m["Subject"] or ""), m["List-Id"] and str(m["List-Id"])
    out["sent"], out["received"] = utc(m["Date"] and str(m["Date"])), utc(str(m["Received"] or "").rpartition(";")[2].strip() or None)
    for part in m.walk():
        if part.is_multipart():
            continue
        if part.get_content_disposition() == "attachment":
            out["has_attachment"] = True
        elif (kind := part.get_content_type()) in ("text/html", "text/plain"):
            field = kind[5:].replace("plain", "text")
            if out[field] is None:
                out[field] = (part.get_payload(decode=True) or b"").decode("utf-8" if part.get_content_charset() in (None, "us-ascii") else _known(part.get_content_charset()), "replace")
    out["visible"] = blocks.visible_text(out["html"], out["text"])
    return out


def _known(charset: str) -> str:
    try:
        "".encode(charset)
    except LookupError:
        return "utf-8"
    return charset


def identified(files: DataFrame) -> DataFrame:
    """(path, content) as (message_id, content). The id is the hexadecimal suffix of the file name, else the hash of the content."""
    named = F.regexp_extract("path", r"__([0-9a-f]{12,20})\.eml$", 1)
    return files.where("content IS NOT NULL").select(F.when(named != "", named).otherwise(F.concat(F.lit("file-"), F.substring(F.sha2("content", 256), 1, 16))).alias("message_id"), "content")


def parse(raw: DataFrame) -> DataFrame:
    """(message_id, content) as messages with their fields and bodies."""
    known = raw.select("message_id", F.sha2("content", 256).alias("content_hash"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [read_message(x) for x in b.column(2).to_pylist()]
            cols = [pa.array([r[f] for r in rows], pa.string()) for f in _FIELDS]
            headers = pa.array([list(r["headers"].items()) for r in rows], pa.map_(pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.string()), *cols, pa.array([r["has_attachment"] for r in rows]), headers], names=["message_id", "content_hash", *_FIELDS, "has_attachment", "headers"])

    return known.mapInArrow(run, _DDL)


def messages(files: DataFrame) -> DataFrame:
    """(path, content) as messages."""
    return parse(identified(files))


def plus_tags(headers: Column, inbox: str) -> Column:
    """Distinct lower-case tags of local+tag@domain in the recipients' headers, in their order."""
    local, _, domain = inbox.partition("@")
    pattern = rf"(?i){re.escape(local)}\+([a-z0-9_-]+)@{re.escape(domain)}"
    every = F.concat_ws("\n", *[F.element_at(headers, h) for h in rules.TAG_HEADERS])
    return F.array_distinct(F.transform(F.regexp_extract_all(every, F.lit(pattern)), F.lower))


def platform(headers: Column) -> Column:
    """The sending platform by the first rule that holds, else other:<mailer>, else unknown."""
    hits = []
    for header, needle, name in rules.PLATFORMS:
        v = F.lower(F.element_at(headers, header))
        hits.append(F.when((v != "") & F.contains(v, F.lit(needle)), name))
    mailer = F.element_at(headers, "X-Mailer")
    other = F.when(mailer != "", F.concat(F.lit("other:"), F.substring(F.lower(F.regexp_extract(mailer, r"^\s*(\S+)", 1)), 1, 40)))
    return F.coalesce(*hits, other, F.lit("unknown"))


def source_key(address: Column, list_id: Column, name: Column) -> Column:
    """A newsletter's key: the address with the list's id, or with the plain name where there is none."""
    inner = F.regexp_extract(F.coalesce(list_id, F.lit("")), "<([^>]+)>", 1)
    part = F.lower(F.trim(F.when(inner != "", inner).otherwise(F.coalesce(list_id, F.lit("")))))
    part = F.when(part != "", part).otherwise(F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " ")))
    return F.when(address != "", F.when(part != "", F.concat(address, F.lit("|"), part)).otherwise(address))


def segment(address: Column, name: Column, tags: Column, overrides: list[tuple[str, str]], by_tag: dict[str, str], fallbacks: list[tuple[str, str]]) -> Column:
    """Where a message belongs: an override for the address, else the first known tag, else a fallback for name and address."""
    low, who = F.lower(address), F.lower(F.concat(name, F.lit(" <"), address, F.lit(">")))
    known = F.create_map(*[F.lit(x) for kv in by_tag.items() for x in kv]) if by_tag else F.create_map().cast("map<string,string>")
    tagged = F.get(F.filter(F.transform(tags, lambda t: F.element_at(known, t)), lambda s: s.isNotNull()), F.lit(0))
    rules_of = lambda v, rs: [F.when(F.contains(v, F.lit(n.lower())), s) for n, s in rs]
    return F.coalesce(*rules_of(low, overrides), tagged, *rules_of(who, fallbacks), F.lit("unmatched"))


def message_rows(found: DataFrame, inbox: str, overrides: list[tuple[str, str]], by_tag: dict[str, str], fallbacks: list[tuple[str, str]], ignored: list[str] = (), backend: str = "file") -> DataFrame:
    """The archive's row of each message: routed, counted, marked as issue or not. Mail of ignored senders is kept as a row only."""
    n = F.size(tx.words(F.col("visible")))
    skip = F.lower("sender_email").isin(*[x.lower() for x in ignored]) if ignored else F.lit(False)
    out = found.withColumn("tags", plus_tags(F.col("headers"), inbox)).withColumn("word_count", n)
    return out.select(
        F.col("message_id").alias("gmail_id"),
        F.when(skip, "ignored").otherwise(segment(F.col("sender_email"), F.col("sender_name"), F.col("tags"), overrides, by_tag, fallbacks)).alias("segment"),
        source_key(F.col("sender_email"), F.col("list_id"), F.col("sender_name")).alias("source_key"),
        "sender_name", "sender_email", "to_address", "subject", F.col("sent").alias("sent_date"), F.col("received").alias("received_date"),
        F.when(skip, 0).otherwise(tx.is_issue(F.col("subject"), F.col("word_count"))).alias("is_issue"),
        F.substring("visible", 1, 200).alias("snippet"), F.nullif("list_id", F.lit("")).alias("list_id"), F.element_at("headers", "List-Unsubscribe").alias("list_unsubscribe"),
        platform(F.col("headers")).alias("sending_platform"), F.col("html").isNotNull().cast("int").alias("has_html"), F.col("text").isNotNull().cast("int").alias("has_text"),
        "word_count", tx.reading_minutes(F.col("word_count")).alias("reading_minutes"), F.col("has_attachment").cast("int").alias("has_attachments"), "content_hash",
        F.lit(backend).alias("capture_backend"), F.when(skip, "skipped").otherwise("pending").alias("split_status"),
    )


def archive_path(row_segment: Column, sent: Column, name: Column, key: Column) -> Column:
    """<segment>/<day>/<slug>__<id>.eml of a message; undated ones lie under unknown."""
    return F.concat_ws("/", row_segment, F.coalesce(F.substring(sent, 1, 10), F.lit("unknown")), F.concat(tx.slug(name), F.lit("__"), key, F.lit(".eml")))


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """All .eml files below a folder as (message_id, content). Files without a byte are passed over by the reader."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", True).load(folder)
    return identified(files.select("path", "content"))


def read_eml(spark: SparkSession, folder: str) -> DataFrame:
    """All .eml files below a folder, as messages."""
    return parse(read_raw(spark, folder))


def add_new(known: DataFrame, found: DataFrame, key: str = "message_id") -> DataFrame:
    """The found rows whose key is not known yet, one for each key: what an idempotent ingest appends."""
    return found.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def since(last_run: datetime, overlap_days: int = 3) -> str:
    """The date from which the next run scans again, so that late messages are found."""
    return datetime.fromtimestamp(last_run.timestamp() - 86_400 * overlap_days, UTC).date().isoformat()
