"""Small sources and sinks: dimensions, settings, mail filters, transcripts, exports."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header; all columns are text, quoted fields may hold line ends."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def tag_map(feeds: DataFrame) -> DataFrame:
    """tag and segment of feeds, the tag from local+tag@domain of subscribe_email."""
    tag = F.regexp_extract(F.lower(F.trim("subscribe_email")), r"\+([^@]*)@", 1)
    return feeds.select(tag.alias("tag"), "segment").where("tag <> ''")


def source_counts(sources: DataFrame) -> DataFrame:
    """How many sources a segment has by status and frequency."""
    return sources.groupBy("segment", "status", "send_frequency").agg(F.count("*").alias("n"))


def read_settings(path: str) -> dict:
    """A YAML (or JSON) file of settings; the rules' needles in lower case. Values of the environment QUILLMESH_<NAME> win for top-level names."""
    text = Path(path).read_text(encoding="utf-8-sig")
    try:
        import yaml
    except ImportError:
        found = json.loads(text)
    else:
        found = yaml.safe_load(text) or {}
    for name in list(found):
        found[name] = os.environ.get(f"QUILLMESH_{name.upper()}", found[name])
    for rules in (found.get("segments") or {}).values():
        for r in rules if isinstance(rules, list) else []:
            if isinstance(r, dict) and "match" in r:
                r["match"] = str(r["match"]).lower()
    return found


def load_env(path: str) -> dict[str, str]:
    """Sets the variables of a KEY=value file that are not set yet; quotes are cut, comments passed over, a byte order mark too."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8-sig").splitlines():
        key, eq, value = line.strip().partition("=")
        if eq and not key.startswith("#"):
            value = value.strip()
            out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    for k, v in out.items():
        os.environ.setdefault(k, v)
    return out


def read_filters(spark: SparkSession, path: str) -> DataFrame:
    """Mail filters (XML): title and properties of each entry, as name and value in one map."""
    rows = spark.read.format("xml").option("rowTag", "entry").load(path)
    prop = next(c for c in rows.columns if c.endswith("property"))
    pairs = F.transform(F.col(f"`{prop}`"), lambda p: F.struct(p["_name"].alias("key"), p["_value"].alias("value")))
    return rows.select("title", F.map_from_entries(pairs).alias("properties"))


TRANSCRIPT = "type string, sessionId string, isMeta boolean, message struct<role:string,content:string>"


def user_prompts(lines: DataFrame, length: int = 140, most: int = 40) -> DataFrame:
    """session, position and text of a transcript's (session, at, line) user turns: text parts joined, injected and empty turns
    left out, cut to a length, the first `most` of a session. Lines that are no JSON are passed over."""
    content = F.get_json_object("line", "$.message.content")
    parts = F.from_json(content, "array<struct<type:string,text:string>>")
    joined = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit(""))), " ")
    text = F.trim(F.regexp_replace(F.coalesce(F.when(F.startswith(content, F.lit("[{")), joined).otherwise(content), F.lit("")), r"(?U)\s+", " "))
    rows = lines.where(F.get_json_object("line", "$.type") == "user").select("session", "at", text.alias("text"))
    low = F.lower("text")
    noise = (F.col("text") == "") | F.startswith("text", F.lit("<")) | F.contains(low, F.lit("system-reminder")) | F.startswith("text", F.lit("[Request interrupted")) | F.startswith(low, F.lit("caveat:"))
    rows = rows.where(~noise).withColumn("position", F.row_number().over(W.partitionBy("session").orderBy("at"))).where(F.col("position") <= most)
    return rows.select("session", "position", F.when(F.length("text") > length, F.concat(F.rtrim(F.substring("text", 1, length)), F.lit("…"))).otherwise(F.col("text")).alias("text"))


def cues(files: DataFrame) -> DataFrame:
    """video, start (seconds) and text of each cue of caption files (video, content): the first line of a cue, without markup;
    cues that say what the one before said are left out."""
    clean = F.regexp_replace("content", "\r", "")
    mark = r"(\d{2}):(\d{2}):(\d{2})\.(\d{3})\s*-->"
    blocks = files.select("video", F.posexplode(F.split(clean, r"\n(?=\d{2}:\d{2}:\d{2}\.\d{3}\s*-->)|^(?=\d{2}:\d{2}:\d{2}\.\d{3}\s*-->)")).alias("at", "cue"))
    part = lambda k: F.regexp_extract("cue", mark, k).cast("double")
    lines = F.filter(F.slice(F.split("cue", "\n"), F.lit(2), F.greatest(F.size(F.split("cue", "\n")) - 1, F.lit(0))), lambda x: (F.trim(x) != "") & ~x.rlike(r"^\d+$") & ~x.rlike("^(WEBVTT|Kind:|Language:)"))
    text = F.trim(F.regexp_replace(F.get(lines, F.lit(0)), "<[^>]+>", ""))
    rows = blocks.where(F.col("cue").rlike("^" + mark)).select("video", "at", F.round(part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000, 3).alias("start"), text.alias("text")).where("text <> ''")
    before = F.lag("text").over(W.partitionBy("video").orderBy("at"))
    return rows.withColumn("_p", before).where(~F.col("_p").eqNullSafe(F.col("text"))).select("video", "at", "start", "text")


def transcript(found: DataFrame) -> DataFrame:
    """Each video's cues as one text."""
    return found.groupBy("video").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("text"))


def base64url(value: Column) -> Column:
    """Bytes of base64url text, padded or not."""
    plain = F.translate(value, "-_", "+/")
    return F.unbase64(F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4)))))


def header(raw: Column, name: str) -> Column:
    """A header's unfolded value in raw headers, or null."""
    unfolded = F.regexp_replace(F.substring_index(F.regexp_replace(raw, "\r\n", "\n"), "\n\n", 1), r"\n[ \t]+", " ")
    return F.nullif(F.trim(F.regexp_extract(unfolded, rf"(?im)^{name}:[ \t]*(.*)$", 1)), F.lit(""))


def csv_cell(value: Column) -> Column:
    return F.when(value.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(value, F.lit("")))


def export(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the mailbox list as CSV and JSON, by segment, and gives the number of messages of each."""
    ordered = rows.repartitionByRange("segment").sortWithinPartitions("segment", "sent_date")
    ordered.write.mode("overwrite").option("header", True).csv(f"{folder}/emails.csv")
    ordered.write.mode("overwrite").json(f"{folder}/emails.json")
    return rows.groupBy("segment").agg(F.count("*").alias("n")).orderBy("segment")


def write_texts(rows: DataFrame, folder: str, segment: str = "segment", text: str = "text") -> None:
    """Texts as a folder a segment: what a reader of Markdown files takes."""
    rows.select(segment, F.col(text).alias("value")).write.mode("overwrite").partitionBy(segment).option("lineSep", "\n\n").text(folder)


def flatten_cells(rows: Column) -> Column:
    """A document's table (rows of cells) as lines, cells by tabs."""
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, "\t")), "\n")


def replace_all(text: Column, old: str, new: str, match_case: bool = False) -> tuple[Column, Column]:
    """The text with every `old` replaced, and how many there were."""
    pattern = ("" if match_case else "(?i)") + r"\Q" + old + r"\E"
    return F.regexp_replace(text, pattern, new.replace("\\", "\\\\").replace("$", "\\$")), F.regexp_count(text, F.lit(pattern))
