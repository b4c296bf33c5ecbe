"""The daily run over an archive of Parquet tables: capture, split, extract, cluster, compose, decide. Also the command line."""

from __future__ import annotations

import argparse
import json
import os
import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmesh import models
from quillmesh.functions import text as tx
from quillmesh.operators import archive, duplicates, grounding, health, similarity, splitting, stories
from quillmesh.sources import blocks, mail

STALE = 3 * 3600


class Archive:
    """Tables in a folder that all executors see. A table is replaced by writing it anew beside the old one and then naming the new
    version, so a failed write leaves what was there; readers see one version as a whole."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[str]:
        at = self._path(f"{self.folder}/{name}")
        found = [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(v for v in found if v.startswith("v") and self._fs.exists(self._path(f"{self.folder}/{name}/{v}/_SUCCESS")))

    def has(self, name: str) -> bool:
        return bool(self._versions(name))

    def read(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """The table's last whole version; empty with the schema if there is none."""
        versions = self._versions(name)
        if versions:
            return self.spark.read.parquet(f"{self.folder}/{name}/{versions[-1]}")
        return self.spark.createDataFrame([], schema)

    def write(self, name: str, table: DataFrame) -> DataFrame:
        old = self._versions(name)
        table.write.parquet(f"{self.folder}/{name}/v{time.time_ns():020d}-{uuid.uuid4().hex[:6]}")
        for v in old[:-1]:  # the version that was read last stays for those that still read it
            self._fs.delete(self._path(f"{self.folder}/{name}/{v}"), True)
        return self.read(name)


ITEMS = "item_id long, gmail_id string, segment string, source_key string, sender_name string, sent_date string, position int, section string, title string, body string, url string, kind string, is_sponsor int, word_count int"
ENRICHED = "item_id long, summary string, category string, importance int, dropped int, error string, prompt_version string"
LOG = "id long, run_at string, scanned long, new_added long, status string"
ISSUES = "id long, segment string, issue_date string, status string, text string, validator_report string"


def capture(a: Archive, found: DataFrame, routing: dict, now: datetime, dry_run: bool = False) -> dict[str, int]:
    """New messages of (message_id, content) rows, routed and marked; a row in the log. Known ids are passed over."""
    known = a.read("messages", archive.MESSAGES)
    raw = found.join(known.select(F.col("gmail_id").alias("message_id")), "message_id", "left_anti")
    scanned = found.count()
    if dry_run:
        return {"scanned": scanned, "added": raw.count()}
    parsed = mail.parse(raw)
    rows = archive.conform(mail.message_rows(parsed, **routing).withColumn("raw_eml_path", F.when(F.col("segment") != "ignored", mail.archive_path(F.col("segment"), F.col("sent_date"), F.col("sender_name"), F.col("gmail_id")))), archive.MESSAGES)
    rows = a.write("new", rows)
    a.write("raw", a.read("raw", "message_id string, content binary").unionByName(raw.select("message_id", "content")))
    a.write("messages", duplicates.mark(archive.insert_new(known, rows, ["gmail_id"])).select(*archive.MESSAGES.names))
    added = rows.count()
    log = a.read("sync_log", LOG)
    last = log.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    a.write("sync_log", log.unionByName(a.spark.createDataFrame([(last + 1, now.isoformat(timespec="seconds"), scanned, added, "ok")], LOG)))
    return {"scanned": scanned, "added": added}


def resume_from(a: Archive, overlap_days: int = 3) -> str | None:
    """The day from which to scan again: that of the last good run less the overlap."""
    last = a.read("sync_log", LOG).where("status = 'ok'").agg(F.max("run_at")).first()[0]
    return mail.since(datetime.fromisoformat(last), overlap_days) if last else None


def split(a: Archive, segments: list[str] = (), redo: bool = False, limit: int | None = None) -> dict[str, int]:
    """Splits waiting issues into items and links; a rerun replaces what a message had. A message without a body fails and waits."""
    messages = a.read("messages", archive.MESSAGES)
    todo = archive.to_split(messages, segments, redo=redo, limit=limit)
    raw = a.read("raw", "message_id string, content binary").join(F.broadcast(todo.select(F.col("gmail_id").alias("message_id"))) if limit else todo.select(F.col("gmail_id").alias("message_id")), "message_id", "left_semi")
    bodies = mail.parse(raw).select(F.col("message_id").alias("gmail_id"), "html", "text", "subject")
    cleaned = blocks.with_blocks(bodies).withColumn("blocks", blocks.without_boilerplate(F.col("blocks")))
    found = a.write("split", splitting.with_items(cleaned.withColumn("clean_md", blocks.markdown(F.col("blocks")))).select("gmail_id", "items", "split_shape", "is_promo", "clean_md", F.when(F.col("html").isNull() & F.col("text").isNull(), "no body").alias("split_error")))
    about = messages.select("gmail_id", "segment", "source_key", "sender_name", "sent_date")
    rows = splitting.item_rows(found.where("split_error IS NULL").select("gmail_id", "items")).join(about, "gmail_id")
    old = a.read("items", ITEMS)
    links = a.read("links", "item_id long, url string, anchor_text string, domain string, link_type string")
    gone = old.join(found.select("gmail_id"), "gmail_id", "left_semi").select("item_id")
    a.write("links", links.join(gone, "item_id", "left_anti").unionByName(splitting.link_rows(rows)))
    a.write("items", archive.replace_children(old, rows.select(*old.columns), ["gmail_id"], found.select("gmail_id")))
    a.write("messages", archive.split_outcome(messages, found))
    return {r["split_shape"]: r["issues"] for r in splitting.counters(found).collect()}


def reindex(a: Archive, routing: dict, dry_run: bool = False) -> DataFrame:
    """Derives routing and kind of every message again, and duplicates after that; gives what changed."""
    messages = a.read("messages", archive.MESSAGES)
    again = mail.message_rows(mail.parse(a.read("raw", "message_id string, content binary")), **routing)
    changes = a.write("changes", archive.rerouted(messages, again))
    if not dry_run:
        a.write("items", archive.with_routing(a.read("items", ITEMS), changes))
        a.write("messages", duplicates.mark(archive.with_routing(messages, changes)).select(*archive.MESSAGES.names))
    return changes


def extract(a: Archive, make: Callable[[], models.Client], model: str, version: str = "v1", segments: list[str] = (), since: str | None = None, limit: int | None = None, dry_run: bool = False) -> dict[str, int]:
    """Facts of the items that still lack them; replies are kept by key, so asking again costs nothing. dry_run gives the estimate only."""
    messages, items, done = a.read("messages", archive.MESSAGES), a.read("items", ITEMS), a.read("item_enrichment", ENRICHED)
    todo, short = archive.long_enough(archive.to_extract(items, messages, done, version, segments, since, limit=limit))
    if dry_run:
        n, words = todo.agg(F.count("*"), F.coalesce(F.sum(F.least("word_count", F.lit(1800))), F.lit(0))).first()
        return {"items": n, "tokens": int(words * 1.4) + 450 * n}
    text = tx.item_text(F.col("section"), F.col("title"), F.col("body"))
    asked = todo.select("item_id", F.lit(models.EXTRACT).alias("system"), text.alias("user")).withColumn("key", F.sha2(F.concat_ws("\n", F.lit(model), F.lit(version), "system", "user"), 256))
    cache = a.read("llm_cache", "key string, reply string")
    got = a.write("replies", models.replies(asked, make, model, cache))
    a.write("llm_cache", archive.insert_new(cache, got.where("reply IS NOT NULL").select("key", "reply"), ["key"]))
    tables = grounding.facts(grounding.validated(got.withColumn("source", F.col("user")).where("error IS NULL"), "reply", "source"))
    failed = got.where("error IS NOT NULL").select("item_id", "error")
    fresh = tables.pop("item_enrichment").unionByName(failed, allowMissingColumns=True).withColumn("prompt_version", F.lit(version))
    a.write("item_enrichment", archive.upsert(done, fresh.select(*done.columns), ["item_id"]))
    for name, rows in tables.items():
        old = a.read(name, rows.schema)
        a.write(name, archive.replace_children(old, rows, ["item_id"], got.select("item_id")))
    ok = a.read("item_enrichment").join(got.select("item_id"), "item_id", "left_semi").agg(F.count_if(F.col("error").isNull()), F.coalesce(F.sum("dropped"), F.lit(0))).first()
    return {"done": ok[0], "skipped_short": short.count(), "dropped": ok[1]}


def cluster(a: Archive, end: datetime, hours: int = 48, threshold: float = similarity.rules.THRESHOLD) -> DataFrame:
    """Stories of every segment in the window up to `end`; those of the same day are replaced."""
    items = archive.told(a.read("items", ITEMS), a.read("messages", archive.MESSAGES))
    at = F.lit(end.isoformat()).cast("timestamp")
    window = similarity.in_window(items.withColumn("source_key", F.coalesce("source_key", "gmail_id")), at, hours)
    names = a.read("entities", "item_id long, name string, type string")
    docs = a.write("docs", similarity.docs(window, a.read("item_enrichment", ENRICHED), names, similarity.recurring_titles(a.read("items", ITEMS))))
    vectors = similarity.weights(similarity.term_frequency(docs), *similarity.background(a.read("items", ITEMS)))
    pairs = a.write("pairs", similarity.similar(vectors, docs))
    enough = docs.join(vectors.select("item_id").distinct(), "item_id", "left_semi")
    members = a.write("members", similarity.stories(pairs, enough, threshold))
    told = similarity.rollup(members, docs)
    key = ["segment", "window_end"]
    a.write("stories", archive.replace_children(a.read("stories", told.schema), told, key))
    close = similarity.closeness(members, pairs).join(members.select("item_id", *key), "item_id")
    a.write("story_items", archive.replace_children(a.read("story_items", close.schema), close, key))
    return a.read("stories").where(F.col("window_end") == F.lit(end.date().isoformat()).cast("date"))


def selected(a: Archive, segment: str, day: str) -> DataFrame:
    """The day's stories with their roles, without items that earlier issues cite."""
    items = a.read("items", ITEMS).join(a.read("item_enrichment", ENRICHED).where("error IS NULL").select("item_id", "summary", "importance"), "item_id", "left")
    own = a.read("stories").where((F.col("segment") == segment) & (F.col("window_end") == F.lit(day).cast("date")))
    told = stories.load(own, a.read("story_items"), items, stories.cited_before(a.read("issues", ISSUES), segment, day), similarity.recurring_titles(a.read("items", ITEMS)))
    return stories.assign_roles(told, "segment", "story", summary="has_summary").where("role IS NOT NULL")


def compose(a: Archive, segment: str, day: str, client: models.Client, model: str, title: str, newsletters: list[str] = ()) -> dict:
    """Writes a day's draft: selected stories as notes, the model's reply checked sentence by sentence, tried once more if that
    finds problems. A decided issue of the day is left as it is."""
    issues = a.read("issues", ISSUES)
    old = issues.where((F.col("segment") == segment) & (F.col("issue_date") == day)).first()
    if old and old["status"] != "draft":
        return {"skipped": old["status"]}
    picked = selected(a, segment, day)
    empty = F.array().cast("array<struct<text:string,items:array<bigint>>>")
    rows = picked.withColumn("notes", stories.notes(F.col("role"), F.col("story"), F.col("sources"), F.transform("items", lambda i: F.struct(i["item_id"].alias("item_id"), i["title"].alias("title"), i["summary"].alias("summary"), i["text"].alias("text"), F.array().cast("array<string>").alias("stats"))), empty, empty))
    found = rows.select("story", "role", "headline", "notes", "items").collect()  # at most twelve stories of a page
    if not found:
        return {"skipped": "no stories"}
    texts = a.spark.createDataFrame([(i["item_id"], i["text"]) for r in found for i in r["items"]], "item_id long, text string")
    prompt = [{"role": "system", "content": models.COMPOSE}, {"role": "user", "content": f"{title}, {day}\n\n" + "\n\n".join(r["notes"] for r in sorted(found, key=lambda r: ("TOP", "TALKED_ABOUT", "QUICK_HIT", "SKIP").index(r["role"])))}]

    def checked(reply: dict) -> tuple[dict, list[str]]:
        return check_issue(a.spark, reply, texts, newsletters, next(r["headline"] for r in found if r["role"] == "TOP"))

    issue, problems = checked(client.chat(model, prompt))
    issue, problems, again = models.better(issue, problems, lambda p: checked(client.chat(model, [*prompt, {"role": "user", "content": "Mend these: " + "; ".join(p)}])))
    cited = sorted({int(i) for i in __import__("re").findall(r"\[i(\d+)\]", json.dumps(issue))})
    urls = {r["item_id"]: r["url"] for r in a.read("items", ITEMS).where(F.col("item_id").isin(*cited)).select("item_id", "url").collect() if r["url"]} if cited else {}
    page = stories.markdown(issue, urls, title, datetime.fromisoformat(day).strftime("%A, %-d %B %Y"))
    number = old["id"] if old else (issues.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1)
    row = a.spark.createDataFrame([(number, segment, day, "draft", page, json.dumps({"cited_items": cited, "problems_dropped": problems, "retried": again}))], ISSUES)
    a.write("issues", archive.upsert(issues, row, ["segment", "issue_date"], keep=("id",)))
    return {"id": number, "problems": problems, "retried": again, "text": page}


def check_issue(spark: SparkSession, reply: dict, texts: DataFrame, newsletters: list[str], headline: str) -> tuple[dict, list[str]]:
    """A reply as an issue of sound sentences within its caps, and the problems of those that go."""
    top = reply.get("top_story") or {}
    capped = {"talking_about": stories.TALKED, "quick_hits": stories.QUICK, "safe_to_skip": stories.SKIP}
    parts = [("hook", 0, reply.get("hook")), *(("top", k, p) for k, p in enumerate((top.get("paragraphs") or [])[:4])), ("why", 0, top.get("why_it_matters"))]
    parts += [(c, k, x.get("text") if isinstance(x, dict) else x) for c, n in capped.items() for k, x in enumerate((reply.get(c) or [])[:n])]
    every = [r[0] for r in texts.select("item_id").distinct().collect()]
    heads = [("subject", 0, reply.get("subject")), ("head", 0, top.get("headline")), *((f"{c}-head", k, x.get("headline")) for c, n in capped.items() for k, x in enumerate((reply.get(c) or [])[:n]) if isinstance(x, dict))]
    rows = spark.createDataFrame([(1, p, k, str(t) if t else None) for p, k, t in parts], "issue int, part string, position int, text string")
    named = spark.createDataFrame([(p, k, " ".join(str(t or "").split()), every) for p, k, t in heads], "part string, position int, sentence string, scope array<bigint>")
    named = named.withColumn("sentence", tx.plain(tx.tidy(F.col("sentence"))))
    got = {(r["part"], r["position"]): r for r in grounding.checked_parts(rows, texts, newsletters).collect()}
    titles = {(r["part"], r["position"]): r for r in grounding.checked_sentences(named, texts, newsletters, need=False).collect()}
    text = lambda p, k=0: got[p, k]["text"] if (p, k) in got else ""
    title = lambda p, k=0: titles[p, k]["sentence"] if (p, k) in titles and not titles[p, k]["problem"] else ""
    issue = {"subject": (title("subject") or title("head") or headline)[:90], "hook": text("hook"), "top_story": {"headline": title("head"), "paragraphs": [t for k in range(4) if (t := text("top", k))], "why_it_matters": text("why")}}
    for c, n in capped.items():
        issue[c] = [{"headline": title(f"{c}-head", k), "text": t} for k in range(n) if (t := text(c, k))]
    close = " ".join(str(reply.get("close") or "").split())
    issue["close"] = close if close and not any(map(str.isdigit, close)) else "That's all for today."
    problems = [f"{p}: {x}" for (p, _), r in sorted(got.items()) for x in r["problems"]] + [f"{p}: {r['problem']}" for (p, _), r in sorted(titles.items()) if r["problem"] and r["sentence"]]
    return issue, problems + ([] if issue["top_story"]["paragraphs"] else ["top story: nothing left"])


def quiet(a: Archive, now: datetime) -> DataFrame:
    """Sources whose issues have stopped coming."""
    own = a.read("messages", archive.MESSAGES).where("is_issue = 1 AND duplicate_of IS NULL").select("segment", "sender_email", F.col("sent_date").cast("timestamp").alias("ts"))
    now_row = a.spark.createDataFrame([("", "", now)], "segment string, sender_email string, ts timestamp")
    return health.quiet_sources(own.unionByName(now_row), "segment", "sender_email", "ts")


class Locked(RuntimeError):
    pass


def daily(path: str, steps: list[tuple[str, Callable[[], object]]], clock: Callable[[], float] = time.time) -> dict[str, str]:
    """Runs steps one after another, each by itself: one that fails doesn't keep the next from running. One run at a time: a lock file
    on the driver, taken over after three hours."""
    if os.path.exists(path) and clock() - os.path.getmtime(path) < STALE:
        raise Locked(path)
    with open(path, "w", encoding="utf-8") as f:
        f.write(datetime.fromtimestamp(clock(), UTC).isoformat())
    out = {}
    try:
        for name, step in steps:
            try:
                out[name] = f"ok {step()}"
            except Exception as e:  # noqa: BLE001 - a step's failure is its result
                out[name] = f"failed {type(e).__name__}: {e}"
    finally:
        os.remove(path)
    return out


def main(argv: list[str] | None = None) -> int:
    """python -m quillmesh.app <verb> --archive FOLDER ..."""
    p = argparse.ArgumentParser(prog="quillmesh")
    p.add_argument("verb", choices=["init-db", "capture", "stats", "split", "split-review", "reindex", "cluster", "issues", "approve", "reject", "health"])
    p.add_argument("--archive", required=True)
    p.add_argument("--mail", help="folder of .eml files")
    p.add_argument("--routing", help="JSON file: inbox, overrides, by_tag, fallbacks, ignored")
    p.add_argument("--segment", action="append", default=[])
    p.add_argument("--unmatched", action="store_true")
    p.add_argument("--redo", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--days", type=int, default=7)
    p.add_argument("--end", default=None)
    p.add_argument("--id", type=int)
    o = p.parse_args(argv)
    spark = SparkSession.builder.appName("quillmesh").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    a, now = Archive(spark, o.archive), datetime.fromisoformat(o.end) if o.end else datetime.now(UTC)
    routing = json.load(open(o.routing, encoding="utf-8")) if o.routing else {"inbox": "box@example.com", "overrides": [], "by_tag": {}, "fallbacks": []}
    messages = a.read("messages", archive.MESSAGES)
    cutoff = F.lit((now - timedelta(days=o.days)).isoformat())
    match o.verb:
        case "init-db":
            a.write("messages", messages)
        case "capture":
            print(capture(a, mail.read_raw(spark, o.mail), routing, now, o.dry_run))
        case "stats":
            for table in [archive.unmatched(messages)] if o.unmatched else [archive.by_segment(messages, cutoff), archive.by_sender(messages, cutoff), archive.last_runs(a.read("sync_log", LOG))]:
                table.show(1000, False)
        case "split":
            print(split(a, o.segment, o.redo, o.limit))
        case "split-review":
            archive.review(messages, a.read("items", ITEMS), o.limit or 20).show(100, False)
        case "reindex":
            archive.moves(reindex(a, routing, o.dry_run)).show(1000, False)
        case "cluster":
            cluster(a, now).orderBy(F.desc("score")).show(100, False)
        case "issues":
            archive.issue_list(a.read("issues", ISSUES)).drop("text").show(20, False)
        case "approve" | "reject":
            a.write("issues", archive.decide(a.read("issues", ISSUES), o.id, o.verb == "approve"))
        case "health":
            quiet(a, now).show(1000, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
