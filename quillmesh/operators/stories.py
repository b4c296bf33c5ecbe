"""Stories of an issue: which are told, in what role, in what words the notes give them, and how the issue reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx
from quillmesh.operators.similarity import score

__all__ = ["assign_roles", "cited_before", "linked", "load", "markdown", "notes", "score"]
TALKED, QUICK, SKIP = 3, 6, 2


def cited_before(issues: DataFrame, segment: str, day: str) -> DataFrame:
    """item_id of all that earlier issues of a segment cite, rejected ones aside; a report that is no JSON cites none."""
    earlier = issues.where((F.col("segment") == segment) & (F.col("issue_date") < F.lit(day)) & (F.col("status") != "rejected"))
    report = F.from_json("validator_report", "cited_items array<bigint>")
    return earlier.select(F.explode(report["cited_items"]).alias("item_id")).distinct()


def load(stories: DataFrame, members: DataFrame, items: DataFrame, used: DataFrame, recurring: DataFrame) -> DataFrame:
    """The stories that still have items, none of them cited before or of a recurring section: sources are counted by
    newsletter names, items nest in order of sending. items: item_id, segment, source_key, sender_name, title, body, sent_date, summary, importance."""
    own = items.withColumn("norm_title", tx.norm(tx.clean_title(F.col("title"))))
    own = own.join(used, "item_id", "left_anti").join(recurring.select("segment", "source_key", "norm_title"), ["segment", "source_key", "norm_title"], "left_anti")
    j = members.select("story", "item_id").join(own.drop("segment"), "item_id")
    weight = F.coalesce(F.nullif("importance", F.lit(0)), F.lit(rules.IMPORTANCE))
    item = F.struct("sent_date", "item_id", tx.newsletter_name(F.col("sender_name")).alias("newsletter"), tx.clean_title(F.col("title")).alias("title"), "summary", weight.alias("importance"), F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))).alias("text"))
    some = F.max((F.coalesce("summary", F.lit("")) != "").cast("int")).alias("has_summary")
    per = j.groupBy("story").agg(F.countDistinct(tx.newsletter_name(F.col("sender_name"))).alias("sources"), F.max(weight).alias("importance"), some, F.array_sort(F.collect_list(item)).alias("items"))
    return stories.select("segment", "window_end", "story", "headline", "score").join(per, "story")


def assign_roles(scored: DataFrame, issue: str, story: str, talked: int = TALKED, quick: int = QUICK, skip: int = SKIP, summary: str | None = None) -> DataFrame:
    """Adds `role` to rows with sources, importance and score. Order is twice the sources and the importance, then the score,
    then the lesser story. TOP is the first; of the others those with two sources are TALKED_ABOUT; of those left with a
    summary, important ones (3 or more) are QUICK_HIT and unimportant ones SKIP, each up to its number; the rest has none.

    Only an issue's `1 + talked + quick + skip` first rows of each class can get a role. They are found by top-k in every
    task, before the shuffle, and only they are numbered together; no window takes an issue's whole rows into one task.
    """
    order = [F.desc(2 * F.col("sources") + F.col("importance")), F.desc("score"), F.asc(story)]
    told = F.lit(True) if summary is None else F.coalesce(F.col(summary).cast("boolean"), F.lit(False))
    rows = scored.withColumns({"_wide": F.col("sources") >= 2, "_kind": F.when(told & (F.col("importance") >= 3), "q").when(told & (F.col("importance") <= 2), "s").otherwise("n")})
    top = F.row_number().over(W.partitionBy(issue, "_wide", "_kind").orderBy(*order))
    few = rows.withColumn("_r", top).where(F.col("_r") <= 1 + talked + max(quick, skip)).drop("_r")
    few = few.withColumn("_r", F.row_number().over(W.partitionBy(issue).orderBy(*order)))
    few = few.withColumn("_k", F.row_number().over(W.partitionBy(issue, "_wide", F.col("_r") == 1).orderBy("_r")))
    few = few.withColumn("_one", F.when(F.col("_r") == 1, "TOP").when(F.col("_wide") & (F.col("_k") <= talked), "TALKED_ABOUT"))
    few = few.withColumn("_k", F.row_number().over(W.partitionBy(issue, F.col("_one").isNull(), "_kind").orderBy("_r")))
    second = F.when((F.col("_kind") == "q") & (F.col("_k") <= quick), "QUICK_HIT").when((F.col("_kind") == "s") & (F.col("_k") <= skip), "SKIP")
    roles = few.select(F.col(issue).alias("_issue"), F.col(story).alias("_story"), F.coalesce("_one", second).alias("role")).where("role IS NOT NULL")
    return scored.join(roles, scored[issue].eqNullSafe(roles["_issue"]) & (scored[story] == roles["_story"]), "left").drop("_issue", "_story")


def notes(role: Column, story: Column, sources: Column, items: Column, consensus: Column, divergence: Column) -> Column:
    """What the writer reads of a story: its items' summaries or first words, their numbers, and where they agree and differ.
    items: array of (item_id, title, summary, text, stats); points: arrays of (text, items)."""
    head = F.concat(F.lit("### STORY "), story.cast("string"), F.lit(" — "), role, F.lit(" — "), F.when(sources >= 2, "widely covered today").otherwise("single report"))
    n = F.size(items).cast("string")

    def lines(it: Column, k: Column) -> Column:
        body = F.when(F.coalesce(it["summary"], F.lit("")) != "", it["summary"]).otherwise(tx.first_words(it["text"], rules.BODY_WORDS))
        first = F.concat(F.lit("[i"), it["item_id"].cast("string"), F.lit("] note "), (k + 1).cast("string"), F.lit("/"), n, F.lit(": "), it["title"], F.lit("\n    "), body)
        numbers = F.concat(F.lit("    numbers: "), F.array_join(F.slice(it["stats"], 1, 4), "; "))
        return F.when(F.size(it["stats"]) > 0, F.array(first, numbers)).otherwise(F.array(first))

    def points(name: str, given: Column) -> Column:
        cites = lambda p: F.array_join(F.transform(p["items"], lambda i: F.concat(F.lit("[i"), i.cast("string"), F.lit("]"))), "")
        return F.transform(given, lambda p: F.concat(F.lit(f"    notes {name}: "), p["text"], F.lit(" "), cites(p)))

    return F.array_join(F.concat(F.array(head), F.flatten(F.transform(items, lines)), points("agree", consensus), points("differ", divergence)), "\n")


def linked(texts: Iterable[str], urls: dict[int, str]) -> list[str]:
    """For each text of one issue, in order, the address of the first item it cites that has one no text before has taken; or ""."""
    import re

    used: set[str] = set()
    out = []
    for t in texts:
        own = (urls.get(int(i), "") for i in re.findall(rules.CITATION, t or ""))
        out.append(next((u for u in own if u and u not in used), ""))
        used.add(out[-1])
    return out


def _plain(text: str) -> str:
    import re

    return re.sub(r"\s{2,}", " ", re.sub(r"\s+([.!?,;:])", r"\1", re.sub(rules.CITATION, "", text or ""))).strip()


def markdown(issue: dict, urls: dict[int, str], title: str, day: str) -> str:
    """One issue as Markdown, on the driver: an issue is a page."""
    top = issue["top_story"]
    sections = [("## Everyone's talking about", "talking_about", "", "\n"), ("## Quick hits", "quick_hits", "- ", "")]
    order = [*top["paragraphs"], *(x["text"] for _, k, _, _ in sections for x in issue.get(k, []))]
    links = iter(linked(order, urls))

    def told(text: str) -> str:
        url = next(links)
        return _plain(text) + (f" [Read story]({url})" if url else "")

    out = [f"**{title}** — {day}", "", f"# {issue['subject']}", "", _plain(issue.get("hook", "")), "", "## Today's big story", f"### {top['headline']}", *(told(p) + "\n" for p in top["paragraphs"])]
    if top.get("why_it_matters"):
        out.append(f"**Why it matters:** {_plain(top['why_it_matters'])}\n")
    for head, key, mark, end in sections:
        if issue.get(key):
            out += [head, *(mark + (f"**{x['headline']}** " if x.get("headline") else "") + told(x["text"]) + end for x in issue[key]), *([""] if mark else [])]
    if issue.get("safe_to_skip"):
        out += ["## Safe to skip", *("- " + _plain(x["text"]) for x in issue["safe_to_skip"]), ""]
    return "\n".join([*out, issue.get("close", "")]).strip() + "\n"
