"""What a model wrote held against its sources: extracted facts, points of agreement, sentences of an issue. Native."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx

REPLY = (
    "summary string, category string, importance string, entities array<struct<name:string,type:string>>, claims array<struct<text:string,type:string>>, "
    "stats array<struct<value:string,unit:string,description:string>>, quotes array<struct<text:string,speaker:string>>, topics array<string>"
)
POINTS = "array<struct<text:string,items:array<string>>>"


def _some(values: Column, n: int) -> Column:
    return F.slice(F.coalesce(values, F.array()), 1, n)


def _clip(value: Column, n: int) -> Column:
    return tx.clip(F.coalesce(value, F.lit("")), n)


def _one_of(value: Column, names: tuple[str, ...], other: str) -> Column:
    low = F.lower(F.trim(F.coalesce(F.nullif(value, F.lit("")), F.lit(other))))
    return F.when(low.isin(*names), low).otherwise(other)


def _distinct_by(values: Column, key: Callable[[Column], Column]) -> Column:
    keys = F.transform(values, key)
    return F.filter(values, lambda v, i: F.array_position(keys, key(v)) == i + 1)


def validated(rows: DataFrame, reply: str = "reply", source: str = "source") -> DataFrame:
    """rows with a parsed reply as x: summary, category, importance (1 to 5), entities, claims, stats, quotes and topics that the
    source holds, and dropped, the number of those it doesn't. x is null where there is no object, or no summary of a
    source of sixty words or more; a shorter source's first line then stands in, at importance 1."""
    r, t, words = F.from_json(tx.json_object(F.col(reply)), REPLY), tx.norm(F.col(source)), F.size(tx.words(F.col(source)))
    rows = rows.withColumn("_r", r).withColumn("_t", t)
    r, t = F.col("_r"), F.col("_t")
    summary, first = _clip(r["summary"], 400), _clip(F.substring_index(F.col(source), "\n", 1), 200)
    blank = summary == ""
    importance = F.when(blank, 1).otherwise(F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce(F.bround(r["importance"].try_cast("double"), 0).cast("int"), F.lit(3)))))

    def holds(value: Column) -> Column:
        return tx.number_in_text(value, t)

    named = F.filter(F.transform(_some(r["entities"], 12), lambda e: F.struct(_clip(e["name"], 80).alias("name"), _one_of(e["type"], rules.ENTITY_TYPES, "other").alias("type"))), lambda e: e["name"] != "")
    found = F.filter(named, lambda e: F.contains(t, tx.norm(e["name"])))
    claims = F.filter(F.transform(_some(r["claims"], 6), lambda c: F.struct(_clip(c["text"], 300).alias("text"), _one_of(c["type"], rules.CLAIM_TYPES, "fact").alias("type"))), lambda c: c["text"] != "")
    true = F.filter(claims, lambda c: ~c["text"].rlike(r"\d") | holds(c["text"]))
    stats = F.transform(_some(r["stats"], 6), lambda s: F.struct(_clip(s["value"], 40).alias("value"), _clip(s["unit"], 40).alias("unit"), _clip(s["description"], 120).alias("description")))
    known = F.filter(stats, lambda s: (s["value"] != "") & holds(s["value"]))
    quotes = F.transform(_some(r["quotes"], 3), lambda q: F.struct(_clip(F.regexp_replace(F.coalesce(q["text"], F.lit("")), "^[ \"'“”]+|[ \"'“”]+$", ""), 400).alias("text"), _clip(q["speaker"], 80).alias("speaker")))
    said = F.filter(quotes, lambda q: (F.size(tx.words(q["text"])) >= 3) & F.contains(t, F.substring(tx.norm(q["text"]), 1, 60)))
    topics = F.array_distinct(F.filter(F.transform(_some(r["topics"], 4), lambda x: _clip(F.lower(x), 40)), lambda x: x != ""))
    gone = F.size(named) - F.size(found) + F.size(claims) - F.size(true) + F.size(stats) - F.size(known) + F.size(quotes) - F.size(said)
    x = F.struct(
        F.when(blank, F.when(first == "", "(no summary)").otherwise(first)).otherwise(summary).alias("summary"), _one_of(r["category"], rules.CATEGORIES, "other").alias("category"), importance.alias("importance"),
        F.slice(_distinct_by(found, lambda e: tx.norm(e["name"])), 1, 8).alias("entities"), F.slice(true, 1, 5).alias("claims"), F.slice(known, 1, 5).alias("stats"), F.slice(said, 1, 2).alias("quotes"), topics.alias("topics"), gone.alias("dropped"),
    )
    return rows.withColumn("x", F.when(r.isNotNull() & (~blank | (words < 60)), x)).drop("_r", "_t")


def facts(checked: DataFrame, key: str = "item_id") -> dict[str, DataFrame]:
    """The fact tables of validated rows: a row an entity, claim, stat, quote and topic, and one an item; failed ones have an error."""
    good = checked.where("x IS NOT NULL")
    out = {name: good.select(key, F.inline(f"x.{name}")) for name in ("entities", "claims", "stats", "quotes")}
    out["topics"] = good.select(key, F.explode("x.topics").alias("topic"))
    out["item_enrichment"] = checked.select(key, "x.summary", "x.category", "x.importance", "x.dropped", F.when(F.col("x").isNull(), "no valid extraction").alias("error"))
    return out


def valid_points(points: Column, allowed: Column) -> Column:
    """Of points (text, items) at most three that cite items of the map `allowed` (id to text) only and whose numbers these hold."""

    def own(p: Column) -> Column:
        ids = F.filter(F.transform(F.coalesce(p["items"], F.array().cast("array<string>")), tx.cited_id), lambda i: i.isNotNull() & F.map_contains_key(allowed, F.coalesce(i, F.lit(-1))))
        return F.struct(tx.flat(F.coalesce(p["text"], F.lit(""))).alias("text"), ids.alias("items"))

    def holds(p: Column) -> Column:
        cited = tx.norm(F.array_join(F.transform(p["items"], lambda i: F.element_at(allowed, i)), " "))
        return (p["text"] != "") & (F.size(p["items"]) > 0) & (~p["text"].rlike(r"\d") | tx.number_in_text(p["text"], cited))

    kept = F.filter(F.transform(F.coalesce(points, F.from_json(F.lit("[]"), POINTS)), own), holds)
    return F.slice(F.transform(kept, lambda p: F.struct(F.substring(p["text"], 1, 300).alias("text"), p["items"].alias("items"))), 1, 3)


def checked_sentences(rows: DataFrame, texts: DataFrame, newsletters: list[str] = (), need: bool = True) -> DataFrame:
    """rows (any columns, `sentence`) with `problem`: null, or the first rule that the sentence breaks against texts (item_id,
    text) it cites. Sentences without a letter break none. One without a citation, where none is needed, is held against the
    items in a column `scope` (array of ids) if rows have it, else against no text at all.

    Only the texts that a row cites are joined to it, so nothing of the whole archive travels along.
    """
    s = F.col("sentence")
    own = rows.withColumns({"_id": F.monotonically_increasing_id(), "_cites": tx.citations(s), "_bare": F.trim(F.regexp_replace(s, rules.CITATION, ""))})
    scope = F.col("scope") if "scope" in rows.columns else F.array().cast("array<bigint>")
    cited = own.select("_id", F.explode(F.when(F.size("_cites") > 0, F.col("_cites")).otherwise(scope)).alias("item_id"))
    known = texts.select("item_id", tx.norm(F.col("text")).alias("_text"), tx.ngrams(F.col("text")).alias("_runs"))
    met = cited.join(known, "item_id", "left")
    per = met.groupBy("_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "_text"))), lambda x: F.coalesce(x["_text"], F.lit(""))), " ").alias("_src"), F.array_distinct(F.flatten(F.collect_list(F.coalesce("_runs", F.array().cast("array<string>"))))).alias("_grams"), F.array_sort(F.collect_list(F.when(F.col("_text").isNull(), F.col("item_id")))).alias("_lost"))
    j = own.join(per, "_id", "left").withColumn("_unknown", F.array_intersect("_lost", "_cites"))
    bare, src = F.col("_bare"), F.coalesce("_src", F.lit(""))
    names = [n for n in newsletters if n and len(n) >= 3]
    paper = F.coalesce(*[F.when(bare.rlike(r"(?U)(?<![\w])\Q" + n + r"\E(?![\w])"), F.lit(f"names the newsletter '{n}'")) for n in names], F.lit(None).cast("string"))
    numbers = F.regexp_extract_all(F.regexp_replace(bare, rules.SOURCE_COUNT, " "), F.lit(f"({rules.NUMBER})"))
    flat = F.replace(src, F.lit(","), F.lit(""))
    odd = F.get(F.filter(numbers, lambda n: ~(F.contains(src, n) | F.contains(flat, F.replace(n, F.lit(","), F.lit(""))))), F.lit(0))
    words = F.regexp_extract_all(bare, F.lit(r"(?U)([A-Za-z][\w.&+'’-]*)"))
    later = F.filter(F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), lambda w: w.rlike(r"^[A-Z]"))
    plain = lambda w: F.regexp_replace(F.regexp_replace(tx.norm(w), r"^[.'’-]+|[.'’-]+$", ""), r"['’]s$", "")
    name = F.get(F.filter(later, lambda w: (plain(w) != "") & ~plain(w).isin(*rules.ALLOWED_NAMES) & ~F.contains(src, plain(w))), F.lit(0))
    problem = (
        F.when(~bare.rlike("[A-Za-z]"), F.lit(None).cast("string"))
        .when(F.size(F.coalesce("_unknown", F.array().cast("array<bigint>"))) > 0, F.concat(F.lit("cites unknown item(s) ["), F.array_join("_unknown", ", "), F.lit("]")))
        .when(F.lit(need) & (F.size("_cites") == 0), "no citation")
        .when(paper.isNotNull(), paper)
        .when(bare.rlike(r"(?i)\bnewsletters?\b"), "mentions newsletters")
        .when(odd.isNotNull(), F.concat(F.lit("number "), odd, F.lit(" not in the cited source")))
        .when(name.isNotNull(), F.concat(F.lit("name '"), name, F.lit("' not in the cited source")))
        .when(F.arrays_overlap(tx.ngrams(bare), F.coalesce("_grams", F.array().cast("array<string>"))), F.lit("copies 11+ words from the source"))
    )
    return j.withColumn("problem", problem).select(*rows.columns, "problem")


def checked_parts(parts: DataFrame, texts: DataFrame, newsletters: list[str] = ()) -> DataFrame:
    """parts (issue, part, position, text) with the text's sound sentences and the problems of the others."""
    split = parts.select("issue", "part", "position", F.posexplode_outer(tx.sentences(tx.tidy(F.col("text")))).alias("at", "sentence"))
    found = checked_sentences(split.where("sentence IS NOT NULL"), texts, newsletters)
    kept = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("at", "sentence", "problem"))), lambda x: x["problem"].isNull()), lambda x: x["sentence"])
    bad = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("at", "sentence", "problem"))), lambda x: x["problem"].isNotNull()), lambda x: F.concat(F.lit('"'), F.substring(x["sentence"], 1, 90), F.lit('" - '), x["problem"]))
    per = found.groupBy("issue", "part", "position").agg(F.array_join(kept, " ").alias("text"), bad.alias("problems"))
    return parts.select("issue", "part", "position").join(per, ["issue", "part", "position"], "left").select("issue", "part", "position", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("problems", F.array().cast("array<string>")).alias("problems"))
