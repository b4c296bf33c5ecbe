"""Stories: items of different sources that tell the same, by weighted words and names.

All but the last step is native: words and weights are long tables, similar pairs meet in an inverted index (a join on the
word), so that items without a common word are never compared. Grouping takes pairs in their order and is a grouped
Python stage over one window's links, which are few.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.functions import text as tx

KEY = ["segment", "window_end"]


def recurring_titles(items: DataFrame, least: int = rules.RECURRING) -> DataFrame:
    """segment, source_key and plain title of sections that come back in at least so many messages."""
    named = items.select("segment", "source_key", tx.norm(tx.clean_title(F.col("title"))).alias("norm_title"), "gmail_id").where("norm_title <> ''")
    return named.groupBy("segment", "source_key", "norm_title").agg(F.countDistinct("gmail_id").alias("issues")).where(F.col("issues") >= least)


def in_window(items: DataFrame, end: Column, hours: int = 48) -> DataFrame:
    """Items sent in the hours up to the end, both included."""
    at = F.col("sent_date").cast("timestamp")
    return items.where(at.between(end - F.make_dt_interval(hours=F.lit(hours)), end)).withColumn("window_end", end.cast("date"))


def docs(items: DataFrame, enrichment: DataFrame | None = None, names: DataFrame | None = None, recurring: DataFrame | None = None) -> DataFrame:
    """Items as documents: summary and importance where extraction gave them, distinct plain names, whether the title recurs."""
    out = items
    if enrichment is not None:
        good = enrichment.where("error IS NULL").select("item_id", F.col("summary").alias("_summary"), F.col("importance").alias("_importance"))
        out = out.join(good, "item_id", "left")
    else:
        out = out.withColumns({"_summary": F.lit(None).cast("string"), "_importance": F.lit(None).cast("int")})
    if names is not None:
        out = out.join(names.groupBy("item_id").agg(F.collect_set(tx.norm(F.col("name"))).alias("names")), "item_id", "left")
    else:
        out = out.withColumn("names", F.lit(None).cast("array<string>"))
    out = out.withColumns({"names": F.array_sort(F.coalesce("names", F.array().cast("array<string>"))), "importance": F.coalesce("_importance", F.lit(rules.IMPORTANCE))})
    out = out.withColumn("clean_title", tx.clean_title(F.col("title"))).withColumn("_norm", tx.norm(F.col("clean_title")))
    out = out.withColumn("extra", F.coalesce(F.nullif("_summary", F.lit("")), tx.first_words(F.col("body"), rules.BODY_WORDS)))
    if recurring is not None:
        flags = recurring.select("segment", "source_key", F.col("norm_title").alias("_norm"), F.lit(True).alias("_again"))
        out = out.join(flags, ["segment", "source_key", "_norm"], "left").withColumn("recurring", F.coalesce("_again", F.lit(False))).drop("_again")
    else:
        out = out.withColumn("recurring", F.lit(False))
    return out.drop("_summary", "_importance", "_norm")


def together(rows: DataFrame) -> DataFrame:
    """Rows of a window in one partition; four times as many partitions as a shuffle has, as much is done within one."""
    return rows.repartition(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "window_end")


def term_frequency(documents: DataFrame) -> DataFrame:
    """Key, item_id, token and tf: title words count twice, names' words twice besides; documents with a sum under 3 are left out."""

    def part(value: Column, weight: int) -> Column:
        return F.transform(tx.tokens(value), lambda t: F.struct(t.alias("token"), F.lit(weight).alias("w")))

    every = F.concat(part(F.col("clean_title"), 2), part(F.col("extra"), 1), part(F.array_join("names", " "), 2))
    found = documents.where("item_id IS NOT NULL").select(*KEY, "item_id", every.alias("_every"))
    total = F.sum(F.aggregate("_every", F.lit(0), lambda n, x: n + x["w"])).over(W.partitionBy("item_id"))
    # whole documents are dealt out, a window's to one task: its words, counts and pairs then meet without another shuffle
    enough = together(found.withColumn("_n", total).where(F.col("_n") >= rules.LEAST_TOKENS))
    return enough.select(*KEY, "item_id", F.explode("_every").alias("x")).groupBy(*KEY, "item_id", "x.token").agg(F.sum("x.w").alias("tf"))


def background(items: DataFrame, limit: int = rules.BACKGROUND) -> tuple[DataFrame, DataFrame]:
    """Document frequency of words over each segment's latest items that are no adverts (segment, token, df), and their number.

    The latest are found by a partial top-k in every task before any row of them is shuffled; they, and their words, are
    `limit` items a segment at most, and are sent to every task.
    """
    rank = F.row_number().over(W.partitionBy("segment").orderBy(F.desc("sent_date"), F.desc("item_id")))
    latest = items.where("is_sponsor = 0").select("segment", "item_id", "sent_date").withColumn("_r", rank).where(F.col("_r") <= limit).select("item_id")
    own = items.join(F.broadcast(latest), "item_id", "left_semi")
    seen = F.array_distinct(tx.tokens(F.concat_ws(" ", tx.clean_title(F.col("title")), tx.first_words(F.col("body"), rules.BODY_WORDS))))
    df = own.select("segment", F.explode(seen).alias("token")).groupBy("segment", "token").agg(F.count("*").alias("df"))
    return df, own.groupBy("segment").agg(F.count("*").alias("n"))


def weights(tf: DataFrame, df: DataFrame | None = None, n: DataFrame | None = None) -> DataFrame:
    """Key, item_id, token and normalised w: (1 + ln tf)(ln((1 + n) / (1 + df)) + 1). Where the background has more items than
    the window, its counts are added to the window's."""
    own = tf.where(" AND ".join(f"{c} IS NOT NULL" for c in (*KEY, "item_id")))
    own = own.withColumns({"_df": F.count("*").over(W.partitionBy("window_end", "segment", "token")), "_n": F.size(F.collect_set("item_id").over(W.partitionBy("window_end", "segment")))})
    if df is not None:
        own = own.join(F.broadcast(n.withColumnRenamed("n", "_bn")), "segment", "left").withColumn("_big", F.coalesce(F.col("_bn") > F.col("_n"), F.lit(False)))
        own = own.join(F.broadcast(df.withColumnRenamed("df", "_bdf")), ["segment", "token"], "left")
    else:
        own = own.withColumns({"_big": F.lit(False), "_bn": F.lit(0), "_bdf": F.lit(0)})
    total = F.col("_n") + F.when(F.col("_big"), F.col("_bn")).otherwise(0)
    has = F.col("_df") + F.when(F.col("_big"), F.coalesce("_bdf", F.lit(0))).otherwise(0)
    raw = own.select(*KEY, "item_id", "token", ((1 + F.log("tf")) * (F.log((1 + total) / (1 + has)) + 1)).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("window_end", "item_id")))
    return raw.withColumn("_l", norm).select(*KEY, "item_id", "token", F.when(F.col("_l") > 0, F.col("w") / F.col("_l")).otherwise(F.col("w")).alias("w"))


def similar(vectors: DataFrame, documents: DataFrame, least: float = 0.0) -> DataFrame:
    """Key, a, b (a < b) and s of pairs of one window with different sources and no recurring title that share a word or a name:
    the cosine, or three quarters of it and a quarter of the names' Jaccard where both have names. s = 0 is left out."""
    flat = documents.where("NOT recurring").select(*KEY, "item_id", "source_key", "names")
    # a row an item until its window's items are together: words (weighted) and names (not) of one window meet there
    items = vectors.groupBy(*KEY, "item_id").agg(F.collect_list(F.struct("token", "w")).alias("_own")).join(flat.drop(*KEY), "item_id")
    named = flat.where("size(names) > 0").select(*KEY, "item_id", "source_key", "names", F.transform("names", lambda n: F.struct(n.alias("token"), F.lit(None).cast("double").alias("w"))).alias("_own"))
    rows = together(items.select(*named.columns).unionByName(named))
    one = rows.select(*KEY, F.struct("item_id", "source_key", F.size("names").alias("n")).alias("i"), F.explode("_own").alias("t"))
    met = one.groupBy(*KEY, "t.token", F.col("t.w").isNull().alias("name")).agg(F.collect_list(F.struct("i.item_id", "i.source_key", "i.n", "t.w")).alias("met")).where("size(met) > 1")
    both = met.select(*KEY, "name", "met", F.explode("met").alias("x")).select(*KEY, "name", "x", F.explode("met").alias("y"))
    other = (F.col("x.item_id") < F.col("y.item_id")) & ~F.col("x.source_key").eqNullSafe(F.col("y.source_key"))
    pairs = both.where(other).groupBy(*KEY, F.col("x.item_id").alias("a"), F.col("y.item_id").alias("b")).agg(
        F.sum(F.col("x.w") * F.col("y.w")).alias("cos"), F.sum(F.col("name").cast("int")).alias("m"), F.max("x.n").alias("na"), F.max("y.n").alias("nb")
    )
    c = F.coalesce("cos", F.lit(0.0))
    jaccard = F.col("m") / (F.col("na") + F.col("nb") - F.col("m"))
    s = F.when((F.col("na") > 0) & (F.col("nb") > 0), (1 - rules.NAME_WEIGHT) * c + rules.NAME_WEIGHT * jaccard).otherwise(c)
    return pairs.select(*KEY, "a", "b", s.alias("s")).where((F.col("s") > 0) & (F.col("s") >= least))


def linked_pairs(vectors: DataFrame, documents: DataFrame, threshold: float = rules.THRESHOLD) -> DataFrame:
    """All pairs, close or not, of items that have some pair as similar as the threshold: what `stories` reads of all pairs."""
    ends = similar(vectors, documents, threshold).select(F.explode(F.array("a", "b")).alias("item_id")).distinct()
    return similar(vectors, documents.join(ends, "item_id", "left_semi"))


def grouped(pairs: list[tuple[float, int, int]], source: dict[int, str], threshold: float = rules.THRESHOLD) -> dict[int, int]:
    """The story of every item (its least item): pairs in descending order join their stories if these have no source in
    common and are on average as similar as the threshold, where a pair without a similarity counts as 0."""
    sims = {(a, b): s for s, a, b in pairs} | {(b, a): s for s, a, b in pairs}
    home, members = {i: i for i in source}, {i: [i] for i in source}
    for s, a, b in sorted(pairs, reverse=True):
        x, y = home[a], home[b]
        if s < threshold or x == y or {source[i] for i in members[x]} & {source[i] for i in members[y]}:
            continue
        if sum(sims.get((i, j), 0.0) for i in members[x] for j in members[y]) >= threshold * len(members[x]) * len(members[y]):
            members[x] += members.pop(y)
            home |= {i: x for i in members[x]}
    least = {x: min(m) for x, m in members.items()}
    return {i: least[x] for i, x in home.items()}


def stories(pairs: DataFrame, documents: DataFrame, threshold: float = rules.THRESHOLD) -> DataFrame:
    """Key, story (its least item) and item_id of every document. Only items that some pair links reach the Python stage, a
    connected window at a time; all others are stories by themselves."""
    source = documents.select("item_id", F.coalesce(F.col("source_key").cast("string"), F.lit("")).alias("source"))
    sa, sb = (source.select(F.col("item_id").alias(k), F.col("source").alias(f"s{k}")) for k in ("a", "b"))
    rows = pairs.join(sa, "a").join(sb, "b").select(*KEY, "a", "b", "s", "sa", "sb")

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        close = own[own["s"] >= threshold]
        source = dict(zip(close["a"], close["sa"], strict=True)) | dict(zip(close["b"], close["sb"], strict=True))
        home = grouped([(s, a, b) for s, a, b in zip(own["s"], own["a"].tolist(), own["b"].tolist(), strict=True) if a in source and b in source], source, threshold)
        # plain objects: pandas' own strings come as chunks, which Spark's writer refuses
        keys = {k: pd.Series([v] * len(home), dtype=object) for k, v in zip(KEY, key, strict=True)}
        return pd.DataFrame(keys | {"story": pd.Series(list(home.values()), dtype="int64"), "item_id": pd.Series(list(home), dtype="int64")})

    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    found = rows.groupBy(*KEY).applyInPandas(run, f"segment {types['segment']}, window_end {types['window_end']}, story long, item_id long")
    alone = documents.join(found.select("item_id"), "item_id", "left_anti").select(*KEY, F.col("item_id").alias("story"), "item_id")
    return found.unionByName(alone)


def score(sources: Column, importance: Column, n: Column) -> Column:
    """Two a source, the importance, a tenth an item; half to even."""
    return F.bround(2 * sources + importance + n / 10, 2)


def rollup(members: DataFrame, documents: DataFrame) -> DataFrame:
    """Key, story, first and last sending, sources, items, greatest importance, score and headline: the most important title,
    then one of five words or more, then the shortest, then the least item's."""
    own = members.join(documents.drop(*KEY), "item_id")
    title = F.coalesce("title", F.lit(""))
    order = F.struct(-F.col("importance"), (F.size(tx.words(title)) < 5).cast("int"), F.length(title), F.col("item_id"))
    out = own.groupBy(*KEY, "story").agg(
        F.min("sent_date").alias("first_seen"), F.max("sent_date").alias("last_seen"), F.countDistinct("source_key").alias("source_count"), F.count("*").alias("items"),
        F.max("importance").alias("importance"), F.min_by(F.coalesce(F.nullif("title", F.lit("")), F.lit("(untitled)")), order).alias("headline"),
    )
    return out.withColumn("score", score(F.col("source_count"), F.col("importance"), F.col("items")))


def closeness(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """story, item_id and its greatest similarity within the story, to three places; 1 for an item by itself."""
    both = pairs.select("a", "b", "s").unionAll(pairs.select("b", "a", "s"))
    m = members.select("story", F.col("item_id").alias("a"))
    other = members.select(F.col("story").alias("_story"), F.col("item_id").alias("b"))
    best = m.join(both, "a").join(other, "b").where("story = _story").groupBy("a").agg(F.max("s").alias("s"))
    return m.join(best, "a", "left").select("story", F.col("a").alias("item_id"), F.bround(F.coalesce("s", F.lit(1.0)), 3).alias("similarity"))
