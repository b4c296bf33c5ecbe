"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Everything is a DataFrame expression. The text is read once for the sizes; the decision about a row needs only its
source's threshold, so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.llm import common

#: Hash buckets of one source. Only the bucket where the fractional share ends is ordered row by row.
BUCKETS = 4096
#: The plan has one row per source; above so many it is joined by shuffle.
BROADCAST_SOURCES = 50_000
SEED = 20_240_607


def _ranked(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights by rank of the source, by code point and null last; ranks come from sorted ranges, not from one task."""
    spark = sources.sparkSession
    parts = common.as_table(sources.repartitionByRange(max(1, min(64, common.partitions(spark))), F.col("source").isNull(), F.col("source")).withColumn("_part", F.spark_partition_id()), "mix-sources")
    before, starts = 0, {}
    for r in sorted(parts.groupBy("_part").count().collect()):  # at most 64 rows
        starts[r["_part"]] = before
        before += r["count"]
    start = F.coalesce(*[F.when(F.col("_part") == k, F.lit(v)) for k, v in starts.items()], F.lit(0))
    rank = start + F.row_number().over(W.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return parts.withColumn("weight", weight).drop("_part")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Adds `target` to (source, source_size, weight): shares of `total` by weight, none above max_epochs sizes.

    Each round clamps the sources above their cap and gives the rest out anew, by weight; a round is one aggregate over
    the per-source table and brings one row to the driver. The level only rises, so a clamped source stays clamped.
    """
    cap, level = F.col("source_size") * float(max_epochs), 0.0
    while True:
        held = F.col("weight") * level >= cap
        got = sources.agg(F.sum(F.when(held, cap).otherwise(0.0)).alias("full"), F.sum(F.when(held, 0.0).otherwise(F.col("weight"))).alias("open"), F.sum(held.cast("long")).alias("n")).first()
        if not got["open"]:
            break
        new = (total - got["full"]) / got["open"]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return sources.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(cap, F.col("weight") * level)))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), total_share: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> tuple[DataFrame, int]:
    """One row per source: source, source_size, target, whole (repetitions of every row), cut (rows whose seeded hash is
    below it get one more; null: none). Also the number of sources."""
    sized = common.as_table(docs.select(F.col("source"), common.word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), F.col("doc_id")).alias("u")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = common.as_table(_ranked(sources, weights), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = common.as_table(
        water_fill(ranked, total_share * total, max_epochs).withColumn("whole", F.least(F.floor(rate + 1e-9), F.lit(int(max_epochs))).cast("long")).withColumn("more", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))),
        "mix-plan",
    )
    n = plan.count()
    few = F.broadcast if n <= BROADCAST_SOURCES else (lambda x: x)
    width = (1 << 64) // BUCKETS
    bucket = F.floor((F.col("u") / F.lit(float(width)))) + BUCKETS // 2
    sums = sized.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("in_b"))
    upto = W.partitionBy("source").orderBy("b")
    sums = sums.withColumn("before", F.sum("in_b").over(upto) - F.col("in_b"))
    edge = sums.alias("s").join(few(plan.alias("p")), F.col("s.source").eqNullSafe(F.col("p.source"))).where((F.col("before") <= F.col("more")) & (F.col("before") + F.col("in_b") > F.col("more")))
    edge = common.as_table(edge.select(F.col("s.source").alias("source"), "b", "before", "more"), "mix-edges")
    rows = sized.withColumn("b", bucket).alias("r").join(few(edge.alias("e")), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.b") == F.col("e.b")))
    rows = rows.select(F.col("r.source").alias("source"), "u", "size", "before", "more")
    rows = rows.withColumn("at", F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("u", "size").rowsBetween(W.unboundedPreceding, 0)))
    # the first row whose greater half would be too much
    cut = rows.where(F.col("at") - F.col("size") / 2 > F.col("more")).groupBy("source").agg(F.min("u").alias("cut_u"))
    after = edge.select("source", ((F.col("b") + 1 - BUCKETS // 2) * F.lit(float(width))).alias("after"))
    out = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").join(after.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source")), "left")
    out = out.select(F.col("p.source").alias("source"), "source_size", "weight", "target", "whole", F.col("cut_u"), F.col("after"))
    return common.as_table(out, "mix-cuts"), n


def _decided(docs: DataFrame, **options) -> DataFrame:
    """docs with __size, __source_size, __target and __repeats."""
    seed = options.get("seed", SEED)
    plan, n = mix_plan(docs, **options)
    plan = plan.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("whole").alias("__whole"), F.col("cut_u").alias("__cut"), F.col("after").alias("__after"))
    out = docs.withColumn("__u", F.xxhash64(F.lit(seed), F.col("doc_id")))
    out = out.join(F.broadcast(plan) if n <= BROADCAST_SOURCES else plan, F.col("source").eqNullSafe(F.col("__source")))
    more = F.when(F.col("__cut").isNotNull(), F.col("__u") < F.col("__cut")).otherwise(F.coalesce(F.col("__u").cast("double") < F.col("__after"), F.lit(False)))
    out = out.withColumn("__size", common.word_count(F.col("text"))).withColumn("__repeats", (F.col("__whole") + more.cast("long")).cast("int"))
    return out.drop("__source", "__whole", "__cut", "__after", "__u")


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with size, source_size, target, repeats (how often the mix takes the row) and taken (= repeats * size).

    Options as mix_plan's. Sources by code point, null last, weigh 5, 2, 1, repeating. Rows of one source are taken in
    the order of a seeded hash of doc_id until its share is nearest; reruns agree. Null text has size 0; a null source
    is a source; rows with the same doc_id are taken alike; an empty table gives an empty one. Columns of docs with one
    of the five names are replaced, others stay.
    """
    new = ["size", "source_size", "target", "repeats"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in [*new, "taken"]])
    return _decided(docs, **options).withColumnsRenamed({f"__{c}": c for c in new}).withColumn("taken", F.col("repeats") * F.col("size"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with docs' own columns, whatever their names."""
    out = _decided(docs, **options).where("__repeats > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__repeats")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9(docs: DataFrame) -> DataFrame:
    """The columns of the query."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")
