"""Source health: which senders have gone quiet against their own cadence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import rules


def quiet_sources(messages: DataFrame, segment: str = "event_type", sender: str = "user_id", sent: str = "ts", least: int = rules.QUIET_LEAST, factor: float = rules.QUIET_FACTOR, quiet_days: float = rules.QUIET_DAYS, lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """Senders of a segment whose silence up to the last message of all exceeds both `quiet_days` and `factor` times their median
    gap (the upper of two), in days, over the days looked back on. Senders with fewer than `least` messages have no cadence.

    The median is the gap whose rank the count gives: ranks and counts are windows, which spill; no list of gaps is built.
    """
    at = F.unix_micros(F.col(sent).cast("timestamp")) / 86_400e6
    m = messages.where(F.col(sent).isNotNull()).select(segment, sender, at.alias("t"))
    now = m.agg(F.max("t").alias("now"))  # one row
    m = m.crossJoin(F.broadcast(now)).where(F.col("t") >= F.col("now") - lookback_days)
    gaps = m.withColumn("gap", F.col("t") - F.lag("t").over(W.partitionBy(segment, sender).orderBy("t")))
    counted = gaps.groupBy(segment, sender).agg(F.count("*").alias("n"), (F.max("now") - F.max("t")).alias("silent")).where(F.col("n") >= least)
    counted = counted.where(F.col("silent") > quiet_days)  # only these have to be ranked
    ranked = gaps.where("gap IS NOT NULL").select(segment, sender, "gap").join(counted, [segment, sender])
    ranked = ranked.withColumn("r", F.row_number().over(W.partitionBy(segment, sender).orderBy("gap")))
    median = ranked.where(F.col("r") == F.floor((F.col("n") - 1) / 2) + 1)
    return median.where(F.col("silent") > factor * F.col("gap")).select(segment, sender, F.col("n").alias("messages"), F.round("gap", 4).alias("usual_days"), F.round("silent", 4).alias("silent_days"))
