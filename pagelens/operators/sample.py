"""Sample weights and weighted sampling with replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.constants import LEAST_SAMPLE_WEIGHT
from pagelens.operators.ordinal import running
from pagelens.session import stage

#: Weights are summed as integers in this unit, so sums are exact in any order.
UNIT = 1_000_000


def sample_weight(weight: Column) -> Column:
    """A row's weight: null weighs 1, and none less than 0.01."""
    return F.greatest(F.coalesce(weight.cast("double"), F.lit(1.0)), F.lit(LEAST_SAMPLE_WEIGHT))


def uniform(seed: int, n: Column) -> Column:
    """A number in [0, 1) from md5 of seed and ``n``: 48 bits."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), n.cast("string"))), 1, 12), 16, 10)
    return h.cast("double") / F.lit(float(1 << 48))


def weighted_sample(rows: DataFrame, key: str, weight: str, seed: int, draws: int | None = None) -> DataFrame:
    """(key, draws): how often each row is drawn in ``draws`` draws (default: as many as rows), rows never drawn left out.

    The weights' running sums cut the line into intervals and each draw falls into one.  Intervals and draws are
    met in bins of equal length, so the join is by bin with the interval as residual; an interval that spans
    several bins stands in each.  ``key`` must be unique.
    """
    spark = rows.sparkSession
    w = F.round(sample_weight(F.col(weight)) * F.lit(UNIT)).cast("bigint")
    line = stage(running(rows.select(key, w.alias("__w")), [], [F.col(key)], F.col("__w"), "__hi").select(key, (F.col("__hi") - F.col("__w")).alias("__lo"), "__hi"), "sample-line")
    stats = line.agg(F.max("__hi").alias("total"), F.count("*").alias("n")).first()
    if not stats.n:
        return line.select(key, F.lit(0).cast("bigint").alias("draws"))
    n = stats.n if draws is None else draws
    width = max(1, stats.total // max(1, stats.n))
    at = F.floor(uniform(seed, F.col("id")) * F.lit(float(stats.total))).cast("bigint")
    drawn = spark.range(n).select(at.alias("__at")).withColumn("__bin", F.floor(F.col("__at") / F.lit(width)).cast("bigint"))
    bins = F.sequence(F.floor(F.col("__lo") / F.lit(width)).cast("bigint"), F.floor((F.col("__hi") - 1) / F.lit(width)).cast("bigint"))
    placed = line.withColumn("__bin", F.explode(bins))
    return placed.join(drawn, "__bin").where("__at >= __lo AND __at < __hi").groupBy(key).agg(F.count("*").alias("draws"))
