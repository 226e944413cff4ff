"""Row numbers and running sums inside groups of any size, without a task that sees a whole group.

Rows are range-partitioned by group and order; each partition counts its part of a group, the few counts give
each part's offset, and rows are numbered inside their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelens.session import stage


def running(df: DataFrame, keys: list[str], order: list[Column], value: Column, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its group up to and with the row, as column ``out``.

    ``order`` must be total inside a group for a deterministic result; null keys are one group.
    """
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.alias(n) for o, n in zip(order, names)], value.alias("__v"))
    by = [F.col(k) for k in keys]
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stage(keyed.repartitionByRange(parts, *by, *names).withColumn("__part", F.spark_partition_id()), "ordinal")
    sums = ranged.groupBy(*keys, "__part").agg(F.sum("__v").alias("__s"))
    before = F.sum("__s").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    inner = F.sum("__v").over(Window.partitionBy(*by, "__part").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    numbered = ranged.withColumn("__inner", inner)
    on = numbered["__part"] == offsets["__p"]
    for i, k in enumerate(keys):
        on = on & numbered[k].eqNullSafe(offsets[f"__k{i}"])
    joined = numbered.join(offsets, on)
    return joined.select(*[numbered[c] for c in df.columns], (F.col("__before") + F.col("__inner")).alias(out))


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], out: str = "rn") -> DataFrame:
    """``df`` with the row's 1-based place in its group."""
    return running(df, keys, order, F.lit(1).cast("bigint"), out)
