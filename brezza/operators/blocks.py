"""Order-dependent operators over series of any length, cut into blocks of time.

A window over a whole series puts a hot series into one task.  These helpers work per (series, block) and carry what is
needed across the cut by one summary row per block, so that only summaries are ever ordered over a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: Sequence[str], order: str, block: Column, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Adds the named columns of the preceding row of the same series, as ``prefix + name`` (null for the first row).

    ``block`` must be monotone in ``order``.  Rows equal in ``order`` are told apart by nothing: make it unique first.
    """
    cut = df.withColumn("_block", block)
    carried = F.struct(*columns)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    along = Window.partitionBy(*keys).orderBy("_block")
    ends = cut.groupBy(*keys, "_block").agg(F.max_by(carried, order).alias("_end")).select(*keys, "_block", F.lag("_end").over(along).alias("_carry"))
    lagged = cut.withColumn("_lag", F.lag(carried).over(inside))
    previous = F.coalesce(F.col("_lag"), F.col("_carry"))
    joined = lagged.join(ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_block").alias("_kb"), "_carry"), _matches(keys), "left")
    return joined.select(*df.columns, *(previous[c].alias(prefix + c) for c in columns))


def _matches(keys: Sequence[str]) -> Column:
    condition = F.col("_block") == F.col("_kb")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return condition
