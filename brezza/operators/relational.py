"""Reusable relational operators: precedence, latest rows, upserts, incremental scope, grids and differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.  Make the order total, or ties are settled by chance.

    Aggregates instead of ranking, so that rows of one key are reduced before the shuffle and hot keys cost nothing.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*keys, *(F.col("_best")[c].alias(c) for c in rest)).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The row of each key with the greatest ``by``; nulls in it come last; equal ones are settled by all columns."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(by), F.xxhash64(*rest))).alias("_best"))
    return best.select(*keys, *(F.col("_best")[c].alias(c) for c in rest)).select(*df.columns)


def union_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """All rows of several tables with their names as a column; columns that some lack are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(tag, F.lit(name)) for name, df in parts.items()))


def upsert_relation(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """Stored rows, replaced by incoming ones of the same key, with ``_change``: inserted, updated, unchanged or kept.

    Of several incoming rows of a key the one with the greatest ``sequence`` holds, or else the greatest by all columns.
    """
    values = [c for c in stored.columns if c not in keys]
    order = [F.col(sequence)] if sequence else []
    last = incoming.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order, *values)).alias("_new"))
    joined = stored.select(*keys, F.struct(*values).alias("_old")).join(last, list(keys), "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("updated")
    )
    row = F.coalesce("_new", "_old")
    return joined.select(*keys, *(row[c].alias(c) for c in values), change.alias("_change")).select(*stored.columns, "_change")


def incremental_scope(rows: DataFrame, loaded: DataFrame, ts: str, keys: Sequence[str], days: int, always: Column, reprocess_from: Column | None = None) -> DataFrame:
    """Rows to process again: those from ``days`` before the newest loaded one on, and ``always`` rows not yet loaded at all.

    ``reprocess_from`` reaches further back, by a day more than it says, as a local day begins on the UTC day before.  Nothing loaded
    yet means that all rows are in scope.  The newest instant is one value, brought in by a scalar subquery; the rows not yet loaded
    come by an anti join of just those that the first condition leaves.
    """
    newest = loaded.agg(F.max(ts).alias("_newest"))
    since = F.col("_newest") - F.expr(f"interval {int(days)} days")
    if reprocess_from is not None:
        since = F.least(since, reprocess_from - F.expr("interval 1 day"))
    bound = newest.select(since.alias("_since"))
    placed = rows.withColumn("_since", bound.scalar())
    fresh = placed.where(F.col("_since").isNull() | (F.col(ts) >= F.col("_since")))
    old = placed.where((F.col(ts) < F.col("_since")) & always)
    unseen = old.join(loaded.where(always).select(*keys), list(keys), "left_anti").select(*placed.columns)
    return fresh.unionByName(unseen).drop("_since")


def delete_insert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the keys of ``rows``, and ``rows``."""
    kept = target.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(rows.select(*target.columns))


def symmetric_difference(left: DataFrame, right: DataFrame, decimals: int = 6) -> DataFrame:
    """Rows of one table that the other lacks, each as often as it is missing, with ``side``; numbers rounded first."""

    def rounded(df: DataFrame) -> DataFrame:
        return df.select(*(F.round(c, decimals).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))

    a, b = rounded(left), rounded(right.select(*left.columns))
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
