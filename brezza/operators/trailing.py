"""Totals and means over trailing periods of days, from segment trees per entity and time shard.

The days of an entity are cut into shards of ``shard_days`` (a power of two).  Each shard holds one segment tree as
two arrays in heap order (node 1 is the root, node ``shard_days + k`` the leaf of the shard's k-th day): sums and counts.
A trailing period is a range of days, answered from O(log shard_days) nodes in each shard that it touches.
A late correction of a day changes its leaf and that leaf's ancestors, in its own shard only.
Sums are held in units of 2**20 millionths: values with up to six decimal places add up without error below 2**53 millionths,
so that neither files nor partitions nor the tree's order of addition decide how a mean at a rounding boundary comes out.

Scale: readings are summed per entity and day before the first shuffle, so that an entity with a third of all rows
costs no more than its days; a shard is one row of fixed size; along an entity only its shards are ordered, one for
every ``shard_days`` days.  Corrections of a stored forest send only the shards that they touch through Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brezza.functions.temporal import day_from_number, day_number

SHARD_DAYS = 64
PARTS = 1e6 / 2**20  # units in one: exact as a double, and below one, so that no sum overflows that would not without it


def _trees(leaf_sums: np.ndarray, leaf_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heap-ordered trees [n, 2 * width] over leaves [n, width]."""
    n, width = leaf_sums.shape
    sums, counts = np.zeros((n, 2 * width)), np.zeros((n, 2 * width), dtype=np.int64)
    sums[:, width:], counts[:, width:] = leaf_sums, leaf_counts
    half = width // 2
    while half:
        for tree in (sums, counts):
            tree[:, half : 2 * half] = tree[:, 2 * half : 4 * half : 2] + tree[:, 2 * half + 1 : 4 * half : 2]
        half //= 2
    return sums, counts


def _range_totals(
    sums: np.ndarray, counts: np.ndarray, tree: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count over the leaves first..last (inclusive; empty where last < first) of the given tree, per query."""
    width = sums.shape[1] // 2
    lo, hi = first + width, last + width + 1
    total, number = np.zeros(len(tree)), np.zeros(len(tree), dtype=np.int64)
    while (open_ := lo < hi).any():
        take = open_ & (lo & 1 == 1)
        total[take] += sums[tree[take], lo[take]]
        number[take] += counts[tree[take], lo[take]]
        lo = lo + take
        take = open_ & (hi & 1 == 1)
        hi = hi - take
        total[take] += sums[tree[take], hi[take]]
        number[take] += counts[tree[take], hi[take]]
        lo, hi = np.where(open_, lo >> 1, 0), np.where(open_, hi >> 1, 0)
    return total, number


def _list_matrix(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=dtype).reshape(-1, width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(matrix.ravel(), type=kind))


def _in_parts(value: Column) -> Column:
    """The value in units of 2**20 millionths: whole millionths for a value with up to six decimal places, others as they are."""
    scaled = value.cast("double") * PARTS
    whole = F.rint(scaled * 2**20) / 2**20
    return F.when(whole / PARTS == value, whole).otherwise(scaled)


def day_leaves(df: DataFrame, keys: Sequence[str], day: str, value: str, valid: Column) -> DataFrame:
    """One row per entity and day: ``day_no, leaf_sum, leaf_count``; the sum in units of 2**20 millionths.

    Rows with a null key or day are left out.  ``valid`` null counts as false.  A valid null value counts but adds nothing.
    """
    ok = F.coalesce(valid, F.lit(False))
    return (
        df.where(F.col(day).isNotNull())
        .dropna(subset=list(keys))
        .groupBy(*keys, day_number(F.col(day)).alias("day_no"))
        .agg(
            F.sum(F.when(ok, F.coalesce(_in_parts(F.col(value)), F.lit(0.0))).otherwise(0.0)).alias("leaf_sum"),
            F.count(F.when(ok, 1)).alias("leaf_count"),
        )
    )


def build_forest(leaves: DataFrame, keys: Sequence[str], shard_days: int = SHARD_DAYS) -> DataFrame:
    """One row per entity and shard with data: ``shard, sums, counts`` (the trees) and the first and last day of the
    shard that has a leaf (``first_no, last_no``) and of those with a count (``first_valid_no, last_valid_no``, nullable)."""
    if shard_days & (shard_days - 1) or shard_days < 2:
        raise ValueError("shard_days must be a power of two")
    counted = F.when(F.col("leaf_count") > 0, F.col("day_no"))
    grouped = leaves.groupBy(*keys, F.floor(F.col("day_no") / shard_days).cast("int").alias("shard")).agg(
        F.collect_list(F.pmod("day_no", F.lit(shard_days)).cast("int")).alias("at"),
        F.collect_list("leaf_sum").alias("s"),
        F.collect_list("leaf_count").alias("c"),
        F.min("day_no").alias("first_no"),
        F.max("day_no").alias("last_no"),
        F.min(counted).alias("first_valid_no"),
        F.max(counted).alias("last_valid_no"),
    )
    kept = [*keys, "shard", "first_no", "last_no", "first_valid_no", "last_valid_no"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sizes = b.num_rows, np.asarray(b.column("at").value_lengths())
            row, at = np.repeat(np.arange(n), sizes), np.asarray(b.column("at").flatten())
            leaf_sums, leaf_counts = np.zeros((n, shard_days)), np.zeros((n, shard_days), dtype=np.int64)
            leaf_sums[row, at], leaf_counts[row, at] = np.asarray(b.column("s").flatten()), np.asarray(b.column("c").flatten())
            sums, counts = _trees(leaf_sums, leaf_counts)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), _lists(sums, pa.float64()), _lists(counts, pa.int64())], [*kept, "sums", "counts"]
            )

    schema = T.StructType(
        [grouped.schema[c] for c in kept]
        + [T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("counts", T.ArrayType(T.LongType()))]
    )
    return grouped.mapInArrow(grow, schema)


def correct_forest(forest: DataFrame, corrections: DataFrame, keys: Sequence[str], shard_days: int = SHARD_DAYS) -> DataFrame:
    """The forest after late corrections: rows of ``keys, day_no, sum_change, count_change``.  Store the forest before (a checkpoint or a table).

    Corrections, in the values' own unit, add up by day.  Only the corrected leaves and their ancestors change, all of a batch at once; shards without a correction
    pass through as they are and never leave the JVM; a correction of a shard that does not exist yet makes it.  Days whose count falls to 0 stay
    days of the series.  The bounds follow the corrected days.
    """
    changes = (
        corrections.dropna(subset=[*keys, "day_no"])
        .groupBy(*keys, "day_no")
        .agg(F.sum(_in_parts(F.col("sum_change"))).alias("sum_change"), F.sum("count_change").alias("count_change"))
        .groupBy(*keys, F.floor(F.col("day_no") / shard_days).cast("int").alias("shard"))
        .agg(F.collect_list(F.struct(F.col("day_no").cast("bigint").alias("day"), F.col("sum_change").cast("double").alias("s"), F.col("count_change").cast("bigint").alias("c"))).alias("changes"))
    )
    own, width, columns = [*keys, "shard"], 2 * shard_days, forest.columns
    touched = changes.join(forest, own, "left").select(*forest.columns, "changes")
    untouched = forest.join(changes.select(*own), own, "left_anti").select(*forest.columns)
    bounds = ("first_no", "last_no", "first_valid_no", "last_valid_no")

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            sums, counts = _matrix_or_zeros(b.column("sums"), width, float), _matrix_or_zeros(b.column("counts"), width, np.int64)
            changed = b.column("changes")
            row = np.repeat(np.arange(n), np.asarray(changed.value_lengths(), dtype=np.int64))
            flat = changed.flatten()
            day, by_sum, by_count = np.asarray(flat.field("day")), np.nan_to_num(np.asarray(flat.field("s"))), np.asarray(flat.field("c").fill_null(0))
            node = shard_days + day % shard_days
            while len(node) and node[0]:
                np.add.at(sums, (row, node), by_sum)
                np.add.at(counts, (row, node), by_count)
                node = node >> 1
            far = np.iinfo(np.int64).max
            first, last = (np.asarray(b.column(c).cast(pa.int64()).fill_null(x)).copy() for c, x in (("first_no", far), ("last_no", -far)))
            np.minimum.at(first, row, day)
            np.maximum.at(last, row, day)
            counted = counts[:, shard_days:] > 0
            base, none = np.asarray(b.column("shard"), dtype=np.int64) * shard_days, ~counted.any(axis=1)
            found = {
                "first_no": pa.array(first), "last_no": pa.array(last),
                "first_valid_no": pa.array(base + counted.argmax(axis=1), mask=none),
                "last_valid_no": pa.array(base + shard_days - 1 - counted[:, ::-1].argmax(axis=1), mask=none),
                "sums": _lists(sums, pa.float64()), "counts": _lists(counts, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([found[c].cast(b.schema.field(c).type) if c in bounds else found.get(c, b.column(c)) for c in columns], columns)

    return untouched.unionByName(touched.mapInArrow(update, forest.schema))


def _matrix_or_zeros(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    """Rows of lists of one width; zeros for null lists."""
    out = np.zeros((len(column), width), dtype=dtype)
    there = np.asarray(column.is_valid())
    if there.any():
        out[there] = np.asarray(column.drop_null().flatten(), dtype=dtype).reshape(-1, width)
    return out


def query_forest(
    forest: DataFrame, keys: Sequence[str], periods: Sequence[int], *, valid_bounds: bool = False, empty_only: bool = False, shard_days: int = SHARD_DAYS
) -> DataFrame:
    """One row per entity, day and period length: ``day, period_days, total, mean, readings``.

    The days run from the first to the last day of the entity (with ``valid_bounds``: that has a valid reading), those
    without any reading included.  Where a period holds no valid reading, total and mean are null and readings is 0;
    ``empty_only`` keeps just these.
    """
    if not periods or min(periods) < 1:
        raise ValueError("periods must be positive")
    lead, tail = ("first_valid_no", "last_valid_no") if valid_bounds else ("first_no", "last_no")
    back = -(-(max(periods) - 1) // shard_days)
    along = Window.partitionBy(*keys).orderBy("shard")
    tree = F.struct("shard", "sums", "counts")
    # One pass over the trees: each with those that a period reaches back to, and the bounds of its entity.
    held = forest.select(
        *keys,
        "shard",
        F.min(lead).over(Window.partitionBy(*keys)).alias("lo"),
        F.max(tail).over(Window.partitionBy(*keys)).alias("hi"),
        F.lead("shard").over(along).alias("following"),
        F.collect_list(tree).over(along.rangeBetween(-back, 0)).alias("near"),
    ).where(F.col("lo").isNotNull())
    # The shards without data up to the next one follow the last one that has some.
    every = held.select(*keys, "lo", "hi", "near", F.explode(F.sequence("shard", F.greatest(F.col("shard"), F.coalesce(F.col("following"), F.col("shard") + 1) - 1))).alias("shard"))
    inside = F.col("shard").between(F.floor(F.col("lo") / shard_days), F.floor(F.col("hi") / shard_days))
    placed = every.where(inside).select(*keys, "lo", "hi", "shard", F.filter("near", lambda t: t["shard"] >= F.col("shard") - back).alias("near"))
    lengths, width = np.asarray(sorted(set(periods)), dtype=np.int64), 2 * shard_days

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                b = whole.slice(begin, 256)
                shard, lo, hi = (np.asarray(b.column(c), dtype=np.int64) for c in ("shard", "lo", "hi"))
                first, last = np.maximum(lo, shard * shard_days), np.minimum(hi, (shard + 1) * shard_days - 1)
                days = last - first + 1
                row = np.repeat(np.arange(b.num_rows), days)
                day = np.arange(days.sum()) - np.repeat(np.cumsum(days) - days, days) + first[row]
                row, day, length = np.repeat(row, len(lengths)), np.repeat(day, len(lengths)), np.tile(lengths, len(day))
                total, number = np.zeros(len(row)), np.zeros(len(row), dtype=np.int64)
                near = b.column("near")
                flat, sizes = near.flatten(), np.asarray(near.value_lengths(), dtype=np.int64)
                if len(flat):
                    at = np.asarray(flat.field("shard"), dtype=np.int64)
                    sums, counts = _list_matrix(flat.field("sums"), width, float), _list_matrix(flat.field("counts"), width, np.int64)
                    starts = np.cumsum(sizes) - sizes
                    for k in range(int(sizes.max(initial=0))):
                        has = k < sizes[row]
                        tree = np.where(has, starts[row] + k, 0)
                        base = at[tree] * shard_days
                        left = np.clip(day - length + 1 - base, 0, shard_days)
                        right = np.where(has, np.clip(day - base, -1, shard_days - 1), -1)
                        s, c = _range_totals(sums, counts, tree, left, right)
                        total += s
                        number += c
                keep = np.flatnonzero(number == 0) if empty_only else np.arange(len(row))
                row, day, length, total, number = row[keep], day[keep], length[keep], total[keep], number[keep]
                none = number == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c).take(pa.array(row)) for c in keys),
                        pa.array(day, pa.int32()),
                        pa.array(length, pa.int32()),
                        pa.array(total / PARTS, pa.float64(), mask=none),
                        pa.array(total / (PARTS * np.where(none, 1, number)), pa.float64(), mask=none),
                        pa.array(number, pa.int64()),
                    ],
                    [*keys, "day_no", "period_days", "total", "mean", "readings"],
                )

    schema = T.StructType(
        [placed.schema[c] for c in keys]
        + [
            T.StructField("day_no", T.IntegerType()),
            T.StructField("period_days", T.IntegerType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("mean", T.DoubleType()),
            T.StructField("readings", T.LongType()),
        ]
    )
    out = placed.mapInArrow(answer, schema)
    return out.select(*keys, day_from_number(F.col("day_no")).alias("day"), "period_days", "total", "mean", "readings")


def trailing_totals(
    df: DataFrame, keys: Sequence[str], day: str, value: str, valid: Column, periods: Sequence[int] = (7, 30), **options: bool
) -> DataFrame:
    """Totals and means of the valid values over trailing periods of days, for every day of each entity.

    See ``day_leaves`` for nulls, ``query_forest`` for the columns.  An empty table gives an empty result; repeated rows
    count as often as they occur; columns of the input other than those named are ignored, whatever their names.
    """
    return query_forest(build_forest(day_leaves(df, keys, day, value, valid), keys), keys, periods, **options)
