"""Implausible readings, judged by what their own series normally shows: impossible, spiking and stuck values.

* ``impossible``: below zero, or above the largest value that is plausible for the quantity.
* ``spike``: the readings are put on a logarithmic scale, on which the noise of low and high levels is alike, and decomposed by a stationary
  Haar wavelet.  A detail of level k compares the mean of the ``2^(k-1)`` readings from an instant on with that of as many before it.  A pulse
  of ``w`` readings shows as two details of opposite sign, where it is entered and where it is left.  It is a spike where both exceed
  ``DETAIL_SIGMAS`` robust deviations of the series at every level whose support is no wider than the pulse, and where the detail across the
  whole pulse stays below ``MOST_SHIFT`` of them, so that shifts of level (one detail), episodes (small ones) and coarse steps are none.
* ``stuck``: runs of zero details of level 1, longer than chance gives a series of this length and resolution.

Robust deviations are medians of the absolute details, read from logarithmic histograms (bins of 2 %), which add up across tasks.  Over a gap
of g averaging periods the deviation is larger by the root of g, up to ``GAP_PERIODS``, as details grow with the time between readings.

Scale: a series is cut into blocks of ``BLOCK`` averaging periods, one row each; blocks take the readings around them and the lengths of runs
that reach in from one summary row per block, so that no task sees more than a block of a hot series at a time.  Each block is decomposed
once: its details are checkpointed together with their histogram, and thresholded when the deviations of the whole series are known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brezza.functions.temporal import MICROS_PER_MINUTE, epoch_micros
from brezza.operators.checkpoints import broadcast_if_small, shared_checkpoint

BLOCK = 512
#: What "a few readings" are, unless the caller says otherwise.
MAX_WIDTH = 5
DETAIL_SIGMAS = 5.0
MOST_SHIFT = 0.5
GAP_PERIODS = 24
# The logarithm is taken of the value and an offset: so much of the level, but so many of the smallest steps at least.
OFFSET_SHARE, OFFSET_STEPS = 0.25, 6.0
BIN = 1.02
LEAST_RUN = 6
_PART = 128
_MEDIAN_TO_SIGMA = 1.4826


def impossible(value: Column, largest: Column) -> Column:
    """Below zero or above ``largest`` (null: no such bound); NaN counts as impossible; null for a null value."""
    return (value < 0) | F.isnan(value) | F.coalesce(value > largest, F.lit(False))


def impossible_readings(readings: DataFrame, keys: Sequence[str], ts: str, value: str, largest: str) -> DataFrame:
    """``keys, ts, value`` of the readings that no series can show; null keys, timestamps and values are left out."""
    return readings.where(impossible(F.col(value), F.col(largest))).dropna(subset=[ts, *keys]).select(*keys, ts, value)


def levels(max_width: int) -> range:
    """Levels of the decomposition: those whose support is no wider than the widest pulse."""
    return range(1, max_width.bit_length() + 1)


def _blocks(readings: DataFrame, own: Sequence[str], max_width: int) -> DataFrame:
    """One row per series and block of ``own, us, v``: readings in order of time, those around, the reach of edge runs, offset and floor."""
    block = F.floor(F.col("us") / (F.col("period_us") * BLOCK))
    # The filter is the one that the join below infers, so that both of its sides use the same grouping.
    cut = readings.select(*own, block.alias("block"), "us", "v").where(F.col("block").isNotNull() & F.col("period_us").isNotNull())
    rows = cut.groupBy(*own, "block").agg(F.sort_array(F.collect_list(F.struct("us", "v"))).alias("r"))
    halo, reach = 3 * max_width, 2 * max_width
    n, values = F.size("r"), F.col("r")["v"]
    first, last = F.get("r", F.lit(0))["v"], F.element_at("r", -1)["v"]

    def steady(from_end: bool) -> Column:
        same = F.transform(F.reverse(values) if from_end else values, lambda v: v == (last if from_end else first))
        at = F.array_position(same, F.lit(False)).cast("int")
        return F.when(at == 0, n).otherwise(at - 1)

    moves = F.zip_with(F.slice(values, 2, F.greatest(n - 1, F.lit(1))), F.slice(values, 1, F.greatest(n - 1, F.lit(1))), lambda a, b: F.abs(a - b))
    # Only edges and lengths are ordered along a whole series; the readings of a block stay where they are.
    edges = rows.select(
        *own,
        "block",
        first.alias("first"),
        last.alias("last"),
        steady(False).alias("lead"),
        steady(True).alias("trail"),
        n.alias("n"),
        F.slice("r", 1, halo).alias("head"),
        F.slice("r", F.greatest(F.lit(1), n - halo + 1), halo).alias("tail"),
        F.get(F.sort_array(values), F.floor(n / 2).cast("int")).alias("middle"),
        F.array_min(F.filter(moves, lambda m: m > 1e-9)).alias("move"),
    )
    series = Window.partitionBy(*own)
    ahead = series.orderBy("block")
    up_to, from_here = ahead.rowsBetween(Window.unboundedPreceding, 0), ahead.rowsBetween(0, Window.unboundedFollowing)
    constant = F.col("lead") == F.col("n")
    # A chain is a block and the constant blocks of the same value next to it; its running length is what reaches further.
    edges = edges.select(
        *own,
        "block",
        *(F.col(c) for c in ("first", "last", "lead", "trail")),
        F.when(constant & (F.lag("last").over(ahead) == F.col("first")), 0).otherwise(1).alias("cut_f"),
        F.when(constant & (F.lead("first").over(ahead) == F.col("last")), 0).otherwise(1).alias("cut_b"),
        # Every block holds a reading, so that so many blocks hold all that the details at the edges need.
        F.flatten(F.collect_list("tail").over(ahead.rowsBetween(-reach, -1))).alias("before"),
        F.flatten(F.collect_list("head").over(ahead.rowsBetween(1, reach))).alias("after"),
        (F.sum(F.col("middle") * F.col("n")).over(series) / F.sum("n").over(series)).alias("level"),
        F.coalesce(F.min("move").over(series), F.lit(0.0)).alias("step"),
    )
    edges = edges.withColumn("chain_f", F.sum("cut_f").over(up_to)).withColumn("chain_b", F.sum("cut_b").over(from_here))
    edges = edges.withColumn("len_f", F.sum("trail").over(Window.partitionBy(*own, "chain_f").orderBy("block"))).withColumn(
        "len_b", F.sum("lead").over(Window.partitionBy(*own, "chain_b").orderBy("block").rowsBetween(0, Window.unboundedFollowing))
    )
    reach_f = F.when(F.lag("last").over(ahead) == F.col("first"), F.lag("len_f").over(ahead))
    reach_b = F.when(F.lead("first").over(ahead) == F.col("last"), F.lead("len_b").over(ahead))
    offset = F.greatest(F.col("level") * OFFSET_SHARE, F.col("step") * OFFSET_STEPS, F.lit(1e-9))
    neighbours = edges.select(
        *own,
        "block",
        F.slice("before", F.greatest(F.lit(1), F.size("before") - halo + 1), halo).alias("before"),
        F.slice("after", 1, halo).alias("after"),
        F.coalesce(reach_f, F.lit(0)).cast("int").alias("reach_before"),
        F.coalesce(reach_b, F.lit(0)).cast("int").alias("reach_after"),
        offset.alias("offset"),
        # No detail is told from noise that is smaller than half of one smallest step at the level of the series.
        (F.log1p(F.col("step") / (F.col("level") + offset)) / 2).alias("least_sigma"),
    )
    return rows.join(neighbours, [*own, "block"]).drop("block")


def _moved(x: np.ndarray, row: np.ndarray, by: int) -> np.ndarray:
    """x of the reading ``by`` places later in the same row, else NaN."""
    out = np.full(len(x), np.nan)
    if by == 0:
        out[:] = x
    elif abs(by) < len(x):
        here, there = (slice(None, -by), slice(by, None)) if by > 0 else (slice(-by, None), slice(None, by))
        out[here] = np.where(row[here] == row[there], x[there], np.nan)
    return out


def _haar(y: np.ndarray, row: np.ndarray, level: int) -> np.ndarray:
    """Stationary details of a level: what follows against what precedes each reading."""
    half = 1 << (level - 1)
    return sum(_moved(y, row, k) for k in range(half)) / half - sum(_moved(y, row, -k) for k in range(1, half + 1)) / half


def _stretch(t: np.ndarray, row: np.ndarray, level: int) -> np.ndarray:
    """Mean distance of the readings in the support of each detail, in averaging periods."""
    half = 1 << (level - 1)
    return (_moved(t, row, half - 1) - _moved(t, row, -half)) / (2 * half - 1)


def _rows_of(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


def _decompose(b: pa.RecordBatch, number: int) -> dict[str, pa.Array]:
    """The details of each block of a batch with their histogram, and its runs of zero details."""
    n, size = b.num_rows, []
    us, v = [], []
    for name in ("before", "r", "after"):
        column = b.column(name)
        flat = column.flatten()
        size.append(np.asarray(column.value_lengths(), dtype=np.int64))
        us.append(np.asarray(flat.field("us")))
        v.append(np.asarray(flat.field("v")))
    sizes = np.stack(size, axis=1)
    total = sizes.sum(axis=1)
    # The three parts of each row one behind the other.
    order = np.argsort(np.concatenate([_rows_of(s) * 3 + k for k, s in enumerate(size)]), kind="stable")
    us, v = np.concatenate(us)[order], np.concatenate(v)[order]
    row = _rows_of(total)
    at = np.arange(len(us)) - np.repeat(np.cumsum(total) - total, total)
    own = (at >= sizes[row, 0]) & (at < sizes[row, 0] + sizes[row, 1])
    t = us / np.asarray(b.column("period_us"), dtype=float)[row]
    y = np.log(v + np.asarray(b.column("offset"), dtype=float)[row])
    codes, details = [], []
    for level in range(1, number + 1):
        detail = _haar(y, row, level)
        details.append(detail)
        counted = own & (np.abs(detail) > 0) & (_stretch(t, row, level) < 1.01)
        bins = np.floor(np.log(np.abs(detail[counted])) / math.log(BIN)).astype(np.int64)
        codes.append((row[counted] << 32) + (level << 24) + bins + (1 << 23))
    code, count = np.unique(np.concatenate(codes), return_counts=True)
    histogram = np.bincount(code >> 32, minlength=n)
    # Runs of zero details among the block's own readings; those that reach over its edges are as long as they are in the series.
    inside = np.flatnonzero(own)
    begins = ~(details[0][inside] == 0) | (np.diff(row[inside], prepend=-1) != 0)
    run = np.cumsum(begins) - 1
    run_row = row[inside][begins]
    first, last = np.diff(run_row, prepend=-1) != 0, np.diff(run_row, append=n) != 0
    before, after = (np.asarray(b.column(c), dtype=np.int64)[run_row] for c in ("reach_before", "reach_after"))
    length = np.bincount(run, minlength=len(run_row)) + np.where(first, before, 0) + np.where(last, after, 0)
    counted = run_row[~(first & (before > 0))]
    longer = run_row[~(first & (before > 0)) & (length >= 2)]
    # Of runs, only those are passed on that may be stuck: where they begin and end in their row, and how long they are in the series.
    starts = inside[begins] - (np.cumsum(total) - total)[run_row]
    ends = starts + np.bincount(run, minlength=len(run_row))
    long = length >= LEAST_RUN
    held = np.bincount(run_row[long], minlength=n)
    return {
        "us": _lists(us, total, pa.int64()),
        "v": _lists(v, total, pa.float64()),
        "run_from": _lists(starts[long], held, pa.int32()),
        "run_to": _lists(ends[long], held, pa.int32()),
        "run_length": _lists(length[long], held, pa.int64()),
        "own_from": pa.array(sizes[:, 0], pa.int32()),
        "own_to": pa.array(sizes[:, 0] + sizes[:, 1], pa.int32()),
        **{f"d{k + 1}": _lists(d.astype(np.float32), total, pa.float32()) for k, d in enumerate(details)},
        "bins": _lists(code & ((1 << 32) - 1), histogram, pa.int64()),
        "counts": _lists(count, histogram, pa.int64()),
        "runs": pa.array(np.bincount(counted, minlength=n), pa.int64()),
        "long_runs": pa.array(np.bincount(longer, minlength=n), pa.int64()),
    }


def _longest_by_chance(runs: Column, long_runs: Column) -> Column:
    """Length that a run must reach to count as stuck."""
    repeat = F.greatest(long_runs, F.lit(1)) / F.greatest(runs, F.lit(2))
    chance = F.log(F.greatest(runs, F.lit(2)).cast("double")) / -F.log(F.least(repeat, F.lit(0.98)))
    return F.greatest(F.lit(LEAST_RUN), F.ceil(chance * 1.5 + 1.5))


def _scales(details: DataFrame, own: Sequence[str], number: int) -> DataFrame:
    """Per series: the robust deviation of each level, and the length from which a run is stuck."""
    named = details.select(*own, F.explode(F.arrays_zip("bins", "counts")).alias("_b")).select(*own, F.col("_b.bins").alias("_bin"), F.col("_b.counts").alias("_n"))
    counted = named.groupBy(*own, "_bin").agg(F.sum("_n").alias("_n")).withColumn("_level", F.shiftright("_bin", 24))
    along = Window.partitionBy(*own, "_level")
    ranked = counted.withColumn("_upto", F.sum("_n").over(along.orderBy("_bin"))).withColumn("_all", F.sum("_n").over(along))
    centre = F.pow(F.lit(BIN), F.pmod("_bin", F.lit(1 << 24)) - (1 << 23) + 0.5)
    medians = ranked.where(F.col("_upto") * 2 >= F.col("_all")).groupBy(*own).agg(*(F.min(F.when(F.col("_level") == k, centre)).alias(f"_m{k}") for k in range(1, number + 1)))
    runs = details.groupBy(*own).agg(F.sum("runs").alias("_runs"), F.sum("long_runs").alias("_long"), F.max("least_sigma").alias("_least"))
    return runs.join(medians, list(own), "left").select(
        *own,
        *(F.greatest(F.coalesce(F.col(f"_m{k}"), F.lit(0.0)) * _MEDIAN_TO_SIGMA, F.col("_least"), F.lit(1e-9)).alias(f"sigma{k}") for k in range(1, number + 1)),
        _longest_by_chance(F.col("_runs"), F.col("_long")).cast("int").alias("stuck_from"),
    )


def _pulses(d: list[np.ndarray], sigma: list[np.ndarray], row: np.ndarray, max_width: int, sigmas: float, most_shift: float) -> np.ndarray:
    """Which readings lie in a pulse that is entered and left by details beyond ``sigmas`` deviations.

    Narrower pulses come first and each detail belongs to one pulse only, so that the readings between two spikes are none.
    """
    n = len(row)
    taken, spike = np.zeros(n + 1, dtype=bool), np.zeros(n, dtype=bool)
    rise = np.concatenate([[0.0], np.cumsum(np.nan_to_num(d[0].astype(float)))])
    strength = [x / s for x, s in zip(d, sigma, strict=True)]
    for width in range(1, max_width + 1):
        enter = np.arange(1, n - width)
        enter = enter[row[enter - 1] == row[np.minimum(enter + width, n - 1)]] if len(enter) else enter
        leave = enter + width
        with np.errstate(invalid="ignore"):
            sign = np.sign(d[0][enter])
            least = np.min([np.minimum(s[enter] * sign, -s[leave] * sign) for k, s in enumerate(strength) if 1 << k <= width], axis=0) if len(enter) else np.zeros(0)
            back = np.abs(rise[leave + 1] - rise[enter]) <= most_shift * np.minimum(np.abs(d[0][enter]), np.abs(d[0][leave]))
            good = (least > sigmas) & back
        for k in sorted(np.flatnonzero(good), key=lambda k: (-least[k], enter[k])):
            if not (taken[enter[k]] or taken[leave[k]]):
                taken[enter[k]] = taken[leave[k]] = True
                spike[enter[k] : leave[k]] = True
    return spike


def flag_readings(
    readings: DataFrame, keys: Sequence[str], ts: str, value: str, largest: str, period_minutes: str, max_width: int | None = None, sigmas: float | None = None
) -> DataFrame:
    """``keys, ts, value, reason`` of each reading that cannot be true; a reading has one row per reason.

    ``largest`` null: no upper bound.  Null keys, timestamps and values are left out; a null or senseless period counts as 60
    minutes.  Readings repeated at one instant all count, in order of value.  A spike has at most ``max_width`` readings (``MAX_WIDTH``), details
    beyond ``sigmas`` deviations (``DETAIL_SIGMAS``) and readings on both sides: of the first and last ones of a series, none tells a spike from a shift of level.  Other columns are ignored.
    """
    # Read here, not in the tasks, where the module is another one.
    max_width, sigmas, most_shift, gap_periods = MAX_WIDTH if max_width is None else max_width, DETAIL_SIGMAS if sigmas is None else sigmas, MOST_SHIFT, GAP_PERIODS
    if max_width < 1:
        raise ValueError("a spike has one reading at least")
    us_to_ts = F.timestamp_micros("us").cast(readings.schema[ts].dataType)
    stated = F.col(value).isNotNull()
    for column in (ts, *keys):
        # Stated as the joins below would infer it, so that the blocks are computed once for both of their uses.
        stated = stated & F.col(column).isNotNull()
    clean = readings.where(stated).select(
        *keys,
        epoch_micros(F.col(ts)).alias("us"),
        F.col(value).cast("double").alias("v"),
        impossible(F.col(value), F.col(largest)).alias("bad"),
        (F.when(F.col(period_minutes) > 0, F.col(period_minutes)).otherwise(60).cast("bigint") * MICROS_PER_MINUTE).alias("period_us"),
    )
    bad = clean.where("bad").select(*keys, "us", "v", F.lit("impossible").alias("reason"))
    own, number = [*keys, "period_us"], len(levels(max_width))
    blocks = _blocks(clean.where("not bad"), own, max_width)
    passed = [*own, "least_sigma"]
    parts = {"us": pa.int64(), "v": pa.float64(), "run_from": pa.int32(), "run_to": pa.int32(), "run_length": pa.int64(), **{f"d{k}": pa.float32() for k in range(1, number + 1)}, "bins": pa.int64(), "counts": pa.int64()}
    spark_types = {pa.int64(): T.LongType(), pa.float64(): T.DoubleType(), pa.int32(): T.IntegerType(), pa.float32(): T.FloatType()}
    schema = T.StructType(
        [blocks.schema[c] for c in passed] + [T.StructField(c, T.ArrayType(spark_types[t])) for c, t in parts.items()] + [T.StructField(c, T.IntegerType()) for c in ("own_from", "own_to")] + [T.StructField(c, T.LongType()) for c in ("runs", "long_runs")]
    )
    order = [f.name for f in schema]

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _PART):
                b = whole.slice(begin, _PART)
                found = _decompose(b, number)
                yield pa.RecordBatch.from_arrays([found[c] if c in found else b.column(c) for c in order], order)

    details = shared_checkpoint(blocks.mapInArrow(decompose, schema))
    scales = broadcast_if_small(shared_checkpoint(_scales(details, own, number)))
    judged = details.drop("bins", "counts", "runs", "long_runs", "least_sigma").join(scales, own)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _PART):
                b = whole.slice(begin, _PART)
                total = np.asarray(b.column("us").value_lengths(), dtype=np.int64)
                row, begun = _rows_of(total), np.cumsum(total) - total
                us, v, *d = (np.asarray(b.column(c).flatten()) for c in ("us", "v", *(f"d{k}" for k in range(1, number + 1))))
                t = us / np.asarray(b.column("period_us"), dtype=float)[row]
                sigma = [
                    np.asarray(b.column(f"sigma{k}"), dtype=float)[row] * np.sqrt(np.clip(_stretch(t, row, k), 1, gap_periods)) for k in range(1, number + 1)
                ]
                # Readings around a block are judged in their own block.
                at = np.arange(len(us)) - begun[row]
                own = (at >= np.asarray(b.column("own_from"))[row]) & (at < np.asarray(b.column("own_to"))[row])
                spikes = np.flatnonzero(_pulses(d, sigma, row, max_width, sigmas, most_shift) & own)
                run_row = _rows_of(np.asarray(b.column("run_length").value_lengths(), dtype=np.int64))
                first, last, length = (np.asarray(b.column(c).flatten(), dtype=np.int64) for c in ("run_from", "run_to", "run_length"))
                long = length >= np.asarray(b.column("stuck_from"))[run_row]
                held = (last - first)[long]
                stuck = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat((begun[run_row] + first)[long], held)
                at = np.concatenate([spikes, stuck])
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(pa.array(row[at])) for c in keys), pa.array(us[at]), pa.array(v[at]), pa.array(["spike"] * len(spikes) + ["stuck"] * len(stuck), pa.string())],
                    [*keys, "us", "v", "reason"],
                )

    fields = [T.StructField("us", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("reason", T.StringType())]
    found = judged.mapInArrow(judge, T.StructType([judged.schema[c] for c in keys] + fields))
    return bad.unionByName(found).select(*keys, us_to_ts.alias(ts), F.col("v").alias(value), "reason")
