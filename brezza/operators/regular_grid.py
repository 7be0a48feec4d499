"""Irregular readings onto a regular grid of cells, with the uncovered cells marked.

Everything that arrives is brought to increments over intervals.  A cumulative counter gives, for two consecutive
readings, their difference over the time between them (after a reset: what the counter shows since it restarted at zero).
A reading that stands for its own instant is an interval of no length.  Increments are spread over the cells in
proportion to the overlap, an interval without length falling whole into the cell that holds it.  Cells that no interval
covers are marked.  Cells are numbered: cell n of length L minutes and offset O minutes covers
[n * L - O, (n + 1) * L - O) minutes after 1970-01-01 UTC.

Scale: the spread increments are summed per cell before the shuffle, so that repeated and hot sources cost no more than
their cells; uncovered cells are found per block of 512 cells and, between blocks, from one row per block.  Long intervals and
gaps are cut into blocks before they are cut into cells, so that no row holds more cells than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brezza.functions.temporal import MICROS_PER_MINUTE, epoch_micros, naive_from_micros
from brezza.operators.blocks import with_previous

BLOCK_CELLS = 512


def cell_of(us: Column, minutes: Column, offset_minutes: int) -> Column:
    """Number of the cell that holds an instant."""
    shifted, length = us + F.lit(offset_minutes * MICROS_PER_MINUTE), minutes.cast("bigint") * MICROS_PER_MINUTE
    return F.call_function("div", shifted - F.pmod(shifted, length), length)


def cell_start(cell: Column, minutes: Column, offset_minutes: int) -> Column:
    """First instant of a cell, as a naive UTC timestamp."""
    return naive_from_micros((cell * minutes.cast("bigint") - F.lit(offset_minutes)) * MICROS_PER_MINUTE)


def instant_intervals(readings: DataFrame, keys: Sequence[str], ts: str, value: Column, minutes: Column) -> DataFrame:
    """``keys, minutes, from_us, to_us, increment`` of readings that stand for their own instant.

    Rows with a null key, timestamp or cell length give nothing.
    """
    return (
        readings.where(F.col(ts).isNotNull() & (minutes > 0))
        .dropna(subset=list(keys))
        .select(*keys, minutes.cast("int").alias("minutes"), epoch_micros(F.col(ts)).alias("from_us"), epoch_micros(F.col(ts)).alias("to_us"), value.alias("increment"))
    )


def counter_intervals(readings: DataFrame, keys: Sequence[str], ts: str, counter: str, minutes: Column, max_gap_minutes: int | Column) -> DataFrame:
    """``keys, minutes, from_us, to_us, increment, is_reset`` between consecutive readings of a cumulative counter.

    Of several readings at one instant the largest holds; null readings are left out.  A reading below its predecessor is
    a reset.  Readings further apart than ``max_gap_minutes`` (of the later one) leave the time between them uncovered.
    """
    gap = F.lit(max_gap_minutes) if isinstance(max_gap_minutes, int) else max_gap_minutes
    at = (
        readings.where(F.col(ts).isNotNull() & F.col(counter).isNotNull() & (minutes > 0))
        .dropna(subset=list(keys))
        .groupBy(*keys, minutes.cast("int").alias("minutes"), epoch_micros(F.col(ts)).alias("to_us"))
        .agg(F.max(counter).cast("double").alias("reading"), F.max(gap.cast("bigint") * MICROS_PER_MINUTE).alias("gap_us"))
    )
    block = F.floor(F.col("to_us") / (F.col("minutes").cast("bigint") * MICROS_PER_MINUTE * BLOCK_CELLS))
    paired = with_previous(at, [*keys, "minutes"], "to_us", block, ["to_us", "reading"])
    reset = F.col("reading") < F.col("prev_reading")
    return paired.where((F.col("to_us") - F.col("prev_to_us")) <= F.col("gap_us")).select(
        *keys,
        "minutes",
        F.col("prev_to_us").alias("from_us"),
        "to_us",
        F.when(reset, F.col("reading")).otherwise(F.col("reading") - F.col("prev_reading")).alias("increment"),
        reset.alias("is_reset"),
    )


def spread_on_grid(intervals: DataFrame, keys: Sequence[str], offset_minutes: int = 0) -> DataFrame:
    """``keys, minutes, cell, amount, covered_minutes, intervals`` of each cell that an interval touches.

    An interval with a null increment touches nothing.  An interval that ends where a cell begins does not touch it.
    """
    length = F.col("minutes").cast("bigint") * MICROS_PER_MINUTE
    first = cell_of(F.col("from_us"), F.col("minutes"), offset_minutes)
    last = cell_of(F.greatest(F.col("from_us"), F.col("to_us") - 1), F.col("minutes"), offset_minutes)
    start = F.col("cell") * length - F.lit(offset_minutes * MICROS_PER_MINUTE)
    overlap = F.least(F.col("to_us"), start + length) - F.greatest(F.col("from_us"), start)
    duration = F.col("to_us") - F.col("from_us")
    whole = intervals.where(F.col("increment").isNotNull() & (F.col("to_us") >= F.col("from_us"))).select(*keys, "minutes", "from_us", "to_us", "increment", first.alias("_first"), last.alias("_last"))
    cut = whole.select("*", F.explode(F.sequence(_block("_first"), _block("_last"))).alias("_block"))
    return (
        cut.select(*keys, "minutes", "from_us", "to_us", "increment", F.explode(_within("_block", "_first", "_last")).alias("cell"))
        .groupBy(*keys, "minutes", "cell")
        .agg(
            F.sum(F.when(duration == 0, F.col("increment")).otherwise(F.col("increment") * overlap / duration)).alias("amount"),
            F.sum(overlap / MICROS_PER_MINUTE).alias("covered_minutes"),
            F.count(F.lit(1)).alias("intervals"),
        )
    )


def _block(cell: str) -> Column:
    return F.floor(F.col(cell) / BLOCK_CELLS)


def _within(block: str, first: str, last: str) -> Column:
    """The cells of a block from first to last."""
    start = F.col(block) * BLOCK_CELLS
    return F.sequence(F.greatest(F.col(first), start), F.least(F.col(last), start + (BLOCK_CELLS - 1)))


def uncovered_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, minutes, cell`` of each cell between the first and the last covered one of a source that is not covered."""
    own = [*keys, "minutes"]
    blocks = cells.groupBy(*own, _block("cell").alias("block")).agg(F.collect_set("cell").alias("filled"), F.min("cell").alias("first"), F.max("cell").alias("last"))
    along = Window.partitionBy(*own).orderBy("block")
    following = F.lead("block").over(along)
    # From the first cell of a source to its last, each block stands for itself and the blocks without any cell that follow it.
    start, end = F.col("block") * BLOCK_CELLS, F.col("block") * BLOCK_CELLS + (BLOCK_CELLS - 1)
    reach = blocks.select(
        *own,
        "block",
        "filled",
        F.when(F.lag("block").over(along).isNull(), F.col("first")).otherwise(start).alias("lo"),
        F.when(following.isNull(), F.col("last")).otherwise(end).alias("hi"),
        F.coalesce(following, F.col("block") + 1).alias("following"),
    )
    each = reach.select(*own, "lo", "hi", F.col("block").alias("_held"), "filled", F.explode(F.sequence("block", F.col("following") - 1)).alias("block"))
    held = F.col("block") == F.col("_held")
    missing = F.when(held, F.array_except(F.sequence("lo", "hi"), "filled")).otherwise(F.sequence(start, end))
    return each.select(*own, F.explode(missing).alias("cell"))


def regular_series(intervals: DataFrame, keys: Sequence[str], offset_minutes: int = 0) -> DataFrame:
    """``keys, slot, amount, intervals, is_empty``: one row per cell from the first to the last covered one of a source.

    An empty cell has a null amount.  An empty table gives an empty series.
    """
    cells = spread_on_grid(intervals, keys, offset_minutes)
    slot = cell_start(F.col("cell"), F.col("minutes"), offset_minutes).alias("slot")
    filled = cells.select(*keys, slot, "amount", "intervals", F.lit(False).alias("is_empty"))
    empty = uncovered_cells(cells, keys).select(
        *keys, slot, F.lit(None).cast("double").alias("amount"), F.lit(0).cast("bigint").alias("intervals"), F.lit(True).alias("is_empty")
    )
    return filled.unionByName(empty)
