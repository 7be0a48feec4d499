"""Full history of changing attributes from dated full snapshots: gaps and islands over all snapshots.

Of several rows of one key and day the latest loaded one holds.  Within a key, a row begins an island where the hash of its
attributes differs from the row before it or where the key was absent from a snapshot in between; a running sum numbers the
islands; the first day of an island and the next snapshot without it give the validity.

Scale: rows of one key and day are reduced before the shuffle by ``max_by``, so that a key with many repeats costs one row per
snapshot; a window never holds more rows than there are snapshot days.  Only hashes travel through the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: stands for the day of a snapshot before the first one.
_BEFORE_ALL = "0001-01-01"


def attribute_hash(df: DataFrame, attributes: Sequence[str], decimals: int | None = 6, fold: bool = True) -> Column:
    """Hash of attributes in which digits beyond ``decimals`` (None: all count) and, with ``fold``, letter case and white space make no difference.

    Null is a value of its own, different from the empty text.  NaN equals NaN, -0.0 equals 0.0.
    """
    parts = []
    for name in attributes:
        kind, column = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            text = F.regexp_replace(F.lower(F.upper(column)), r"[\s\p{Z}\x{200B}\x{FEFF}]+", "") if fold else column
        elif isinstance(kind, T.DoubleType | T.FloatType | T.DecimalType):
            number = column.cast("double")
            rounded = number if decimals is None else F.round(number, decimals)
            text = F.when(F.isnan(number), F.lit("NaN")).otherwise((rounded + F.lit(0.0)).cast("string"))
        else:
            text = column.cast("string")
        parts.append(F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text)))
    return F.unhex(F.md5(F.concat_ws("\u001f", *parts)))


def snapshot_versions(
    snapshots: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    day: str,
    loaded: str,
    earlier: DataFrame | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    decimals: int | None = 6,
    fold: bool = True,
) -> DataFrame:
    """``keys, attributes, valid_from, valid_to`` (null while open): one row per version, continuing an earlier history.

    ``earlier`` holds versions from before all snapshots with the same keys and attributes and the columns ``valid_from`` and
    ``valid_to``: closed ones stay, open ones go on while the first snapshot shows them unchanged, and end there otherwise.
    A version ends on the day of the first snapshot that differs or lacks the key; a key that returns opens a new version.
    What counts as a difference is told by ``decimals`` and ``fold`` (see ``attribute_hash``).  Rows with a null key or day are left out.  Equal ``loaded`` times are settled by the attribute hash, null times count as
    earliest.  Without any snapshot the earlier history is the result.
    """
    own = [*keys, "_day"]
    rows = snapshots.dropna(subset=[*keys, day]).select(
        *keys, F.col(day).alias("_day"), F.col(loaded).alias("_loaded"), attribute_hash(snapshots, attributes, decimals, fold).alias("_hash"), F.struct(*attributes).alias("_attributes")
    )
    # The order of structs puts nulls first, as wanted.  Hash and attributes are taken apart, so that a query without attributes never
    # moves them; the spelling decides between rows that are equal otherwise.
    order = F.struct("_loaded", "_hash", F.xxhash64("_attributes"))
    held = rows.groupBy(*own).agg(F.max_by("_hash", order).alias("_hash"), F.max_by("_attributes", order).alias("_attributes")).withColumn("_since", F.lit(None).cast("date"))
    # One row per snapshot day, so few that they are broadcast: its number and the day of the next snapshot.
    listed = snapshots.where(F.col(day).isNotNull()).agg(F.array_sort(F.collect_set(F.col(day))).alias("_days"))
    before_all = F.lit(_BEFORE_ALL).cast("date")
    numbered = (
        listed.select(F.concat(F.array(before_all), "_days").alias("_days"))
        .select("_days", F.posexplode("_days").alias("_at", "_on"))
        .select("_on", "_at", F.get("_days", F.col("_at") + 1).alias("_next"))
    )
    if earlier is not None:
        before = earlier.dropna(subset=list(keys)).select(
            *keys, attribute_hash(earlier, attributes, decimals, fold).alias("_hash"), F.struct(*attributes).alias("_attributes"), F.col(valid_from).alias("_since"), F.col(valid_to).alias("_until")
        )
        closed = before.where(F.col("_until").isNotNull()).select(*keys, "_attributes.*", F.col("_since").alias(valid_from), F.col("_until").alias(valid_to))
        # An open version stands as if on a snapshot before the first one.
        going_on = before.where(F.col("_until").isNull()).select(*keys, before_all.alias("_day"), "_hash", "_attributes", "_since")
        held = held.unionByName(going_on)
    placed = held.join(F.broadcast(numbered), F.col("_day") == F.col("_on"))
    along = Window.partitionBy(*keys).orderBy("_at", "_since", "_hash")
    new = F.coalesce((F.lag("_hash").over(along) != F.col("_hash")) | (F.lag("_at").over(along) + 1 != F.col("_at")), F.lit(True))
    islands = placed.withColumn("_new", new.cast("int")).withColumn("_island", F.sum("_new").over(along))
    first = F.coalesce(F.min("_since"), F.min(F.when(F.col("_at") > 0, F.col("_day"))))
    versions = islands.groupBy(*keys, "_island").agg(
        first.alias(valid_from),
        F.max_by("_next", "_at").alias(valid_to),
        F.max_by("_attributes", "_at").alias("_attributes"),
    )
    versions = versions.select(*keys, "_attributes.*", valid_from, valid_to)
    return versions if earlier is None else versions.unionByName(closed)
