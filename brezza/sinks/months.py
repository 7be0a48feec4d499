"""Time-series datasets in month partitions, upserted by key; reference data as dated snapshots; tables and views.

An upsert reads the months that the batch touches and no others, and rewrites those in which a row was inserted or changed.  The
result does not depend on the order or batching of the input, and writing the same rows again writes nothing.  Partitions are
replaced by Spark's commit protocol after all of their new files are complete.  One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza.operators.checkpoints import shared_checkpoint
from brezza.operators.relational import upsert_relation
from brezza.schemas import Dataset, check_schema

MONTH = ["year", "month"]
ROWS_PER_FILE = 2_000_000


@dataclass(frozen=True)
class WriteReport:
    partitions_written: int = 0
    rows_stored: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_dataset(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """A stored dataset with its declared columns, without those of its month partitions.

    A file that lacks a column or holds another type is an error.  A dataset that was never written is empty.
    """
    path = f"{root}/{dataset.path}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], dataset.schema)
    stored = spark.read.parquet(path)
    if "extracted_on" in dataset.schema.names:
        stored = stored.withColumn("extracted_on", F.col("extracted_on").cast("date"))
    return check_schema(stored, dataset.schema, dataset.path)


def _with_month(df: DataFrame, time: str) -> DataFrame:
    """Partition columns from the UTC month."""
    return df.withColumn("year", F.date_format(time, "yyyy")).withColumn("month", F.date_format(time, "MM"))


def upsert_months(incoming: DataFrame, root: str, dataset: Dataset, sequence: str | None = None, files_per_month: int | None = None) -> WriteReport:
    """Writes a batch; rows of equal key are replaced.  Of several in the batch the greatest by ``sequence``, else by values, holds.

    A month has a file for every ``ROWS_PER_FILE`` rows of the largest month, unless a number is given.
    """
    spark = incoming.sparkSession
    assert dataset.time is not None
    batch = shared_checkpoint(incoming)
    touched = [tuple(r) for r in _with_month(batch.select(dataset.time), dataset.time).select(*MONTH).distinct().collect()]
    if not touched:
        return WriteReport()
    # Of partition columns, whose texts are read as numbers; the filter still prunes.
    wanted = F.format_string("%04d%02d", F.col("year").cast("int"), F.col("month").cast("int")).isin([y + m for y, m in touched])
    stored = read_dataset(spark, root, dataset)
    path = f"{root}/{dataset.path}"
    if path_exists(spark, path):
        check_schema(spark.read.parquet(path), dataset.schema, dataset.path)
        stored = spark.read.parquet(path).where(wanted).select(*dataset.schema.names)
    changes = shared_checkpoint(_with_month(upsert_relation(stored, batch, dataset.key, sequence), dataset.time))
    counts = changes.groupBy(*MONTH, "_change").count().collect()
    dirty = sorted({r.year + r.month for r in counts if r["_change"] in ("inserted", "updated")})
    number = {kind: sum(r["count"] for r in counts if r["_change"] == kind) for kind in ("inserted", "updated", "unchanged", "kept")}
    if dirty:
        sizes = {kind: sum(r["count"] for r in counts if r.year + r.month == kind) for kind in dirty}
        files_per_month = files_per_month or -(-max(sizes.values()) // ROWS_PER_FILE)
        rows = changes.where(F.concat("year", "month").isin(dirty)).drop("_change")
        spread = [F.col("year"), F.col("month"), F.pmod(F.xxhash64(*dataset.key), F.lit(files_per_month))]
        (
            rows.repartition(max(1, len(dirty) * files_per_month), *spread)
            .sortWithinPartitions(*MONTH, *dataset.key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH)
            .parquet(path)
        )
    return WriteReport(len(dirty), sum(number.values()), number["inserted"], number["updated"])


def write_snapshot(rows: DataFrame, root: str, dataset: Dataset, day: date) -> int:
    """Replaces the snapshot of a day, and gives the number of its rows; other days stay as they are."""
    names = [n for n in dataset.schema.names if n != "extracted_on"]
    values = [n for n in names if n not in dataset.key]
    # Of several rows of a key the greatest holds, so that the snapshot does not depend on their order.
    snapshot = shared_checkpoint(rows.select(*names).groupBy(*dataset.key).agg(F.max(F.struct(*values)).alias("_row")).select(*dataset.key, "_row.*").select(*names))
    number = snapshot.count()
    path = f"{root}/{dataset.path}/extracted_on={day.isoformat()}"
    snapshot.repartitionByRange(max(1, -(-number // ROWS_PER_FILE)), *dataset.key).sortWithinPartitions(*dataset.key).write.mode("overwrite").parquet(path)
    return number


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Writes a table anew and reads it back; the definition must not read the table itself.  A view of its name would hide it and is dropped."""
    df.sparkSession.catalog.dropTempView(name)
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a stored table of this name; a view is none."""
    return any(t.name == name and not t.isTemporary for t in spark.catalog.listTables())


def replace_months(df: DataFrame, name: str, time: str, months: DataFrame | None = None) -> DataFrame:
    """Writes a table in partitions by the month of ``time``, all of them, or those of ``months`` (a column ``part``) in place of what they hold.

    ``df`` may read the table itself: what is written is checkpointed before.
    """
    spark = df.sparkSession
    spark.catalog.dropTempView(name)
    part = F.date_format(time, "yyyy-MM")
    if months is None or not table_exists(spark, name):
        df.withColumn("part", part).repartition("part").write.mode("overwrite").partitionBy("part").saveAsTable(name)
    else:
        fresh = shared_checkpoint(df.withColumn("part", part).join(months, "part", "left_semi").select(*df.columns, "part"))
        fresh.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    return spark.table(name).drop("part")
