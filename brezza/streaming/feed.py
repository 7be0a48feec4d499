"""New files of a folder into a month-partitioned dataset, as a stream that takes what is there and ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brezza.schemas import Dataset
from brezza.sinks.months import WriteReport, upsert_months


def upsert_new_files(
    spark: SparkSession, folder: str, root: str, dataset: Dataset, state: str, on_report: Callable[[int, WriteReport], object] = lambda *_: None, files_per_batch: int = 1000
) -> None:
    """Upserts every Parquet file that came since the last run.

    ``state`` keeps what was read.  A batch that is repeated after a loss changes nothing, as the upsert is idempotent.
    """
    files = spark.readStream.schema(dataset.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def upsert(batch: DataFrame, number: int) -> None:
        on_report(number, upsert_months(batch, root, dataset))

    query = files.writeStream.foreachBatch(upsert).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
