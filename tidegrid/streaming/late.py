"""Late data as a stream: each micro-batch is upserted into a store.

The engine's own increments are batches (plans.incremental); this lets a folder of arriving files
feed the same upsert, and gives windowed means with a watermark for dashboards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidegrid.sources.store import CubeStore


def upsert_stream(stream: DataFrame, store: CubeStore, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Each batch's rows win over stored ones. Upserts can be repeated, so a retried batch does no harm."""

    def one(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store.add_data(batch)

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def windowed_means(stream: DataFrame, variable: str, window: str = "1 day", late: str = "2 days", time: str = "time") -> DataFrame:
    """Mean of a variable by window; rows later than `late` behind the newest are past."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.avg(variable).alias(variable), F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), variable, "n"
    )
