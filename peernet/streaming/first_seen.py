"""The first-seen merge as a stream: new feed files are merged into the table, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from peernet.config import RunConfig
from peernet.plans.mempool import merge_first_seen
from peernet.schemas import SCHEMAS
from peernet.sources.tables import Tables


def stream_first_seen(
    spark: SparkSession, feed_path: str, tables: Tables, checkpoint: str, cfg: RunConfig
) -> StreamingQuery:
    """Process the feed files not seen yet, then stop.

    The state is the table itself, so it is bounded by the hashes and survives a restart. A batch that runs twice
    changes nothing: the merge only ever moves a first sighting back. As in the batch increment, a file counts however late it
    is, and of the table only the dates that may hold a hash of the batch are read.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_first_seen(batch, tables, cfg)

    feed = spark.readStream.schema(SCHEMAS["network_feed"]).parquet(feed_path)
    return (
        feed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
