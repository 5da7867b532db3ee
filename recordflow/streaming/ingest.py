"""Event streams: stateless decode and partitioned append, restartable from a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recordflow.plans.customers.merge import KEYS, event_items, merge_items, newest_items
from recordflow.sources.events import EVENT_PARTITIONS, decode_payload, readable, rejected
from recordflow.streaming.store import BUCKET, BucketStore, touched_buckets

RAW = T.StructType([T.StructField("value", T.BinaryType())])


def read_event_stream(
    spark: SparkSession, source: str | dict, schema: T.StructType = RAW, max_files: int = 1000
) -> DataFrame:
    """A directory of Parquet files, or Kafka when ``source`` is a dict of Kafka options.

    Kafka needs the external connector. Both start from the earliest data; the checkpoint of
    the sink decides what a restart still has to read. ``max_files`` bounds a micro-batch.
    """
    if isinstance(source, dict):
        return spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", **source}).load()
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)


def ingest_stream(raw: DataFrame, value: str = "value", codec: str = "json") -> DataFrame:
    """Decode and flatten what can be read; a map over rows, so it holds no state."""
    return readable(raw, value, codec)


def reject_stream(raw: DataFrame, value: str = "value", codec: str = "json") -> DataFrame:
    """The raw rows that ``ingest_stream`` leaves out, for an output of their own."""
    return rejected(raw, value, codec)


def write_event_stream(
    df: DataFrame, path: str, checkpoint: str, parts: Sequence[str] = EVENT_PARTITIONS, fmt: str = "parquet"
) -> StreamingQuery:
    """Exactly-once append. Takes what is available, then stops; start again to continue."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    if parts:
        writer = writer.partitionBy(*parts)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a stream to finish; an error in the stream is raised here.

    Without a ``timeout`` the wait has no limit. With one, a longer stream is stopped.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")


def merge_stream(
    events: DataFrame,
    base: Callable[[], DataFrame],
    delta_root: str,
    item_root: str,
    checkpoint: str,
    buckets: int = 64,
    compact_every: int = 16,
) -> StreamingQuery:
    """Fold each micro-batch onto the snapshot and write the modified customers as a delta.

    ``item_root`` keeps the newest items with their event times, in buckets by customer (see
    ``streaming.store``), and is compacted every ``compact_every`` batches. A customer's state is the
    base and the newest of all its items, so an event that arrives late never replaces a newer one,
    in whatever order batches come. A batch is read once, and of the items only the buckets of its
    customers. ``base()`` is read anew for every batch; a base laid out by ``write_bucketed_folders`` with
    as many buckets is read by bucket as well. Deltas are dated by the newest event of their batch; read them
    with ``current_snapshot(..., tie=("batch",))``. All outputs are written by overwrite of the batch's own
    folder, so a batch that is replayed after a failure replaces them.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        items = event_items(decode_payload(batch)).withColumn("_day", F.timestamp_millis("event_timestamp").cast("date"))
        day = Observation("batch")
        fresh = newest_items(items.observe(day, F.max("_day").alias("day"), F.count(F.lit(1)).alias("rows")))
        store = BucketStore(spark, item_root, fresh.schema, KEYS, newest_items, buckets, compact_every)
        store.purge(batch_id)
        own = store.put(fresh, batch_id)
        seen = day.get
        if seen["rows"]:
            touched = touched_buckets(own)
            ids = own.select(*KEYS).distinct()

            def of_batch(frame: DataFrame) -> DataFrame:
                named = ids.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
                return frame.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS], "left_semi")

            rows = base()
            if BUCKET in rows.columns:
                rows = rows.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            state = newest_items(of_batch(store.read(batch_id, touched)))
            merged = merge_items(of_batch(rows), state, str(seen["day"])).drop("was_modified")
            merged.withColumn("batch", F.lit(batch_id).cast("bigint")).write.option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch").mode("overwrite").parquet(delta_root)
        if store.due(batch_id):
            store.compact(batch_id)

    return (
        events.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
