import pytest
from pyspark.sql import functions as F

from recordflow.catalog import customers as c
from recordflow.plans.customers import merge, snapshot
from recordflow.session import scratch_path
from recordflow.sources import events, tables
from recordflow.streaming import ingest, store
from recordflow import schemas
from pyspark.sql import types as T


def drain(spark, raw, out, checkpoint):
    stream = ingest.ingest_stream(ingest.read_event_stream(spark, raw))
    ingest.drain(ingest.write_event_stream(stream, out, checkpoint))


def test_restart_adds_nothing_and_new_files_are_taken(spark, inputs):
    raw, out, checkpoint = (scratch_path(spark, n) for n in ("raw", "out", "cp"))
    values = c.encoded(inputs).select("value", "event_id")
    half = values.agg(F.max("event_id")).first()[0] // 2
    values.where(F.col("event_id") <= half).select("value").write.parquet(raw)
    drain(spark, raw, out, checkpoint)
    first = events.read_events(spark, out).count()
    drain(spark, raw, out, checkpoint)
    assert events.read_events(spark, out).count() == first == half + 1
    values.where(F.col("event_id") > half).select("value").write.mode("append").parquet(raw)
    drain(spark, raw, out, checkpoint)
    streamed = events.read_events(spark, out)
    assert streamed.count() == values.count()
    batch = events.flatten_envelope(values.select("value")).select(*streamed.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


@pytest.mark.parametrize("late_first", [False, True])
def test_incremental_merge_equals_one_merge(spark, inputs, late_first):
    raw, delta_root, items, checkpoint = (scratch_path(spark, n) for n in ("raw", "delta", "items", "cp"))
    flat = events.flatten_envelope(c.encoded(inputs).select("value"))
    base = c.base_snapshot(inputs)
    schema = T.StructType([*schemas.SNAPSHOT.fields, T.StructField("batch", T.LongType())])
    day = flat.agg(F.percentile("event_timestamp", 0.5)).first()[0]
    parts = [F.col("event_timestamp") <= day, F.col("event_timestamp") > day]
    for part in reversed(parts) if late_first else parts:
        flat.where(part).write.mode("append").parquet(raw)
        stream = spark.readStream.schema(flat.schema).parquet(raw)
        ingest.drain(ingest.merge_stream(stream, lambda: base, delta_root, items, checkpoint, 8, compact_every=1))
    deltas = tables.read_if_exists(spark, delta_root, schema)
    final = snapshot.current_snapshot(base, deltas, tie=("batch",)).drop("logical_date")
    whole = merge.merge_customers(base, events.decode_payload(flat), "2024-02-01").drop("was_modified", "logical_date")
    assert sorted(map(str, final.collect())) == sorted(map(str, whole.select(*final.columns).collect()))


KINDS = "tenant_id string, customer_id string, kind string, item_type string, item int, event_timestamp long, event_key string"


def item_store(spark, root, every=2):
    schema = spark.createDataFrame([], KINDS).schema
    return store.BucketStore(spark, root, schema, merge.KEYS, merge.newest_items, 8, every)


def some_items(spark, *rows):
    return spark.createDataFrame([("42", c, "name", "", v, ts, "k") for c, v, ts in rows], KINDS)


def values(df):
    return sorted((r.customer_id, r.item) for r in merge.newest_items(df).collect())


def test_only_touched_buckets_are_read(spark):
    kept = item_store(spark, scratch_path(spark, "items"))
    for batch in range(5):
        own = kept.put(some_items(spark, *[(f"c{i}", 100 * batch + i, 10 - batch) for i in range(40)]), batch)
        if kept.due(batch):
            kept.compact(batch)
    one = some_items(spark, ("c7", 0, 0)).select(store.bucket_of(merge.KEYS, 8).alias(store.BUCKET))
    (bucket,) = store.touched_buckets(one)
    got = kept.read(5, [bucket])
    files = got.inputFiles()
    assert files and all(f"/bucket={bucket}/" in f for f in files)
    # the last compaction (batches 0 to 3) and the batch after it, nothing older
    assert {f.split("/")[-3] for f in files} == {"upto=3", "batch=4"}
    assert ("c7", 7) in values(got)
    assert len(store.touched_buckets(own)) == 8 and len(kept.paths(5, None)) == 16


def test_replayed_batches_and_purge(spark):
    kept = item_store(spark, scratch_path(spark, "items"))
    kept.put(some_items(spark, ("a", 1, 5), ("b", 1, 5)), 0)
    kept.put(some_items(spark, ("a", 2, 4), ("b", 2, 6)), 1)
    kept.compact(1)
    # batch 1 failed after its compaction and comes again: it still finds what was there before it
    kept.purge(1)
    kept.put(some_items(spark, ("a", 2, 4), ("b", 2, 6)), 1)
    assert values(kept.read(1)) == [("a", 1), ("b", 2)] and kept.last_compaction(1) == -1
    kept.compact(1)
    kept.purge(2)
    kept.put(some_items(spark, ("a", 3, 9)), 2)
    assert sorted(kept._folders(f"{kept.root}/batches")) == ["2"]
    for _ in range(2):
        kept.purge(2)
        kept.put(some_items(spark, ("a", 3, 9)), 2)
        assert values(kept.read(2)) == [("a", 3), ("b", 2)]
    # a compaction that did not finish is not used
    fs, at = kept._fs(f"{kept.root}/compacted/upto=1/_SUCCESS")
    fs.delete(at, False)
    assert kept.last_compaction(2) == -1


def test_a_hot_customer_and_null_keys(spark):
    kept = item_store(spark, scratch_path(spark, "items"), every=1)
    rows = [("hot", i, i) for i in range(500)] + [(None, 1, 1), (None, 2, 2), ("x", 1, 1)]
    for batch in range(2):
        kept.put(merge.newest_items(some_items(spark, *rows)), batch)
        kept.compact(batch)
    assert merge.newest_items(kept.read(2)).count() == 3
    assert {r.item for r in kept.read(2).collect()} == {499, 2, 1}


def test_unreadable_values_become_null_rows(spark):
    df = spark.createDataFrame([(bytearray(b"junk"),)], "value binary")
    row = events.flatten_envelope(df).first()
    assert row.customer_id is None and row.payload is None
    assert [bytes(r.value) for r in events.rejected(df).collect()] == [b"junk"]


def test_readable_and_rejected_are_all_rows(spark, inputs):
    good = c.encoded(inputs).select("value").limit(5)
    bad = spark.createDataFrame([(bytearray(b"junk"),), (bytearray(b""),), (None,)], "value binary")
    both = good.unionAll(bad)
    assert events.readable(both).count() == 5 and events.rejected(both).count() == 3
    assert events.readable(bad).count() == 0
    flat = events.flatten_envelope(good)
    assert sorted(map(str, events.readable(good).collect())) == sorted(map(str, flat.collect()))


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.read_event_stream(spark, {"kafka.bootstrap.servers": "none", "subscribe": "t"})
