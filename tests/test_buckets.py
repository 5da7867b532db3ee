import re

import pytest
from pyspark.sql import functions as F

from recordflow import schemas
from recordflow.catalog import customers as c
from recordflow.plans.customers import merge, snapshot
from recordflow.session import scratch_path
from recordflow.sources import buckets, events


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, part=None, n=4):
    return buckets.BucketTable(spark, scratch_path(spark, "buckets"), schemas.SNAPSHOT, merge.KEYS, n, part)


@pytest.fixture
def stored(spark, inputs):
    base = table(spark)
    base.write(c.base_snapshot(inputs))
    return base


def changes(inputs):
    return merge.newest_items(merge.event_items(events.decode_payload(c.flat_events(inputs))))


def test_merge_leaves_the_snapshot_where_it_is(spark, inputs, stored, rows):
    newest = changes(inputs)
    merged = merge.merge_in_buckets(stored.read(), newest, c.RUN_DATE, stored.n)
    text = plan(merged)
    assert "Bucketed: true" in text and "FullOuter" in text
    assert not re.search(r"Exchange hashpartitioning\(bucket_key", text)
    assert "SelectedBucketsCount: 4 out of 4" in text
    whole = merge.merge_items(c.base_snapshot(inputs), newest, c.RUN_DATE)
    assert rows(merged.drop("bucket_key")) == rows(whole)
    after = table(spark)
    after.write(merged.drop("was_modified"), placed=True)
    assert rows(after.read().drop("bucket_key")) == rows(whole.drop("was_modified"))
    # one file a bucket: the rows were there already
    assert len(after.read().inputFiles()) == 4
    # a second run meets the written table without a shuffle, too
    again = merge.merge_in_buckets(after.read(), newest, c.RUN_DATE, after.n)
    assert not re.search(r"Exchange hashpartitioning\(bucket_key", plan(again))


def test_snapshot_of_buckets_shuffles_nothing(spark, inputs, stored, rows):
    deltas = table(spark, "logical_date")
    daily = c._dated_deltas(inputs)
    deltas.write_days(daily.where("logical_date < '2024-01-12'"))
    deltas.write_days(daily.where("logical_date >= '2024-01-12'"))
    now = snapshot.snapshot_in_buckets(stored.read(), deltas.read(), before="2024-01-20")
    text = plan(now)
    assert "Exchange" not in text and text.count("Bucketed: true") == 2 and "PartitionFilters: [isnotnull" in text
    want = snapshot.current_snapshot(c.base_snapshot(inputs), daily, before="2024-01-20")
    assert rows(now.select(*want.columns)) == rows(want)


def test_a_day_is_replaced_and_found_by_a_new_session(spark, rows):
    days = table(spark, "logical_date")
    empty = spark.createDataFrame([], schemas.SNAPSHOT)
    one = empty.unionByName(spark.range(20).select(F.lit("42").alias("tenant_id"), F.col("id").cast("string").alias("customer_id")), allowMissingColumns=True)
    for n, day in ((20, "2024-01-01"), (5, "2024-01-02"), (7, "2024-01-02")):
        days.write(one.limit(n).drop("logical_date"), day)
    found = days.read().groupBy(F.col("logical_date").cast("string").alias("d")).count()
    assert rows(found) == [("2024-01-01", 20), ("2024-01-02", 7)]
    spark.sql(f"DROP TABLE {days.name}")
    assert rows(days.read().groupBy(F.col("logical_date").cast("string").alias("d")).count()) == rows(found)


def test_null_keys_and_a_hot_bucket(spark, rows):
    kinds = "tenant_id string, customer_id string, v int"
    base = buckets.BucketTable(spark, scratch_path(spark, "b"), spark.createDataFrame([], kinds).schema, merge.KEYS, 4)
    data = [("a", None, 1), (None, "a", 2), (None, None, 3), ("a", "a", 4), ("null", "a", 5)]
    base.write(spark.createDataFrame(data, kinds))
    keys = base.read().groupBy(buckets.KEY).count()
    assert keys.count() == 5 and "Exchange" not in plan(keys)
    assert rows(base.read().drop(buckets.KEY)) == sorted(data, key=repr)
    base.write(spark.createDataFrame([], kinds))
    assert base.read().count() == 0
