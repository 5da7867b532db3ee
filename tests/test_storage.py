import pytest
from pyspark.sql import functions as F

from recordflow import schemas
from recordflow.session import cut_lineage, scratch_path, shared_dir
from recordflow.sources import events, tables


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


def test_missing_folder_reads_empty(spark, path):
    df = tables.read_if_exists(spark, path, schemas.SNAPSHOT)
    assert df.count() == 0 and df.schema == schemas.SNAPSHOT


def test_truncate_keeps_the_schema(spark, path):
    spark.range(3).write.parquet(path)
    tables.truncate_with_schema(spark, path, spark.range(1).schema)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id"]
    assert tables.read_if_exists(spark, path, spark.range(1).schema).count() == 0


def test_dated_write_replaces_one_day(spark, path, rows):
    tables.write_dated(spark.range(2), path, "2025-04-01")
    tables.write_dated(spark.range(5), path, "2025-04-02")
    tables.write_dated(spark.range(1), path, "2025-04-01")
    got = tables.read_table(spark, path).groupBy(F.col("logical_date").cast("string").alias("d")).count()
    assert rows(got) == [("2025-04-01", 1), ("2025-04-02", 5)]


def test_load_is_idempotent_per_batch(spark, path):
    source = scratch_path(spark, "source")
    spark.range(4).write.parquet(source)
    for batch in ("b1", "b2", "b2"):
        tables.load_files(spark, source, path, batch)
    assert spark.read.parquet(path).count() == 8
    tables.load_files(spark, source, path, "b3", overwrite=True)
    assert spark.read.parquet(path).count() == 4


def test_partition_values_keep_their_types(spark, path):
    df = spark.createDataFrame([("007", "2025-04-01", 1)], "p string, d string, v int").withColumn("d", F.col("d").cast("date"))
    tables.write_partitioned(df, path, ["p", "d"])
    back = tables.read_table(spark, path, df.schema)
    assert back.first().p == "007" and dict(back.dtypes)["d"] == "date"


def test_event_slices_prune_folders(spark, path):
    df = spark.range(100).select(
        F.lit("42").alias("tenant_id"),
        (F.col("id") % 4).cast("string").alias("partition_id"),
        F.concat(F.col("id") % 4, F.lit("_"), "id").alias("customer_id"),
        F.col("id").alias("event_timestamp"),
        F.when(F.col("id") < 50, F.lit("2025-04-02")).otherwise("2025-04-03").cast("date").alias("logical_date"),
        F.lit("NAME").alias("event_type"),
        F.lit("x").cast("binary").alias("payload"),
    )
    tables.write_partitioned(df, path, events.EVENT_PARTITIONS)
    slice_ = events.read_events(spark, path, "42", "2025-04-03")
    assert slice_.count() == 50
    text = slice_._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in text
    assert events.read_events(spark, path, "43").count() == 0


def test_text_extract_per_tenant(spark, path):
    df = spark.createDataFrame([("a", "1|x"), ("b", "1|y"), ("a", "2|z")], "tenant_id string, line string")
    tables.write_text_extract(df, path, single_file=True)
    assert sorted(r.value for r in spark.read.text(f"{path}/tenant_id=a").collect()) == ["1|x", "2|z"]


def test_inspect_and_ctas(spark):
    schema, count, head = tables.inspect(spark.range(20), [F.col("id").desc()], 3)
    assert "id:bigint" in schema and count == 20 and [r.id for r in head.collect()] == [19, 18, 17]
    tables.ctas(spark.range(3), "staged_three")
    assert spark.table("staged_three").count() == 3
    tables.ctas(spark.range(4), "kept_four", persistent=True)
    assert tables.table_or_none(spark, "kept_four").count() == 4
    assert tables.table_or_none(spark, "absent_table") is None


def test_copy_columns(spark):
    assert tables.copy_columns(spark.range(1), ["id"]).columns == ["id", "x_id"]


def test_lineage_is_cut_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(10).repartition(3))
    assert df.count() == 10
    assert spark.sparkContext.getCheckpointDir() is not None
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
