import pytest
from pyspark.sql import functions as F

from recordflow.session import scratch_path
from recordflow.sources import loads, summaries, tables


@pytest.fixture
def folder(spark):
    return lambda name: scratch_path(spark, name)


def source(spark, path, n, files=3):
    spark.range(n).repartition(files).write.parquet(path)
    return path


def test_files_are_moved_not_copied(spark, folder):
    src, table = source(spark, folder("src"), 10), folder("table")
    names = loads._names(spark, src)
    assert loads.move_files(spark, src, table, "2024-05-01") == len(names) == 3
    assert loads._names(spark, src) == [] and loads._names(spark, f"{table}/load_batch=2024-05-01") == names
    got = loads.read_loaded(spark, table, spark.range(1).schema)
    assert got.count() == 10 and {r.load_batch for r in got.collect()} == {"2024-05-01"}


def test_replay_and_replace(spark, folder):
    table = folder("table")
    loads.move_files(spark, source(spark, folder("a"), 4), table, "b1")
    empty = folder("none")
    assert loads.move_files(spark, empty, table, "b1") == 0
    again = source(spark, folder("b"), 7)
    with pytest.raises(ValueError, match="loaded already"):
        loads.move_files(spark, again, table, "b1")
    assert len(loads._names(spark, again)) == 3
    loads.move_files(spark, again, table, "b1", replace=True)
    assert loads.read_loaded(spark, table, spark.range(1).schema).count() == 7
    assert loads.move_files(spark, folder("gone"), table, "b2") == 0
    assert loads.loaded_batches(spark, table) == ["b1", "b2"]
    assert loads.read_loaded(spark, table, spark.range(1).schema).count() == 7
    with pytest.raises(ValueError):
        loads.move_files(spark, again, table, "_x")


def test_failure_between_move_and_marker(spark, folder, monkeypatch):
    src, table, schema = source(spark, folder("src"), 9), folder("table"), spark.range(1).schema
    loads.move_files(spark, source(spark, folder("old"), 2), table, "b0")
    fs, one = loads._fs(spark, f"{src}/{loads._names(spark, src)[0]}")
    fs.mkdirs(loads._fs(spark, f"{table}/load_batch=b1")[1])
    fs.rename(one, loads._fs(spark, f"{table}/load_batch=b1/{one.getName()}")[1])
    # the attempt died here: some files are moved, no marker
    assert loads.read_loaded(spark, table, schema).count() == 2
    assert loads.move_files(spark, src, table, "b1") == 2
    assert loads.read_loaded(spark, table, schema).groupBy("load_batch").count().orderBy("load_batch").collect() == [("b0", 2), ("b1", 9)]


def measures():
    v = F.col("v")
    return {
        "n": summaries.Measure("count"),
        "known": summaries.Measure("count", v),
        "total": summaries.Measure("sum", v),
        "low": summaries.Measure("min", v),
        "high": summaries.Measure("max", v),
        "mean": summaries.Measure("avg", v),
    }


def facts(spark, n, seed=0):
    v = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 3 + seed)
    return spark.range(n).select((F.col("id") % 5).alias("k"), v.alias("v"))


def whole(spark, src):
    v = F.col("v")
    rows = spark.read.option("basePath", src).parquet(src)
    return rows.groupBy("k").agg(
        F.count("*").alias("n"), F.count(v).alias("known"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean")
    )


def test_refresh_reads_changed_partitions_only(spark, folder, rows):
    src, root = folder("src"), folder("summary")
    for day in ("d1", "d2", "d3"):
        facts(spark, 40).write.parquet(f"{src}/day={day}")

    def refresh():
        out = summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
        want = whole(spark, src)
        assert rows(out.summary.select(*want.columns)) == rows(want)
        return out.read, out.removed

    assert refresh() == (("d1", "d2", "d3"), ())
    assert refresh() == ((), ())
    facts(spark, 10, 1).write.mode("append").parquet(f"{src}/day=d2")  # a file more
    facts(spark, 10, 2).write.parquet(f"{src}/day=d4")  # a day more
    assert refresh() == (("d2", "d4"), ())
    facts(spark, 25, 5).write.mode("overwrite").parquet(f"{src}/day=d1")  # a day again
    tables.remove_path(spark, f"{src}/day=d3")
    assert refresh() == (("d1",), ("d3",))
    facts(spark, 0).write.mode("overwrite").parquet(f"{src}/day=d2")  # files without rows
    assert refresh() == (("d2",), ())


def test_old_partitions_are_not_opened(spark, folder):
    src, root = folder("src"), folder("summary")
    facts(spark, 20).write.parquet(f"{src}/day=d1")
    summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
    before = summaries.partition_files(spark, src, "day")
    facts(spark, 20).write.parquet(f"{src}/day=d2")
    seen = []
    read = type(spark.read).parquet

    def spy(self, *paths, **options):
        seen.extend(paths)
        return read(self, *paths, **options)

    type(spark.read).parquet = spy
    try:
        summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
    finally:
        type(spark.read).parquet = read
    assert f"{src}/day=d2" in seen and not any(p.startswith(f"{src}/day=d1") for p in seen)
    assert summaries.partition_files(spark, src, "day")["d1"] == before["d1"]


def test_refresh_after_a_failure(spark, folder, rows, monkeypatch):
    src, root = folder("src"), folder("summary")
    facts(spark, 20).write.parquet(f"{src}/day=d1")
    summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
    facts(spark, 30, 4).write.parquet(f"{src}/day=d2")
    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(summaries, "remove_path", fail)
    tables.remove_path(spark, f"{src}/day=d1")
    with pytest.raises(OSError):
        summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
    monkeypatch.undo()
    out = summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures())
    want = whole(spark, src)
    assert out.read == ("d2",) and rows(out.summary.select(*want.columns)) == rows(want)
    tables.remove_path(spark, f"{src}/day=d2")
    assert summaries.refresh_by_partition(spark, src, root, "day", ["k"], measures()).summary.count() == 0
