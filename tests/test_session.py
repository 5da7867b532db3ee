import os

import pytest
from pyspark.sql import functions as F

from recordflow.operators.paging import paginate
from recordflow.session import scratch_path, scratch_scope, shared_dir
from recordflow.sources.tables import stage


def folders(spark):
    """Everything below the shared folder but Spark's own checkpoint root."""
    top = shared_dir(spark).removeprefix("file:")
    found = set()
    for name in os.listdir(top):
        inner = os.path.join(top, name)
        own = [os.path.join(name, x) for x in os.listdir(inner) if x.startswith("rdd-")] if os.path.isdir(inner) else []
        found |= set(own) if own or name.count("-") == 4 else {name}
    return found


def test_a_report_leaves_nothing_but_its_result(spark, rows):
    source = spark.range(500).select((F.col("id") % 7).alias("k"), "id")
    want = rows(paginate(source, [F.col("k"), F.col("id")], 50))
    target = scratch_path(spark, "result")
    before = folders(spark)
    with scratch_scope(spark):
        paginate(stage(source, "rows"), [F.col("k"), F.col("id")], 50).write.parquet(target)
    assert folders(spark) - before == {os.path.basename(target)}
    assert rows(spark.read.parquet(target)) == want


def test_kept_results_can_be_read_and_belong_to_the_outer_scope(spark):
    before = folders(spark)
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as inner:
            first = stage(spark.range(10), "first")
            kept = inner.keep(stage(first.where("id > 3"), "second"))
        assert kept.count() == 6 and outer.owned_by(kept)
        assert len(folders(spark) - before) == 1
        lazy = kept.where("id > 7")
        assert lazy.count() == 2
    assert folders(spark) == before


def test_disk_falls_stage_by_stage(spark):
    before = folders(spark)
    with scratch_scope(spark) as scope:
        now = stage(spark.range(100), "s0")
        for i in range(4):
            nxt = stage(now.withColumn("id", F.col("id") + 1), f"s{i + 1}")
            scope.free(now)
            now = nxt
            assert len(folders(spark) - before) == 1
        assert now.agg(F.min("id")).first()[0] == 4
    assert folders(spark) == before


def test_an_error_clears_up_as_well(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        stage(spark.range(3), "left")
        raise ZeroDivisionError
    assert folders(spark) == before
    free = stage(spark.range(3), "free")  # outside a scope nothing is removed
    assert len(folders(spark) - before) == 1 and free.count() == 3
