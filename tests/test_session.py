import os

import pytest
from pyspark.sql import functions as F

from docweave.session import FREE_SHUFFLES, materialize, scratch, shared_root


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_materialised_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    counts = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table = materialize(counts, "counts")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert sorted(r["count"] for r in table.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert counts.count() == 7  # the frame itself can be run again


def tables_of(spark, purpose):
    root = shared_root(spark).removeprefix("file://")
    return sum(name.startswith(purpose) for name in os.listdir(root)) if os.path.isdir(root) else 0


def test_scratch_tables_go_and_kept_ones_stay(spark):
    with scratch(spark):
        with scratch(spark):
            step = materialize(spark.range(5), "scratch-step")
            result = materialize(step.filter("id > 2"), "scratch-result", keep=True)
        assert tables_of(spark, "scratch-step") == 0
        materialize(result, "scratch-last")
        assert tables_of(spark, "scratch-last") == 1
    assert tables_of(spark, "scratch-last") == 0
    assert result.count() == 2
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialize(spark.range(5), "scratch-step")
        raise ZeroDivisionError
    assert tables_of(spark, "scratch-step") == 0
    materialize(spark.range(5), "scratch-outside")
    assert tables_of(spark, "scratch-outside") == 1
