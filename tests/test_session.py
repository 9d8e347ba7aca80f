"""Scratch tables and what is left of writing them."""

import time

from pyspark.sql import functions as F

from lossmill.session import cut_lineage, shuffles_dropped

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_scratch_table_leaves_no_shuffle_files(spark):
    before = shuffled_files(spark)
    frame = cut_lineage(spark.range(10_000).repartition(5, F.col("id")))
    left = shuffled_files(spark) - before
    for _ in range(50):  # they are deleted by another thread
        if not left:
            break
        time.sleep(0.1)
        left = shuffled_files(spark) - before
    assert not left and frame.count() == 10_000
    assert spark.conf.get(SETTING) == "false"


def test_writers_side_by_side_leave_the_setting_as_it_was(spark):
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            assert spark.conf.get(SETTING) == "true"
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING) == "false"
