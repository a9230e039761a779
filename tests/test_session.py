import os
import time

from pyspark.sql import functions as F

from lakeferry.session import CLEANUP, scratch_path, scratch_root, shuffles_removed, staged, temporarily_staged
from workload import estate


def test_scratch_folder_comes_from_the_settings(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_staged_rows_are_removed_after_use(spark):
    with temporarily_staged(spark.range(5), "once") as rows:
        assert rows.count() == 5
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_staged_rows_leave_no_shuffle_files(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in n}

    def grouped():
        return spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()

    before, setting = shuffles(), spark.conf.get(CLEANUP, None)
    rows = staged(grouped(), "grouped")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before and spark.conf.get(CLEANUP, None) == setting
    assert rows.count() == 100 and sorted(rows.collect()) == sorted(grouped().collect())


def test_writers_that_overlap_put_the_setting_back(spark):
    setting, first, second = spark.conf.get(CLEANUP, None), shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP, None) == setting


def test_short_rows_are_spread_however_few_splits_a_file_makes(spark, monkeypatch):
    monkeypatch.setattr(estate, "SPREAD_ROWS", 50)
    rows = spark.range(1000, numPartitions=1)
    parts = estate.spread(rows).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 1000 and max(r["count"] for r in parts) <= 60
    assert estate.spread(rows.limit(50)).count() == 50
