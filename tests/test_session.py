"""Materialised results and the shuffle files of their jobs."""

import time

from rollspan import session


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_are_dropped_with_their_job(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 AS k").repartition("k").groupBy("k").count()
    kept = session.cut_lineage(rows, drops_shuffles=True)
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session._DROP_SHUFFLES, "false") == "false"
    assert kept.count() == 7 and rows.count() == 7
