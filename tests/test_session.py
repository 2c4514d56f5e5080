import re
import time

from tillwright.session import collected, stored


def _shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return set(re.findall(r"shuffle_(\d+)_", blocks.mkString(" ")))


def test_collected_takes_the_shuffles_of_the_last_job(spark):
    before = _shuffles(spark)
    rows = stored(spark.range(1_000).repartition("id"), "shuffled")
    new = _shuffles(spark) - before
    assert new
    collected(spark)
    for _ in range(50):
        if not new & _shuffles(spark):
            break
        time.sleep(0.2)
    assert not new & _shuffles(spark) and rows.count() == 1_000
