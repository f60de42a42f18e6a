"""Settings put on sessions made elsewhere."""

from starload.session import TASK_MOST, adaptive

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_partitions_are_merged_to_no_more_than_a_task_can_unpack(spark):
    session = spark.newSession()
    adaptive(session)
    assert int(session.conf.get(ADVISORY)) == TASK_MOST


def test_a_smaller_size_of_partitions_stays(spark):
    session = spark.newSession()
    session.conf.set(ADVISORY, "3m")
    adaptive(session)
    assert session.conf.get(ADVISORY) == "3m"
