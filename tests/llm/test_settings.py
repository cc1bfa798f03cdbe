"""Queries leave the session's settings as they find them."""

from streakline.llm.queries import op7_decontaminate, op10_warc
from streakline.llm.tables import BATCH, short_batches

SF = "/root/testdata/sf0.001"


def test_settings_are_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with short_batches(spark):
        assert spark.conf.get(key) == BATCH[key]
    assert spark.conf.get(key) == before
    spark.conf.set(key, "777")
    try:
        assert op10_warc(spark, SF).count() and op7_decontaminate(spark, SF).count()
        assert spark.conf.get(key) == "777"
    finally:
        spark.conf.set(key, before)
