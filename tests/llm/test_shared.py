"""Checkpoints: what a query leaves behind."""

from pyspark.sql import functions as F

from collatio.llm.shared import EXCLUDED, TIDY, durable


def test_no_stage_outlives_a_checkpoint(spark):
    before = {name: spark.conf.get(name, None) for name in (TIDY, EXCLUDED)}
    none = durable(spark.range(10).where("id < 0").selectExpr("id AS k", "id AS z"))
    many = spark.range(2_000_000).withColumn("k", F.col("id") % 50_000).groupBy("k").agg(F.count("*").alias("n"))
    # One side is known to be empty long before the other is done; the query must not end before both are.
    assert durable(many.join(none.hint("merge"), "k")).count() == 0
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert before == {name: spark.conf.get(name, None) for name in (TIDY, EXCLUDED)}
