"""Listing many folders."""

from pyspark.sql import functions as F


def test_many_folders_are_listed_by_few_tasks(spark, tmp_root):
    from credlake.sources.files import read_documents
    s = spark.range(300).select(F.concat(F.lit("n"), F.col("id")).alias("carpeta"), F.lit("{\n}").alias("value"))
    s.coalesce(1).write.partitionBy("carpeta").text(f"{tmp_root}/raw")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        docs = read_documents(spark, f"{tmp_root}/raw", pattern="*.txt")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup("listing") for i in tracker.getJobInfo(j).stageIds]
    assert stages and max(i.numTasks for i in stages) <= 256
    assert docs.count() == 300
