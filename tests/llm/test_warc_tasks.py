"""Archives are read back by many tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from yearpanel.llm import warc
from yearpanel.sources.scratch import scratch_path

PAGES = "page_id long, url string, html string, record_type string"


def test_archives_are_read_by_several_tasks(spark):
    rows = [(k, f"http://x.example/{k}", f"<p>{k}</p> " + f"{k * 7919} " * 200, "z") for k in range(60)]
    folder = scratch_path(spark, "warc")
    plan = warc.planned(spark.createDataFrame(rows, PAGES).repartition(12))
    n = warc.write_archives(plan, folder, archive_bytes=2000).count()
    found = warc.read_archives(spark, folder).withColumn("task", F.spark_partition_id())
    tasks = found.groupBy("task").agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in tasks) == 60
    assert n >= 4 and len(tasks) > 1
