"""Tables laid out for their joins (JN9, JN10): bucketed and sorted by the join key.

Metrics and episodes are written once in the same number of buckets of the episode, sorted by it. Every
later join or aggregate on the episode then reads matching buckets side by side: no row of the metrics
moves, and none is sorted again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from castline.session import scratch_path

#: Least buckets of the metrics and of the episodes.
BUCKETS = 16


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions, so that a bucket stays as small as a task at any size."""
    return max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None, path: str | None = None, dealt: bool = False) -> DataFrame:
    """``df`` written in buckets of ``key``, sorted by it, under the shared folder; the table read back.

    One file a bucket and task: rows are dealt out by the key first, so that a bucket is one file; rows that are
    ``dealt`` by the key into as many partitions don't move again.  A key with very many
    rows makes its bucket long; the aggregates that follow combine it as they read.
    """
    spark = df.sparkSession
    buckets = buckets or bucket_count(spark)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    ((df if dealt else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", path or scratch_path(spark, f"bucketed-{name}")).saveAsTable(table))
    return spark.table(table)
