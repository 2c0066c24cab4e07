"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.session import scratch_path

#: The six ASCII white-space characters of the word rule ``[^\x20\x09-\x0D]+``.
WHITE = " \t\n\x0b\x0c\r"
#: Share of all rows from which a group counts as hot: at most HOT_PARTS groups can be that large.
HOT_PARTS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read again, so a lost
    executor costs a re-read, not the whole history of the query.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables.  Only where all that was derived from them has been staged itself."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.staged_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` in ``groups`` without a hot task.

    ``groups[size]`` is the number of ``rows`` of the key.  Keys that own more
    than 1/HOT_PARTS of all rows number fewer than HOT_PARTS, which bounds the
    broadcast; their rows never move.  All other keys are joined by a shuffle
    in which no key is large.  Both inputs are read twice: pass staged tables.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(total // HOT_PARTS, 1)
    extra = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > limit)
    few = groups.where(F.col(size) <= limit)
    fast = rows.join(F.broadcast(hot), key, "inner")
    slow = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(few, key, "inner")
    cols = [*rows.columns, *extra]
    return fast.select(*cols).unionByName(slow.select(*cols))


def without(docs: DataFrame, key: Column, gone: DataFrame, again: DataFrame) -> DataFrame:
    """``docs`` with all columns, less the rows whose ``(doc_id, key)`` is in ``gone``; of those in ``again`` one stays.

    ``gone`` and ``again`` are staged tables with ``doc_id`` and ``key``; null
    ids are matched too.  Only ``again`` rows, which repeat id and key, are grouped.
    """
    cols = docs.columns
    marks = gone.select(F.col("doc_id").alias("m_id"), F.col("key").alias("m_key"), F.lit(True).alias("m_gone")).unionByName(
        again.select(F.col("doc_id").alias("m_id"), F.col("key").alias("m_key"), F.lit(False).alias("m_gone")))
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], F.col("doc_id").alias("id"),
                        key.alias("key"))
    # Both sides grow with the corpus: a merge join at every size, so that a small run shows the plan of a large one.
    rows = inner.join(marks.hint("merge"), F.col("id").eqNullSafe(F.col("m_id")) & (F.col("key") == F.col("m_key")), "left")
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]
    kept = rows.where("m_gone IS NULL").select(*back)
    if again.isEmpty():
        return kept
    return kept.unionByName(rows.where("NOT m_gone").dropDuplicates(["id", "key"]).select(*back))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
