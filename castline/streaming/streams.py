"""Structured Streaming jobs (ST1-ST4): see also ``isolation`` for ST4 as a stream.

Landed files are the stream: a file source (``readStream`` with a declared
schema) replaces the sync tool's cursor with a checkpoint, and
``trigger(availableNow=True)`` processes everything new then stops — the
incremental daily run.  Stateful keyed semantics (upsert, insert-once) run in
``foreachBatch`` on the batch operators, which are idempotent, so replaying a
micro-batch after an executor or driver failure cannot double-apply it.
Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.operators import landing as ld
from castline.operators import maintain as mn
from castline.operators import versions as vs

col = F.col


def land(df: DataFrame, path: str, drops: list) -> None:
    """Write ``df`` into ``path`` as successive file drops (one append per
    predicate in ``drops``), the way a sync lands new files over time."""
    for pred in drops:
        df.where(pred).write.mode("append").parquet(path)


def _source(spark: SparkSession, path: str, schema, files_per_batch: int | None) -> DataFrame:
    r = spark.readStream.format("parquet").schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def stream_append(spark: SparkSession, src: str, schema, sink: str, checkpoint: str,
                  files_per_batch: int | None = None) -> None:
    """ST1: append every new landed file to the sink exactly once."""
    q = (_source(spark, src, schema, files_per_batch).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()


def stream_upsert(spark: SparkSession, src: str, schema, target: str, checkpoint: str, keys: list[str],
                  update_cols: list[str], order: list[str], partition_col: str | None = None,
                  files_per_batch: int | None = None) -> None:
    """ST2: late corrections overwrite the same key; replay-safe."""
    def apply(batch: DataFrame, _epoch: int) -> None:
        mn.upsert_table(batch.sparkSession, target, batch, keys, update_cols, order, partition_col)

    q = (_source(spark, src, schema, files_per_batch).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_insert_once(spark: SparkSession, src: str, schema, target: str, checkpoint: str, keys: list[str],
                       order: list[str] | None = None, files_per_batch: int | None = None,
                       buckets: int | None = None) -> None:
    """ST3: repeated records (same key) are ignored; with ``buckets`` a
    micro-batch scans only the key buckets it touches."""
    def apply(batch: DataFrame, _epoch: int) -> None:
        mn.insert_if_absent_table(batch.sparkSession, target, batch, keys, order, buckets)

    q = (_source(spark, src, schema, files_per_batch).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_insert_once_bounded(spark: SparkSession, src: str, schema, target: str, checkpoint: str, keys: list[str],
                               event_time: str, arrival: str, delay: str, order: list[str] | None = None,
                               files_per_batch: int | None = None) -> list[dict]:
    """ST3 with bounded state: repeated records are dropped by a keyed state store, not by reading the table.

    ``event_time`` is when a record came to be and is the same in each copy of it; ``arrival`` is when this copy
    landed.  Records that arrive within ``delay`` of their event time go through
    ``dropDuplicatesWithinWatermark``: the watermark is never beyond ``arrival - delay``, so no such
    record is late, and the state of a key is kept as long as a copy of it can still arrive in time.  Older ones
    (few: a late first copy, or a copy of an old record) are inserted if absent, reading only
    the files that can hold their keys.  A key is kept until the watermark is ``delay`` beyond its event time, so state
    rows are bounded by the records of two delays and the last drops, whatever the size of the table.  Records without an event time take the second way.

    Both lanes read the same drops with checkpoints of their own; the second one runs after the first,
    so that it sees what that wrote.  Returns the progress of the first lane: rows of state, and rows
    that came too late (none, if no event time lies after its arrival).
    """
    event, landed = col(event_time).cast("timestamp_ltz"), col(arrival).cast("timestamp_ltz")
    fresh = event.isNotNull() & landed.isNotNull() & (event >= landed - F.expr(f"INTERVAL {delay}")) & (event <= landed)

    def append(batch: DataFrame, epoch: int) -> None:
        # A batch that is run again after a failure finds its rows by their keys.
        if not batch.isEmpty():
            mn.insert_if_absent_table(batch.sparkSession, target, batch, keys, order) if epoch in replayed else mn.append_table(
                batch.sparkSession, target, batch, keys)

    # Only the batch that a crash may have left half done can be written twice: the first one of this start.
    replayed = {_next_batch(spark, f"{checkpoint}/fresh")}
    once = (_source(spark, src, schema, files_per_batch).where(fresh).withColumn("_event", event).withWatermark("_event", delay)
            .dropDuplicatesWithinWatermark(keys).drop("_event"))
    q = (once.writeStream.foreachBatch(append).option("checkpointLocation", f"{checkpoint}/fresh")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    progress = [{"batch": p["batchId"], "rows": p["numInputRows"], "state_rows": s["numRowsTotal"], "late": s["numRowsDroppedByWatermark"]}
                for p in q.recentProgress for s in p["stateOperators"]]

    def insert(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            mn.insert_if_absent_table(batch.sparkSession, target, batch, keys, order)

    q = (_source(spark, src, schema, files_per_batch).where(~F.coalesce(fresh, F.lit(False))).writeStream.foreachBatch(insert)
         .option("checkpointLocation", f"{checkpoint}/old").trigger(availableNow=True).start())
    q.awaitTermination()
    return progress


def _next_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number of the first batch that a query with this checkpoint runs."""
    done = [int(n) for n in vs.Folder(spark, f"{checkpoint}/commits").names() if n.isdigit()]
    return max(done, default=-1) + 1


# ST4 --------------------------------------------------------------------------
def split_valid(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse each landed record once; malformed ones go to quarantine instead of
    failing the run (one bad record or platform never stops the others)."""
    parsed = ld.parsed(lines).withColumn("k", ld.field(col(ld.DOC), "$.k", "bigint"))
    cols = [c for c in lines.columns if c != "payload"]
    good = parsed.where("k IS NOT NULL").select(*cols, "k")
    rejected = parsed.where("k IS NULL").select(*cols, "payload")
    return good, rejected


def partial_failure_summary(lines: DataFrame) -> DataFrame:
    """Per platform: records parsed, records quarantined, metric total and
    the run status the run log records (completed if anything was parsed)."""
    is_ok = F.get_json_object("payload", "$.k").isNotNull()
    k = F.get_json_object("payload", "$.k").try_cast("bigint")
    s = lines.groupBy("platform").agg(
        F.count(F.when(is_ok, 1)).alias("records_ok"),
        F.count(F.when(~is_ok, 1)).alias("records_rejected"),
        F.sum(F.when(is_ok, k)).alias("metric_total"))
    return s.withColumn("status", F.when(col("records_ok") > 0, "completed").otherwise("failed"))
