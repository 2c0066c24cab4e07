"""ST4 as a stream: a platform that keeps failing is held back while the others go on.

A run takes the drops that landed since the last one, in four steps with checkpoints and keys of their own, so that each
can be run again after a failure:

1. *outcomes*: records of a drop are parsed once and counted per platform (a partial aggregate, so a
   platform with a third of all records is a few rows by then);
2. *decisions*: a keyed state with timers follows each platform's outcomes.  After ``FAILURES`` drops in
   a row without one usable record the platform is held until a timer ends, and its drops wait.  The
   first drop after that is tried: if it works, or if the timer ends without one, the waiting drops are
   released; if it fails, the platform is held again.  A platform without outcomes for ``EXPIRY_MS`` is forgotten;
3. *apply*: records of the drops that a decision lets through are written, usable ones to the metrics,
   others to the quarantine, each by its id once;
4. the run log is counted from what was written.

Only outcomes and decisions (one row a platform and drop) pass the state; records never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from castline.operators import maintain as mn
from castline.streaming.streams import split_valid

col = F.col
#: Drops in a row without a usable record after which a platform is held, for so long (event time).
FAILURES = 3
HOLD_MS = 2 * 24 * 3600 * 1000
EXPIRY_MS = 30 * 24 * 3600 * 1000

OUTCOME = "platform string, drop timestamp_ltz, ok bigint, bad bigint"
DECISION = "platform string, drop timestamp_ltz, action string, failures int"
# failures in a row, held until (ms, 0: not held), drops that wait (ms), last drop seen (ms)
STATE = "failures int, until bigint, waiting array<bigint>, last bigint"


def decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The decisions on one platform's new outcomes, or those of a timer that ended."""
    failures, until, waiting, last = state.get if state.exists else (0, 0, [], 0)
    waiting, out = list(waiting), []

    def say(drop: int, action: str) -> None:
        out.append((key[0], pd.Timestamp(drop, unit="ms"), action, failures))

    def release() -> None:
        nonlocal until, waiting
        for drop in sorted(waiting):
            say(drop, "release")
        until, waiting = 0, []

    if state.hasTimedOut:
        if not until:                       # nothing heard for long
            state.remove()
            return
        release()
        failures = FAILURES - 1             # the next drop is a trial
    else:
        rows = pd.concat(frames).sort_values("drop")
        for drop, ok in zip((rows["drop"].astype("int64") // 10 ** 6).tolist() if rows["drop"].dtype == "datetime64[ns]" else
                            rows["drop"].map(lambda t: int(t.timestamp() * 1000)).tolist(), rows["ok"].tolist(), strict=True):
            last = max(last, drop)
            if until and drop < until:
                waiting.append(drop)
                say(drop, "hold")
                continue
            failures = 0 if ok else failures + 1
            say(drop, "apply")
            if ok:
                release()
            elif failures >= FAILURES:
                until = drop + HOLD_MS
    state.update((failures, until, waiting, last))
    state.setTimeoutTimestamp(max(until or last + EXPIRY_MS, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["platform", "drop", "action", "failures"])


def outcomes_of(lines: DataFrame) -> DataFrame:
    good, rejected = split_valid(lines)
    each = good.select("platform", "drop", F.lit(1).alias("ok"), F.lit(0).alias("bad")).unionByName(
        rejected.select("platform", "drop", F.lit(0).alias("ok"), F.lit(1).alias("bad")))
    return each.groupBy("platform", "drop").agg(F.sum("ok").alias("ok"), F.sum("bad").alias("bad"))


def run_drops(spark: SparkSession, src: str, schema, root: str, files_per_batch: int | None = None) -> None:
    """Take all drops under ``src`` (``record_id, platform, drop, metric_date, payload``) that no run has taken."""
    root = root.rstrip("/")
    path = {n: f"{root}/{n}" for n in ("outcomes", "decisions", "metrics", "quarantine")}

    def stream(folder: str, of, limit: int | None) -> DataFrame:
        reader = spark.readStream.format("parquet").schema(of)
        return (reader.option("maxFilesPerTrigger", limit) if limit else reader).load(folder)

    def finish(writer, name: str) -> None:
        writer.option("checkpointLocation", f"{root}/checkpoints/{name}").trigger(availableNow=True).start().awaitTermination()

    def count(batch: DataFrame, epoch: int) -> None:
        # One folder an epoch, overwritten if the epoch is run again: a drop's outcomes are there once.
        outcomes_of(batch).select(*[f.split()[0] for f in OUTCOME.split(", ")]).coalesce(1).write.mode("overwrite").parquet(
            f"{path['outcomes']}/epoch={epoch:010d}")

    finish(stream(src, schema, files_per_batch).writeStream.foreachBatch(count), "outcomes")
    decided = (stream(f"{path['outcomes']}/*", OUTCOME, files_per_batch).withWatermark("drop", "0 seconds").groupBy("platform")
               .applyInPandasWithState(decide, DECISION, STATE, "append", GroupStateTimeout.EventTimeTimeout))
    finish(decided.writeStream.format("parquet").outputMode("append").option("path", path["decisions"]), "decisions")
    apply_decisions(spark, src, schema, root)


def through(spark: SparkSession, root: str) -> DataFrame:
    """``platform, drop`` of the drops that decisions have let through so far."""
    made = spark.read.schema(DECISION).parquet(f"{root}/decisions")
    return made.where("action <> 'hold'").select("platform", "drop").distinct()


def apply_decisions(spark: SparkSession, src: str, schema, root: str) -> None:
    """Write the records that were let through and are not written yet."""
    done = mn.read_table(spark, f"{root}/applied")
    open_ = through(spark, root)
    if done is not None:
        open_ = open_.join(done, ["platform", "drop"], "left_anti")
    open_ = spark.createDataFrame(open_.collect(), "platform string, drop timestamp_ltz")      # a row a platform and drop of this run
    lines = spark.read.schema(schema).parquet(src).join(F.broadcast(open_), ["platform", "drop"], "left_semi")
    good, rejected = split_valid(lines)
    for name, rows in (("metrics", good), ("quarantine", rejected)):
        mn.insert_if_absent_table(spark, f"{root}/{name}", rows, ["record_id"], buckets=8)
    mn.insert_if_absent_table(spark, f"{root}/applied", open_, ["platform", "drop"])


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Per platform: records written, records quarantined, metric total and the run's status."""
    good = mn.read_table(spark, f"{root}/metrics").select("platform", col("k"))
    bad = mn.read_table(spark, f"{root}/quarantine").select("platform", F.lit(None).cast("bigint").alias("k"))
    s = good.unionByName(bad).groupBy("platform").agg(
        F.count("k").alias("records_ok"), F.count(F.when(col("k").isNull(), 1)).alias("records_rejected"), F.sum("k").alias("metric_total"))
    return s.withColumn("status", F.when(col("records_ok") > 0, "completed").otherwise("failed"))
