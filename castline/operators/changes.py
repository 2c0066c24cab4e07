"""Work on what changed: snapshot differences, interval ledgers and totals kept by change.

* ``sync_changes`` (S4): a full refresh gives the rows that were inserted, changed and deleted.  Rows
  are divided by key hash; a range whose digest is the same in both snapshots is not read again.
* ``incremental_by_change`` (S13): a ledger keeps the digest of each interval's source rows, so a run
  rebuilds gaps and changed intervals only, and one that was killed goes on where it stopped.
* ``PerformanceByChange`` (A11): partial totals per content and month are replaced for the months whose
  data files changed, and only the totals of their contents are computed anew.

What comes to the driver is one row a key range, interval or data file.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.operators import maintain as mn
from castline.operators.dims import CALENDAR_END, CALENDAR_START
from castline.operators.versions import Layout, Snapshot, commit, read_files, read_table, snapshot, write_files
from castline.session import staged

col = F.col
RANGES = 64


def row_hash(columns: list[str], seed: int) -> Column:
    """A 64-bit hash of a row; which columns are NULL counts too."""
    nulls = F.concat(*[F.when(col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def digests(rows: DataFrame, group: Column, columns: list[str]) -> DataFrame:
    """``grp`` and the digest of its rows as a multiset, whatever their order: one partial aggregate."""
    first, second = row_hash(columns, 1), row_hash(columns, 2).cast("decimal(20,0)")
    return rows.groupBy(group.alias("grp")).agg(
        F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(first), F.sum(second).cast("string")).alias("digest"))


# S4 ------------------------------------------------------------------------
def sync_changes(fresh: DataFrame, path: str, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """Make ``fresh`` the table's content; returns ``change`` (inserted, changed, deleted) and the row of each difference.

    A deleted row is given as it was, the others as they are.  Rows with equal keys count once (the smallest row).
    Only key ranges whose digests differ are read for the difference, and their rows meet in one shuffle.  The
    result reads the two newest versions: use it before the table's next but one write.
    """
    spark, layout = fresh.sparkSession, Layout(buckets=ranges, keys=tuple(keys))
    base = snapshot(spark, path)
    if base is not None:
        fresh = fresh.select(*base.schema.names)
    new = Snapshot(0, fresh.schema, layout).adding(write_files(mn.first_rows(fresh, keys), path, layout))
    old = base or Snapshot(0, fresh.schema, layout)
    columns = fresh.columns
    found = {r["grp"]: r["digest"] for r in digests(read_files(spark, path, new), layout.part(), columns).collect()}
    ledger = f"{path.rstrip('/')}/digests"
    known = {}
    if base is not None:
        known = {r["grp"]: r["digest"] for r in read_table(spark, ledger).collect()}
    differ = {g for g in found.keys() | known.keys() if found.get(g) != known.get(g)}
    commit(spark, path, base, new)
    mn.full_rebuild(spark.createDataFrame(sorted(found.items()), "grp string, digest string"), ledger)

    def side(snap: Snapshot, mark: int) -> DataFrame:
        return read_files(spark, path, snap, [f for f in snap.files if f.part in differ]).withColumn("_side", F.lit(mark))

    rest = [c for c in columns if c not in keys]
    row, here = F.struct(*[col(c) for c in rest], row_hash(columns, 1).alias("_h")), col("_side") == 1
    met = side(old, 0).unionByName(side(new, 1)).groupBy(*keys).agg(
        F.first(F.when(~here, row), ignorenulls=True).alias("before"), F.first(F.when(here, row), ignorenulls=True).alias("after"))
    change = F.when(col("before").isNull(), "inserted").when(col("after").isNull(), "deleted").when(
        col("before._h") != col("after._h"), "changed")
    return met.withColumn("change", change).where("change IS NOT NULL").select(
        "change", *keys, *[F.coalesce(col("after"), col("before"))[c].alias(c) for c in rest])


# S13 -----------------------------------------------------------------------
def changed_intervals(found: dict[str, str], ledger: DataFrame | None) -> list[str]:
    """Intervals whose digest is not the one in the ledger, those that lost all rows included."""
    known = {} if ledger is None else {r["interval"]: r["digest"] for r in ledger.collect()}
    known = {k: v for k, v in known.items() if v}
    return sorted(k for k in found.keys() | known.keys() if found.get(k) != known.get(k))


def note(spark: SparkSession, ledger: str, intervals: list[str], found: dict[str, str]) -> None:
    rows = spark.createDataFrame([(k, found.get(k, "")) for k in intervals], "interval string, digest string")
    mn.upsert_table(spark, ledger, rows, ["interval"], ["digest"])


def incremental_by_change(source: DataFrame, date_col: str, build: Callable[[str, str], DataFrame], path: str,
                          partition_col: str, max_days_per_job: int = 3660) -> list[tuple[str, str]]:
    """Rebuild the months of a month-partitioned table whose source rows changed since their last build.

    The ledger beside the table has a digest of each month's source rows.  It is written after each job's
    commit: a run that dies repeats at most the job it was in.  Months that lost all their source rows lose their
    partitions.  Returns the jobs that ran.
    """
    spark, ledger = source.sparkSession, f"{path.rstrip('/')}/ledger"
    dated = source.where(col(date_col).isNotNull())
    found = {r["grp"]: r["digest"] for r in digests(dated, mn.month_of(col(date_col)), source.columns).collect()}
    stale = changed_intervals(found, read_table(spark, ledger))
    months = [mn.whole_months(f"{m}-01", f"{m}-01") for m in stale]
    jobs = mn.group_intervals(months, max_days_per_job)
    for start, end in jobs:
        mn.incremental_by_time_range(spark, build, path, partition_col, start, end, align="month", max_days_per_job=max_days_per_job)
        note(spark, ledger, [m for m in stale if start[:7] <= m <= end[:7]], found)
    return jobs


# A11 -----------------------------------------------------------------------
SUMS = ("views", "likes", "comments", "shares", "watch_time_seconds")


def month_parts(engagement: DataFrame, first: str, last: str) -> DataFrame:
    """Totals of a content in a month that add up over months: sums, first and last day, and its days as bits.

    Days outside the calendar don't count, as in the full rebuild."""
    day = col("metric_date")
    return engagement.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).groupBy("content_key", mn.month_of(day).alias("month")).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(day))).alias("days"))


def totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("content_key").agg(
        *[F.sum(c).alias(f"total_{c}") for c in SUMS], F.min("first_day").alias("first_metric_date"),
        F.max("last_day").alias("last_metric_date"), F.sum(F.bit_count("days")).cast("long").alias("days_with_metrics"))


@dataclass
class PerformanceByChange:
    """``fact_content_performance`` kept up to date from a daily engagement table (a versioned table by day)."""

    spark: SparkSession
    engagement: str
    root: str
    first: str = CALENDAR_START
    last: str = CALENDAR_END

    def refresh(self) -> list[str]:
        """Take the days whose data files changed since the last refresh; returns their months."""
        spark, root = self.spark, self.root.rstrip("/")
        snap = snapshot(spark, self.engagement)
        by_month: dict[str, list] = {}
        for f in snap.files:
            if f.part is not None:
                by_month.setdefault(f.part[:7], []).append(f)
        # Data files never change: the names of a month's files are a digest of its rows, and nothing is read for it.
        found = {m: hashlib.sha256("\n".join(sorted(f.path for f in fs)).encode()).hexdigest() for m, fs in by_month.items()}
        stale = changed_intervals(found, read_table(spark, f"{root}/ledger"))
        if not stale:
            return []
        files = [f for m in stale for f in by_month.get(m, [])]
        parts = snapshot(spark, f"{root}/parts")
        old = None if parts is None else read_files(spark, f"{root}/parts", parts, [f for f in parts.files if f.part in stale])
        fresh = month_parts(read_files(spark, self.engagement, snap, files), self.first, self.last)
        layout = Layout("month")
        fresh_files = write_files(fresh, f"{root}/parts", layout)
        base = parts or Snapshot(0, fresh.schema, layout)
        # Contents of the changed months, before and after.
        touched = read_files(spark, f"{root}/parts", Snapshot(0, fresh.schema).adding(fresh_files)).select("content_key")
        if old is not None:
            touched = touched.unionByName(old.select("content_key"))
        touched = staged(touched.distinct(), "performance-keys")
        now = commit(spark, f"{root}/parts", parts, base.keeping(lambda f: f.part not in stale).adding(fresh_files))
        again = totals(read_files(spark, f"{root}/parts", now).join(touched, "content_key", "left_semi"))
        # Contents that lost all their days stay with no days, and are left out when the table is read.
        update = touched.join(again, "content_key", "left")
        mn.upsert_table(spark, f"{root}/totals", update, ["content_key"], [c for c in update.columns if c != "content_key"], buckets=16)
        note(spark, f"{root}/ledger", stale, found)
        return stale

    def table(self, content: DataFrame) -> DataFrame:
        """The fact, with the platform of each content."""
        rows = read_table(self.spark, f"{self.root.rstrip('/')}/totals").where("days_with_metrics > 0")
        c = content.select(col("content_key").alias("c_key"), "platform_key")
        return rows.join(c, col("content_key") == col("c_key"), "left").select(
            "content_key", "platform_key", *[f"total_{s}" for s in SUMS], "first_metric_date", "last_metric_date", "days_with_metrics",
            (col("total_views").cast("double") / col("days_with_metrics").cast("double")).alias("avg_daily_views"))


def days_between(start: str, n: int) -> list[str]:
    first = dt.date.fromisoformat(start)
    return [(first + dt.timedelta(days=i)).isoformat() for i in range(n)]
