"""Table maintenance (S4-S15): syncs, keyed upserts, insert-if-absent, run
log, incremental time-range rebuilds, full rebuilds, look-back windows.

Plain Parquet has no MERGE, so an upsert is expressed as relational algebra over
unique keys.  A batch whose staged files are small is broadcast: the target is
read map-side and not shuffled.  A larger one is unioned with the target and
dealt once by the key; in a written table by partition and key hash, so that the merged
rows are written where they are.  Keys match null-safely on all ways, so a replayed
batch changes nothing whatever its keys hold.

Written tables are versioned lists of files that never change
(:mod:`castline.operators.versions`): a writer adds files and then one list, so a job that
dies at any point loses nothing and can be run again, on any file system.  An upsert
rewrites only the files that hold a key of the batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from castline.operators.versions import (KEY_HASH, Folder, Layout, Snapshot, commit, files_for, files_with, read_files, read_table,
                                         snapshot, write_files)
from castline.session import scratch_path

col = F.col

# Batches at or under this size, by their staged files, are broadcast into the upsert joins.
BROADCAST_BATCH_BYTES = 32 << 20
# A larger batch with a key of more rows than this, or with more than REPEATS rows a key, is collapsed before it is merged.
HOT_KEY_ROWS = 100_000
REPEATS = 3

# Looks at a written candidate and raises if it must not be published.  One with a method ``watch`` has observed
# its rows while they were written.
Check = Callable[[DataFrame], None]


# S6 ------------------------------------------------------------------------
def dedupe_latest(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``groupBy + max_by`` aggregates partially on the map side, so a key with
    millions of versions is reduced per partition before the shuffle instead
    of being buffered in one task (as a window over the key would be).
    ``order`` should be a total order (add tie-breakers)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = F.max_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order]))
    return df.groupBy(*keys).agg(picked.alias("_r")).select(*keys, *[col(f"_r.{c}").alias(c) for c in rest])


# S7-S10 --------------------------------------------------------------------
def collapse_batch(batch: DataFrame, keys: list[str], update_cols: list[str], order: list[str]) -> DataFrame:
    """A batch with repeated keys as the sequence of ``ON CONFLICT`` upserts
    would leave it: updated columns from the latest row, the other columns
    (``created_at``, ids) from the first row that inserted the key.  Both
    picks are partial aggregates in one ``groupBy``.  Ties of ``order`` are broken
    by all other columns, so that the same rows always give the same result."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.dropDuplicates(keys)
    kept = [c for c in rest if c not in update_cols]
    ranked = [c for c in rest if c not in order and not isinstance(batch.schema[c].dataType, (MapType, VariantType))]
    o = F.struct(*[col(c) for c in [*order, *ranked]])
    aggs = [F.max_by(F.struct(*[col(c) for c in rest]), o).alias("_last")]
    if kept:
        aggs.append(F.min_by(F.struct(*[col(c) for c in kept]), o).alias("_first"))
    return batch.groupBy(*keys).agg(*aggs).select(
        *keys, *[col(f"_first.{c}" if c in kept else f"_last.{c}").alias(c) for c in rest])



def plan_bytes(df: DataFrame) -> int:
    """Size by the optimizer's statistics (file sizes for a table that was read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def upsert(target: DataFrame, batch: DataFrame, keys: Iterable[str], update_cols: Iterable[str],
           order: Iterable[str] | None = None, broadcast_bytes: int | None = None) -> DataFrame:
    """Insert-or-update ``batch`` into ``target`` on ``keys``.

    Matched rows take ``update_cols`` from the batch and keep every other
    column (e.g. ``created_at``, the surrogate ``id``) from the target; new keys
    take all columns from the batch.  Duplicate keys inside the batch behave
    like the sequence of ``ON CONFLICT`` statements (see
    :func:`collapse_batch`) in the given order, or without one in that of all
    columns.  NULL matches NULL in a key.  Rows of the target that share a key are
    each updated.  The size of the batch decides the plan, not the result.  Idempotent:
    upsert(upsert(t, b), b) == upsert(t, b).
    """
    keys, update_cols = list(keys), list(update_cols)
    b = collapse_batch(batch.select(*target.columns), keys, update_cols, list(order or []))
    return merge(target, b, keys, update_cols, broadcast_bytes)


def merge(target: DataFrame, b: DataFrame, keys: list[str], update_cols: list[str], broadcast_bytes: int | None = None) -> DataFrame:
    """:func:`upsert` of a batch that has each key once."""
    if broadcast_bytes is not None and plan_bytes(b) <= broadcast_bytes:
        return _upsert_broadcast(target, b, keys, update_cols)
    return _upsert_one_shuffle(target, b, keys, update_cols)


def _same_key(keys: list[str], mark: str):
    cond = F.lit(True)
    for k in keys:
        cond = cond & col(k).eqNullSafe(col(f"{mark}{k}"))
    return cond


def _upsert_broadcast(target: DataFrame, b: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Small (checked) batch.  The target streams past the broadcast batch and
    takes its updates; a second map-side pass finds which batch keys it has, and
    only batch rows without one (fewer than the batch) are added."""
    cols = target.columns
    new = b.select(*[col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_hit"))
    updated = target.join(F.broadcast(new), _same_key(keys, "_b_"), "left").select(
        *[F.when(col("_hit"), col(f"_b_{c}")).otherwise(col(c)).alias(c) if c in update_cols else col(c) for c in cols])
    marks = b.select(*[col(k).alias(f"_m_{k}") for k in keys])
    present = target.join(F.broadcast(marks), _same_key(keys, "_m_"), "left_semi").select(
        *[col(k).alias(f"_p_{k}") for k in keys])       # keys are unique: at most the batch's rows
    added = b.join(F.broadcast(present), _same_key(keys, "_p_"), "left_anti")
    return updated.unionByName(added.select(*cols))


def _upsert_one_shuffle(target: DataFrame, b: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Large batch: one outer join on the key, one shuffle of each row (keys are unique, so no skew).

    Rows with a NULL in the key can only match each other and are joined null-safely by themselves; all
    others by plain equality, so that inputs that are already dealt by the key are not shuffled again.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & col(k).isNotNull()
    return _outer_merge(target.where(whole), b.where(whole), keys, update_cols, Column.__eq__).unionByName(
        _outer_merge(target.where(~whole), b.where(~whole), keys, update_cols, Column.eqNullSafe))


def _outer_merge(target: DataFrame, b: DataFrame, keys: list[str], update_cols: list[str],
                 same: Callable[[Column, Column], Column]) -> DataFrame:
    cols = target.columns
    t = target.select(*[col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_old"))
    new = b.select(*[col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_hit"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & same(col(f"_t_{k}"), col(f"_b_{k}"))
    both = t.join(new, cond, "full_outer")
    return both.select(*[(F.when(col("_hit"), col(f"_b_{c}")).otherwise(col(f"_t_{c}")) if c in update_cols
                          else F.when(col("_old"), col(f"_t_{c}")).otherwise(col(f"_b_{c}"))).alias(c) for c in cols])


def _upsert_by_range(target: DataFrame, batch: DataFrame, keys: list[str], update_cols: list[str], order: list[str],
                     layout: Layout) -> DataFrame:
    """Large batch of a written table: :func:`collapse_batch` and the merge in one shuffle of each row.

    Both sides are dealt by ranges of partition value and key hash, in which a writer needs them anyway.  The rows of
    a key then lie side by side, those of the target first and the batch's in their order.
    """
    rest = [c for c in target.columns if c not in keys]
    ranked = [c for c in rest if c not in order and not isinstance(target.schema[c].dataType, (MapType, VariantType))]
    helpers = layout.helpers()
    rows = target.withColumn("_sent", F.lit(False)).unionByName(batch.withColumn("_sent", F.lit(True))).withColumns(helpers)
    # The hash leads the sort: it tells most keys apart by itself.
    own = Window.partitionBy(KEY_HASH, *keys, *[h for h in helpers if h != KEY_HASH]).orderBy("_sent", *[col(c) for c in [*order, *ranked]])
    last = F.last(F.struct("_sent", *update_cols)).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # A key that the target does not have is inserted by its first row.
    seen = rows.repartitionByRange(*helpers).withColumns({"_last": last, "_nth": F.row_number().over(own)}).where("NOT _sent OR _nth = 1")
    return seen.select(*[F.when(col("_last._sent"), col(f"_last.{c}")).otherwise(col(c)).alias(c) if c in update_cols else col(c)
                         for c in target.columns])


def _crowded(batch: DataFrame, keys: list[str]) -> bool:
    """Whether a batch holds a hot key or many rows a key, which are better reduced where they lie before any shuffle.

    One pass over the key columns; its estimates decide the plan, not the result."""
    seen = batch.select(F.xxhash64(*keys).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("k").alias("kinds"), F.expr("approx_top_k(k, 1)").alias("top")).first()
    return seen["n"] > REPEATS * seen["kinds"] or any(t["count"] > HOT_KEY_ROWS for t in seen["top"])


# S11 -----------------------------------------------------------------------
def first_rows(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest ``order`` tuple (first arrival), ties and rows without an
    order by all other columns, via a partially aggregated ``min_by``."""
    rest, order = [c for c in df.columns if c not in keys], list(order or [])
    if not rest:
        return df.dropDuplicates(keys)
    ranked = [c for c in rest if c not in order and not isinstance(df.schema[c].dataType, (MapType, VariantType))]
    first = F.min_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in [*order, *ranked]]))
    return df.groupBy(*keys).agg(first.alias("_r")).select(*keys, *[col(f"_r.{c}").alias(c) for c in rest])



def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Iterable[str],
                     order: Iterable[str] | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT DO NOTHING``: existing keys are never modified;
    within the batch the first row per key (smallest ``order``) is kept."""
    keys = list(keys)
    b = first_rows(batch.select(*target.columns), keys, order)
    return target.unionByName(_absent(target, b, keys))


def _absent(target: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    t_keys = target.select(*[col(k).alias(f"_t_{k}") for k in keys])
    return b.join(t_keys, _same_key(keys, "_t_"), "left_anti").select(*target.columns)


# S12 -----------------------------------------------------------------------
RUN_STATUSES = ("running", "completed", "failed")


def run_log(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert run rows, then apply status / count updates by run id."""
    return upsert(runs, updates, ["id"],
                  ["run_completed_at", "status", "episodes_processed", "metrics_collected", "error_message"])


# S15 -----------------------------------------------------------------------
def lookback_window(df: DataFrame, date_col: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows with ``date_col`` in [as_of − days, as_of]."""
    a = F.lit(as_of).cast("date")
    return df.where(col(date_col).cast("date").between(F.date_sub(a, days), a))


# S13 -----------------------------------------------------------------------
def whole_months(start: str, end: str) -> tuple[str, str]:
    """[start, end] widened to the months it touches."""
    last = (dt.date.fromisoformat(end).replace(day=1) + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    return dt.date.fromisoformat(start).replace(day=1).isoformat(), last.isoformat()


def plan_intervals(start: str, end: str, batch_days: int = 30, align: str | None = None) -> list[tuple[str, str]]:
    """[start, end] split into inclusive day ranges of ``batch_days``, or into
    whole calendar months (``align="month"``) for month-partitioned tables: a
    range that begins or ends inside a month is widened, as a batch replaces
    whole partitions."""
    if align == "month":
        start, end = whole_months(start, end)
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    out = []
    while s <= e:
        if align == "month":
            nxt = (s.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
            stop = nxt - dt.timedelta(days=1)
        else:
            stop = min(s + dt.timedelta(days=batch_days - 1), e)
        out.append((s.isoformat(), stop.isoformat()))
        s = stop + dt.timedelta(days=1)
    return out


def month_of(c) -> "Column":  # noqa: F821
    """Partition value of a month-partitioned table: ``yyyy-MM``."""
    return F.date_format(c, "yyyy-MM")


def range_of(dates: DataFrame, date_col: str) -> tuple[str, str] | None:
    """First and last day of the data, or None without any (one aggregate)."""
    d = col(date_col).cast("date")
    first, last = dates.agg(F.min(d), F.max(d)).first()
    return None if first is None else (first.isoformat(), last.isoformat())


def intervals_with_data(dates: DataFrame, date_col: str, start: str, end: str,
                        batch_days: int = 30, align: str | None = None) -> list[tuple[str, str]]:
    """The planned intervals that contain at least one source date.

    One aggregate returns the distinct batch ids present (at most one per
    interval of the range — a bounded result), so empty batches are skipped
    without running them."""
    if align == "month":
        start, end = whole_months(start, end)
    base = dt.date.fromisoformat(start)
    d = col(date_col).cast("date")
    if align == "month":
        idx = month_of(d)
    else:
        idx = F.floor(F.datediff(d, F.lit(start).cast("date")) / batch_days).cast("int")
    present = {r[0] for r in dates.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
               .select(idx.alias("b")).distinct().collect()}
    out = []
    for s, e in plan_intervals(start, end, batch_days, align):
        key = s[:7] if align == "month" else (dt.date.fromisoformat(s) - base).days // batch_days
        if key in present:
            out.append((s, e))
    return out


def group_intervals(intervals: list[tuple[str, str]], max_days: int) -> list[tuple[str, str]]:
    """Merge adjacent planned batches into jobs of at most ``max_days`` days.

    Batches stay the unit of planning (and of a daily incremental run), but a
    backfill of many adjacent batches runs as a few large jobs instead of one
    full source scan per 30 days."""
    jobs: list[tuple[str, str]] = []
    for s, e in intervals:
        if jobs:
            js, je = jobs[-1]
            adjacent = dt.date.fromisoformat(je) + dt.timedelta(days=1) == dt.date.fromisoformat(s)
            span = (dt.date.fromisoformat(e) - dt.date.fromisoformat(js)).days + 1
            if adjacent and span <= max_days:
                jobs[-1] = (js, e)
                continue
        jobs.append((s, e))
    return jobs


def incremental_by_time_range(spark: SparkSession, build: Callable[[str, str], DataFrame], path: str,
                              partition_col: str, start: str, end: str, batch_days: int = 30,
                              intervals: list[tuple[str, str]] | None = None,
                              max_days_per_job: int = 3660, align: str | None = None,
                              check: Check | None = None, spread: str | None = "rebalance") -> list[tuple[str, str]]:
    """Recompute [start, end] in 30-day batches and replace exactly those days.

    After the run, the table's partitions in the range are exactly the
    recomputed output.  Each job writes its rows as new files and commits them as the next
    version of the table, without the files that its range had before: partitions
    that it did not produce go.  Batches of the range that were not run because no source row falls into
    them lose their partitions too.  ``align="month"`` works on whole months.
    Re-running a batch, after a failure or for late data, gives the same table.
    A range without rows on a new table leaves an empty table.
    ``check`` sees each job's written output; if it raises, the range stays as it was.  ``spread`` is that of
    :func:`write_files`: None for rows that ``build`` has dealt by the partition column."""
    if align == "month":
        start, end = whole_months(start, end)
    planned = intervals if intervals is not None else plan_intervals(start, end, batch_days, align)
    cut = (lambda d: d[:7]) if align == "month" else (lambda d: d)
    done, made, df = [], set(), None
    for s, e in group_intervals(planned, max_days_per_job):
        df = build(s, e)
        made |= _replace_range(spark, df, path, partition_col, cut(s), cut(e), check, spread)
        done.append((s, e))
    base = snapshot(spark, path)
    if base is None:
        # Nothing in the whole range: an empty table with the output's schema.
        commit(spark, path, None, Snapshot(0, build(start, end).schema, Layout(partition_col)))
        return done
    lo, hi = cut(start), cut(end)
    left = base.keeping(lambda f: f.part in made or not _within(f.part, lo, hi))
    if left.files != base.files:
        commit(spark, path, base, left)
    return done


def _within(part: str | None, lo: str, hi: str) -> bool:
    return part is not None and lo <= part <= hi


def _checked(df: DataFrame, check: Check | None, written: str) -> None:
    """Show a written candidate to ``check``; a candidate that fails is dropped."""
    if check is None:
        return
    try:
        check(df)
    except Exception:
        Folder(df.sparkSession, written).drop()
        raise


def _replace_range(spark: SparkSession, df: DataFrame, path: str, partition_col: str, lo: str, hi: str,
                   check: Check | None, spread: str | None) -> set[str | None]:
    """Commit ``df`` as the content of the partitions in [lo, hi]; returns the partitions it made."""
    base = snapshot(spark, path)
    layout = Layout(partition_col)
    if base is not None:
        df = df.select(*base.schema.names)
    old = base or Snapshot(0, df.schema, layout)
    files = write_files(df, path, layout, spread, watch=getattr(check, "watch", None))
    if files:
        _checked(read_files(spark, path, Snapshot(0, old.schema).adding(files)), check, f"{path}/data/{files[0].token}")
    if base is not None or files:
        commit(spark, path, base, old.keeping(lambda f: not _within(f.part, lo, hi)).adding(files))
    return {f.part for f in files}


# S4 / S14 ------------------------------------------------------------------
def full_rebuild(df: DataFrame, path: str, partition_by: Iterable[str] = (), check: Check | None = None,
                 spread: str | None = "rebalance") -> str:
    """Replace the table with a freshly computed version (kind FULL).

    ``check`` sees the written candidate; if it raises, the table stays as it was.  ``spread`` is that of
    :func:`write_files`: None for rows that already lie together by partition value."""
    spark, partition_by = df.sparkSession, list(partition_by)
    if len(partition_by) > 1:
        raise ValueError("a table is divided by one column")
    layout = Layout(*partition_by)
    base = snapshot(spark, path) if Folder(spark, f"{path}/versions").exists() else None
    files = write_files(df, path, layout, spread, watch=getattr(check, "watch", None))
    new = Snapshot(0, df.schema, layout).adding(files)
    if files:
        _checked(read_files(spark, path, new), check, f"{path}/data/{files[0].token}")
    commit(spark, path, base, new)
    return path


sync_overwrite = full_rebuild


# S5 ------------------------------------------------------------------------
def sync_append_cursor(source: DataFrame, target_path: str, cursor: str, keys: Iterable[str]) -> None:
    """Append source rows at or beyond the last loaded cursor that are not loaded yet.

    The cursor is a day, and rows of the last day may arrive after it was read:
    the source is read again from that day on, and rows whose ``keys`` the table
    has for those days are left out.  The last cursor is one aggregate over the
    target; nothing else leaves the cluster."""
    keys, spark = list(keys), source.sparkSession
    base = snapshot(spark, target_path)
    if base is None:
        base = Snapshot(0, source.schema, Layout(keys=tuple(keys)))
        new = first_rows(source, keys)
    else:
        target = read_files(spark, target_path, base)
        last = target.agg(F.max(cursor)).first()[0]
        since = F.lit(True) if last is None else col(cursor) >= F.lit(last)
        new = _absent(target.where(since), first_rows(source.where(since).select(*target.columns), keys), keys)
    files = write_files(new, target_path, base.layout)
    if files or not base.version:
        commit(spark, target_path, base, base.adding(files))


# Writers ---------------------------------------------------------------------
def _layout(base: Snapshot | None, keys: list[str], partition_col: str | None, buckets: int | None) -> Layout:
    """The table's own layout, or that of its first write."""
    wanted = Layout(None if buckets else partition_col, buckets, tuple(keys))
    if base is None or not base.version:
        return wanted
    own = base.layout
    if own.keys and (own.keys, own.buckets) != (wanted.keys, wanted.buckets):
        raise ValueError(f"the table is laid out by {own}, not by {wanted}")
    return Layout(own.column or wanted.column, own.buckets, own.keys or wanted.keys)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], update_cols: list[str],
                 order: list[str] | None = None, partition_col: str | None = None,
                 broadcast_bytes: int | None = BROADCAST_BATCH_BYTES, buckets: int | None = None) -> str:
    """Upsert into a written table: copy on write by data file.

    The list of files tells which can hold a key of the batch (partition value and
    range of key hashes).  For a batch of checked small size the key columns of those are read, and only
    files that do hold one are rewritten; rows with new keys go to files of their own.  A
    larger batch rewrites all files that its keys' ranges meet, in one shuffle.  All other files are
    neither read nor written.  The partition column must be one of the keys, or
    the key's bucket (``buckets``): then a key can't leave another version of its row in
    a partition that the batch does not touch.  Replaying a batch gives the same rows, and
    an empty first batch an empty table.
    """
    if not buckets and partition_col and partition_col not in keys:
        raise ValueError(f"{partition_col} is not part of the key {keys}: a key could move between partitions")
    base = snapshot(spark, path)
    layout = _layout(base, keys, partition_col, buckets)
    order, b = list(order or []), batch if base is None else batch.select(*base.schema.names)
    if base is None or not base.files:
        b = collapse_batch(b, keys, update_cols, order)
        schema = base.schema if base else b.schema
        commit(spark, path, base, Snapshot(0, schema, layout).adding(write_files(b, path, layout, "range")))
        return path
    stage = scratch_path(spark, "upsert-batch")
    b = _written(b, f"{stage}/rows")                 # its files give the size, and are read several times
    base = replace(base, layout=layout)
    hit = files_for(base, b)
    small = broadcast_bytes is not None and plan_bytes(b) <= broadcast_bytes
    if small or _crowded(b, keys):
        b = _written(collapse_batch(b, keys, update_cols, order), f"{stage}/keys")
        small = broadcast_bytes is not None and plan_bytes(b) <= broadcast_bytes
    if small:
        hit = files_with(spark, path, base, hit, keys, b)
        merged = _upsert_broadcast(read_files(spark, path, base, hit), b, keys, update_cols)
    else:
        merged = _upsert_by_range(read_files(spark, path, base, hit), b, keys, update_cols, order, layout)
    files = write_files(merged, path, layout, None)
    if files:
        commit(spark, path, base, base.keeping(lambda f: f not in hit).adding(files))
    Folder(spark, stage).drop()
    return path


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_if_absent_table(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                           order: list[str] | None = None, buckets: int | None = None) -> str:
    """Append only the batch rows whose key is absent from the table
    (existing rows are never rewritten: one anti-join, one append).  Only files whose
    partition and key range allow them to hold a key of the batch are scanned.  An empty first batch gives
    an empty table."""
    base = snapshot(spark, path)
    layout = _layout(base, keys, None, buckets)
    b = first_rows(batch if base is None else batch.select(*base.schema.names), keys, order)
    if base is None or not base.files:
        schema = base.schema if base else b.schema
        commit(spark, path, base, Snapshot(0, schema, layout).adding(write_files(b, path, layout, "range")))
        return path
    stage = scratch_path(spark, "insert-batch")
    b.write.mode("overwrite").parquet(stage)
    b = spark.read.schema(b.schema).parquet(stage)
    base = replace(base, layout=layout)
    new = _absent(read_files(spark, path, base, files_for(base, b)), b, keys)
    files = write_files(new, path, layout)
    if files:
        commit(spark, path, base, base.adding(files))
    Folder(spark, stage).drop()
    return path


def append_table(spark: SparkSession, path: str, batch: DataFrame, keys: list[str]) -> str:
    """Add rows that are known to be new (no key is looked up)."""
    base = snapshot(spark, path)
    layout = _layout(base, keys, None, None)
    if base is not None:
        batch = batch.select(*base.schema.names)
    files = write_files(batch, path, layout)
    if files or base is None:
        commit(spark, path, base, (base or Snapshot(0, batch.schema, layout)).adding(files))
    return path


def compact_table(spark: SparkSession, path: str, most: int = 8) -> int:
    """Write partitions that have more than ``most`` files anew, sorted by key; returns how many files went."""
    base = snapshot(spark, path)
    if base is None:
        return 0
    held: dict[str | None, int] = {}
    for f in base.files:
        held[f.part] = held.get(f.part, 0) + 1
    many = [f for f in base.files if held[f.part] > most]
    if not many:
        return 0
    files = write_files(read_files(spark, path, base, many), path, base.layout, "range")
    gone = set(many)
    commit(spark, path, base, base.keeping(lambda f: f not in gone).adding(files))
    return len(many)
