import datetime as dt

import pytest
from pyspark.sql import functions as F

from castline.operators import audits as au
from castline.operators import maintain as mn
from castline.operators import versions as vs
from tests.conftest import rows

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
SCHEMA = "platform string, platform_id string, show_name string, created_at timestamp_ntz, updated_at timestamp_ntz"


def _tables(spark):
    target = spark.createDataFrame([("yt", "a", "A", T1, T1), ("yt", "b", "B", T1, T1)], SCHEMA)
    batch = spark.createDataFrame([("yt", "a", "A2", T2, T2), ("yt", "a", "A3", T3, T3),   # duplicate key: latest wins
                                   ("yt", "c", "C", T2, T2)], SCHEMA)
    return target, batch


def test_upsert_latest_wins_and_keeps_created_at(spark):
    t, b = _tables(spark)
    out = mn.upsert(t, b, ["platform", "platform_id"], ["show_name", "updated_at"], ["updated_at"])
    assert rows(out) == sorted([("yt", "a", "A3", T1, T3), ("yt", "b", "B", T1, T1), ("yt", "c", "C", T2, T2)],
                               key=repr)


def test_upsert_is_idempotent_and_broadcast_path_matches(spark):
    t, b = _tables(spark)
    args = (["platform", "platform_id"], ["show_name", "updated_at"], ["updated_at"])
    once = mn.upsert(t, b, *args)
    twice = mn.upsert(once, b, *args)
    assert rows(once) == rows(twice)
    assert rows(mn.upsert(t, b, *args, broadcast_bytes=10**12)) == rows(once)


def test_insert_if_absent_never_updates(spark):
    t, b = _tables(spark)
    out = mn.insert_if_absent(t, b, ["platform", "platform_id"], ["updated_at"])
    assert rows(out) == sorted([("yt", "a", "A", T1, T1), ("yt", "b", "B", T1, T1), ("yt", "c", "C", T2, T2)],
                               key=repr)


def test_dedupe_latest_on_a_hot_key(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    got = rows(mn.dedupe_latest(df, ["k"], ["v"]))
    assert got == [(0, 19999), (1, 19998)]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "pem")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    base = spark.createDataFrame([(1, d1, 10, T1, T1), (2, d1, 20, T1, T1), (1, d2, 30, T1, T1)],
                                 "episode_id int, metric_date date, plays int, created_at timestamp_ntz, "
                                 "updated_at timestamp_ntz")
    mn.upsert_table(spark, path, base, ["episode_id", "metric_date"], ["plays", "updated_at"], ["updated_at"],
                    partition_col="metric_date")
    batch = spark.createDataFrame([(1, d2, 31, T2, T2), (3, d2, 5, T2, T2)], base.schema)
    before = [f for f in vs.snapshot(spark, path).files if f.part == "2024-01-01"]
    for _ in range(2):  # replaying the same batch changes nothing
        mn.upsert_table(spark, path, batch, ["episode_id", "metric_date"], ["plays", "updated_at"], ["updated_at"],
                        partition_col="metric_date")
    out = mn.read_table(spark, path).select("episode_id", F.col("metric_date").cast("date"), "plays", "created_at")
    assert rows(out) == sorted([(1, d1, 10, T1), (2, d1, 20, T1), (1, d2, 31, T1), (3, d2, 5, T2)], key=repr)
    after = [f for f in vs.snapshot(spark, path).files if f.part == "2024-01-01"]
    assert before == after and before   # the untouched day was not rewritten


def test_plan_intervals():
    assert mn.plan_intervals("2024-01-01", "2024-03-01", 30) == [
        ("2024-01-01", "2024-01-30"), ("2024-01-31", "2024-02-29"), ("2024-03-01", "2024-03-01")]


def test_lookback_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),), (dt.date(2024, 1, 31),)], "d date")
    assert rows(mn.lookback_window(df, "d", "2024-01-31", 30)) == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 31),)]


def test_run_log_applies_updates(spark):
    s = ("id bigint, platform string, run_started_at timestamp_ntz, run_completed_at timestamp_ntz, status string, "
         "episodes_processed int, metrics_collected int, error_message string, created_at timestamp_ntz")
    runs = spark.createDataFrame([(1, "yt", T1, None, "running", 0, 0, None, T1)], s)
    upd = spark.createDataFrame([(1, "yt", T1, T2, "failed", 3, 9, "boom", T2)], s)
    r = mn.run_log(runs, upd).first()
    assert (r.status, r.episodes_processed, r.error_message, r.created_at) == ("failed", 3, "boom", T1)


# ------------------------------------------------------------------- audits
def _dirty(spark):
    return spark.createDataFrame([(1, "a", 5, 20240101), (1, None, -1, 19990101), (2, "x", 0, None)],
                                 "id int, src string, n int, date_key int")


def test_seeded_violations_are_caught(spark):
    df = _dirty(spark)
    from castline.operators import dims as dm
    assert au.assert_not_null(df, "src").count() == 1
    assert au.assert_positive_values(df, "n").count() == 1
    assert rows(au.duplicate_groups(df, "id")) == [(1, 2)]
    assert rows(au.assert_valid_date_key(df, "date_key", dm.calendar(spark))) == [(19990101,)]
    assert rows(au.accepted_values(df, "src", ["a"]), "src") == [("x",)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(au.referential(df, "id", parent, "id"), "id") == [(2,)]


def test_runner_blocks_on_failure_and_passes_clean_data(spark):
    checks = [au.Check("t", "id", "unique"), au.Check("t", "src", "not_null"),
              au.Check("t", "src", "accepted_values", ("a", "x")), au.Check("t", "n", "positive", blocking=False)]
    res = au.audit_runner({"t": _dirty(spark)}, checks)
    got = {(r.column_name, r.test): r.failures for r in res.collect()}
    assert got == {("id", "unique"): 1, ("src", "not_null"): 1, ("src", "accepted_values"): 0, ("n", "positive"): 1}
    with pytest.raises(au.AuditFailure):
        au.enforce(res, checks)
    clean = spark.createDataFrame([(1, "a", 1, 20240101)], _dirty(spark).schema)
    assert au.enforce(au.audit_runner({"t": clean}, checks), checks) == []


def test_plan_intervals_month_aligned_and_grouping():
    ivals = mn.plan_intervals("2024-01-15", "2024-03-10", align="month")
    assert ivals == [("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-31")]
    assert mn.group_intervals(ivals, 70) == [("2024-01-01", "2024-02-29"), ("2024-03-01", "2024-03-31")]
    assert mn.group_intervals([("2024-01-01", "2024-01-30"), ("2024-03-01", "2024-03-30")], 999) == \
        [("2024-01-01", "2024-01-30"), ("2024-03-01", "2024-03-30")]   # not adjacent: separate jobs


def test_rebuilding_a_range_drops_days_that_became_empty(spark, tmp_path):
    path = str(tmp_path / "f")
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    src = {"rows": [(1, d[0]), (2, d[1]), (3, d[2])]}

    def build(s, e):
        df = spark.createDataFrame(src["rows"], "v int, day date")
        return df.where(F.col("day").between(F.lit(s).cast("date"), F.lit(e).cast("date")))

    mn.incremental_by_time_range(spark, build, path, "day", "2024-01-01", "2024-01-03", 30)
    src["rows"] = [(1, d[0]), (3, d[2])]       # day 2 lost its only row (late delete)
    mn.incremental_by_time_range(spark, build, path, "day", "2024-01-01", "2024-01-03", 30)
    out = mn.read_table(spark, path).select("v", F.col("day").cast("date"))
    assert rows(out) == [(1, d[0]), (3, d[2])]
