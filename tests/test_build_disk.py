"""What the build puts on disk: shuffles go with their statement, keys and dealt rows move once, digests are packed."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from castline.functions import date_key, surrogate_key
from castline.operators import facts as fx
from castline.operators import maintain as mn
from castline.operators import versions as vs
from castline.plans import build as bd
from castline.session import DROP_SHUFFLES, shuffles_dropped
from tests.conftest import rows

DAY, LATE = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 2, 1, 23)


def exchanges(df):
    text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange " in line and "Broadcast" not in line]


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(found.size()) if (f := found.apply(i).getName()).startswith("shuffle_")}


def test_build_leaves_no_shuffle_files(spark, cat, tmp_path):
    held = shuffle_files(spark)
    bd.build_warehouse(spark, cat, str(tmp_path / "w"))
    end = time.time() + 30                       # they are deleted in the background
    while (left := shuffle_files(spark) - held) and time.time() < end:
        time.sleep(0.2)
    assert not left


def test_the_switch_is_as_before_also_after_an_error(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise ValueError("no")
    assert spark.conf.get(DROP_SHUFFLES, None) == before


def sources(spark):
    yt = spark.createDataFrame(
        [("a", DAY.date(), 1, 1, None, 0, 5, 2.5, 1), ("a", DAY.date(), 2, None, 1, 0, 5, 0.0, 1), (None, DAY.date(), 3, 1, 1, 1, 1, 1.0, 0),
         ("", DAY.date(), 4, 1, 1, 1, 1, None, 0), ("a", LATE.date(), 5, 1, 1, 1, 1, None, 2), ("b", None, 6, 1, 1, 1, 1, 1.0, 1)],
        "video_id string, metric_date date, views bigint, likes bigint, comments bigint, shares bigint, watch_time_seconds bigint, "
        "avg_view_duration_seconds double, subscribers_gained bigint")
    tw = spark.createDataFrame([("a", DAY, 1, 2, 3, 4, 5), ("a", DAY, 1, None, 3, 4, 5), (None, LATE, 1, 2, 3, 4, 5)],
                               "tweet_id string, created_at timestamp_ntz, impression_count int, like_count int, reply_count int, "
                               "retweet_count int, quote_count int")
    li = spark.createDataFrame([("p", LATE, 1, 2, 3, 4)], "post_id string, published_at timestamp_ntz, impressions int, likes int, "
                               "comments int, shares int")
    tc = spark.createDataFrame([("a", DAY, 7), ("s", None, 8)], "stream_id string, started_at timestamp_ntz, viewer_count int")
    return yt, tw, li, tc


@pytest.mark.parametrize("by_day", (False, True))
def test_engagement_moves_native_ids_and_has_each_key_once(spark, by_day):
    got = fx.fact_daily_engagement(*sources(spark), None, None, by_day=by_day)
    key = surrogate_key(F.col("p"), F.col("i"))
    want = spark.createDataFrame(
        [(DAY.date(), "youtube", "a", 3, 1, 1, 0, 10, 2.5, 2), (DAY.date(), "youtube", None, 7, 2, 2, 2, 2, 1.0, 0),
         (LATE.date(), "youtube", "a", 5, 1, 1, 1, 1, None, 2), (DAY.date(), "twitter", "a", 2, 2, 6, 18, 0, None, 0),
         (LATE.date(), "twitter", None, 1, 2, 3, 9, 0, None, 0), (LATE.date(), "linkedin", "p", 1, 2, 3, 4, 0, None, 0),
         (DAY.date(), "twitch", "a", 7, 0, 0, 0, 0, None, 0)],
        "d date, p string, i string, views bigint, likes bigint, comments bigint, shares bigint, watch bigint, avg double, gained bigint")
    assert rows(got) == rows(want.select(date_key("d"), "d", key, "p", "views", "likes", "comments", "shares", F.lit(0).cast("bigint"),
                                         "watch", "avg", "gained"))
    assert got.columns == ["date_key", "metric_date", "content_key", "platform", "views", "likes", "comments", "shares", "saves",
                           "watch_time_seconds", "avg_view_duration_seconds", "followers_gained"]
    moved = exchanges(got)
    assert len(moved) == 1 + by_day and not any("content_key" in x for x in moved)


def activity(spark):
    commits = spark.createDataFrame(
        [("r", "a", DAY, 1, 2), ("r", "a", DAY, 3, None), ("r", None, DAY, 5, 1), ("s", "b", LATE, None, None), (None, "a", DAY, 1, 1),
         ("r", "b", LATE, 1, 1), ("r", "a", None, 1, 1)],
        "repo_full_name string, author_email string, committed_at timestamp_ntz, lines_added int, lines_deleted int")
    prs = spark.createDataFrame([("r", DAY, DAY, DAY), ("s", DAY, None, DAY)],
                                "repo_full_name string, created_at timestamp_ntz, merged_at timestamp_ntz, closed_at timestamp_ntz")
    issues = spark.createDataFrame([("r", LATE, None), ("u", DAY, DAY)],
                                   "repo_full_name string, created_at timestamp_ntz, closed_at timestamp_ntz")
    return commits, prs, issues


def test_activity_by_day_is_moved_once_on_the_grain_and_not_for_the_write(spark, tmp_path):
    repos = spark.createDataFrame([("k1", "r"), ("k2", "s")], "repo_key string, repo_full_name string")
    want = fx.fact_github_activity(*activity(spark), repos, None, None)
    got = fx.fact_github_activity(*activity(spark), F.broadcast(repos), None, None, by_day=True)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    moved = exchanges(got)
    assert len(moved) == 2 and sum("rangepartitioning(activity_date" in x for x in moved) == 1
    path = str(tmp_path / "t")
    mn.incremental_by_time_range(spark, lambda s, e: got.withColumn("m", mn.month_of(F.col("activity_date"))), path, "m", "2024-01-01",
                                 "2024-02-29", align="month", spread=None)
    assert rows(mn.read_table(spark, path).drop("m")) == rows(want)
    assert {f.part for f in vs.snapshot(spark, path).files} == {"2024-01", "2024-02"}


def test_content_performance_moves_engagement_once(spark):
    dates = spark.createDataFrame([(20240101, DAY.date()), (20240201, LATE.date())], "date_key int, full_date date")
    content = spark.createDataFrame([("a", "y"), ("c", "y")], "content_key string, platform_key string")
    fact = spark.createDataFrame([(20240101, "a", 1), (20240201, "a", 2), (20240101, "b", 4), (20240101, None, 5), (None, "a", 9)],
                                 "date_key int, content_key string, views bigint")
    for c in ("likes", "comments", "shares", "watch_time_seconds"):
        fact = fact.withColumn(c, F.col("views"))
    got = fx.fact_content_performance(fact, dates, content)
    assert rows(got, "content_key", "platform_key", "total_views", "days_with_metrics", "first_metric_date", "last_metric_date") == sorted(
        [("a", "y", 3, 2, DAY.date(), LATE.date()), ("b", None, 4, 1, DAY.date(), DAY.date()), (None, None, 5, 1, DAY.date(), DAY.date())],
        key=repr)
    assert sum("Exchange hashpartitioning(content_key" in x for x in exchanges(got)) == 1


def test_files_are_dealt_by_the_column_and_packed(spark, tmp_path, monkeypatch):
    data = spark.range(2000).select("id", F.md5(F.col("id").cast("string")).alias("k"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("int").alias("d"))
    files = vs.write_files(data, str(tmp_path / "t"), vs.Layout("d"))
    assert {f.part for f in files} == {None, "1", "2", "3", "4"} and all(f.path.endswith(".zstd.parquet") for f in files)
    got = vs.read_files(spark, str(tmp_path / "t"), vs.Snapshot(0, data.schema, vs.Layout("d")).adding(files))
    assert rows(got) == rows(data)
