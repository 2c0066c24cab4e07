import datetime as dt

from pyspark.sql import functions as F

from castline.operators import dims as dm
from castline.operators import facts as fx
from castline.operators import maintain as mn
from castline.operators import staging as stg
from castline.plans.queries import FULL, t2_engagement
from tests.conftest import rows

T = dt.datetime(2024, 1, 10, 12)


def test_all_zero_view_duration_averages_to_null(spark):
    yt = spark.createDataFrame([("v1", T.date(), 5, 0, 1, 0, 0, 0.0, 0), ("v1", T.date(), 3, 0, 0, 0, 0, 0.0, 1)],
                               "video_id string, metric_date date, views bigint, watch_time_seconds bigint, "
                               "likes bigint, comments bigint, shares bigint, avg_view_duration_seconds double, "
                               "subscribers_gained int")
    empty_tw = spark.createDataFrame([], "tweet_id string, created_at timestamp_ntz, impression_count int, "
                                         "like_count int, reply_count int, retweet_count int, quote_count int")
    empty_li = spark.createDataFrame([], "post_id string, published_at timestamp_ntz, impressions int, likes int, "
                                         "comments int, shares int")
    empty_tc = spark.createDataFrame([], "stream_id string, started_at timestamp_ntz, viewer_count int")
    r = fx.fact_daily_engagement(yt, empty_tw, empty_li, empty_tc, "2024-01-01", "2024-01-31").first()
    assert r.views == 8 and r.avg_view_duration_seconds is None and r.followers_gained == 1


def test_range_is_inclusive_of_last_day_at_2359(spark):
    tw = spark.createDataFrame([("t1", dt.datetime(2024, 1, 31, 23, 59), 1, 0, 0, 0, 0),
                                ("t2", dt.datetime(2024, 2, 1, 0, 0), 1, 0, 0, 0, 0),
                                ("t3", dt.datetime(2024, 1, 1, 0, 0), 1, 0, 0, 0, 0)],
                               "tweet_id string, created_at timestamp_ntz, impression_count int, like_count int, "
                               "reply_count int, retweet_count int, quote_count int")
    yt = spark.createDataFrame([], "video_id string, metric_date date, views bigint, watch_time_seconds bigint, "
                                   "likes bigint, comments bigint, shares bigint, avg_view_duration_seconds double, "
                                   "subscribers_gained int")
    li = spark.createDataFrame([], "post_id string, published_at timestamp_ntz, impressions int, likes int, "
                                   "comments int, shares int")
    tc = spark.createDataFrame([], "stream_id string, started_at timestamp_ntz, viewer_count int")
    got = rows(fx.fact_daily_engagement(yt, tw, li, tc, "2024-01-01", "2024-01-31"), "metric_date")
    assert got == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 31),)]


def _gh(spark):
    commits = spark.createDataFrame([
        ("org/a", T, 5, 1, "x@e"), ("org/a", T, 2, 0, "y@e"),
        ("org/only-commits", T, 1, 1, "x@e"), (None, T, 1, 1, "z@e"), ("org/not-in-dim", T, 1, 0, "x@e")],
        "repo_full_name string, committed_at timestamp_ntz, lines_added int, lines_deleted int, author_email string")
    prs = spark.createDataFrame([
        ("org/a", T, T, None), ("org/only-prs", T, None, T), (None, T, None, None)],
        "repo_full_name string, created_at timestamp_ntz, merged_at timestamp_ntz, closed_at timestamp_ntz")
    issues = spark.createDataFrame([("org/a", T, T), ("org/only-issues", T, None), (None, T, T)],
                                   "repo_full_name string, created_at timestamp_ntz, closed_at timestamp_ntz")
    repos = spark.createDataFrame([(f"k-{n}", n) for n in ("org/a", "org/only-commits", "org/only-prs",
                                                           "org/only-issues")],
                                  "repo_key string, repo_full_name string")
    return commits, prs, issues, repos


def test_union_groupby_equals_full_outer_chain_after_lookup(spark):
    c, p, i, repos = _gh(spark)
    a = fx.repo_lookup(fx.full_outer_chain(c, p, i, "2024-01-01", "2024-01-31"), repos)
    b = fx.fact_github_activity(c, p, i, repos, "2024-01-01", "2024-01-31")
    assert rows(a) == rows(b)
    got = {r.repo_key: r for r in b.collect()}
    assert set(got) == {"k-org/a", "k-org/only-commits", "k-org/only-prs", "k-org/only-issues"}
    a_row = got["k-org/a"]
    assert (a_row.commits, a_row.lines_added, a_row.unique_contributors) == (2, 7, 2)
    assert (a_row.prs_opened, a_row.prs_merged, a_row.prs_closed) == (1, 1, 0)
    assert (a_row.issues_opened, a_row.issues_closed) == (1, 1)
    assert got["k-org/only-prs"].prs_closed == 1 and got["k-org/only-prs"].commits == 0


def test_full_outer_chain_keeps_null_repositories_apart(spark):
    c, p, i, _ = _gh(spark)
    chain = fx.full_outer_chain(c, p, i, "2024-01-01", "2024-01-31")
    assert chain.where(F.col("repo_full_name").isNull()).count() == 3   # NULL never matches NULL


def test_engagement_totals_equal_staging_totals(cat):
    yt = stg.staged(cat, "stg_youtube_video_metrics")
    tw = stg.staged(cat, "stg_twitter_tweets")
    li = stg.staged(cat, "stg_linkedin_posts")
    tc = stg.staged(cat, "stg_twitch_streams")
    fact = t2_engagement(cat)
    want = (yt.agg(F.sum("views")).first()[0] + tw.agg(F.sum("impression_count")).first()[0]
            + li.agg(F.sum("impressions")).first()[0] + tc.agg(F.sum("viewer_count")).first()[0])
    assert fact.agg(F.sum("views")).first()[0] == want
    assert fact.groupBy("date_key", "content_key").count().where("count > 1").count() == 0   # grain


def test_adjacent_ranges_equal_one_full_build(cat):
    whole = t2_engagement(cat, "2024-01-01", "2024-01-31")
    parts = t2_engagement(cat, "2024-01-01", "2024-01-12").unionByName(t2_engagement(cat, "2024-01-13", "2024-01-31"))
    assert rows(whole) == rows(parts)


def test_incremental_rebuild_is_idempotent(spark, cat, tmp_path):
    path = str(tmp_path / "fde")
    build = lambda s, e: t2_engagement(cat, s, e)
    mn.incremental_by_time_range(spark, build, path, "metric_date", "2024-01-01", "2024-01-31", 10)
    first = rows(mn.read_table(spark, path))
    mn.incremental_by_time_range(spark, build, path, "metric_date", "2024-01-11", "2024-01-20", 10)  # re-run a batch
    assert rows(mn.read_table(spark, path)) == first
    assert mn.read_table(spark, path).count() == t2_engagement(cat, "2024-01-01", "2024-01-31").count()


def test_calendar_inner_join_drops_dates_outside_range(spark, cat):
    fact = t2_engagement(cat, *FULL)
    outside = fact.where(F.col("metric_date") < F.lit("2020-01-01").cast("date")).count()
    assert outside > 0   # the binding puts some tweets before the calendar
    perf = fx.fact_content_performance(fact, dm.calendar(spark), fact.select("content_key").distinct()
                                       .withColumn("platform_key", F.lit("p")))
    assert perf.where(F.col("first_metric_date") < F.lit("2020-01-01").cast("date")).count() == 0
