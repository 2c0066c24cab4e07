"""Tool-2 facts.

Time ranges are half-open ``[start, end + 1 day)`` on every fact (the
reference cuts the revenue range at 00:00 of the end day; see README).  The
range predicates are written on the raw time column so they reach the Parquet
scan as pushed filters and, on a day-partitioned table, prune partitions.

Aggregations always run with partial (map-side) aggregation, so a content key
or repository holding a third of all rows is pre-combined per input partition
before the single shuffle on the grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castline.functions import date_key, safe_divide, surrogate_key

col = F.col


def in_range(c: Column, start: str | None, end: str | None) -> Column:
    """``c::date BETWEEN start AND end`` as a half-open timestamp range; without bounds, all times."""
    if start is None or end is None:
        return c.isNotNull()
    return (c >= F.lit(start).cast("date").cast("timestamp_ntz")) & \
           (c < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))


def in_date_range(c: Column, start: str | None, end: str | None) -> Column:
    if start is None or end is None:
        return c.isNotNull()
    return (c >= F.lit(start).cast("date")) & (c <= F.lit(end).cast("date"))


# A8 ------------------------------------------------------------------------
def youtube_daily_platform(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric_date").agg(
        F.lit("youtube").alias("platform"),
        F.sum("views").cast("bigint").alias("total_views"),
        F.sum(col("likes") + col("comments") + col("shares")).cast("bigint").alias("total_engagement"),
        F.countDistinct("video_id").alias("content_count"))


def twitter_daily_platform(tweets: DataFrame) -> DataFrame:
    return tweets.groupBy(col("created_at").cast("date").alias("metric_date")).agg(
        F.lit("twitter").alias("platform"),
        F.sum("impression_count").cast("bigint").alias("total_views"),
        F.sum(col("like_count") + col("reply_count") + col("retweet_count") + col("quote_count"))
         .cast("bigint").alias("total_engagement"),
        F.countDistinct("tweet_id").alias("content_count"))


def linkedin_daily_platform(posts: DataFrame) -> DataFrame:
    return posts.groupBy(col("published_at").cast("date").alias("metric_date")).agg(
        F.lit("linkedin").alias("platform"),
        F.sum("impressions").cast("bigint").alias("total_views"),
        F.sum(col("likes") + col("comments") + col("shares")).cast("bigint").alias("total_engagement"),
        F.countDistinct("post_id").alias("content_count"))


def twitch_daily_platform(streams: DataFrame) -> DataFrame:
    return streams.groupBy(col("started_at").cast("date").alias("metric_date")).agg(
        F.lit("twitch").alias("platform"),
        F.sum("viewer_count").cast("bigint").alias("total_views"),
        F.lit(0).cast("bigint").alias("total_engagement"),
        F.countDistinct("stream_id").alias("content_count"))


# A9 ------------------------------------------------------------------------
def int_daily_platform_metrics(yt: DataFrame, tw: DataFrame, li: DataFrame, tc: DataFrame) -> DataFrame:
    u = (youtube_daily_platform(yt).unionByName(twitter_daily_platform(tw))
         .unionByName(linkedin_daily_platform(li)).unionByName(twitch_daily_platform(tc)))
    return u.where(col("metric_date").isNotNull()).select(
        "metric_date", "platform", "total_views", "total_engagement", "content_count",
        (safe_divide("total_engagement", "total_views") * 100).alias("avg_engagement_rate"))


# A10 -----------------------------------------------------------------------
_ENGAGEMENT_COLS = ("views", "likes", "comments", "shares", "saves", "watch_time_seconds",
                    "avg_view_duration_seconds", "followers_gained")


def _engagement_rows(df: DataFrame, platform: str, native_id: str, day: Column, values: dict) -> DataFrame:
    zero = F.lit(0)
    return df.select(
        day.alias("metric_date"), F.lit(platform).alias("platform"),
        F.coalesce(col(native_id).cast("string"), F.lit("")).alias("native_id"),        # a missing id is '' in its key, too
        *[(values.get(c, zero)).cast("double" if c == "avg_view_duration_seconds" else "bigint").alias(c)
          for c in _ENGAGEMENT_COLS])


def fact_daily_engagement(yt: DataFrame, tw: DataFrame, li: DataFrame, tc: DataFrame,
                          start: str, end: str, by_day: bool = False) -> DataFrame:
    """Daily engagement per content over [start, end]; grain (date_key, content_key).

    Rows are moved by platform and native id, which make up the content key and are shorter than it; the keys are made
    at the end.  With ``by_day`` rows come out dealt by day, split and joined as a writer of days would have it."""
    y = _engagement_rows(
        yt.where(in_date_range(col("metric_date"), start, end)), "youtube", "video_id", col("metric_date"),
        {"views": col("views"), "likes": col("likes"), "comments": col("comments"), "shares": col("shares"),
         "watch_time_seconds": col("watch_time_seconds"),
         "avg_view_duration_seconds": col("avg_view_duration_seconds"),
         "followers_gained": col("subscribers_gained")})
    t = _engagement_rows(
        tw.where(in_range(col("created_at"), start, end)), "twitter", "tweet_id", col("created_at").cast("date"),
        {"views": col("impression_count"), "likes": col("like_count"), "comments": col("reply_count"),
         "shares": col("retweet_count") + col("quote_count")})
    lk = _engagement_rows(
        li.where(in_range(col("published_at"), start, end)), "linkedin", "post_id", col("published_at").cast("date"),
        {"views": col("impressions"), "likes": col("likes"), "comments": col("comments"), "shares": col("shares")})
    tc_ = _engagement_rows(
        tc.where(in_range(col("started_at"), start, end)), "twitch", "stream_id", col("started_at").cast("date"),
        {"views": col("viewer_count")})
    u = y.unionByName(t).unionByName(lk).unionByName(tc_)
    daily = u.groupBy("metric_date", "platform", "native_id").agg(
        *[F.sum(c).alias(c) for c in ("views", "likes", "comments", "shares", "saves", "watch_time_seconds")],
        F.avg(F.nullif(col("avg_view_duration_seconds"), F.lit(0.0))).alias("avg_view_duration_seconds"),
        F.sum("followers_gained").alias("followers_gained"))
    if by_day:
        daily = daily.hint("rebalance", "metric_date")
    return daily.select(date_key("metric_date").alias("date_key"), "metric_date",
                        surrogate_key("platform", "native_id").alias("content_key"), "platform", *_ENGAGEMENT_COLS)


# A11 -----------------------------------------------------------------------
def fact_content_performance(engagement: DataFrame, dates: DataFrame, content: DataFrame) -> DataFrame:
    """engagement ⋈ dim_date (broadcast, bounded calendar) → per content → ⟕ dim_content.

    Its grain has a content at most once a day, so there is nothing to sum up before a shuffle and no content has more
    rows than the calendar: one shuffle by content serves the distinct days, the sums and the join."""
    d = F.broadcast(dates.select(col("date_key").alias("d_date_key"), "full_date"))
    agg = (engagement.repartition("content_key").join(d, col("date_key") == col("d_date_key"), "inner")
           .groupBy("content_key").agg(
               F.sum("views").alias("total_views"), F.sum("likes").alias("total_likes"),
               F.sum("comments").alias("total_comments"), F.sum("shares").alias("total_shares"),
               F.sum("watch_time_seconds").alias("total_watch_time_seconds"),
               F.min("full_date").alias("first_metric_date"), F.max("full_date").alias("last_metric_date"),
               F.countDistinct("date_key").alias("days_with_metrics")))
    c = content.select(col("content_key").alias("c_content_key"), "platform_key")
    return agg.join(c, col("content_key") == col("c_content_key"), "left").select(
        "content_key", "platform_key", "total_views", "total_likes", "total_comments", "total_shares",
        "total_watch_time_seconds", "first_metric_date", "last_metric_date", "days_with_metrics",
        F.when(col("days_with_metrics") == 0, F.lit(0.0))
         .otherwise(col("total_views").cast("double") / col("days_with_metrics").cast("double"))
         .alias("avg_daily_views"))


# A12-A14 -------------------------------------------------------------------
_KEYS = ("date_key", "activity_date", "repo_full_name")


def commits_daily(commits: DataFrame, start: str, end: str) -> DataFrame:
    day = col("committed_at").cast("date")
    return (commits.where(in_range(col("committed_at"), start, end))
            .groupBy(date_key(day).alias("date_key"), day.alias("activity_date"), "repo_full_name")
            .agg(F.count(F.lit(1)).alias("commits"), F.sum("lines_added").alias("lines_added"),
                 F.sum("lines_deleted").alias("lines_deleted"),
                 F.countDistinct("author_email").alias("unique_contributors")))


def prs_daily(prs: DataFrame, start: str, end: str) -> DataFrame:
    """PR merged / closed are counted on the day the PR was created."""
    day = col("created_at").cast("date")
    return (prs.where(in_range(col("created_at"), start, end))
            .groupBy(date_key(day).alias("date_key"), day.alias("activity_date"), "repo_full_name")
            .agg(F.count(F.lit(1)).alias("prs_opened"),
                 F.count(F.when(col("merged_at").isNotNull(), 1)).alias("prs_merged"),
                 F.count(F.when(col("closed_at").isNotNull() & col("merged_at").isNull(), 1)).alias("prs_closed")))


def issues_daily(issues: DataFrame, start: str, end: str) -> DataFrame:
    day = col("created_at").cast("date")
    return (issues.where(in_range(col("created_at"), start, end))
            .groupBy(date_key(day).alias("date_key"), day.alias("activity_date"), "repo_full_name")
            .agg(F.count(F.lit(1)).alias("issues_opened"),
                 F.count(F.when(col("closed_at").isNotNull(), 1)).alias("issues_closed")))


_ACTIVITY = ("commits", "lines_added", "lines_deleted", "unique_contributors", "prs_opened", "prs_merged",
             "prs_closed", "issues_opened", "issues_closed")


def full_outer_chain(commits: DataFrame, prs: DataFrame, issues: DataFrame, start: str, end: str) -> DataFrame:
    """JN4: the literal plan — commits ⟗ PRs ⟗ issues, second join on COALESCE keys."""
    c = commits_daily(commits, start, end).select(*[col(k).alias(f"c_{k}") for k in _KEYS],
                                                    "commits", "lines_added", "lines_deleted", "unique_contributors")
    p = prs_daily(prs, start, end).select(*[col(k).alias(f"p_{k}") for k in _KEYS],
                                          "prs_opened", "prs_merged", "prs_closed")
    i = issues_daily(issues, start, end).select(*[col(k).alias(f"i_{k}") for k in _KEYS],
                                                "issues_opened", "issues_closed")
    cp = c.join(p, (col("c_date_key") == col("p_date_key")) & (col("c_repo_full_name") == col("p_repo_full_name")),
                "full_outer")
    cpi = cp.join(i, (F.coalesce("c_date_key", "p_date_key") == col("i_date_key"))
                  & (F.coalesce("c_repo_full_name", "p_repo_full_name") == col("i_repo_full_name")), "full_outer")
    return cpi.select(
        *[F.coalesce(f"c_{k}", f"p_{k}", f"i_{k}").alias(k) for k in _KEYS],
        *[F.coalesce(col(m), F.lit(0).cast("bigint")).alias(m) for m in _ACTIVITY])


def combined_activity(commits: DataFrame, prs: DataFrame, issues: DataFrame, start: str, end: str,
                      by_day: bool = False) -> DataFrame:
    """Same rows as :func:`full_outer_chain` for every non-NULL repository,
    without its joins.  Only commits pay for their distinct authors: they are summed per
    author first.  Those sums and the rows of the other sources then meet in one partially
    aggregated ``groupBy`` on the grain.  NULL repositories collapse into one group here but are
    removed by the repository lookup either way.

    With ``by_day`` all meet by ranges of day and repository instead of their hash, so that the rows of a day come out
    side by side, as a writer of days or months needs them, and are not moved again."""
    zero, by = F.lit(0).cast("bigint"), ("activity_date", "repo_full_name")

    def wide(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        return rows.select(*by, *[values.get(m, zero).cast("bigint").alias(m) for m in _ACTIVITY])

    def dated(rows: DataFrame, time: str) -> DataFrame:
        return rows.where(in_range(col(time), start, end)).withColumn("activity_date", col(time).cast("date"))

    def one(which: Column) -> Column:
        return F.when(which, F.lit(1)).otherwise(F.lit(0))

    authors = dated(commits, "committed_at").groupBy(*by, "author_email").agg(
        F.count(F.lit(1)).alias("commits"), F.sum("lines_added").alias("lines_added"), F.sum("lines_deleted").alias("lines_deleted"))
    merged, closed = col("merged_at").isNotNull(), col("closed_at").isNotNull()
    every = wide(authors, {**{m: col(m) for m in ("commits", "lines_added", "lines_deleted")},
                           "unique_contributors": one(col("author_email").isNotNull())}).unionByName(
        wide(dated(prs, "created_at"), {"prs_opened": F.lit(1), "prs_merged": one(merged), "prs_closed": one(closed & ~merged)})).unionByName(
        wide(dated(issues, "created_at"), {"issues_opened": F.lit(1), "issues_closed": one(closed)}))
    if by_day:
        every = every.repartitionByRange(*by)
    return every.groupBy(*by).agg(*[F.coalesce(F.sum(m), zero).alias(m) for m in _ACTIVITY]).select(
        date_key("activity_date").alias("date_key"), *by, *_ACTIVITY)


def repo_lookup(combined: DataFrame, repos: DataFrame) -> DataFrame:
    """JN5: ⟕ dim_repository + ``repo_key IS NOT NULL`` = inner join."""
    r = repos.select("repo_key", col("repo_full_name").alias("r_repo_full_name"))
    return combined.join(r, col("repo_full_name") == col("r_repo_full_name"), "inner").select(
        "date_key", "activity_date", "repo_key", *_ACTIVITY)


# A15 -----------------------------------------------------------------------
def fact_github_activity(commits: DataFrame, prs: DataFrame, issues: DataFrame, repos: DataFrame,
                         start: str, end: str, by_day: bool = False) -> DataFrame:
    return repo_lookup(combined_activity(commits, prs, issues, start, end, by_day), repos)


# D6 ------------------------------------------------------------------------
def fact_revenue(charges: DataFrame, start: str, end: str) -> DataFrame:
    return charges.where((col("is_paid") == F.lit(True)) & in_range(col("created_at"), start, end)).select(
        "charge_id", date_key("created_at").alias("date_key"), "customer_id",
        F.lit("stripe_charge").alias("revenue_source"), "amount_cents", "amount_dollars", "currency", "status",
        "is_refunded", col("description").alias("product_name"), "invoice_id", "created_at")
