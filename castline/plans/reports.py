"""Dashboard / documented queries (O4-O14, JN9-JN13, A17-A20, §2.11).

``as_of`` replaces ``CURRENT_DATE`` so results are reproducible.  Top-k
queries use a total order (metric, then a unique tie-break) so the k rows are
deterministic; Spark plans ``orderBy(...).limit(k)`` as TakeOrderedAndProject:
each partition keeps its own top k and only k rows per partition reach the
final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castline.functions import cents_to_dollars, days_before, safe_divide

col = F.col
AS_OF = "2024-01-31"


def _since(c: str, as_of: str, days: int):
    return col(c) >= days_before(as_of, days)


# ----------------------------------------------------------- dashboard cards
def total_streams(mart_content: DataFrame) -> DataFrame:
    """A20 card: ungrouped SUM."""
    return mart_content.agg(F.sum("total_streams").alias("total_streams"))


def total_views(mart_content: DataFrame) -> DataFrame:
    return mart_content.agg(F.sum("total_views").alias("total_views"))


def streams_30d(daily: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """O5."""
    return daily.where(_since("metric_date", as_of, 30)).agg(F.sum("spotify_streams").alias("streams"))


def views_30d(daily: DataFrame, as_of: str = AS_OF) -> DataFrame:
    return daily.where(_since("metric_date", as_of, 30)).agg(F.sum("youtube_views").alias("views"))


def period_comparison(daily: DataFrame, as_of: str = AS_OF, days: int = 30) -> DataFrame:
    """The card metric for the current and the preceding period in one pass."""
    cur = _since("metric_date", as_of, days) & (col("metric_date") <= F.lit(as_of).cast("date"))
    prev = _since("metric_date", as_of, 2 * days) & (col("metric_date") < days_before(as_of, days))
    out = daily.where(_since("metric_date", as_of, 2 * days)).agg(
        F.sum(F.when(cur, col("spotify_streams"))).alias("streams_current"),
        F.sum(F.when(prev, col("spotify_streams"))).alias("streams_previous"),
        F.sum(F.when(cur, col("youtube_views"))).alias("views_current"),
        F.sum(F.when(prev, col("youtube_views"))).alias("views_previous"))
    return out


def daily_trend(daily: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Last 90 days ordered by date."""
    return (daily.where(_since("metric_date", as_of, 90))
            .select("metric_date", "spotify_streams", "youtube_views").orderBy("metric_date"))


def top_episodes(mart_content: DataFrame, k: int = 10) -> DataFrame:
    """O7."""
    return (mart_content.where(col("total_streams") > 0)
            .orderBy(col("total_streams").desc(), col("title").asc_nulls_last(), col("content_id").asc())
            .limit(k).select("title", "total_streams"))


def top_videos(mart_content: DataFrame, k: int = 10) -> DataFrame:
    return (mart_content.where(col("total_views") > 0)
            .orderBy(col("total_views").desc(), col("title").asc_nulls_last(), col("content_id").asc())
            .limit(k).select("title", "total_views"))


def platform_pie(comparison: DataFrame) -> DataFrame:
    """O8."""
    return comparison.select("platform", "total_consumption")


def content_table(mart_content: DataFrame) -> DataFrame:
    """O9."""
    return (mart_content.select("title", "published_date", "content_source", "total_streams", "total_views",
                                "total_consumption", "content_id")
            .orderBy(col("total_consumption").desc(), col("content_id").asc())
            .drop("content_id"))


# ------------------------------------------------------------ star queries
def top_content_30d(engagement: DataFrame, content: DataFrame, dates: DataFrame, as_of: str = AS_OF,
                    k: int = 20) -> DataFrame:
    """Fact ⋈ dim_content ⋈ dim_date over the last 30 days, top 20 by views.

    The fact is aggregated to the content grain before joining dim_content,
    so the dimension join sees one row per content key."""
    d = F.broadcast(dates.where(_since("full_date", as_of, 30)).select(col("date_key").alias("d_key")))
    per_content = (engagement.join(d, col("date_key") == col("d_key"), "left_semi")
                   .groupBy("content_key")
                   .agg(F.sum("views").alias("total_views"), F.sum("likes").alias("total_likes"),
                        F.sum("comments").alias("total_comments")))
    c = content.select(col("content_key").alias("c_key"), "title", "platform", "url")
    return (per_content.join(c, col("content_key") == col("c_key"), "inner")
            .orderBy(col("total_views").desc(), col("content_key").asc()).limit(k)
            .select("title", "platform", "url", "total_views", "total_likes", "total_comments"))


def monthly_revenue(revenue: DataFrame, dates: DataFrame) -> DataFrame:
    """A18."""
    d = F.broadcast(dates.select(col("date_key").alias("d_key"), "year", "month", "year_month"))
    return (revenue.join(d, col("date_key") == col("d_key"), "inner")
            .groupBy("year", "month", "year_month").agg(cents_to_dollars(F.sum("amount_cents")).alias("revenue")))


def yoy_self_join(monthly: DataFrame) -> DataFrame:
    """JN11: each month joined to the same month one year earlier."""
    last = monthly.select(col("year").alias("ly_year"), col("month").alias("ly_month"),
                          col("revenue").alias("prior_year_revenue"))
    return monthly.join(last, (col("year") == col("ly_year") + 1) & (col("month") == col("ly_month")), "left")


def yoy_growth(monthly: DataFrame) -> DataFrame:
    """ROUND((cur - prev) / NULLIF(prev, 0) * 100, 1), newest first.

    ``monthly`` is one row per calendar month: a bounded, tiny relation; the
    self-join is on an equality key (year+1, month)."""
    j = yoy_self_join(monthly)
    return j.select(
        "year_month", col("revenue").alias("current_revenue"), "prior_year_revenue",
        F.round((col("revenue") - col("prior_year_revenue")) / F.nullif(col("prior_year_revenue"), F.lit(0.0)) * 100,
                1).alias("yoy_growth_pct"),
    ).orderBy(col("year_month").desc())


def weekly_platform(engagement: DataFrame, dates: DataFrame) -> DataFrame:
    """Views / likes / avg duration by platform × ISO week."""
    d = F.broadcast(dates.select(col("date_key").alias("d_key"), "full_date"))
    return (engagement.join(d, col("date_key") == col("d_key"), "inner")
            .groupBy("platform", F.date_trunc("week", col("full_date")).cast("date").alias("week"))
            .agg(F.sum("views").alias("views"), F.sum("likes").alias("likes"),
                 F.avg("avg_view_duration_seconds").alias("avg_duration"))
            .orderBy("platform", "week"))


# -------------------------------------------------------------- collector
def metrics_latest(pem: DataFrame, pe: DataFrame, p: DataFrame, as_of: str = AS_OF, days: int = 30) -> DataFrame:
    """JN9: episode metrics ⋈ episodes ⋈ podcasts over the look-back window."""
    e = pe.select(col("id").alias("e_id"), col("podcast_id"), "episode_title", "publish_date")
    s = p.select(col("id").alias("p_id"), "show_name", "platform")
    return (pem.where(_since("metric_date", as_of, days))
            .join(e, col("episode_id") == col("e_id"), "inner")
            .join(s, col("podcast_id") == col("p_id"), "inner")
            .select("show_name", "platform", "episode_title", "publish_date", "metric_date", "plays", "listeners",
                    "engaged_listeners", "views", "likes", "comments_count", "completion_rate", "top_countries",
                    "top_cities"))


_SUMS = ("plays", "listeners", "views", "downloads", "comments_count", "likes")
_SUM_NAMES = {"plays": "total_plays", "listeners": "total_listeners", "views": "total_views",
              "downloads": "total_downloads", "comments_count": "total_comments", "likes": "total_likes"}


def _per_episode(pem: DataFrame, as_of: str, days: int) -> DataFrame:
    """Metrics in the look-back window pre-aggregated per episode (map-side
    partial aggregation), so every later join sees one row per episode."""
    return (pem.where(_since("metric_date", as_of, days)).groupBy("episode_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.sum("completion_rate").alias("cr_sum"), F.count("completion_rate").alias("cr_cnt")))


def _per_podcast(pem: DataFrame, pe: DataFrame, psm: DataFrame, as_of: str, days: int):
    e = pe.select(col("id").alias("e_id"), col("podcast_id"))
    em = (_per_episode(pem, as_of, days)
          .join(e, col("episode_id") == col("e_id"), "inner")
          .groupBy("podcast_id").agg(
              F.count(F.lit(1)).alias("n_episodes"),          # one row per episode with metrics
              *[F.sum(c).alias(c) for c in _SUMS],
              F.sum("cr_sum").alias("cr_sum"), F.sum("cr_cnt").alias("cr_cnt")))
    sm = psm.groupBy(col("podcast_id").alias("s_podcast_id")).agg(
        F.count(F.lit(1)).alias("n_show_rows"), F.max("followers_total").alias("max_followers"),
        F.max("subscribers_total").alias("max_subscribers"))
    return em, sm


def performance_summary(p: DataFrame, pe: DataFrame, pem: DataFrame, psm: DataFrame, as_of: str = AS_OF,
                        days: int = 30, exact: bool = False) -> DataFrame:
    """JN10: per (show_name, platform) totals.

    ``exact=False`` reproduces the reference view bit-for-bit: its show-metrics
    join multiplies every SUM (and re-weights AVG) by the podcast's number of
    show-metric rows.  The multiplicity is applied arithmetically to per-podcast
    pre-aggregates — the episode × show-metric pairs are never materialised.
    ``exact=True`` gives the intended, un-multiplied totals.
    """
    em, sm = _per_podcast(pem, pe, psm, as_of, days)
    shows = p.select(col("id").alias("p_id"), "show_name", "platform")
    j = (em.join(shows, col("podcast_id") == col("p_id"), "inner")
         .join(sm, col("podcast_id") == col("s_podcast_id"), "left"))
    m = F.lit(1).cast("bigint") if exact else F.coalesce(col("n_show_rows"), F.lit(1).cast("bigint"))
    cr_den = F.sum(col("cr_cnt") * m)
    return j.groupBy("show_name", "platform").agg(
        F.sum("n_episodes").alias("total_episodes"),
        *[F.sum(col(c) * m).alias(_SUM_NAMES[c]) for c in _SUMS],
        F.when(cr_den > 0, F.sum(col("cr_sum") * m) / cr_den).alias("avg_completion_rate"),
        F.max("max_followers").alias("latest_followers"),
        F.max("max_subscribers").alias("latest_subscribers"),
    ).select("show_name", "platform", "total_episodes", "total_plays", "total_listeners", "total_views",
             "total_downloads", "avg_completion_rate", "total_comments", "total_likes", "latest_followers",
             "latest_subscribers")


def top_podcast_episodes(pem: DataFrame, pe: DataFrame, p: DataFrame, as_of: str = AS_OF, k: int = 10) -> DataFrame:
    """Top episodes by plays over 30 days (metrics pre-aggregated per
    episode before the joins; the average is carried as sum and count)."""
    e = pe.select(col("id").alias("e_id"), "podcast_id", "episode_title")
    s = p.select(col("id").alias("p_id"), "platform")
    return (_per_episode(pem, as_of, 30)
            .join(e, col("episode_id") == col("e_id"), "inner")
            .join(s, col("podcast_id") == col("p_id"), "inner")
            .groupBy("platform", "episode_title")
            .agg(F.sum("plays").alias("total_plays"), F.sum("views").alias("total_views"),
                 (F.sum("cr_sum") / F.sum("cr_cnt")).alias("avg_completion"))
            .orderBy(col("total_plays").desc(), col("platform").asc(), col("episode_title").asc())
            .limit(k))


def comment_stats(comments: DataFrame, pe: DataFrame, p: DataFrame, platform: str = "youtube") -> DataFrame:
    """Comments and average likes per episode title, one platform
    (comments pre-aggregated per episode before the joins)."""
    per_ep = comments.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"), F.sum("likes_count").alias("likes"),
                                                F.count("likes_count").alias("likes_n"))
    e = pe.select(col("id").alias("e_id"), "podcast_id", "episode_title")
    s = p.where(col("platform") == platform).select(col("id").alias("p_id"))
    return (per_ep.join(e, col("episode_id") == col("e_id"), "inner")
            .join(s, col("podcast_id") == col("p_id"), "left_semi")
            .groupBy("episode_title")
            .agg(F.sum("n").alias("comment_count"),
                 (F.sum("likes").cast("double") / F.sum("likes_n")).alias("avg_comment_likes"))
            .orderBy(col("comment_count").desc(), col("episode_title").asc()))


def comment_threads(comments: DataFrame, pe: DataFrame) -> DataFrame:
    """JN13: each comment with its parent comment (same episode) and episode title."""
    parent = comments.select(col("episode_id").alias("pa_episode_id"),
                             col("platform_comment_id").alias("pa_comment_id"),
                             col("author_name").alias("parent_author_name"),
                             col("comment_text").alias("parent_comment_text"))
    e = pe.select(col("id").alias("e_id"), "episode_title")
    return (comments
            .join(parent, (col("episode_id") == col("pa_episode_id"))
                  & (col("parent_platform_comment_id") == col("pa_comment_id")), "left")
            .join(e, col("episode_id") == col("e_id"), "left")
            .select("episode_id", "episode_title", "platform_comment_id", "author_name", "likes_count",
                    "parent_platform_comment_id", "parent_author_name",
                    col("pa_comment_id").isNotNull().alias("has_parent")))


def failed_runs(runs: DataFrame) -> DataFrame:
    """O14."""
    return runs.where(col("status") == "failed").orderBy(col("run_started_at").desc(), col("id").asc())


def latest_sorted(latest: DataFrame) -> DataFrame:
    """O13.  The unique tie-break keys let the range partitioner split a hot
    date across several sort tasks instead of sorting it in one."""
    return latest.orderBy(col("metric_date").desc(), "show_name", "platform", "episode_title")


def summary_sorted(summary: DataFrame) -> DataFrame:
    return summary.orderBy(col("total_plays").desc_nulls_last(), "show_name", "platform")


# ------------------------------------------ documented dashboard questions
def views_by_platform_30d(engagement: DataFrame, as_of: str = AS_OF) -> DataFrame:
    return (engagement.where(_since("metric_date", as_of, 30))
            .groupBy("platform").agg(F.sum("views").alias("views")))


def top10_by_engagement(engagement: DataFrame, k: int = 10) -> DataFrame:
    eng = F.sum(col("likes") + col("comments") + col("shares"))
    return (engagement.groupBy("content_key", "platform").agg(eng.alias("engagement"))
            .orderBy(col("engagement").desc(), col("content_key").asc()).limit(k))


def views_trend(engagement: DataFrame) -> DataFrame:
    return engagement.groupBy("metric_date").agg(F.sum("views").alias("views")).orderBy("metric_date")


def platform_share(engagement: DataFrame) -> DataFrame:
    """Each platform's share of all views: totals per platform, share over the
    (tiny, one row per platform) result via an unpartitioned window."""
    per = engagement.groupBy("platform").agg(F.sum("views").alias("views"))
    return per.select("platform", "views",
                      (col("views").cast("double") / F.sum("views").over(Window.partitionBy()) * 100)
                      .alias("share_pct"))


def monthly_revenue_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select("year_month", "revenue").orderBy("year_month")


def revenue_by_product(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("product_name").agg(cents_to_dollars(F.sum("amount_cents")).alias("revenue"),
                                               F.count(F.lit(1)).alias("charges"))


def customers_over_time(customers: DataFrame) -> DataFrame:
    """New customers per month and the running total (window over months)."""
    per = customers.groupBy(F.date_format("created_at", "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("new_customers"))
    w = Window.orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("year_month", "new_customers", F.sum("new_customers").over(w).alias("total_customers"))


def avg_transaction_value(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy(F.date_format("created_at", "yyyy-MM").alias("year_month")).agg(
        safe_divide(F.sum("amount_cents"), F.count("amount_cents") * 100, None).alias("avg_transaction_value"))


def commits_per_week_by_repo(activity: DataFrame) -> DataFrame:
    return (activity.groupBy("repo_key", F.date_trunc("week", col("activity_date")).cast("date").alias("week"))
            .agg(F.sum("commits").alias("commits")))


def pr_merge_rate(activity: DataFrame) -> DataFrame:
    agg = activity.groupBy("repo_key").agg(F.sum("prs_opened").alias("prs_opened"),
                                           F.sum("prs_merged").alias("prs_merged"))
    return agg.select("repo_key", "prs_opened", "prs_merged",
                      F.when(col("prs_opened") > 0, col("prs_merged").cast("double") / col("prs_opened"))
                      .otherwise(F.lit(0.0)).alias("merge_rate"))


def issue_resolution_time(issues: DataFrame) -> DataFrame:
    secs = F.unix_timestamp(col("closed_at").cast("timestamp")) - F.unix_timestamp(col("created_at").cast("timestamp"))
    return (issues.where(col("closed_at").isNotNull()).groupBy("repo_full_name")
            .agg(F.avg(secs / 3600.0).alias("avg_hours_to_close"), F.count(F.lit(1)).alias("closed_issues")))


def contributor_activity(commits: DataFrame) -> DataFrame:
    return commits.groupBy("author_email").agg(
        F.count(F.lit(1)).alias("commits"), F.sum("lines_added").alias("lines_added"),
        F.countDistinct("repo_full_name").alias("repos"))


def engagement_rate_by_platform(daily_platform: DataFrame) -> DataFrame:
    agg = daily_platform.groupBy("platform").agg(F.sum("total_views").alias("views"),
                                                 F.sum("total_engagement").alias("engagement"))
    return agg.select("platform", "views", "engagement",
                      F.when(col("views") > 0, col("engagement").cast("double") / col("views") * 100)
                      .otherwise(F.lit(0.0)).alias("engagement_rate"))


def publish_frequency(content: DataFrame) -> DataFrame:
    return (content.where(col("published_at").isNotNull())
            .groupBy("platform", F.date_trunc("week", col("published_at")).cast("date").alias("week"))
            .agg(F.count(F.lit(1)).alias("items_published")))


def audience_growth(user_metrics: DataFrame) -> DataFrame:
    """Followers per snapshot date and the change from the previous snapshot.
    The window runs over the per-date totals (one row per day), not raw rows."""
    per = user_metrics.groupBy("metric_date").agg(F.sum("followers_count").alias("followers"))
    w = Window.orderBy("metric_date")
    return per.select("metric_date", "followers",
                      (col("followers") - F.lag("followers").over(w)).alias("followers_change"))
