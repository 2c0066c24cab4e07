"""Registration of every inventory operator as a (Spark, oracle) query pair."""

from __future__ import annotations

from castline.operators import staging as stg
from castline.plans.registry import register

# ------------------------------------------------------------------ P1-P23
_STAGING_DOUBLES = {
    "stg_spotify_daily_performance": ("avg_listen_seconds", "stream_through_rate"),
    "stg_youtube_daily_stats": ("watch_time_minutes", "avg_view_seconds", "minutes_per_view"),
    "stg_youtube_video_metrics": ("avg_view_duration_seconds",),
    "stg_linkedin_posts": ("engagement_rate",),
    "stg_stripe_charges": ("amount_dollars",),
    "stg_stripe_customers": ("balance_dollars",),
    "stg_stripe_subscriptions": ("amount_dollars",),
}

for _name in stg.STAGING:
    register(_name, (lambda n: lambda cat: stg.staged(cat, n))(_name),
             f"SELECT * FROM {_name}", _STAGING_DOUBLES.get(_name, ()))

# ------------------------------------------------------------- tool-1 marts
from castline.operators import content as ct  # noqa: E402
from castline.operators import dims as dm  # noqa: E402
from castline.operators import facts as fx  # noqa: E402
from castline.operators import marts as mt  # noqa: E402
from castline.plans import oracle_models as om  # noqa: E402

FULL = (None, None)      # all days of the sources


def S(cat, name):
    return stg.staged(cat, name)


def t1_content(cat):
    return ct.content_unified_mapped(S(cat, "stg_spotify_episodes"), S(cat, "stg_youtube_videos_json"),
                                     cat.raw("seed_content_mapping"))


def t1_perf(cat):
    return S(cat, "stg_spotify_daily_performance")


def t1_stats(cat):
    return S(cat, "stg_youtube_daily_stats")


register("content_unified_mapped", t1_content, "SELECT * FROM content_unified_mapped")
register("union_all_mapped", t1_content, "SELECT * FROM content_unified_mapped",
         note="O2: UNION ALL of the mapped branch and the two filtered unmapped branches")
register("src_table", lambda c: c.source("spotify", "episode_performance"),
         "SELECT * FROM raw_spotify_episode_performance", ("avg_listen_seconds",),
         note="S1: raw table resolved by (system, table)")
register("spotify_per_episode", lambda c: mt.spotify_per_episode(t1_perf(c)),
         "SELECT * FROM spotify_per_episode", ("avg_listen_seconds",))
register("youtube_per_video", lambda c: mt.youtube_per_video(t1_stats(c)),
         "SELECT * FROM youtube_per_video", ("total_watch_minutes", "avg_view_seconds"))
register("content_performance_join",
         lambda c: mt.content_performance_join(t1_content(c), mt.spotify_per_episode(t1_perf(c)),
                                               mt.youtube_per_video(t1_stats(c))),
         "SELECT * FROM content_performance_join", ("avg_listen_seconds", "total_watch_minutes", "avg_view_seconds"))
_MCP_D = ("avg_listen_seconds", "total_watch_minutes", "avg_view_seconds", "youtube_like_rate",
          "spotify_completion_rate")
register("mart_content_performance", lambda c: mt.mart_content_performance(t1_content(c), t1_perf(c), t1_stats(c)),
         "SELECT * FROM mart_content_performance", _MCP_D)
register("spotify_daily", lambda c: mt.spotify_daily(t1_perf(c)), "SELECT * FROM spotify_daily")
register("youtube_daily", lambda c: mt.youtube_daily(t1_stats(c)), "SELECT * FROM youtube_daily", ("watch_minutes",))
register("date_spine", lambda c: mt.date_spine(mt.spotify_daily(t1_perf(c)), mt.youtube_daily(t1_stats(c))),
         "SELECT * FROM date_spine")
register("mart_daily_metrics", lambda c: mt.mart_daily_metrics(t1_perf(c), t1_stats(c)),
         "SELECT * FROM mart_daily_metrics", ("youtube_watch_minutes",))
register("date_spine_join", lambda c: mt.date_spine_join(t1_perf(c), t1_stats(c)),
         "SELECT * FROM mart_daily_metrics", ("youtube_watch_minutes",))
register("platform_totals", lambda c: mt.platform_totals(t1_perf(c), t1_stats(c)), "SELECT * FROM platform_totals")
register("mart_platform_comparison",
         lambda c: mt.mart_platform_comparison(t1_perf(c), t1_stats(c), S(c, "stg_spotify_show_stats")),
         "SELECT * FROM mart_platform_comparison", ("avg_daily_consumption",))


# ---------------------------------------------------------- tool-2 star
def t2_content(cat):
    return ct.int_content_unified(S(cat, "stg_youtube_videos"), S(cat, "stg_twitch_streams"),
                                  S(cat, "stg_twitter_tweets"), S(cat, "stg_linkedin_posts"))


def t2_dim_content(cat):
    return dm.dim_content(t2_content(cat), dm.dim_platform(dm.platform_seed(cat.spark)))


def t2_dim_repo(cat):
    return dm.dim_repository(S(cat, "stg_github_repos"))


def t2_engagement(cat, start=FULL[0], end=FULL[1]):
    return fx.fact_daily_engagement(S(cat, "stg_youtube_video_metrics"), S(cat, "stg_twitter_tweets"),
                                    S(cat, "stg_linkedin_posts"), S(cat, "stg_twitch_streams"), start, end)


def t2_gh(cat):
    return S(cat, "stg_github_commits"), S(cat, "stg_github_pull_requests"), S(cat, "stg_github_issues")


register("int_content_unified", t2_content, "SELECT * FROM int_content_unified")
register("union_all_platforms", t2_content, "SELECT * FROM int_content_unified",
         note="O1: the 4-way UNION ALL is the body of int_content_unified")
register("dim_content", t2_dim_content, "SELECT * FROM dim_content")
register("platform_lookup", t2_dim_content, "SELECT * FROM dim_content", note="JN6")
register("dim_repository", t2_dim_repo, "SELECT * FROM dim_repository")
for _plat, _fn, _stg in (("youtube", fx.youtube_daily_platform, "stg_youtube_video_metrics"),
                         ("twitter", fx.twitter_daily_platform, "stg_twitter_tweets"),
                         ("linkedin", fx.linkedin_daily_platform, "stg_linkedin_posts"),
                         ("twitch", fx.twitch_daily_platform, "stg_twitch_streams")):
    # One daily aggregate per platform (NULL dates kept here; A9 drops them).
    register(f"{_plat}_daily_platform", (lambda f, s: lambda c: f(S(c, s)))(_fn, _stg),
             f"SELECT * FROM {_plat}_daily_platform")
register("int_daily_platform_metrics",
         lambda c: fx.int_daily_platform_metrics(S(c, "stg_youtube_video_metrics"), S(c, "stg_twitter_tweets"),
                                                 S(c, "stg_linkedin_posts"), S(c, "stg_twitch_streams")),
         "SELECT * FROM int_daily_platform_metrics", ("avg_engagement_rate",))
register("fact_daily_engagement", t2_engagement, "SELECT * FROM fact_daily_engagement",
         ("avg_view_duration_seconds",))
register("fact_content_performance",
         lambda c: fx.fact_content_performance(t2_engagement(c), dm.calendar(c.spark), t2_dim_content(c)),
         "SELECT * FROM fact_content_performance", ("avg_daily_views",))
register("fact_dim_inner",
         lambda c: t2_engagement(c).join(dm.calendar(c.spark).select("date_key", "full_date", "year_month"),
                                         "date_key", "inner"),
         "SELECT e.*, d.full_date, d.year_month FROM fact_daily_engagement e JOIN dim_date d USING (date_key)",
         ("avg_view_duration_seconds",), note="JN7")
register("perf_dim_left",
         lambda c: fx.fact_content_performance(t2_engagement(c), dm.calendar(c.spark), t2_dim_content(c)),
         "SELECT * FROM fact_content_performance", ("avg_daily_views",), note="JN8")
register("commits_daily", lambda c: fx.commits_daily(t2_gh(c)[0], *FULL), "SELECT * FROM commits_daily")
register("prs_daily", lambda c: fx.prs_daily(t2_gh(c)[1], *FULL), "SELECT * FROM prs_daily")
register("issues_daily", lambda c: fx.issues_daily(t2_gh(c)[2], *FULL), "SELECT * FROM issues_daily")
register("full_outer_chain", lambda c: fx.full_outer_chain(*t2_gh(c), *FULL), "SELECT * FROM full_outer_chain")
register("repo_lookup", lambda c: fx.repo_lookup(fx.full_outer_chain(*t2_gh(c), *FULL), t2_dim_repo(c)),
         "SELECT * FROM fact_github_activity")
register("fact_github_activity", lambda c: fx.fact_github_activity(*t2_gh(c), t2_dim_repo(c), *FULL),
         "SELECT * FROM fact_github_activity")
register("fact_revenue", lambda c: fx.fact_revenue(S(c, "stg_stripe_charges"), *FULL),
         "SELECT * FROM fact_revenue", ("amount_dollars",))


# ------------------------------------------------------------------ reports
from castline.plans import oracle_reports as orp  # noqa: E402
from castline.plans import reports as rp  # noqa: E402


def mart_content(c):
    return mt.mart_content_performance(t1_content(c), t1_perf(c), t1_stats(c))


def mart_daily(c):
    return mt.mart_daily_metrics(t1_perf(c), t1_stats(c))


def mart_comparison(c):
    return mt.mart_platform_comparison(t1_perf(c), t1_stats(c), S(c, "stg_spotify_show_stats"))


def revenue(c):
    return fx.fact_revenue(S(c, "stg_stripe_charges"), *FULL)


def monthly(c):
    return rp.monthly_revenue(revenue(c), dm.calendar(c.spark))


def activity(c):
    return fx.fact_github_activity(*t2_gh(c), t2_dim_repo(c), *FULL)


def collector(c):
    return (c.raw("raw_podcasts"), c.raw("raw_podcast_episodes"), c.raw("raw_podcast_episode_metrics"),
            c.raw("raw_podcast_show_metrics"))


def latest(c):
    p, pe, pem, _ = collector(c)
    return rp.metrics_latest(pem, pe, p)


def summary(c, exact=False):
    p, pe, pem, psm = collector(c)
    return rp.performance_summary(p, pe, pem, psm, exact=exact)


_R = {
    "total_streams": (lambda c: rp.total_streams(mart_content(c)), ()),
    "total_views": (lambda c: rp.total_views(mart_content(c)), ()),
    "streams_30d": (lambda c: rp.streams_30d(mart_daily(c)), ()),
    "views_30d": (lambda c: rp.views_30d(mart_daily(c)), ()),
    "period_comparison": (lambda c: rp.period_comparison(mart_daily(c)), ()),
    "daily_trend": (lambda c: rp.daily_trend(mart_daily(c)), ()),
    "top_episodes": (lambda c: rp.top_episodes(mart_content(c)), ()),
    "top_videos": (lambda c: rp.top_videos(mart_content(c)), ()),
    "platform_pie": (lambda c: rp.platform_pie(mart_comparison(c)), ()),
    "content_table": (lambda c: rp.content_table(mart_content(c)), ()),
    "top_content_30d": (lambda c: rp.top_content_30d(t2_engagement(c), t2_dim_content(c), dm.calendar(c.spark)), ()),
    "monthly_revenue": (monthly, ("revenue",)),
    "yoy_self_join": (lambda c: rp.yoy_self_join(monthly(c)), ("revenue", "prior_year_revenue")),
    "yoy_growth": (lambda c: rp.yoy_growth(monthly(c)), ("current_revenue", "prior_year_revenue", "yoy_growth_pct")),
    "weekly_platform": (lambda c: rp.weekly_platform(t2_engagement(c), dm.calendar(c.spark)), ("avg_duration",)),
    "metrics_latest": (latest, ("completion_rate",)),
    "latest_sorted": (lambda c: rp.latest_sorted(latest(c)), ("completion_rate",)),
    "performance_summary": (summary, ("avg_completion_rate",)),
    "summary_sorted": (lambda c: rp.summary_sorted(summary(c)), ("avg_completion_rate",)),
    "performance_summary_exact": (lambda c: summary(c, exact=True), ("avg_completion_rate",)),
    "top_podcast_episodes": (lambda c: rp.top_podcast_episodes(c.raw("raw_podcast_episode_metrics"),
                                                               c.raw("raw_podcast_episodes"), c.raw("raw_podcasts")),
                             ("avg_completion",)),
    "comment_stats": (lambda c: rp.comment_stats(c.raw("raw_podcast_comments"), c.raw("raw_podcast_episodes"),
                                                 c.raw("raw_podcasts")), ("avg_comment_likes",)),
    "comment_threads": (lambda c: rp.comment_threads(c.raw("raw_podcast_comments"), c.raw("raw_podcast_episodes")),
                        ()),
    "failed_runs": (lambda c: rp.failed_runs(c.raw("raw_podcast_scraper_runs")), ()),
    "views_by_platform_30d": (lambda c: rp.views_by_platform_30d(t2_engagement(c)), ()),
    "top10_by_engagement": (lambda c: rp.top10_by_engagement(t2_engagement(c)), ()),
    "views_trend": (lambda c: rp.views_trend(t2_engagement(c)), ()),
    "platform_share": (lambda c: rp.platform_share(t2_engagement(c)), ("share_pct",)),
    "monthly_revenue_trend": (lambda c: rp.monthly_revenue_trend(monthly(c)), ("revenue",)),
    "revenue_by_product": (lambda c: rp.revenue_by_product(revenue(c)), ("revenue",)),
    "customers_over_time": (lambda c: rp.customers_over_time(S(c, "stg_stripe_customers")), ()),
    "avg_transaction_value": (lambda c: rp.avg_transaction_value(revenue(c)), ("avg_transaction_value",)),
    "commits_per_week_by_repo": (lambda c: rp.commits_per_week_by_repo(activity(c)), ()),
    "pr_merge_rate": (lambda c: rp.pr_merge_rate(activity(c)), ("merge_rate",)),
    "issue_resolution_time": (lambda c: rp.issue_resolution_time(S(c, "stg_github_issues")), ("avg_hours_to_close",)),
    "contributor_activity": (lambda c: rp.contributor_activity(S(c, "stg_github_commits")), ()),
    "engagement_rate_by_platform": (lambda c: rp.engagement_rate_by_platform(
        fx.int_daily_platform_metrics(S(c, "stg_youtube_video_metrics"), S(c, "stg_twitter_tweets"),
                                      S(c, "stg_linkedin_posts"), S(c, "stg_twitch_streams"))), ("engagement_rate",)),
    "publish_frequency": (lambda c: rp.publish_frequency(t2_content(c)), ()),
    "audience_growth": (lambda c: rp.audience_growth(S(c, "stg_twitter_user_metrics")), ()),
}
for _name, (_fn, _dbl) in _R.items():
    register(_name, _fn, orp.REPORTS[_name], _dbl)
