"""DuckDB oracle SQL for reports, dashboard cards and collector views."""

from __future__ import annotations

from castline.plans.oracle import AS_OF, MODELS

D = f"DATE '{AS_OF}'"

MODELS["mart_daily_metrics_t"] = "SELECT * FROM mart_daily_metrics"

REPORTS: dict[str, str] = {
    "total_streams": "SELECT cast(sum(total_streams) AS bigint) AS total_streams FROM mart_content_performance",
    "total_views": "SELECT cast(sum(total_views) AS bigint) AS total_views FROM mart_content_performance",
    "streams_30d": f"""SELECT cast(sum(spotify_streams) AS bigint) AS streams FROM mart_daily_metrics
        WHERE metric_date >= {D} - INTERVAL 30 DAY""",
    "views_30d": f"""SELECT cast(sum(youtube_views) AS bigint) AS views FROM mart_daily_metrics
        WHERE metric_date >= {D} - INTERVAL 30 DAY""",
    "period_comparison": f"""
        SELECT cast(sum(CASE WHEN metric_date >= {D} - INTERVAL 30 DAY AND metric_date <= {D} THEN spotify_streams END) AS bigint) AS streams_current,
               cast(sum(CASE WHEN metric_date >= {D} - INTERVAL 60 DAY AND metric_date < {D} - INTERVAL 30 DAY THEN spotify_streams END) AS bigint) AS streams_previous,
               cast(sum(CASE WHEN metric_date >= {D} - INTERVAL 30 DAY AND metric_date <= {D} THEN youtube_views END) AS bigint) AS views_current,
               cast(sum(CASE WHEN metric_date >= {D} - INTERVAL 60 DAY AND metric_date < {D} - INTERVAL 30 DAY THEN youtube_views END) AS bigint) AS views_previous
        FROM mart_daily_metrics WHERE metric_date >= {D} - INTERVAL 60 DAY""",
    "daily_trend": f"""SELECT metric_date, spotify_streams, youtube_views FROM mart_daily_metrics
        WHERE metric_date >= {D} - INTERVAL 90 DAY ORDER BY metric_date""",
    "top_episodes": """SELECT title, total_streams FROM mart_content_performance WHERE total_streams > 0
        ORDER BY total_streams DESC, title ASC NULLS LAST, content_id LIMIT 10""",
    "top_videos": """SELECT title, total_views FROM mart_content_performance WHERE total_views > 0
        ORDER BY total_views DESC, title ASC NULLS LAST, content_id LIMIT 10""",
    "platform_pie": "SELECT platform, total_consumption FROM mart_platform_comparison",
    "content_table": """SELECT title, published_date, content_source, total_streams, total_views, total_consumption
        FROM mart_content_performance ORDER BY total_consumption DESC""",
    "top_content_30d": f"""
        SELECT c.title, c.platform, c.url, cast(sum(f.views) AS bigint) AS total_views,
               cast(sum(f.likes) AS bigint) AS total_likes, cast(sum(f.comments) AS bigint) AS total_comments
        FROM fact_daily_engagement f JOIN dim_content c ON f.content_key = c.content_key
        JOIN dim_date d ON f.date_key = d.date_key
        WHERE d.full_date >= {D} - INTERVAL 30 DAY
        GROUP BY c.content_key, c.title, c.platform, c.url
        ORDER BY total_views DESC, c.content_key LIMIT 20""",
    "monthly_revenue": "SELECT * FROM monthly_revenue",
    "yoy_self_join": """SELECT c.*, l.year AS ly_year, l.month AS ly_month, l.revenue AS prior_year_revenue
        FROM monthly_revenue c LEFT JOIN monthly_revenue l ON c.year = l.year + 1 AND c.month = l.month""",
    "yoy_growth": """
        SELECT c.year_month, c.revenue AS current_revenue, l.revenue AS prior_year_revenue,
               round((c.revenue - l.revenue) / nullif(l.revenue, 0) * 100, 1) AS yoy_growth_pct
        FROM monthly_revenue c LEFT JOIN monthly_revenue l ON c.year = l.year + 1 AND c.month = l.month
        ORDER BY c.year_month DESC""",
    "weekly_platform": """
        SELECT f.platform, cast(date_trunc('week', d.full_date) AS date) AS week, cast(sum(f.views) AS bigint) AS views,
               cast(sum(f.likes) AS bigint) AS likes, avg(f.avg_view_duration_seconds) AS avg_duration
        FROM fact_daily_engagement f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2 ORDER BY 1, 2""",
    "metrics_latest": "SELECT * FROM podcast_metrics_latest",
    "latest_sorted": "SELECT * FROM podcast_metrics_latest ORDER BY metric_date DESC",
    "performance_summary": "SELECT * FROM podcast_performance_summary",
    "summary_sorted": "SELECT * FROM podcast_performance_summary ORDER BY total_plays DESC NULLS LAST",
    "performance_summary_exact": f"""
        WITH em AS (
          SELECT pe.podcast_id, count(DISTINCT pe.id) AS n_episodes, sum(pem.plays) AS plays,
                 sum(pem.listeners) AS listeners, sum(pem.views) AS views, sum(pem.downloads) AS downloads,
                 sum(pem.comments_count) AS comments_count, sum(pem.likes) AS likes,
                 sum(pem.completion_rate) AS cr_sum, count(pem.completion_rate) AS cr_cnt
          FROM raw_podcast_episode_metrics pem JOIN raw_podcast_episodes pe ON pem.episode_id = pe.id
          WHERE pem.metric_date >= {D} - INTERVAL 30 DAY GROUP BY 1),
        sm AS (SELECT podcast_id, max(followers_total) AS mf, max(subscribers_total) AS ms
               FROM raw_podcast_show_metrics GROUP BY 1)
        SELECT p.show_name, p.platform, cast(sum(n_episodes) AS bigint) AS total_episodes,
               cast(sum(plays) AS bigint) AS total_plays, cast(sum(listeners) AS bigint) AS total_listeners,
               cast(sum(views) AS bigint) AS total_views, cast(sum(downloads) AS bigint) AS total_downloads,
               sum(cr_sum) / nullif(sum(cr_cnt), 0) AS avg_completion_rate,
               cast(sum(comments_count) AS bigint) AS total_comments, cast(sum(likes) AS bigint) AS total_likes,
               max(mf) AS latest_followers, max(ms) AS latest_subscribers
        FROM em JOIN raw_podcasts p ON em.podcast_id = p.id LEFT JOIN sm ON em.podcast_id = sm.podcast_id
        GROUP BY p.show_name, p.platform""",
    "top_podcast_episodes": f"""
        SELECT p.platform, pe.episode_title, cast(sum(pem.plays) AS bigint) AS total_plays,
               cast(sum(pem.views) AS bigint) AS total_views, avg(pem.completion_rate) AS avg_completion
        FROM raw_podcast_episode_metrics pem JOIN raw_podcast_episodes pe ON pem.episode_id = pe.id
        JOIN raw_podcasts p ON pe.podcast_id = p.id
        WHERE pem.metric_date >= {D} - INTERVAL 30 DAY
        GROUP BY p.platform, pe.episode_title ORDER BY total_plays DESC, p.platform, pe.episode_title LIMIT 10""",
    "comment_stats": """
        SELECT pe.episode_title, count(*) AS comment_count, avg(pc.likes_count) AS avg_comment_likes
        FROM raw_podcast_comments pc JOIN raw_podcast_episodes pe ON pc.episode_id = pe.id
        JOIN raw_podcasts p ON pe.podcast_id = p.id WHERE p.platform = 'youtube'
        GROUP BY pe.episode_title ORDER BY comment_count DESC, pe.episode_title""",
    "comment_threads": """
        SELECT c.episode_id, e.episode_title, c.platform_comment_id, c.author_name, c.likes_count,
               c.parent_platform_comment_id, pa.author_name AS parent_author_name,
               pa.platform_comment_id IS NOT NULL AS has_parent
        FROM raw_podcast_comments c
        LEFT JOIN raw_podcast_comments pa ON c.episode_id = pa.episode_id
             AND c.parent_platform_comment_id = pa.platform_comment_id
        LEFT JOIN raw_podcast_episodes e ON c.episode_id = e.id""",
    "failed_runs": "SELECT * FROM raw_podcast_scraper_runs WHERE status = 'failed' ORDER BY run_started_at DESC, id",
    # documented dashboard questions
    "views_by_platform_30d": f"""SELECT platform, cast(sum(views) AS bigint) AS views FROM fact_daily_engagement
        WHERE metric_date >= {D} - INTERVAL 30 DAY GROUP BY 1""",
    "top10_by_engagement": """SELECT content_key, platform, cast(sum(likes + comments + shares) AS bigint) AS engagement
        FROM fact_daily_engagement GROUP BY 1, 2 ORDER BY engagement DESC, content_key LIMIT 10""",
    "views_trend": "SELECT metric_date, cast(sum(views) AS bigint) AS views FROM fact_daily_engagement GROUP BY 1 ORDER BY 1",
    "platform_share": """SELECT platform, views, cast(views AS double) / sum(views) OVER () * 100 AS share_pct
        FROM (SELECT platform, cast(sum(views) AS bigint) AS views FROM fact_daily_engagement GROUP BY 1) t""",
    "monthly_revenue_trend": "SELECT year_month, revenue FROM monthly_revenue ORDER BY year_month",
    "revenue_by_product": """SELECT product_name, sum(amount_cents) / 100.0::double AS revenue, count(*) AS charges
        FROM fact_revenue GROUP BY 1""",
    "customers_over_time": """SELECT year_month, new_customers,
               cast(sum(new_customers) OVER (ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS total_customers
        FROM (SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS new_customers
              FROM stg_stripe_customers GROUP BY 1) t""",
    "avg_transaction_value": """SELECT strftime(created_at, '%Y-%m') AS year_month,
               sum(amount_cents)::double / (count(amount_cents) * 100) AS avg_transaction_value FROM fact_revenue GROUP BY 1""",
    "commits_per_week_by_repo": """SELECT repo_key, cast(date_trunc('week', activity_date) AS date) AS week,
               cast(sum(commits) AS bigint) AS commits FROM fact_github_activity GROUP BY 1, 2""",
    "pr_merge_rate": """SELECT repo_key, prs_opened, prs_merged,
               CASE WHEN prs_opened > 0 THEN cast(prs_merged AS double) / prs_opened ELSE 0.0 END AS merge_rate
        FROM (SELECT repo_key, cast(sum(prs_opened) AS bigint) AS prs_opened, cast(sum(prs_merged) AS bigint) AS prs_merged
              FROM fact_github_activity GROUP BY 1) t""",
    "issue_resolution_time": """SELECT repo_full_name,
               avg((epoch(closed_at) - epoch(created_at)) / 3600.0) AS avg_hours_to_close, count(*) AS closed_issues
        FROM stg_github_issues WHERE closed_at IS NOT NULL GROUP BY 1""",
    "contributor_activity": """SELECT author_email, count(*) AS commits, cast(sum(lines_added) AS bigint) AS lines_added,
               count(DISTINCT repo_full_name) AS repos FROM stg_github_commits GROUP BY 1""",
    "engagement_rate_by_platform": """SELECT platform, views, engagement,
               CASE WHEN views > 0 THEN cast(engagement AS double) / views * 100 ELSE 0.0 END AS engagement_rate
        FROM (SELECT platform, cast(sum(total_views) AS bigint) AS views, cast(sum(total_engagement) AS bigint) AS engagement
              FROM int_daily_platform_metrics GROUP BY 1) t""",
    "publish_frequency": """SELECT platform, cast(date_trunc('week', published_at) AS date) AS week,
               count(*) AS items_published FROM int_content_unified WHERE published_at IS NOT NULL GROUP BY 1, 2""",
    "audience_growth": """SELECT metric_date, followers, followers - lag(followers) OVER (ORDER BY metric_date) AS followers_change
        FROM (SELECT metric_date, cast(sum(followers_count) AS bigint) AS followers
              FROM stg_twitter_user_metrics GROUP BY 1) t""",
}

MODELS["monthly_revenue"] = """
SELECT d.year, d.month, d.year_month, sum(f.amount_cents) / 100.0::double AS revenue
FROM fact_revenue f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month, d.year_month"""

MODELS["podcast_metrics_latest"] = f"""
SELECT p.show_name, p.platform, pe.episode_title, pe.publish_date, pem.metric_date, pem.plays, pem.listeners,
       pem.engaged_listeners, pem.views, pem.likes, pem.comments_count, pem.completion_rate, pem.top_countries,
       pem.top_cities
FROM raw_podcast_episode_metrics pem JOIN raw_podcast_episodes pe ON pem.episode_id = pe.id
JOIN raw_podcasts p ON pe.podcast_id = p.id
WHERE pem.metric_date >= {D} - INTERVAL 30 DAY"""

# The reference view, fan-out included (literal).
MODELS["podcast_performance_summary"] = f"""
SELECT p.show_name, p.platform, count(DISTINCT pe.id) AS total_episodes,
       cast(sum(pem.plays) AS bigint) AS total_plays, cast(sum(pem.listeners) AS bigint) AS total_listeners,
       cast(sum(pem.views) AS bigint) AS total_views, cast(sum(pem.downloads) AS bigint) AS total_downloads,
       avg(pem.completion_rate) AS avg_completion_rate, cast(sum(pem.comments_count) AS bigint) AS total_comments,
       cast(sum(pem.likes) AS bigint) AS total_likes, max(psm.followers_total) AS latest_followers,
       max(psm.subscribers_total) AS latest_subscribers
FROM raw_podcasts p
LEFT JOIN raw_podcast_episodes pe ON p.id = pe.podcast_id
LEFT JOIN raw_podcast_episode_metrics pem ON pe.id = pem.episode_id
LEFT JOIN raw_podcast_show_metrics psm ON p.id = psm.podcast_id
WHERE pem.metric_date >= {D} - INTERVAL 30 DAY
GROUP BY p.show_name, p.platform"""
