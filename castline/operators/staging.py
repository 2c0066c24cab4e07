"""Staging (P1-P23): rename, cast, default, derive, drop NULL keys.

Each function is a pure projection (+ at most one filter) over one raw
table, so Catalyst fuses it into the Parquet scan stage: column pruning and
``IS NOT NULL`` pushdown reach the reader and no shuffle is introduced.
Non-deterministic audit columns (load timestamps) are added by writers only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castline.functions import (cents_to_dollars, epoch_to_timestamp, int_or_zero, json_text, parse_hms_duration,
                                parse_iso_duration)

col = F.col


def _ts(name: str) -> Column:
    return col(name).cast("timestamp_ntz")


# --------------------------------------------------------------------- tool 1
def stg_spotify_episodes(raw: DataFrame) -> DataFrame:
    """Ms → s by integer division (the source column is INTEGER)."""
    return raw.select(
        col("id").alias("episode_id"),
        col("name").alias("title"),
        col("release_date").cast("date").alias("published_date"),
        F.expr("duration_ms div 1000").cast("int").alias("duration_seconds"),
        col("description"),
        col("explicit").alias("is_explicit"),
        col("uri").alias("spotify_uri"),
        json_text("external_urls", "spotify").alias("spotify_url"),
    )


def stg_spotify_daily_performance(raw: DataFrame) -> DataFrame:
    """Stream-through rate = streams / starts when starts > 0, else 0."""
    return raw.select(
        col("episode_id"),
        col("date").cast("date").alias("metric_date"),
        col("starts"), col("streams"),
        col("listeners").alias("unique_listeners"),
        col("avg_listen_seconds").cast("double").alias("avg_listen_seconds"),
        F.when(col("starts") > 0, col("streams").cast("double") / col("starts").cast("double"))
         .otherwise(F.lit(0.0)).alias("stream_through_rate"),
    )


def stg_spotify_show_stats(raw: DataFrame) -> DataFrame:
    """P3."""
    return raw.select(
        col("date").cast("date").alias("stats_date"),
        col("total_streams"), col("followers"), col("total_listeners"),
    )


def stg_youtube_videos_json(raw: DataFrame) -> DataFrame:
    """Fields of the ``snippet`` / ``content_details`` JSON documents."""
    return raw.select(
        col("id").alias("video_id"),
        json_text("snippet", "title").alias("title"),
        json_text("snippet", "publishedAt").cast("date").alias("published_date"),
        json_text("snippet", "description").alias("description"),
        json_text("snippet", "channelId").alias("channel_id"),
        json_text("snippet", "channelTitle").alias("channel_title"),
        parse_iso_duration(json_text("content_details", "duration")).alias("duration_seconds"),
        json_text("content_details", "definition").alias("video_definition"),
    )


def stg_youtube_daily_stats(raw: DataFrame) -> DataFrame:
    """P5: minutes per view guarded against zero views."""
    return raw.select(
        col("video_id"),
        col("date").cast("date").alias("metric_date"),
        col("views"),
        col("watch_time_minutes").cast("double").alias("watch_time_minutes"),
        col("average_view_duration").cast("double").alias("avg_view_seconds"),
        col("likes"), col("comments"),
        F.when(col("views") > 0, col("watch_time_minutes").cast("double") / col("views").cast("double"))
         .otherwise(F.lit(0.0)).alias("minutes_per_view"),
    )


# --------------------------------------------------------------------- tool 2
def stg_youtube_videos(raw: DataFrame) -> DataFrame:
    """P6."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("video_id"),
        col("snippet_title").alias("title"),
        col("snippet_description").alias("description"),
        col("snippet_channel_id").alias("channel_id"),
        col("snippet_channel_title").alias("channel_name"),
        col("snippet_category_id").alias("category_id"),
        col("snippet_tags").alias("tags"),
        _ts("snippet_published_at").alias("published_at"),
        int_or_zero("statistics_view_count", "bigint").alias("view_count"),
        int_or_zero("statistics_like_count", "bigint").alias("like_count"),
        int_or_zero("statistics_comment_count", "bigint").alias("comment_count"),
        col("content_details_duration").alias("duration_iso"),
        F.concat(F.lit("https://youtube.com/watch?v="), col("id")).alias("video_url"),
        col("snippet_thumbnails_default_url").alias("thumbnail_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_youtube_video_metrics(raw: DataFrame) -> DataFrame:
    """Watch time in seconds; average view duration guarded."""
    views = int_or_zero("views", "bigint")
    watch_s = int_or_zero("estimated_minutes_watched", "bigint") * 60
    return raw.where(col("video_id").isNotNull() & col("date").isNotNull()).select(
        col("video_id"),
        col("date").cast("date").alias("metric_date"),
        views.alias("views"),
        watch_s.alias("watch_time_seconds"),
        int_or_zero("likes", "bigint").alias("likes"),
        int_or_zero("comments", "bigint").alias("comments"),
        int_or_zero("shares", "bigint").alias("shares"),
        int_or_zero("dislikes", "bigint").alias("dislikes"),
        F.when((views == 0) | col("views").isNull(), F.lit(0.0))
         .otherwise(watch_s.cast("double") / col("views").cast("double")).alias("avg_view_duration_seconds"),
        int_or_zero("subscribers_gained").alias("subscribers_gained"),
        int_or_zero("subscribers_lost").alias("subscribers_lost"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_youtube_channel_stats(raw: DataFrame) -> DataFrame:
    """Snapshot date = extraction date."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("channel_id"),
        col("snippet_title").alias("channel_name"),
        col("snippet_description").alias("description"),
        col("snippet_custom_url").alias("custom_url"),
        col("snippet_country").alias("country"),
        int_or_zero("statistics_subscriber_count", "bigint").alias("subscriber_count"),
        int_or_zero("statistics_video_count", "bigint").alias("video_count"),
        int_or_zero("statistics_view_count", "bigint").alias("view_count"),
        F.coalesce(col("statistics_hidden_subscriber_count").cast("boolean"), F.lit(False))
         .alias("is_subscriber_count_hidden"),
        _ts("snippet_published_at").alias("channel_created_at"),
        col("_airbyte_extracted_at").cast("date").alias("metric_date"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_twitch_streams(raw: DataFrame) -> DataFrame:
    """P9."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("stream_id"), col("user_id"), col("user_login"), col("user_name"),
        col("game_id"), col("game_name"), col("title"), col("type").alias("stream_type"),
        int_or_zero("viewer_count").alias("viewer_count"),
        _ts("started_at").alias("started_at"),
        col("language"),
        col("is_mature").cast("boolean").alias("is_mature"),
        F.concat(F.lit("https://twitch.tv/"), col("user_login")).alias("stream_url"),
        col("thumbnail_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_twitch_videos(raw: DataFrame) -> DataFrame:
    """P10: interval text → seconds, NULL → 0."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("video_id"), col("stream_id"), col("user_id"), col("user_login"), col("user_name"),
        col("title"), col("description"), col("type").alias("video_type"),
        col("duration").alias("duration_raw"),
        parse_hms_duration("duration").alias("duration_seconds"),
        int_or_zero("view_count").alias("view_count"),
        _ts("created_at").alias("created_at"),
        _ts("published_at").alias("published_at"),
        col("url").alias("video_url"), col("thumbnail_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_twitch_followers(raw: DataFrame) -> DataFrame:
    """P11."""
    return raw.where(col("from_id").isNotNull()).select(
        col("from_id").alias("follower_id"),
        col("from_login").alias("follower_login"),
        col("from_name").alias("follower_name"),
        _ts("followed_at").alias("followed_at"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_twitter_tweets(raw: DataFrame) -> DataFrame:
    """P12."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("tweet_id"), col("author_id"), col("conversation_id"), col("in_reply_to_user_id"),
        col("text"),
        int_or_zero("public_metrics_retweet_count").alias("retweet_count"),
        int_or_zero("public_metrics_reply_count").alias("reply_count"),
        int_or_zero("public_metrics_like_count").alias("like_count"),
        int_or_zero("public_metrics_quote_count").alias("quote_count"),
        int_or_zero("public_metrics_impression_count").alias("impression_count"),
        _ts("created_at").alias("created_at"),
        F.concat(F.lit("https://twitter.com/i/web/status/"), col("id")).alias("tweet_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_twitter_user_metrics(raw: DataFrame) -> DataFrame:
    """Snapshot date = extraction date."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("user_id"), col("username"), col("name").alias("display_name"),
        col("description").alias("bio"),
        int_or_zero("public_metrics_followers_count").alias("followers_count"),
        int_or_zero("public_metrics_following_count").alias("following_count"),
        int_or_zero("public_metrics_tweet_count").alias("tweet_count"),
        int_or_zero("public_metrics_listed_count").alias("listed_count"),
        col("verified").cast("boolean").alias("is_verified"),
        _ts("created_at").alias("account_created_at"),
        col("_airbyte_extracted_at").cast("date").alias("metric_date"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_linkedin_posts(raw: DataFrame) -> DataFrame:
    """A NULL impression count is treated as denominator 1."""
    imp = F.coalesce(col("total_share_statistics_impression_count").cast("int"), F.lit(1))
    engagement = (int_or_zero("total_share_statistics_like_count")
                  + int_or_zero("total_share_statistics_comment_count")
                  + int_or_zero("total_share_statistics_share_count"))
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("post_id"), col("author").alias("author_id"),
        F.coalesce(col("specific_content_share_commentary_text"), col("commentary")).alias("title"),
        col("text").alias("description"),
        col("content_landing_page_content_type").alias("content_type"),
        _ts("created_time").alias("published_at"),
        int_or_zero("total_share_statistics_impression_count").alias("impressions"),
        int_or_zero("total_share_statistics_click_count").alias("clicks"),
        int_or_zero("total_share_statistics_like_count").alias("likes"),
        int_or_zero("total_share_statistics_comment_count").alias("comments"),
        int_or_zero("total_share_statistics_share_count").alias("shares"),
        F.when(imp == 0, F.lit(0.0))
         .otherwise(engagement.cast("double") / imp.cast("double") * 100).alias("engagement_rate"),
        F.concat(F.lit("https://linkedin.com/feed/update/"), col("id")).alias("post_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_linkedin_page_stats(raw: DataFrame) -> DataFrame:
    """P15."""
    return raw.where(col("organization").isNotNull()).select(
        col("organization").alias("page_id"), col("organization_name").alias("page_name"),
        int_or_zero("follower_count").alias("follower_count"),
        int_or_zero("page_statistics_views_all_page_views").alias("page_views"),
        int_or_zero("page_statistics_views_unique_visitors").alias("unique_visitors"),
        col("time_range_start").cast("date").alias("metric_date"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_github_repos(raw: DataFrame) -> DataFrame:
    """P16."""
    b = lambda c: col(c).cast("boolean")
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("repo_id"), col("name").alias("repo_name"), col("full_name"),
        col("owner_login"), col("owner_id"), col("description"), col("homepage"), col("language"),
        col("topics"), col("html_url"), col("clone_url"), col("ssh_url"),
        b("private").alias("is_private"), b("fork").alias("is_fork"),
        b("archived").alias("is_archived"), b("disabled").alias("is_disabled"),
        b("has_issues").alias("has_issues_enabled"), b("has_wiki").alias("has_wiki_enabled"),
        b("has_pages").alias("has_pages_enabled"), b("has_downloads").alias("has_downloads_enabled"),
        int_or_zero("stargazers_count").alias("stargazers_count"),
        int_or_zero("watchers_count").alias("watchers_count"),
        int_or_zero("forks_count").alias("forks_count"),
        int_or_zero("open_issues_count").alias("open_issues_count"),
        int_or_zero("size").alias("size_kb"),
        col("license_key"), col("license_name"),
        _ts("created_at").alias("created_at"), _ts("updated_at").alias("updated_at"),
        _ts("pushed_at").alias("pushed_at"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_github_commits(raw: DataFrame) -> DataFrame:
    """P17."""
    return raw.where(col("sha").isNotNull()).select(
        col("sha").alias("commit_sha"), col("repository").alias("repo_full_name"),
        col("commit_author_name").alias("author_name"), col("commit_author_email").alias("author_email"),
        _ts("commit_author_date").alias("authored_at"),
        col("commit_committer_name").alias("committer_name"),
        _ts("commit_committer_date").alias("committed_at"),
        col("commit_message").alias("message"),
        int_or_zero("stats_additions").alias("lines_added"),
        int_or_zero("stats_deletions").alias("lines_deleted"),
        int_or_zero("stats_total").alias("lines_changed"),
        col("html_url").alias("commit_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_github_pull_requests(raw: DataFrame) -> DataFrame:
    """P18."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("pr_id"), col("number").alias("pr_number"), col("repository").alias("repo_full_name"),
        col("title"), col("body").alias("description"), col("state"),
        col("user_login").alias("author_login"), col("user_id").alias("author_id"),
        _ts("created_at").alias("created_at"), _ts("updated_at").alias("updated_at"),
        _ts("merged_at").alias("merged_at"), _ts("closed_at").alias("closed_at"),
        int_or_zero("additions").alias("lines_added"),
        int_or_zero("deletions").alias("lines_deleted"),
        int_or_zero("changed_files").alias("files_changed"),
        int_or_zero("commits").alias("commit_count"),
        int_or_zero("comments").alias("comment_count"),
        col("merged").cast("boolean").alias("is_merged"),
        col("draft").cast("boolean").alias("is_draft"),
        col("html_url").alias("pr_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_github_issues(raw: DataFrame) -> DataFrame:
    """Pull requests are also returned as issues — keep true issues only."""
    return raw.where(col("id").isNotNull() & col("pull_request").isNull()).select(
        col("id").alias("issue_id"), col("number").alias("issue_number"),
        col("repository").alias("repo_full_name"),
        col("title"), col("body"), col("state"),
        col("user_login").alias("author_login"), col("user_id").alias("author_id"),
        col("labels"), col("assignees"),
        _ts("created_at").alias("created_at"), _ts("updated_at").alias("updated_at"),
        _ts("closed_at").alias("closed_at"),
        int_or_zero("comments").alias("comment_count"),
        col("pull_request").isNotNull().alias("is_pull_request"),
        col("html_url").alias("issue_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_stripe_charges(raw: DataFrame) -> DataFrame:
    """P20: cents → dollars; epoch seconds → timestamp."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("charge_id"), col("customer").alias("customer_id"),
        col("amount").alias("amount_cents"),
        cents_to_dollars("amount").alias("amount_dollars"),
        col("currency"), col("status"),
        col("paid").cast("boolean").alias("is_paid"),
        col("refunded").cast("boolean").alias("is_refunded"),
        col("description"), col("receipt_email"),
        col("invoice").alias("invoice_id"),
        epoch_to_timestamp("created").alias("created_at"),
        col("failure_code"), col("failure_message"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_stripe_customers(raw: DataFrame) -> DataFrame:
    """P21."""
    bal = int_or_zero("balance")
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("customer_id"), col("email"), col("name"), col("phone"), col("description"),
        col("address_city").alias("city"), col("address_country").alias("country"),
        col("address_postal_code").alias("postal_code"), col("currency"),
        bal.alias("balance_cents"),
        cents_to_dollars(bal).alias("balance_dollars"),
        col("delinquent").cast("boolean").alias("is_delinquent"),
        col("default_source"),
        epoch_to_timestamp("created").alias("created_at"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_stripe_subscriptions(raw: DataFrame) -> DataFrame:
    """Epoch 0 means "not set" for cancellation / end."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("subscription_id"), col("customer").alias("customer_id"), col("status"),
        col("plan_id"), col("plan_nickname").alias("plan_name"),
        col("plan_amount").alias("amount_cents"),
        cents_to_dollars("plan_amount").alias("amount_dollars"),
        col("plan_currency").alias("currency"), col("plan_interval").alias("interval"),
        col("plan_interval_count").alias("interval_count"),
        epoch_to_timestamp("current_period_start").alias("current_period_start"),
        epoch_to_timestamp("current_period_end").alias("current_period_end"),
        col("cancel_at_period_end").cast("boolean").alias("cancel_at_period_end"),
        epoch_to_timestamp(F.nullif(col("canceled_at"), F.lit(0))).alias("canceled_at"),
        epoch_to_timestamp(F.nullif(col("ended_at"), F.lit(0))).alias("ended_at"),
        epoch_to_timestamp("created").alias("created_at"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


def stg_notion_pages(raw: DataFrame) -> DataFrame:
    """First non-NULL parent id."""
    return raw.where(col("id").isNotNull()).select(
        col("id").alias("page_id"),
        col("properties_title_title_0_plain_text").alias("title"),
        col("parent_type"),
        F.coalesce(col("parent_database_id"), col("parent_page_id"), col("parent_workspace")).alias("parent_id"),
        col("created_by_id").alias("created_by"), col("last_edited_by_id").alias("last_edited_by"),
        _ts("created_time").alias("created_at"), _ts("last_edited_time").alias("last_edited_at"),
        col("archived").cast("boolean").alias("is_archived"),
        col("url").alias("page_url"),
        col("_airbyte_extracted_at").alias("extracted_at"),
    )


# name → (function, raw table)
STAGING = {
    "stg_spotify_episodes": (stg_spotify_episodes, "raw_spotify_episodes"),
    "stg_spotify_daily_performance": (stg_spotify_daily_performance, "raw_spotify_episode_performance"),
    "stg_spotify_show_stats": (stg_spotify_show_stats, "raw_spotify_show_stats"),
    "stg_youtube_videos_json": (stg_youtube_videos_json, "raw_youtube_videos"),
    "stg_youtube_daily_stats": (stg_youtube_daily_stats, "raw_youtube_daily_stats"),
    "stg_youtube_videos": (stg_youtube_videos, "raw_youtube_videos_flat"),
    "stg_youtube_video_metrics": (stg_youtube_video_metrics, "raw_youtube_video_metrics"),
    "stg_youtube_channel_stats": (stg_youtube_channel_stats, "raw_youtube_channel_stats"),
    "stg_twitch_streams": (stg_twitch_streams, "raw_twitch_streams"),
    "stg_twitch_videos": (stg_twitch_videos, "raw_twitch_videos"),
    "stg_twitch_followers": (stg_twitch_followers, "raw_twitch_followers"),
    "stg_twitter_tweets": (stg_twitter_tweets, "raw_twitter_tweets"),
    "stg_twitter_user_metrics": (stg_twitter_user_metrics, "raw_twitter_user_metrics"),
    "stg_linkedin_posts": (stg_linkedin_posts, "raw_linkedin_posts"),
    "stg_linkedin_page_stats": (stg_linkedin_page_stats, "raw_linkedin_page_stats"),
    "stg_github_repos": (stg_github_repos, "raw_github_repositories"),
    "stg_github_commits": (stg_github_commits, "raw_github_commits"),
    "stg_github_pull_requests": (stg_github_pull_requests, "raw_github_pull_requests"),
    "stg_github_issues": (stg_github_issues, "raw_github_issues"),
    "stg_stripe_charges": (stg_stripe_charges, "raw_stripe_charges"),
    "stg_stripe_customers": (stg_stripe_customers, "raw_stripe_customers"),
    "stg_stripe_subscriptions": (stg_stripe_subscriptions, "raw_stripe_subscriptions"),
    "stg_notion_pages": (stg_notion_pages, "raw_notion_pages"),
}


def staged(catalog, name: str) -> DataFrame:
    fn, raw_name = STAGING[name]
    return fn(catalog.raw(raw_name))
