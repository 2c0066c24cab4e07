"""Declared schemas of the landed raw tables (DDL strings).

A sync writes these tables; readers always apply the declared schema instead
of inferring one, so a missing column reads as NULL and a changed type fails
loudly.  ``tests/test_sources.py`` keeps them equal to the test bindings.
"""

RAW_SCHEMAS: dict[str, str] = {
    "raw_spotify_episodes": (
        "id string, name string, description string, release_date date, duration_ms int, "
        "explicit boolean, uri string, external_urls string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_spotify_episode_performance": (
        "episode_id string, date date, starts int, streams int, listeners int, avg_listen_seconds double, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_spotify_show_stats": (
        "date date, total_streams bigint, followers int, total_listeners bigint, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_youtube_videos": (
        "id string, snippet string, content_details string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_youtube_daily_stats": (
        "video_id string, date date, views int, watch_time_minutes double, average_view_duration double, "
        "likes int, comments int, _airbyte_extracted_at timestamp_ntz"
    ),
    "seed_content_mapping": (
        "content_id string, episode_id string, video_id string"
    ),
    "raw_youtube_videos_flat": (
        "id string, snippet_title string, snippet_description string, snippet_channel_id string, "
        "snippet_channel_title string, snippet_category_id string, snippet_tags string, "
        "snippet_published_at timestamp_ntz, statistics_view_count string, statistics_like_count string, "
        "statistics_comment_count string, content_details_duration string, "
        "snippet_thumbnails_default_url string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_youtube_video_metrics": (
        "video_id string, date date, views bigint, estimated_minutes_watched bigint, likes int, "
        "comments int, shares int, dislikes int, subscribers_gained int, subscribers_lost int, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_youtube_channel_stats": (
        "id string, snippet_title string, snippet_description string, snippet_custom_url string, "
        "snippet_country string, statistics_subscriber_count string, statistics_video_count string, "
        "statistics_view_count string, statistics_hidden_subscriber_count string, "
        "snippet_published_at timestamp_ntz, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_twitch_streams": (
        "id string, user_id string, user_login string, user_name string, game_id string, "
        "game_name string, title string, type string, viewer_count int, started_at timestamp_ntz, "
        "language string, is_mature boolean, thumbnail_url string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_twitch_videos": (
        "id string, stream_id string, user_id string, user_login string, user_name string, title string, "
        "description string, type string, duration string, view_count int, created_at timestamp_ntz, "
        "published_at timestamp_ntz, url string, thumbnail_url string, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_twitch_followers": (
        "from_id string, from_login string, from_name string, followed_at timestamp_ntz, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_twitter_tweets": (
        "id string, author_id string, conversation_id string, in_reply_to_user_id string, text string, "
        "public_metrics_retweet_count int, public_metrics_reply_count int, public_metrics_like_count int, "
        "public_metrics_quote_count int, public_metrics_impression_count int, created_at timestamp_ntz, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_twitter_user_metrics": (
        "id string, username string, name string, description string, public_metrics_followers_count int, "
        "public_metrics_following_count int, public_metrics_tweet_count int, "
        "public_metrics_listed_count int, verified boolean, created_at timestamp_ntz, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_linkedin_posts": (
        "id string, author string, specific_content_share_commentary_text string, commentary string, "
        "text string, content_landing_page_content_type string, created_time timestamp_ntz, "
        "total_share_statistics_impression_count int, total_share_statistics_click_count int, "
        "total_share_statistics_like_count int, total_share_statistics_comment_count int, "
        "total_share_statistics_share_count int, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_linkedin_page_stats": (
        "organization string, organization_name string, follower_count int, "
        "page_statistics_views_all_page_views int, page_statistics_views_unique_visitors int, "
        "time_range_start date, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_github_repositories": (
        "id bigint, name string, full_name string, owner_login string, owner_id bigint, "
        "description string, homepage string, language string, topics string, html_url string, "
        "clone_url string, ssh_url string, private boolean, fork boolean, archived boolean, "
        "disabled boolean, has_issues boolean, has_wiki boolean, has_pages boolean, "
        "has_downloads boolean, stargazers_count int, watchers_count int, forks_count int, "
        "open_issues_count int, size int, license_key string, license_name string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, pushed_at timestamp_ntz, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_github_commits": (
        "sha string, repository string, commit_author_name string, commit_author_email string, "
        "commit_author_date timestamp_ntz, commit_committer_name string, "
        "commit_committer_date timestamp_ntz, commit_message string, stats_additions int, "
        "stats_deletions int, stats_total int, html_url string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_github_pull_requests": (
        "id bigint, number bigint, repository string, title string, body string, state string, "
        "user_login string, user_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "merged_at timestamp_ntz, closed_at timestamp_ntz, additions int, deletions int, "
        "changed_files int, commits int, comments int, merged boolean, draft boolean, html_url string, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_github_issues": (
        "id bigint, number bigint, repository string, title string, body string, state string, "
        "user_login string, user_id bigint, labels string, assignees string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, closed_at timestamp_ntz, comments int, pull_request string, "
        "html_url string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_stripe_charges": (
        "id string, customer string, amount bigint, currency string, status string, paid boolean, "
        "refunded boolean, description string, receipt_email string, invoice string, "
        "created bigint, failure_code string, failure_message string, "
        "_airbyte_extracted_at timestamp_ntz"
    ),
    "raw_stripe_customers": (
        "id string, email string, name string, phone string, description string, address_city string, "
        "address_country string, address_postal_code string, currency string, balance int, "
        "delinquent boolean, default_source string, created bigint, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_stripe_subscriptions": (
        "id string, customer string, status string, plan_id string, plan_nickname string, "
        "plan_amount int, plan_currency string, plan_interval string, plan_interval_count int, "
        "current_period_start bigint, current_period_end bigint, cancel_at_period_end boolean, "
        "canceled_at bigint, ended_at bigint, created bigint, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_notion_pages": (
        "id string, properties_title_title_0_plain_text string, parent_type string, "
        "parent_database_id string, parent_page_id string, parent_workspace string, created_by_id string, "
        "last_edited_by_id string, created_time timestamp_ntz, last_edited_time timestamp_ntz, "
        "archived boolean, url string, _airbyte_extracted_at timestamp_ntz"
    ),
    "raw_podcasts": (
        "id bigint, show_name string, platform string, platform_id string, description string, "
        "author string, categories string, language string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "raw_podcast_episodes": (
        "id bigint, podcast_id bigint, episode_title string, platform_episode_id string, "
        "description string, duration_seconds int, publish_date timestamp_ntz, season_number int, "
        "episode_number int, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "raw_podcast_episode_metrics": (
        "episode_id bigint, metric_date date, plays bigint, listeners bigint, engaged_listeners bigint, "
        "views bigint, likes bigint, dislikes bigint, comments_count bigint, shares bigint, watch_time_minutes bigint, "
        "average_view_duration_seconds int, subscribers_gained int, subscribers_lost int, downloads bigint, "
        "streams bigint, completion_rate double, average_listen_time_seconds int, followers_total bigint, "
        "followers_gained int, followers_lost int, top_countries string, top_cities string, "
        "device_breakdown string, raw_data string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "raw_podcast_show_metrics": (
        "podcast_id bigint, metric_date date, total_plays bigint, total_listeners bigint, "
        "total_engaged_listeners bigint, total_views bigint, total_downloads bigint, followers_total bigint, "
        "followers_gained int, followers_lost int, subscribers_total bigint, subscribers_gained int, "
        "subscribers_lost int, average_completion_rate double, total_comments bigint, total_likes bigint, "
        "total_shares bigint, top_countries string, top_cities string, raw_data string, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "raw_podcast_comments": (
        "episode_id bigint, platform_comment_id string, author_name string, author_id string, "
        "comment_text string, likes_count int, reply_count int, parent_platform_comment_id string, "
        "published_at timestamp_ntz"
    ),
    "raw_podcast_scraper_runs": (
        "id bigint, platform string, run_started_at timestamp_ntz, run_completed_at timestamp_ntz, "
        "status string, episodes_processed int, metrics_collected int, error_message string, "
        "created_at timestamp_ntz"
    ),
    "raw_podcast_runs_started": (
        "id bigint, platform string, run_started_at timestamp_ntz, run_completed_at timestamp_ntz, "
        "status string, episodes_processed int, metrics_collected int, error_message string, "
        "created_at timestamp_ntz"
    ),
}
