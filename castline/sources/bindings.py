"""Bindings of the warehouse's raw landed tables to the driver's test tables.

Each raw table ``raw_<system>_<table>`` is declared as one SQL statement over
the base tables (``part``, ``lineitem``, ``orders``, ``events`` …).  The same
text runs in Spark (``spark.sql(text, part=df, …)`` — DataFrame parameters, no
global views) and, with plain table names substituted, in DuckDB where it
becomes a CTE of the oracle queries.  Row counts grow with the scale factor and
no table is cut: each event goes to one platform by its type (error events to
tweets), every other binding reads its base tables whole.  Which rows an update
batch re-sends is decided by attributes of the data; modulo expressions only
derive attribute values (dates, flags, ids of the simulated platform).

Columns the raw table declares but the base tables cannot supply (bios,
thumbnails, license names …) are typed NULLs so downstream staging sees the
declared shape.
"""

from __future__ import annotations

import re

# Base tables provided by the test data; the Spark side reads these Parquet files.
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

N_SUPPLIERS = "(SELECT count(*) FROM {supplier})"

BINDINGS: dict[str, str] = {
    # ---------------------------------------------------------------- tool 1
    "raw_spotify_episodes": """
SELECT concat('e', cast(p_partkey AS string)) AS id, p_name AS name, p_type AS description,
       DATE '2024-01-01' + cast(p_partkey % 28 AS int) AS release_date,
       cast(round(p_retailprice * 1000) AS int) AS duration_ms, p_size % 2 = 0 AS explicit,
       concat('spotify:episode:', cast(p_partkey AS string)) AS uri,
       concat('{{"spotify":"https://open.example/', cast(p_partkey AS string), '"}}') AS external_urls,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {part}""",
    "raw_spotify_episode_performance": """
SELECT concat('e', cast(l_partkey AS string)) AS episode_id,
       DATE '2024-01-01' + cast(l_orderkey % 30 AS int) AS date,
       cast(sum(l_quantity) AS int) AS starts,
       cast(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS int) AS streams,
       cast(count(DISTINCT l_orderkey) AS int) AS listeners, avg(l_quantity) AS avg_listen_seconds,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {lineitem} GROUP BY 1, 2""",
    "raw_spotify_show_stats": """
SELECT DATE '2024-01-01' + cast(o_orderkey % 30 AS int) AS date, count(*) AS total_streams,
       cast(count(DISTINCT o_custkey) AS int) AS followers, count(DISTINCT o_custkey) AS total_listeners,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {orders} GROUP BY 1""",
    # Videos are customers numbered from half the parts on, so some ids are on both platforms, some on one.
    "raw_youtube_videos": """
SELECT concat('v', cast(c_custkey + cast(floor((SELECT count(*) FROM {part}) / 2) AS bigint) AS string)) AS id,
       concat('{{"title":"', c_name, '","publishedAt":"2024-01-', lpad(cast(c_custkey % 28 + 1 AS string), 2, '0'),
              'T00:00:00Z","description":"', c_mktsegment, '","channelId":"ch1","channelTitle":"',
              cast(c_nationkey AS string), '"}}') AS snippet,
       concat('{{"duration":"P', CASE WHEN c_custkey % 50 = 7 THEN '1D' ELSE '' END, 'T',
              CASE WHEN c_custkey % 3 = 0 THEN concat(cast(c_nationkey % 5 + 1 AS string), 'H') ELSE '' END,
              CASE WHEN c_custkey % 2 = 0 THEN concat(cast(c_nationkey + 1 AS string), 'M') ELSE '' END,
              cast(c_custkey % 60 AS string), 'S","definition":"hd"}}') AS content_details,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {customer}""",
    "raw_youtube_daily_stats": """
SELECT concat('v', cast(user_id AS string)) AS video_id, cast(ts AS date) AS date,
       cast(count(*) AS int) AS views, sum(value) AS watch_time_minutes, avg(value) AS average_view_duration,
       cast(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS int) AS likes,
       cast(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS int) AS comments,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} GROUP BY 1, 2""",
    # Mapping seed: both ids, one id with '' or NULL, both blank, NULL content_id.
    "seed_content_mapping": """
SELECT CASE WHEN p_partkey % 21 = 0 THEN NULL ELSE concat('c', cast(p_partkey AS string)) END AS content_id,
       CASE WHEN p_partkey % 5 IN (0, 1) THEN concat('e', cast(p_partkey AS string))
            WHEN p_partkey % 5 = 3 THEN NULL ELSE '' END AS episode_id,
       CASE WHEN p_partkey % 5 IN (0, 2) THEN concat('v', cast(p_partkey AS string))
            WHEN p_partkey % 5 = 4 THEN NULL ELSE '' END AS video_id
FROM {part}""",
    # ---------------------------------------------------------------- tool 2
    "raw_youtube_videos_flat": """
SELECT concat('v', cast(p_partkey AS string)) AS id, p_name AS snippet_title, p_type AS snippet_description,
       'ch1' AS snippet_channel_id, p_brand AS snippet_channel_title, '28' AS snippet_category_id,
       cast(NULL AS string) AS snippet_tags,
       cast(DATE '2024-01-01' + cast(p_partkey % 28 AS int) AS timestamp) AS snippet_published_at,
       cast(p_size * 100 AS string) AS statistics_view_count,
       cast(p_size AS string) AS statistics_like_count, cast(NULL AS string) AS statistics_comment_count,
       'PT5M' AS content_details_duration, cast(NULL AS string) AS snippet_thumbnails_default_url,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {part}""",
    "raw_youtube_video_metrics": """
SELECT concat('v', cast(user_id AS string)) AS video_id, cast(ts AS date) AS date,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE cast(floor(value) AS bigint) END AS views,
       cast(floor(value * 3) AS bigint) AS estimated_minutes_watched,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS likes, CASE WHEN event_type = 'signup' THEN 1 END AS comments,
       CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS shares, 0 AS dislikes,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS subscribers_gained, 0 AS subscribers_lost,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events}""",
    "raw_youtube_channel_stats": """
SELECT concat('ch', cast(c_custkey AS string)) AS id, c_name AS snippet_title,
       cast(NULL AS string) AS snippet_description, cast(NULL AS string) AS snippet_custom_url,
       cast(c_nationkey AS string) AS snippet_country,
       cast(cast(floor(abs(c_acctbal)) AS bigint) * 10 AS string) AS statistics_subscriber_count,
       '10' AS statistics_video_count, cast(NULL AS string) AS statistics_view_count,
       CASE WHEN c_custkey % 9 = 0 THEN 'true' END AS statistics_hidden_subscriber_count,
       TIMESTAMP '2020-01-01 00:00:00' AS snippet_published_at, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {customer}""",
    "raw_twitch_streams": """
SELECT cast(event_id AS string) AS id, cast(user_id AS string) AS user_id, concat('u', cast(user_id AS string)) AS user_login,
       cast(NULL AS string) AS user_name, cast(NULL AS string) AS game_id, cast(NULL AS string) AS game_name,
       concat('stream ', cast(event_id AS string)) AS title, 'live' AS type, cast(floor(value) AS int) AS viewer_count,
       ts AS started_at, cast(NULL AS string) AS language, event_id % 2 = 0 AS is_mature,
       cast(NULL AS string) AS thumbnail_url, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} WHERE event_type = 'view'""",
    "raw_twitch_videos": """
SELECT cast(event_id AS string) AS id, cast(NULL AS string) AS stream_id, cast(user_id AS string) AS user_id,
       concat('u', cast(user_id AS string)) AS user_login, cast(NULL AS string) AS user_name,
       concat('vod ', cast(event_id AS string)) AS title, cast(NULL AS string) AS description, 'archive' AS type,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat(cast(event_id % 3 AS string), 'h', cast(event_id % 60 AS string), 'm',
            cast(event_id % 59 AS string), 's') END AS duration, cast(floor(value) AS int) AS view_count, ts AS created_at,
       ts AS published_at, cast(NULL AS string) AS url, cast(NULL AS string) AS thumbnail_url,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} WHERE event_type = 'purchase'""",
    "raw_twitch_followers": """
SELECT cast(user_id AS string) AS from_id, concat('u', cast(user_id AS string)) AS from_login,
       cast(NULL AS string) AS from_name, ts AS followed_at, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} WHERE event_type = 'signup'""",
    "raw_twitter_tweets": """
SELECT cast(event_id AS string) AS id, cast(user_id AS string) AS author_id, cast(NULL AS string) AS conversation_id,
       cast(NULL AS string) AS in_reply_to_user_id, props AS text,
       cast(event_id % 3 AS int) AS public_metrics_retweet_count, cast(event_id % 5 AS int) AS public_metrics_reply_count,
       cast(floor(value / 10) AS int) AS public_metrics_like_count, cast(NULL AS int) AS public_metrics_quote_count,
       cast(floor(value) AS int) AS public_metrics_impression_count,
       CASE WHEN event_id % 53 = 0 THEN ts - INTERVAL '1600' DAY ELSE ts END AS created_at,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} WHERE event_type IN ('click', 'error')""",
    "raw_twitter_user_metrics": """
SELECT cast(c_custkey AS string) AS id, c_name AS username, c_name AS name, cast(NULL AS string) AS description,
       cast(floor(abs(c_acctbal)) AS int) AS public_metrics_followers_count,
       cast(c_nationkey AS int) AS public_metrics_following_count, cast(NULL AS int) AS public_metrics_tweet_count,
       cast(NULL AS int) AS public_metrics_listed_count,
       c_mktsegment = 'BUILDING' AS verified, TIMESTAMP '2020-01-01 00:00:00' AS created_at,
       cast(DATE '2024-01-28' + cast(c_custkey % 5 AS int) AS timestamp) AS _airbyte_extracted_at
FROM {customer}""",
    "raw_linkedin_posts": """
SELECT cast(event_id AS string) AS id, cast(user_id AS string) AS author,
       CASE WHEN event_id % 2 = 0 THEN props END AS specific_content_share_commentary_text, event_type AS commentary, props AS text,
       cast(NULL AS string) AS content_landing_page_content_type, ts AS created_time,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(floor(value) AS int) END AS total_share_statistics_impression_count,
       cast(event_id % 9 AS int) AS total_share_statistics_click_count, cast(event_id % 4 AS int) AS total_share_statistics_like_count,
       cast(event_id % 3 AS int) AS total_share_statistics_comment_count, cast(event_id % 2 AS int) AS total_share_statistics_share_count,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} WHERE event_type = 'signup'""",
    "raw_linkedin_page_stats": """
SELECT concat('org', cast(user_id AS string)) AS organization, concat('Org ', cast(user_id AS string)) AS organization_name,
       cast(NULL AS int) AS follower_count,
       cast(count(*) AS int) AS page_statistics_views_all_page_views,
       cast(count(DISTINCT event_type) AS int) AS page_statistics_views_unique_visitors,
       cast(ts AS date) AS time_range_start, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {events} GROUP BY user_id, cast(ts AS date)""",
    "raw_github_repositories": """
SELECT s_suppkey AS id, s_name AS name, concat('org/repo', cast(s_suppkey AS string)) AS full_name, 'org' AS owner_login,
       cast(1 AS bigint) AS owner_id, cast(NULL AS string) AS description, cast(NULL AS string) AS homepage,
       'Go' AS language, cast(NULL AS string) AS topics,
       concat('https://github.example/org/repo', cast(s_suppkey AS string)) AS html_url,
       cast(NULL AS string) AS clone_url, cast(NULL AS string) AS ssh_url,
       s_suppkey % 2 = 0 AS private, s_suppkey % 3 = 0 AS fork, false AS archived, false AS disabled,
       true AS has_issues, s_suppkey % 4 = 0 AS has_wiki, false AS has_pages, true AS has_downloads,
       cast(floor(abs(s_acctbal)) AS int) AS stargazers_count, cast(NULL AS int) AS watchers_count,
       cast(s_nationkey AS int) AS forks_count, cast(NULL AS int) AS open_issues_count, cast(s_suppkey AS int) AS size,
       cast(NULL AS string) AS license_key, cast(NULL AS string) AS license_name,
       TIMESTAMP '2020-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at,
       cast(NULL AS timestamp) AS pushed_at, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {supplier}""",
    "raw_github_commits": """
SELECT md5(concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string))) AS sha,
       concat('org/repo', cast(l_suppkey AS string)) AS repository,
       concat('dev', cast(l_partkey AS string)) AS commit_author_name,
       concat('dev', cast(l_partkey AS string), '@x.example') AS commit_author_email,
       l_shipdate + INTERVAL '9131' DAY AS commit_author_date,
       cast(NULL AS string) AS commit_committer_name,
       l_shipdate + INTERVAL '9131' DAY AS commit_committer_date, l_returnflag AS commit_message,
       cast(l_quantity AS int) AS stats_additions,
       CASE WHEN l_discount = 0 THEN NULL ELSE cast(round(l_discount * 100) AS int) END AS stats_deletions,
       cast(NULL AS int) AS stats_total, cast(NULL AS string) AS html_url,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {lineitem}""",
    "raw_github_pull_requests": """
SELECT o_orderkey AS id, o_orderkey AS number,
       concat('org/repo', cast(o_custkey % ((SELECT count(*) FROM {supplier}) + 5) AS string)) AS repository,
       concat('pr ', cast(o_orderkey AS string)) AS title, cast(NULL AS string) AS body,
       CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
       concat('u', cast(o_custkey AS string)) AS user_login, o_custkey AS user_id,
       o_orderdate + INTERVAL '9131' DAY AS created_at, o_orderdate + INTERVAL '9133' DAY AS updated_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '9133' DAY END AS merged_at,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL '9133' DAY END AS closed_at,
       cast(NULL AS int) AS additions, cast(NULL AS int) AS deletions, cast(NULL AS int) AS changed_files,
       cast(NULL AS int) AS commits, cast(NULL AS int) AS comments,
       o_orderstatus = 'F' AS merged, false AS draft, cast(NULL AS string) AS html_url,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {orders}""",
    "raw_github_issues": """
SELECT o_orderkey AS id, o_orderkey AS number,
       concat('org/repo', cast(o_custkey % ((SELECT count(*) FROM {supplier}) + 5) AS string)) AS repository,
       concat('issue ', cast(o_orderkey AS string)) AS title, cast(NULL AS string) AS body,
       CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
       concat('u', cast(o_custkey AS string)) AS user_login, o_custkey AS user_id,
       cast(NULL AS string) AS labels, cast(NULL AS string) AS assignees,
       o_orderdate + INTERVAL '9131' DAY AS created_at, o_orderdate + INTERVAL '9131' DAY AS updated_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '9141' DAY END AS closed_at,
       cast(NULL AS int) AS comments,
       CASE WHEN o_orderkey % 3 = 0 THEN '{{"url":"x"}}' END AS pull_request, cast(NULL AS string) AS html_url,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {orders}""",
    "raw_stripe_charges": """
SELECT cast(o_orderkey AS string) AS id, cast(o_custkey AS string) AS customer,
       cast(round(o_totalprice * 100) AS bigint) AS amount,
       'usd' AS currency, o_orderstatus AS status, o_orderstatus <> 'P' AS paid, o_orderpriority = '1-URGENT' AS refunded,
       o_orderpriority AS description, cast(NULL AS string) AS receipt_email, cast(NULL AS string) AS invoice,
       cast(1420070400 + (o_orderkey * 7919 % 3650) * 86400 + o_orderkey % 86400 AS bigint) AS created,
       cast(NULL AS string) AS failure_code, cast(NULL AS string) AS failure_message,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {orders}""",
    "raw_stripe_customers": """
SELECT cast(c_custkey AS string) AS id, cast(NULL AS string) AS email, c_name AS name, cast(NULL AS string) AS phone,
       c_mktsegment AS description, cast(NULL AS string) AS address_city, cast(c_nationkey AS string) AS address_country,
       cast(NULL AS string) AS address_postal_code, 'usd' AS currency,
       cast(round(c_acctbal * 100) AS int) AS balance, c_acctbal < 0 AS delinquent,
       cast(NULL AS string) AS default_source, cast(1577836800 + c_custkey * 3600 AS bigint) AS created,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {customer}""",
    "raw_stripe_subscriptions": """
SELECT concat('s', cast(c_custkey AS string)) AS id, cast(c_custkey AS string) AS customer,
       CASE WHEN c_custkey % 4 = 0 THEN 'canceled' ELSE 'active' END AS status,
       concat('plan_', c_mktsegment) AS plan_id, c_mktsegment AS plan_nickname,
       cast(c_custkey % 50 * 100 AS int) AS plan_amount, 'usd' AS plan_currency, 'month' AS plan_interval,
       cast(1 AS int) AS plan_interval_count,
       cast(1704067200 AS bigint) AS current_period_start, cast(1706745600 AS bigint) AS current_period_end,
       c_custkey % 4 = 1 AS cancel_at_period_end,
       cast(CASE WHEN c_custkey % 4 = 0 THEN 1704067200 + c_custkey ELSE 0 END AS bigint) AS canceled_at,
       cast(CASE WHEN c_custkey % 8 = 0 THEN 1706745600 ELSE 0 END AS bigint) AS ended_at,
       cast(1577836800 + c_custkey * 3600 AS bigint) AS created,
       TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {customer}""",
    "raw_notion_pages": """
SELECT cast(page_id AS string) AS id, concat('page ', cast(page_id AS string)) AS properties_title_title_0_plain_text,
       CASE WHEN page_id % 2 = 0 THEN 'database_id' ELSE 'workspace' END AS parent_type,
       CASE WHEN page_id % 2 = 0 THEN 'db1' END AS parent_database_id,
       CASE WHEN page_id % 3 = 0 THEN concat('p', cast(page_id AS string)) END AS parent_page_id, 'ws' AS parent_workspace,
       cast(NULL AS string) AS created_by_id, cast(NULL AS string) AS last_edited_by_id,
       TIMESTAMP '2024-01-01 00:00:00' AS created_time, TIMESTAMP '2024-01-15 00:00:00' AS last_edited_time,
       page_id % 7 = 0 AS archived, url, TIMESTAMP '2024-02-01 02:00:00' AS _airbyte_extracted_at
FROM {pages}""",
    # ------------------------------------------------------------- collector
    # Shows are bound to suppliers so their number grows with the data.
    "raw_podcasts": """
SELECT s_suppkey AS id, concat('show ', cast(s_nationkey AS string)) AS show_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform,
       concat('p', cast(s_suppkey AS string)) AS platform_id, cast(NULL AS string) AS description,
       s_name AS author, cast(NULL AS string) AS categories, 'en' AS language,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM {supplier}""",
    "raw_podcast_episodes": """
SELECT p_partkey AS id, p_partkey % (SELECT count(*) FROM {supplier}) AS podcast_id,
       concat(p_name, ' ', cast(p_partkey AS string)) AS episode_title,
       concat('pe', cast(p_partkey AS string)) AS platform_episode_id, p_type AS description,
       p_size * 60 AS duration_seconds,
       cast(DATE '2023-12-01' + cast(p_partkey % 60 AS int) AS timestamp) AS publish_date,
       cast(NULL AS int) AS season_number, cast(p_partkey % 100 AS int) AS episode_number,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM {part}""",
    "raw_podcast_episode_metrics": """
SELECT l_partkey AS episode_id, DATE '2024-01-01' + cast(l_orderkey % 30 AS int) AS metric_date,
       cast(sum(l_quantity) AS bigint) AS plays, count(DISTINCT l_orderkey) AS listeners,
       count(DISTINCT l_suppkey) AS engaged_listeners, count(*) AS views,
       cast(sum(l_linenumber) AS bigint) AS likes, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS dislikes,
       cast(max(l_linenumber) AS bigint) AS comments_count, count(DISTINCT l_linenumber) AS shares,
       cast(sum(l_quantity) AS bigint) * 2 AS watch_time_minutes, cast(max(l_quantity) AS int) AS average_view_duration_seconds,
       cast(count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS int) AS subscribers_gained,
       cast(count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS int) AS subscribers_lost,
       count(DISTINCT l_suppkey) AS downloads, cast(sum(l_quantity) AS bigint) + 3 AS streams,
       avg(l_discount) * 100 AS completion_rate, cast(min(l_quantity) AS int) AS average_listen_time_seconds,
       cast(CASE WHEN count(*) > 1 THEN count(*) + 1000 END AS bigint) AS followers_total,
       cast(count(DISTINCT l_linenumber) AS int) AS followers_gained, cast(0 AS int) AS followers_lost,
       concat('[{{"country":"US","count":', cast(count(*) AS string), '}},{{"country":"DE","count":',
              cast(count(DISTINCT l_orderkey) AS string), '}}]') AS top_countries,
       concat('[{{"city":"Berlin","count":', cast(sum(l_linenumber) AS string), '}}]') AS top_cities,
       concat('{{"mobile":', cast(sum(l_linenumber) AS string), ',"desktop":', cast(count(*) AS string),
              ',"tablet":', cast(max(l_linenumber) AS string), '}}') AS device_breakdown,
       concat('{{"rows":', cast(count(*) AS string), '}}') AS raw_data,
       TIMESTAMP '2024-02-01 02:00:00' AS created_at, TIMESTAMP '2024-02-01 02:00:00' AS updated_at
FROM {lineitem} GROUP BY 1, 2""",
    "raw_podcast_show_metrics": """
SELECT o_custkey % (SELECT count(*) FROM {supplier}) AS podcast_id,
       DATE '2024-01-01' + cast(o_orderkey % 30 AS int) AS metric_date,
       cast(sum(cast(round(o_totalprice) AS bigint)) AS bigint) AS total_plays, count(*) AS total_listeners, cast(0 AS bigint) AS total_engaged_listeners,
       count(*) * 3 AS total_views, cast(NULL AS bigint) AS total_downloads, count(*) AS followers_total,
       cast(count(DISTINCT o_custkey) AS int) AS followers_gained, cast(0 AS int) AS followers_lost,
       count(DISTINCT o_custkey) AS subscribers_total,
       cast(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS int) AS subscribers_gained,
       cast(count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS int) AS subscribers_lost,
       cast(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS double) / count(*) * 100 AS average_completion_rate,
       count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS total_comments,
       count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS total_likes, cast(1 AS bigint) AS total_shares,
       '[]' AS top_countries, cast(NULL AS string) AS top_cities, cast(NULL AS string) AS raw_data,
       TIMESTAMP '2024-02-01 02:00:00' AS created_at, TIMESTAMP '2024-02-01 02:00:00' AS updated_at
FROM {orders} GROUP BY 1, 2""",
    "raw_podcast_comments": """
SELECT conv_id AS episode_id, concat(cast(conv_id AS string), '-', cast(turn AS string)) AS platform_comment_id,
       role AS author_name, concat('a', role) AS author_id, text AS comment_text,
       cast(length(text) % 97 AS int) AS likes_count, cast(0 AS int) AS reply_count,
       CASE WHEN turn > 0 THEN concat(cast(conv_id AS string), '-', cast(turn - 1 AS string)) END AS parent_platform_comment_id,
       cast(DATE '2024-01-01' + cast(turn AS int) AS timestamp) AS published_at
FROM {conversations}""",
    "raw_podcast_scraper_runs": """
SELECT event_id AS id,
       CASE event_id % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform,
       ts AS run_started_at, ts + INTERVAL '5' MINUTE AS run_completed_at,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
       cast(user_id % 20 AS int) AS episodes_processed, cast(floor(value) AS int) AS metrics_collected,
       CASE WHEN event_type = 'error' THEN props END AS error_message, ts AS created_at
FROM {events}""",
}

# --------------------------------------------------------- upsert batches
# Re-collected rows for existing keys (some keys twice, the later version
# must win) plus brand-new keys, shaped exactly like their target tables.
_PODCAST_COLS = """s_suppkey{off} AS id, concat('show ', cast(s_nationkey AS string), '{tag}') AS show_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform,
       concat('{pfx}', cast(s_suppkey AS string)) AS platform_id, concat('about ', s_name) AS description,
       s_name AS author, '["tech"]' AS categories, 'en' AS language,
       TIMESTAMP '{ts}' AS created_at, TIMESTAMP '{ts}' AS updated_at
FROM {{supplier}}"""

BINDINGS["batch_podcasts"] = (
    "\nSELECT " + _PODCAST_COLS.format(off="", tag=" v2", pfx="p", ts="2024-02-01 00:00:00")
    + " WHERE s_nationkey < 12\nUNION ALL\nSELECT "
    + _PODCAST_COLS.format(off="", tag=" v3", pfx="p", ts="2024-02-02 00:00:00")
    + " WHERE s_nationkey < 6\nUNION ALL\nSELECT "
    + _PODCAST_COLS.format(off=" + 1000000000", tag="", pfx="q", ts="2024-02-01 00:00:00")
    + " WHERE s_nationkey >= 20\nUNION ALL\nSELECT "
    # a new show sent twice: the second version updates it, created_at/id stay from the first
    + _PODCAST_COLS.format(off=" + 2000000000", tag=" v2", pfx="q", ts="2024-02-03 00:00:00")
    + " WHERE s_nationkey >= 23")

BINDINGS["batch_podcast_episodes"] = """
SELECT p_partkey AS id, p_partkey % (SELECT count(*) FROM {supplier}) AS podcast_id,
       concat(p_name, ' (remastered)') AS episode_title, concat('pe', cast(p_partkey AS string)) AS platform_episode_id,
       concat('new: ', p_type) AS description, p_size * 61 AS duration_seconds,
       cast(DATE '2023-12-01' + cast(p_partkey % 60 AS int) AS timestamp) AS publish_date,
       cast(1 AS int) AS season_number, cast(p_partkey % 100 AS int) AS episode_number,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM {part} WHERE p_size > 25
UNION ALL
SELECT p_partkey + 1000000000, p_partkey % (SELECT count(*) FROM {supplier}), concat(p_name, ' bonus'),
       concat('pb', cast(p_partkey AS string)), p_type, p_size * 30,
       cast(DATE '2024-01-15' AS timestamp), cast(2 AS int), cast(1 AS int),
       TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '2024-02-01 00:00:00'
FROM {part} WHERE p_size = 1"""

BINDINGS["batch_episode_metrics"] = """
SELECT l_partkey AS episode_id, DATE '2024-01-01' + cast(l_orderkey % 31 AS int) AS metric_date,
       cast(sum(l_quantity) AS bigint) + 7 AS plays, count(DISTINCT l_orderkey) AS listeners,
       count(DISTINCT l_suppkey) AS engaged_listeners, count(*) + 1 AS views,
       cast(sum(l_linenumber) AS bigint) AS likes, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS dislikes,
       cast(max(l_linenumber) AS bigint) AS comments_count, count(DISTINCT l_linenumber) AS shares,
       cast(sum(l_quantity) AS bigint) * 2 AS watch_time_minutes, cast(max(l_quantity) AS int) AS average_view_duration_seconds,
       cast(count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS int) AS subscribers_gained,
       cast(count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS int) AS subscribers_lost,
       count(DISTINCT l_suppkey) AS downloads, cast(sum(l_quantity) AS bigint) + 3 AS streams,
       avg(l_tax) * 100 AS completion_rate, cast(min(l_quantity) AS int) AS average_listen_time_seconds,
       cast(CASE WHEN count(*) > 1 THEN count(*) + 1000 END AS bigint) AS followers_total,
       cast(count(DISTINCT l_linenumber) AS int) AS followers_gained, cast(0 AS int) AS followers_lost,
       '[]' AS top_countries, '[]' AS top_cities, '{{}}' AS device_breakdown, '{{}}' AS raw_data,
       TIMESTAMP '2024-02-02 02:00:00' AS created_at, TIMESTAMP '2024-02-02 02:00:00' AS updated_at
FROM {lineitem} WHERE DATE '2024-01-01' + cast(l_orderkey % 31 AS int) >= DATE '2024-01-24' GROUP BY 1, 2"""

BINDINGS["batch_show_metrics"] = """
SELECT o_custkey % (SELECT count(*) FROM {supplier}) AS podcast_id,
       DATE '2024-01-01' + cast(o_orderkey % 31 AS int) AS metric_date,
       cast(sum(cast(round(o_totalprice) AS bigint)) AS bigint) AS total_plays, count(*) AS total_listeners, cast(0 AS bigint) AS total_engaged_listeners,
       count(*) * 3 AS total_views, cast(NULL AS bigint) AS total_downloads, count(*) + 100 AS followers_total,
       cast(count(DISTINCT o_custkey) AS int) AS followers_gained, cast(0 AS int) AS followers_lost,
       count(DISTINCT o_custkey) AS subscribers_total,
       cast(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS int) AS subscribers_gained,
       cast(count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS int) AS subscribers_lost,
       cast(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS double) / count(*) * 100 AS average_completion_rate,
       count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS total_comments,
       count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS total_likes, cast(1 AS bigint) AS total_shares,
       '[]' AS top_countries, cast(NULL AS string) AS top_cities, '{{}}' AS raw_data,
       TIMESTAMP '2024-02-02 02:00:00' AS created_at, TIMESTAMP '2024-02-02 02:00:00' AS updated_at
FROM {orders} WHERE DATE '2024-01-01' + cast(o_orderkey % 31 AS int) >= DATE '2024-01-24' GROUP BY 1, 2"""

# Comments re-sent (ignored: already present) plus replies not seen before.
BINDINGS["batch_comments"] = """
SELECT conv_id AS episode_id, concat(cast(conv_id AS string), '-', cast(turn AS string)) AS platform_comment_id,
       role AS author_name, concat('a', role) AS author_id, concat('edited: ', text) AS comment_text,
       cast(length(text) % 89 AS int) AS likes_count, cast(1 AS int) AS reply_count,
       cast(NULL AS string) AS parent_platform_comment_id,
       cast(DATE '2024-01-10' AS timestamp) AS published_at
FROM {conversations} WHERE role = 'user'
UNION ALL
SELECT conv_id, concat(cast(conv_id AS string), '-', cast(turn AS string), 'r'), 'user', 'auser',
       concat('reply to ', cast(turn AS string)), cast(turn AS int), cast(0 AS int),
       concat(cast(conv_id AS string), '-', cast(turn AS string)), cast(DATE '2024-01-11' AS timestamp)
FROM {conversations} WHERE role = 'assistant'"""

BINDINGS["raw_podcast_runs_started"] = """
SELECT event_id AS id,
       CASE event_id % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform,
       ts AS run_started_at, cast(NULL AS timestamp) AS run_completed_at, 'running' AS status,
       cast(0 AS int) AS episodes_processed, cast(0 AS int) AS metrics_collected,
       cast(NULL AS string) AS error_message, ts AS created_at
FROM {events}"""

BINDINGS["batch_run_updates"] = """
SELECT event_id AS id,
       CASE event_id % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform,
       ts AS run_started_at, ts + INTERVAL '5' MINUTE AS run_completed_at,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
       cast(user_id % 20 AS int) AS episodes_processed, cast(floor(value) AS int) AS metrics_collected,
       CASE WHEN event_type = 'error' THEN props END AS error_message, ts + INTERVAL '5' MINUTE AS created_at
FROM {events} WHERE event_type <> 'view'"""

# Raw tables with distinct counts: the table and key that they group (by itself or as a text of it), and the text of the day
# they also group by.  Spark would copy each row once per counted column before its shuffle, or shuffle the rows of one
# counted column twice; instead rows are dealt out by the group once, and the first row of each value is marked there.
DEALT = {"raw_spotify_episode_performance": ("lineitem", "l_partkey", "DATE '2024-01-01' + cast(l_orderkey % 30 AS int)"),
         "raw_podcast_episode_metrics": ("lineitem", "l_partkey", "DATE '2024-01-01' + cast(l_orderkey % 30 AS int)"),
         "batch_episode_metrics": ("lineitem", "l_partkey", "DATE '2024-01-01' + cast(l_orderkey % 31 AS int)")}
_DISTINCT = re.compile(r"count\(DISTINCT (\w+)\)")
_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def counted_columns(name: str) -> list[str]:
    """The columns whose distinct values a binding counts."""
    return sorted(set(_DISTINCT.findall(BINDINGS[name])))


def dealt_sql(name: str) -> str:
    """The binding over rows with ``_key``, ``_day`` and a mark ``_first_<column>`` on one row of each value in a group."""
    _, key, day = DEALT[name]
    sql = BINDINGS[name].replace(day, "_day").replace(key, "_key").replace("GROUP BY 1, 2", "GROUP BY _key, _day")
    return _DISTINCT.sub(r"count(CASE WHEN _first_\1 THEN 1 END)", sql)


def base_tables_of(sql: str) -> list[str]:
    """Base tables referenced by a binding template (``{name}`` placeholders)."""
    names = []
    for name in _PLACEHOLDER.findall(sql.replace("{{", "").replace("}}", "")):
        if name not in names:
            names.append(name)
    return names


def duckdb_sql(name: str) -> str:
    """The binding as DuckDB SQL over the pre-registered base views."""
    sql = BINDINGS[name]
    return sql.format(**{t: t for t in base_tables_of(sql)}).strip()
