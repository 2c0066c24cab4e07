"""DuckDB oracle SQL, written independently of the Spark operators.

``MODELS`` holds one SQL body per warehouse model, referring to other models
and to the raw bindings by name.  :func:`compose` turns a final query into a
single self-contained statement: every referenced model / binding becomes a
CTE (dependency order), so DuckDB only needs the pre-registered base tables.

Conventions (shared with the Spark side): SUM/COUNT are BIGINT, rates are
DOUBLE rounded to 6 places in the final projection, ``CURRENT_DATE`` is the
fixed ``AS_OF`` date.
"""

from __future__ import annotations

import re

from castline.sources.bindings import BINDINGS, duckdb_sql

AS_OF = "2024-01-31"


def _i(x: str) -> str:
    """DuckDB: ``COALESCE(x::INT, 0)``."""
    return f"coalesce(cast({x} AS int), 0)"


def _b(x: str) -> str:
    return f"coalesce(cast({x} AS bigint), 0)"


def _rx(x: str, pat: str) -> str:
    return f"try_cast(nullif(regexp_extract({x}, '{pat}', 1), '') AS int)"


def _epoch(x: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(cast({x} AS bigint)))"


def _md5(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(cast({p} AS varchar), '')" for p in parts) + ")"


def _dkey(d: str) -> str:
    return f"cast(strftime(cast({d} AS date), '%Y%m%d') AS int)"


def _iso(x: str) -> str:
    """The time part of an ISO 8601 duration in seconds, without the hours after a day part."""
    parts = (f"regexp_extract({x}, '^P(?:(\\d+)D)?(?:T(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?)?$', "
             "['d', 'h', 'm', 's'])")
    terms = [f"CASE WHEN ({parts}).d = '' THEN coalesce(try_cast(nullif(({parts}).h, '') AS int), 0) ELSE 0 END * 3600"]
    terms += [f"coalesce(try_cast(nullif(({parts}).{n}, '') AS int), 0) * {k}" for n, k in (("m", 60), ("s", 1))]
    return "coalesce(" + " + ".join(terms) + ", 0)"


def _hms(x: str) -> str:
    """The sum of all ``<number><unit>`` steps of a text that consists of such steps, from hours down to seconds."""
    lx = f"lower(trim({x}))"
    step = "cast(p[:-2] AS int) * (CASE p[-1] WHEN 'h' THEN 3600 WHEN 'm' THEN 60 ELSE 1 END)"
    return (f"cast(CASE WHEN regexp_full_match({lx}, '([0-9]+h)?([0-9]+m)?([0-9]+s)?') "
            f"THEN coalesce(list_sum([{step} FOR p IN regexp_extract_all({lx}, '[0-9]+[hms]')]), 0) ELSE 0 END AS int)")


MODELS: dict[str, str] = {}

# ------------------------------------------------------------------ staging
MODELS["stg_spotify_episodes"] = """
SELECT id AS episode_id, name AS title, cast(release_date AS date) AS published_date,
       cast(duration_ms // 1000 AS int) AS duration_seconds, description, explicit AS is_explicit,
       uri AS spotify_uri, json_extract_string(external_urls, '$.spotify') AS spotify_url
FROM raw_spotify_episodes"""

MODELS["stg_spotify_daily_performance"] = """
SELECT episode_id, cast(date AS date) AS metric_date, starts, streams, listeners AS unique_listeners,
       cast(avg_listen_seconds AS double) AS avg_listen_seconds,
       CASE WHEN starts > 0 THEN cast(streams AS double) / cast(starts AS double) ELSE 0.0 END AS stream_through_rate
FROM raw_spotify_episode_performance"""

MODELS["stg_spotify_show_stats"] = """
SELECT cast(date AS date) AS stats_date, total_streams, followers, total_listeners
FROM raw_spotify_show_stats"""

MODELS["stg_youtube_videos_json"] = f"""
SELECT id AS video_id, json_extract_string(snippet, '$.title') AS title,
       cast(left(json_extract_string(snippet, '$.publishedAt'), 10) AS date) AS published_date,
       json_extract_string(snippet, '$.description') AS description,
       json_extract_string(snippet, '$.channelId') AS channel_id,
       json_extract_string(snippet, '$.channelTitle') AS channel_title,
       cast({_iso("json_extract_string(content_details, '$.duration')")} AS int) AS duration_seconds,
       json_extract_string(content_details, '$.definition') AS video_definition
FROM raw_youtube_videos"""

MODELS["stg_youtube_daily_stats"] = """
SELECT video_id, cast(date AS date) AS metric_date, views, cast(watch_time_minutes AS double) AS watch_time_minutes,
       cast(average_view_duration AS double) AS avg_view_seconds, likes, comments,
       CASE WHEN views > 0 THEN cast(watch_time_minutes AS double) / cast(views AS double) ELSE 0.0 END AS minutes_per_view
FROM raw_youtube_daily_stats"""

MODELS["stg_youtube_videos"] = f"""
SELECT id AS video_id, snippet_title AS title, snippet_description AS description,
       snippet_channel_id AS channel_id, snippet_channel_title AS channel_name,
       snippet_category_id AS category_id, snippet_tags AS tags,
       cast(snippet_published_at AS timestamp) AS published_at,
       {_b("statistics_view_count")} AS view_count, {_b("statistics_like_count")} AS like_count,
       {_b("statistics_comment_count")} AS comment_count, content_details_duration AS duration_iso,
       'https://youtube.com/watch?v=' || id AS video_url, snippet_thumbnails_default_url AS thumbnail_url,
       _airbyte_extracted_at AS extracted_at
FROM raw_youtube_videos_flat WHERE id IS NOT NULL"""

MODELS["stg_youtube_video_metrics"] = f"""
SELECT video_id, cast(date AS date) AS metric_date, {_b("views")} AS views,
       {_b("estimated_minutes_watched")} * 60 AS watch_time_seconds,
       {_b("likes")} AS likes, {_b("comments")} AS comments, {_b("shares")} AS shares, {_b("dislikes")} AS dislikes,
       CASE WHEN {_b("views")} = 0 OR views IS NULL THEN 0.0
            ELSE cast({_b("estimated_minutes_watched")} * 60 AS double) / cast(views AS double) END AS avg_view_duration_seconds,
       {_i("subscribers_gained")} AS subscribers_gained, {_i("subscribers_lost")} AS subscribers_lost,
       _airbyte_extracted_at AS extracted_at
FROM raw_youtube_video_metrics WHERE video_id IS NOT NULL AND date IS NOT NULL"""

MODELS["stg_youtube_channel_stats"] = f"""
SELECT id AS channel_id, snippet_title AS channel_name, snippet_description AS description,
       snippet_custom_url AS custom_url, snippet_country AS country,
       {_b("statistics_subscriber_count")} AS subscriber_count, {_b("statistics_video_count")} AS video_count,
       {_b("statistics_view_count")} AS view_count,
       coalesce(cast(statistics_hidden_subscriber_count AS boolean), false) AS is_subscriber_count_hidden,
       cast(snippet_published_at AS timestamp) AS channel_created_at,
       cast(_airbyte_extracted_at AS date) AS metric_date, _airbyte_extracted_at AS extracted_at
FROM raw_youtube_channel_stats WHERE id IS NOT NULL"""

MODELS["stg_twitch_streams"] = f"""
SELECT id AS stream_id, user_id, user_login, user_name, game_id, game_name, title, type AS stream_type,
       {_i("viewer_count")} AS viewer_count, cast(started_at AS timestamp) AS started_at, language,
       cast(is_mature AS boolean) AS is_mature, 'https://twitch.tv/' || user_login AS stream_url, thumbnail_url,
       _airbyte_extracted_at AS extracted_at
FROM raw_twitch_streams WHERE id IS NOT NULL"""

MODELS["stg_twitch_videos"] = f"""
SELECT id AS video_id, stream_id, user_id, user_login, user_name, title, description, type AS video_type,
       duration AS duration_raw, cast({_hms("duration")} AS int) AS duration_seconds,
       {_i("view_count")} AS view_count, cast(created_at AS timestamp) AS created_at,
       cast(published_at AS timestamp) AS published_at, url AS video_url, thumbnail_url,
       _airbyte_extracted_at AS extracted_at
FROM raw_twitch_videos WHERE id IS NOT NULL"""

MODELS["stg_twitch_followers"] = """
SELECT from_id AS follower_id, from_login AS follower_login, from_name AS follower_name,
       cast(followed_at AS timestamp) AS followed_at, _airbyte_extracted_at AS extracted_at
FROM raw_twitch_followers WHERE from_id IS NOT NULL"""

MODELS["stg_twitter_tweets"] = f"""
SELECT id AS tweet_id, author_id, conversation_id, in_reply_to_user_id, text,
       {_i("public_metrics_retweet_count")} AS retweet_count, {_i("public_metrics_reply_count")} AS reply_count,
       {_i("public_metrics_like_count")} AS like_count, {_i("public_metrics_quote_count")} AS quote_count,
       {_i("public_metrics_impression_count")} AS impression_count, cast(created_at AS timestamp) AS created_at,
       'https://twitter.com/i/web/status/' || id AS tweet_url, _airbyte_extracted_at AS extracted_at
FROM raw_twitter_tweets WHERE id IS NOT NULL"""

MODELS["stg_twitter_user_metrics"] = f"""
SELECT id AS user_id, username, name AS display_name, description AS bio,
       {_i("public_metrics_followers_count")} AS followers_count, {_i("public_metrics_following_count")} AS following_count,
       {_i("public_metrics_tweet_count")} AS tweet_count, {_i("public_metrics_listed_count")} AS listed_count,
       cast(verified AS boolean) AS is_verified, cast(created_at AS timestamp) AS account_created_at,
       cast(_airbyte_extracted_at AS date) AS metric_date, _airbyte_extracted_at AS extracted_at
FROM raw_twitter_user_metrics WHERE id IS NOT NULL"""

MODELS["stg_linkedin_posts"] = f"""
SELECT id AS post_id, author AS author_id, coalesce(specific_content_share_commentary_text, commentary) AS title,
       text AS description, content_landing_page_content_type AS content_type,
       cast(created_time AS timestamp) AS published_at,
       {_i("total_share_statistics_impression_count")} AS impressions, {_i("total_share_statistics_click_count")} AS clicks,
       {_i("total_share_statistics_like_count")} AS likes, {_i("total_share_statistics_comment_count")} AS comments,
       {_i("total_share_statistics_share_count")} AS shares,
       CASE WHEN coalesce(cast(total_share_statistics_impression_count AS int), 1) = 0 THEN 0.0
            ELSE cast({_i("total_share_statistics_like_count")} + {_i("total_share_statistics_comment_count")}
                      + {_i("total_share_statistics_share_count")} AS double)
                 / cast(coalesce(cast(total_share_statistics_impression_count AS int), 1) AS double) * 100 END AS engagement_rate,
       'https://linkedin.com/feed/update/' || id AS post_url, _airbyte_extracted_at AS extracted_at
FROM raw_linkedin_posts WHERE id IS NOT NULL"""

MODELS["stg_linkedin_page_stats"] = f"""
SELECT organization AS page_id, organization_name AS page_name, {_i("follower_count")} AS follower_count,
       {_i("page_statistics_views_all_page_views")} AS page_views,
       {_i("page_statistics_views_unique_visitors")} AS unique_visitors,
       cast(time_range_start AS date) AS metric_date, _airbyte_extracted_at AS extracted_at
FROM raw_linkedin_page_stats WHERE organization IS NOT NULL"""

MODELS["stg_github_repos"] = f"""
SELECT id AS repo_id, name AS repo_name, full_name, owner_login, owner_id, description, homepage, language, topics,
       html_url, clone_url, ssh_url, cast(private AS boolean) AS is_private, cast(fork AS boolean) AS is_fork,
       cast(archived AS boolean) AS is_archived, cast(disabled AS boolean) AS is_disabled,
       cast(has_issues AS boolean) AS has_issues_enabled, cast(has_wiki AS boolean) AS has_wiki_enabled,
       cast(has_pages AS boolean) AS has_pages_enabled, cast(has_downloads AS boolean) AS has_downloads_enabled,
       {_i("stargazers_count")} AS stargazers_count, {_i("watchers_count")} AS watchers_count,
       {_i("forks_count")} AS forks_count, {_i("open_issues_count")} AS open_issues_count, {_i("size")} AS size_kb,
       license_key, license_name, cast(created_at AS timestamp) AS created_at,
       cast(updated_at AS timestamp) AS updated_at, cast(pushed_at AS timestamp) AS pushed_at,
       _airbyte_extracted_at AS extracted_at
FROM raw_github_repositories WHERE id IS NOT NULL"""

MODELS["stg_github_commits"] = f"""
SELECT sha AS commit_sha, repository AS repo_full_name, commit_author_name AS author_name,
       commit_author_email AS author_email, cast(commit_author_date AS timestamp) AS authored_at,
       commit_committer_name AS committer_name, cast(commit_committer_date AS timestamp) AS committed_at,
       commit_message AS message, {_i("stats_additions")} AS lines_added, {_i("stats_deletions")} AS lines_deleted,
       {_i("stats_total")} AS lines_changed, html_url AS commit_url, _airbyte_extracted_at AS extracted_at
FROM raw_github_commits WHERE sha IS NOT NULL"""

MODELS["stg_github_pull_requests"] = f"""
SELECT id AS pr_id, number AS pr_number, repository AS repo_full_name, title, body AS description, state,
       user_login AS author_login, user_id AS author_id, cast(created_at AS timestamp) AS created_at,
       cast(updated_at AS timestamp) AS updated_at, cast(merged_at AS timestamp) AS merged_at,
       cast(closed_at AS timestamp) AS closed_at, {_i("additions")} AS lines_added, {_i("deletions")} AS lines_deleted,
       {_i("changed_files")} AS files_changed, {_i("commits")} AS commit_count, {_i("comments")} AS comment_count,
       cast(merged AS boolean) AS is_merged, cast(draft AS boolean) AS is_draft, html_url AS pr_url,
       _airbyte_extracted_at AS extracted_at
FROM raw_github_pull_requests WHERE id IS NOT NULL"""

MODELS["stg_github_issues"] = f"""
SELECT id AS issue_id, number AS issue_number, repository AS repo_full_name, title, body, state,
       user_login AS author_login, user_id AS author_id, labels, assignees,
       cast(created_at AS timestamp) AS created_at, cast(updated_at AS timestamp) AS updated_at,
       cast(closed_at AS timestamp) AS closed_at, {_i("comments")} AS comment_count,
       pull_request IS NOT NULL AS is_pull_request, html_url AS issue_url, _airbyte_extracted_at AS extracted_at
FROM raw_github_issues WHERE id IS NOT NULL AND pull_request IS NULL"""

MODELS["stg_stripe_charges"] = f"""
SELECT id AS charge_id, customer AS customer_id, amount AS amount_cents, cast(amount AS double) / 100.0 AS amount_dollars,
       currency, status, cast(paid AS boolean) AS is_paid, cast(refunded AS boolean) AS is_refunded,
       description, receipt_email, invoice AS invoice_id, {_epoch("created")} AS created_at,
       failure_code, failure_message, _airbyte_extracted_at AS extracted_at
FROM raw_stripe_charges WHERE id IS NOT NULL"""

MODELS["stg_stripe_customers"] = f"""
SELECT id AS customer_id, email, name, phone, description, address_city AS city, address_country AS country,
       address_postal_code AS postal_code, currency, {_i("balance")} AS balance_cents,
       cast({_i("balance")} AS double) / 100.0 AS balance_dollars, cast(delinquent AS boolean) AS is_delinquent,
       default_source, {_epoch("created")} AS created_at, _airbyte_extracted_at AS extracted_at
FROM raw_stripe_customers WHERE id IS NOT NULL"""

MODELS["stg_stripe_subscriptions"] = f"""
SELECT id AS subscription_id, customer AS customer_id, status, plan_id, plan_nickname AS plan_name,
       plan_amount AS amount_cents, cast(plan_amount AS double) / 100.0 AS amount_dollars,
       plan_currency AS currency, plan_interval AS "interval", plan_interval_count AS interval_count,
       {_epoch("current_period_start")} AS current_period_start, {_epoch("current_period_end")} AS current_period_end,
       cast(cancel_at_period_end AS boolean) AS cancel_at_period_end,
       {_epoch("nullif(canceled_at, 0)")} AS canceled_at, {_epoch("nullif(ended_at, 0)")} AS ended_at,
       {_epoch("created")} AS created_at, _airbyte_extracted_at AS extracted_at
FROM raw_stripe_subscriptions WHERE id IS NOT NULL"""

MODELS["stg_notion_pages"] = """
SELECT id AS page_id, properties_title_title_0_plain_text AS title, parent_type,
       coalesce(parent_database_id, parent_page_id, parent_workspace) AS parent_id,
       created_by_id AS created_by, last_edited_by_id AS last_edited_by,
       cast(created_time AS timestamp) AS created_at, cast(last_edited_time AS timestamp) AS last_edited_at,
       cast(archived AS boolean) AS is_archived, url AS page_url, _airbyte_extracted_at AS extracted_at
FROM raw_notion_pages WHERE id IS NOT NULL"""


# ----------------------------------------------------------------- compose
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str) -> list[str]:
    seen = []
    for w in _WORD.findall(sql):
        if (w in MODELS or w in BINDINGS) and w not in seen:
            seen.append(w)
    return seen


def _body(name: str) -> str:
    return MODELS[name] if name in MODELS else duckdb_sql(name)


def compose(final_sql: str) -> str:
    """Wrap ``final_sql`` with every model/binding it needs as CTEs."""
    order: list[str] = []
    visiting: set[str] = set()

    def visit(n: str) -> None:
        if n in order:
            return
        if n in visiting:
            raise ValueError(f"cycle at {n}")
        visiting.add(n)
        for d in _deps(_body(n)):
            if d != n:
                visit(d)
        visiting.discard(n)
        order.append(n)

    for d in _deps(final_sql):
        visit(d)
    if not order:
        return final_sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{_body(n).strip()}\n)" for n in order)
    return f"WITH {ctes}\n{final_sql.strip()}"


def rounded(select_from: str, doubles: list[str] | tuple[str, ...] = ()) -> str:
    """``SELECT * REPLACE (round(d, 6) AS d …) FROM <relation>``, rounding via
    DECIMAL(38, 10) first (matches the Spark side's two-step rounding)."""
    if not doubles:
        return f"SELECT * FROM {select_from}"
    rep = ", ".join(f"CASE WHEN abs({d}) < 1e6 THEN cast(round(cast({d} AS DECIMAL(38, 10)), 6) AS DOUBLE) "
                    f"ELSE round({d}, 6) END AS {d}" for d in doubles)
    return f"SELECT * REPLACE ({rep}) FROM {select_from}"


def upsert_sql(target: str, batch: str, cols: list[str], keys: list[str], update: list[str],
               order: list[str] | None = None) -> str:
    """Oracle form of the keyed upsert (latest batch row per key wins)."""
    c = ", ".join(cols)
    k = ", ".join(keys)
    if order:
        o = ", ".join(f"{x} DESC" for x in order)
        oa = ", ".join(order)
        kept = [x for x in cols if x not in keys and x not in update]
        last = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS _rn FROM {batch}) z WHERE _rn = 1"
        first = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {oa}) AS _rn FROM {batch}) z WHERE _rn = 1"
        fon = " AND ".join(f"l.{x} = f.{x}" for x in keys)
        pick = ", ".join(f"f.{x} AS {x}" if x in kept else f"l.{x} AS {x}" for x in cols)
        b = f"SELECT {pick} FROM ({last}) l JOIN ({first}) f ON {fon}"
    else:
        b = f"SELECT {c} FROM {batch}"
    on = " AND ".join(f"t.{x} = b.{x}" for x in keys)
    sel = ", ".join(f"b.{x}" if (x in keys or x in update) else f"CASE WHEN t.{keys[0]} IS NOT NULL THEN t.{x} ELSE b.{x} END AS {x}"
                    for x in cols)
    return (f"WITH b AS ({b})\n"
            f"SELECT {c} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM b WHERE {on})\n"
            f"UNION ALL\nSELECT {sel} FROM b LEFT JOIN {target} t ON {on}")


def insert_if_absent_sql(target: str, batch: str, cols: list[str], keys: list[str], order: list[str]) -> str:
    c = ", ".join(cols)
    k = ", ".join(keys)
    o = ", ".join(order)
    on = " AND ".join(f"t.{x} = b.{x}" for x in keys)
    return (f"WITH b AS (SELECT {c} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS _rn "
            f"FROM {batch}) z WHERE _rn = 1)\n"
            f"SELECT {c} FROM {target}\nUNION ALL\n"
            f"SELECT {c} FROM b WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})")
