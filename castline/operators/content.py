"""Content unification.

* JN1 ``content_unified_mapped`` (podcast vs video): Spotify episodes and
  YouTube videos linked through a manual mapping table.
* D5 ``int_content_unified`` (cross-platform): four platforms in one shape
  under a hashed surrogate key.

Join strategy: the mapping table is an equi-join side whose size is whatever
the seed holds; we do not force ``broadcast()`` on it — AQE converts the
sort-merge join to a broadcast at runtime when the measured side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the shuffle join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castline.functions import surrogate_key

col = F.col


def _blank(c):
    return c.isNull() | (c == "")


def _join_by_id(rows: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Left join on an id that is blank or NULL in very many rows ("not on that
    platform"): those rows match nothing and stay out of the shuffle, where they
    would all fall to one task."""
    matched = rows.where(~_blank(col(key))).join(other, col(key) == col(other_key), "left")
    alone = rows.where(_blank(col(key))).select(
        *rows.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields])
    return matched.unionByName(alone)


def content_unified_mapped(episodes: DataFrame, videos: DataFrame, mapping: DataFrame) -> DataFrame:
    """JN1: one row per mapped content id plus unmapped episodes / videos.

    Follows the reference exactly: the unmapped branches keep only rows whose
    joined ``content_id`` is NULL, unmapped videos also get the ``ep-`` prefix,
    and the Spotify attributes win in the mapped branch.
    """
    e = episodes.select("episode_id", "title", "published_date", "duration_seconds")
    v = videos.select("video_id", "title", "published_date", "duration_seconds")
    m = mapping.select("content_id", "episode_id", "video_id")
    by_id = m.select("content_id", col("episode_id").alias("m_episode_id"), col("video_id").alias("m_video_id"))

    episode_content = (
        e.join(by_id.where(~_blank(col("m_episode_id"))), col("episode_id") == col("m_episode_id"), "left")
        .where(_blank(col("m_video_id")) & col("content_id").isNull())
        .select("content_id", "episode_id", F.lit(None).cast("string").alias("video_id"),
                "title", "published_date", "duration_seconds",
                F.lit("spotify_only").alias("content_source"))
    )
    video_content = (
        v.join(by_id.where(~_blank(col("m_video_id"))), col("video_id") == col("m_video_id"), "left")
        .where(_blank(col("m_episode_id")) & col("content_id").isNull())
        .select("content_id", F.lit(None).cast("string").alias("episode_id"), "video_id",
                "title", "published_date", "duration_seconds",
                F.lit("youtube_only").alias("content_source"))
    )
    ea = e.select(*[col(c).alias(f"e_{c}") for c in e.columns])
    va = v.select(*[col(c).alias(f"v_{c}") for c in v.columns])
    mapped = (
        _join_by_id(_join_by_id(m.where(col("content_id").isNotNull()), "episode_id", ea, "e_episode_id"),
                    "video_id", va, "v_video_id")
        .select(
            "content_id",
            col("e_episode_id").alias("episode_id"),
            col("v_video_id").alias("video_id"),
            F.coalesce("e_title", "v_title").alias("title"),
            F.coalesce("e_published_date", "v_published_date").alias("published_date"),
            F.coalesce("e_duration_seconds", "v_duration_seconds").alias("duration_seconds"),
            F.when(col("e_episode_id").isNotNull() & col("v_video_id").isNotNull(), "both_platforms")
             .when(col("e_episode_id").isNotNull(), "spotify_only")
             .when(col("v_video_id").isNotNull(), "youtube_only").alias("content_source"),
        )
    )
    unified = mapped.unionByName(episode_content).unionByName(video_content)
    return unified.select(
        F.coalesce(col("content_id"), F.concat(F.lit("ep-"), F.coalesce("episode_id", "video_id"))).alias("content_id"),
        "episode_id", "video_id", "title", "published_date", "duration_seconds", "content_source",
    )


def int_content_unified(yt_videos: DataFrame, tw_streams: DataFrame, tweets: DataFrame,
                        li_posts: DataFrame) -> DataFrame:
    """YouTube, Twitch, Twitter and LinkedIn content in one shape (O1 union)."""
    null_s = F.lit(None).cast("string")
    youtube = yt_videos.select(
        F.lit("youtube").alias("platform"), col("video_id").alias("native_id"), F.lit("video").alias("content_type"),
        "title", "description", col("video_url").alias("url"), "thumbnail_url", "published_at", "extracted_at")
    twitch = tw_streams.select(
        F.lit("twitch").alias("platform"), col("stream_id").alias("native_id"), F.lit("stream").alias("content_type"),
        "title", null_s.alias("description"), col("stream_url").alias("url"), "thumbnail_url",
        col("started_at").alias("published_at"), "extracted_at")
    twitter = tweets.select(
        F.lit("twitter").alias("platform"), col("tweet_id").alias("native_id"), F.lit("tweet").alias("content_type"),
        col("text").alias("title"), null_s.alias("description"), col("tweet_url").alias("url"),
        null_s.alias("thumbnail_url"), col("created_at").alias("published_at"), "extracted_at")
    linkedin = li_posts.select(
        F.lit("linkedin").alias("platform"), col("post_id").alias("native_id"), F.lit("post").alias("content_type"),
        "title", "description", col("post_url").alias("url"), null_s.alias("thumbnail_url"),
        "published_at", "extracted_at")
    unioned = youtube.unionByName(twitch).unionByName(twitter).unionByName(linkedin)
    return unioned.select(surrogate_key("platform", "native_id").alias("content_key"), *unioned.columns)
