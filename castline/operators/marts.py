"""Tool-1 marts (A1-A7, JN2, JN3, O3): podcast vs video performance.

Plan notes
* Per-episode / per-video metrics are aggregated *before* joining to content
  (partial aggregation map-side, then one shuffle on the id), so the joins are
  1:1 on unique keys and cannot fan out or skew.
* ``mart_daily_metrics`` is one union + one ``groupBy(metric_date)``: a single
  shuffle of map-side partial sums, instead of two aggregations, a distinct
  date spine and two joins.  ``date_spine_join`` keeps the literal plan shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castline.functions import days_between_inclusive, pg_day_name, pg_day_of_week

col = F.col


def _zero(c: str, kind: str = "bigint"):
    return F.coalesce(col(c), F.lit(0).cast(kind))


# A1 ------------------------------------------------------------------------
def spotify_per_episode(perf: DataFrame) -> DataFrame:
    return perf.groupBy("episode_id").agg(
        F.sum("streams").alias("total_streams"),
        F.sum("starts").alias("total_starts"),
        F.sum("unique_listeners").alias("total_unique_listeners"),
        F.avg("avg_listen_seconds").alias("avg_listen_seconds"),
    )


# A2 ------------------------------------------------------------------------
def youtube_per_video(stats: DataFrame) -> DataFrame:
    return stats.groupBy("video_id").agg(
        F.sum("views").alias("total_views"),
        F.sum("watch_time_minutes").alias("total_watch_minutes"),
        F.sum("likes").alias("total_likes"),
        F.sum("comments").alias("total_comments"),
        F.avg("avg_view_seconds").alias("avg_view_seconds"),
    )


# JN2 -----------------------------------------------------------------------
def content_performance_join(content: DataFrame, s_agg: DataFrame, y_agg: DataFrame) -> DataFrame:
    """content ⟕ per-episode ⟕ per-video aggregates (keys unique on the right)."""
    s = s_agg.withColumnRenamed("episode_id", "s_episode_id")
    y = y_agg.withColumnRenamed("video_id", "y_video_id")
    return (content
            .join(s, col("episode_id") == col("s_episode_id"), "left")
            .join(y, col("video_id") == col("y_video_id"), "left")
            .drop("s_episode_id", "y_video_id"))


# A3 ------------------------------------------------------------------------
def mart_content_performance(content: DataFrame, perf: DataFrame, stats: DataFrame) -> DataFrame:
    j = content_performance_join(content, spotify_per_episode(perf), youtube_per_video(stats))
    return j.select(
        "content_id", "title", "published_date", "duration_seconds", "content_source", "episode_id", "video_id",
        _zero("total_streams").alias("total_streams"),
        _zero("total_starts").alias("total_starts"),
        _zero("total_unique_listeners").alias("total_unique_listeners"),
        "avg_listen_seconds",
        _zero("total_views").alias("total_views"),
        _zero("total_watch_minutes", "double").alias("total_watch_minutes"),
        _zero("total_likes").alias("total_likes"),
        _zero("total_comments").alias("total_comments"),
        "avg_view_seconds",
        (_zero("total_streams") + _zero("total_views")).alias("total_consumption"),
        F.when(col("total_views") > 0, col("total_likes").cast("double") / col("total_views").cast("double"))
         .otherwise(F.lit(0.0)).alias("youtube_like_rate"),
        F.when(col("total_starts") > 0, col("total_streams").cast("double") / col("total_starts").cast("double"))
         .otherwise(F.lit(0.0)).alias("spotify_completion_rate"),
    )


# A4 ------------------------------------------------------------------------
def spotify_daily(perf: DataFrame) -> DataFrame:
    return perf.groupBy("metric_date").agg(
        F.sum("streams").alias("streams"), F.sum("starts").alias("starts"),
        F.sum("unique_listeners").alias("listeners"))


def youtube_daily(stats: DataFrame) -> DataFrame:
    return stats.groupBy("metric_date").agg(
        F.sum("views").alias("views"), F.sum("watch_time_minutes").alias("watch_minutes"),
        F.sum("likes").alias("likes"), F.sum("comments").alias("comments"))


# O3 ------------------------------------------------------------------------
def date_spine(*frames: DataFrame, date_col: str = "metric_date") -> DataFrame:
    """UNION (distinct) of the dates present in any input."""
    out = None
    for f in frames:
        d = f.select(date_col)
        out = d if out is None else out.union(d)
    return out.distinct()


def _daily_final(df: DataFrame) -> DataFrame:
    return df.select(
        "metric_date",
        _zero("streams").alias("spotify_streams"), _zero("starts").alias("spotify_starts"),
        _zero("listeners").alias("spotify_listeners"), _zero("views").alias("youtube_views"),
        _zero("watch_minutes", "double").alias("youtube_watch_minutes"),
        _zero("likes").alias("youtube_likes"), _zero("comments").alias("youtube_comments"),
        (_zero("streams") + _zero("views")).alias("total_consumption"),
        pg_day_of_week("metric_date").alias("day_of_week"),
        pg_day_name("metric_date").alias("day_name"),
    )


# A5 ------------------------------------------------------------------------
def mart_daily_metrics(perf: DataFrame, stats: DataFrame) -> DataFrame:
    """Daily consumption on both platforms over the union of their dates.

    A NULL date forms its own spine row whose metrics are 0 (NULL never
    matches in the reference's left joins), hence the ``isNotNull`` guards.
    """
    d = col("metric_date")
    nn = d.isNotNull()
    typed_null = lambda t: F.lit(None).cast(t)
    s = perf.select(d, col("streams").cast("bigint").alias("streams"), col("starts").cast("bigint").alias("starts"),
                    col("unique_listeners").cast("bigint").alias("listeners"),
                    typed_null("bigint").alias("views"), typed_null("double").alias("watch_minutes"),
                    typed_null("bigint").alias("likes"), typed_null("bigint").alias("comments"))
    y = stats.select(d, typed_null("bigint").alias("streams"), typed_null("bigint").alias("starts"),
                     typed_null("bigint").alias("listeners"), col("views").cast("bigint").alias("views"),
                     col("watch_time_minutes").cast("double").alias("watch_minutes"),
                     col("likes").cast("bigint").alias("likes"), col("comments").cast("bigint").alias("comments"))
    metrics = ["streams", "starts", "listeners", "views", "watch_minutes", "likes", "comments"]
    daily = s.unionByName(y).groupBy("metric_date").agg(
        *[F.sum(F.when(nn, col(m))).alias(m) for m in metrics])
    return _daily_final(daily).orderBy("metric_date")


def date_spine_join(perf: DataFrame, stats: DataFrame) -> DataFrame:
    """JN3: the literal plan — date spine ⟕ spotify daily ⟕ youtube daily."""
    sd, yd = spotify_daily(perf), youtube_daily(stats)
    spine = date_spine(sd, yd)
    sd = sd.withColumnRenamed("metric_date", "s_date")
    yd = yd.withColumnRenamed("metric_date", "y_date")
    joined = (spine.join(sd, col("metric_date") == col("s_date"), "left")
              .join(yd, col("metric_date") == col("y_date"), "left"))
    return _daily_final(joined).orderBy("metric_date")


# A6 ------------------------------------------------------------------------
def platform_totals(perf: DataFrame, stats: DataFrame) -> DataFrame:
    """Ungrouped totals per platform: exactly one row each, even when empty."""
    sp = perf.agg(
        F.lit("spotify").alias("platform"),
        F.sum("streams").cast("bigint").alias("total_consumption"),
        F.sum("starts").cast("bigint").alias("total_starts"),
        F.sum("unique_listeners").cast("bigint").alias("total_reach"),
        F.countDistinct("episode_id").alias("content_count"),
        F.min("metric_date").alias("first_date"), F.max("metric_date").alias("last_date"))
    yt = stats.agg(
        F.lit("youtube").alias("platform"),
        F.sum("views").cast("bigint").alias("total_consumption"),
        F.lit(None).cast("bigint").alias("total_starts"),
        F.lit(None).cast("bigint").alias("total_reach"),
        F.countDistinct("video_id").alias("content_count"),
        F.min("metric_date").alias("first_date"), F.max("metric_date").alias("last_date"))
    return sp.unionByName(yt)


# A7 ------------------------------------------------------------------------
def mart_platform_comparison(perf: DataFrame, stats: DataFrame, show: DataFrame) -> DataFrame:
    """A6 + days active + daily average + followers (uncorrelated scalar subquery)."""
    followers = show.select(F.max("followers")).scalar()
    days = days_between_inclusive("first_date", "last_date")
    return platform_totals(perf, stats).select(
        "platform", "total_consumption", "total_starts", "total_reach", "content_count",
        "first_date", "last_date",
        days.alias("days_active"),
        F.when(days > 0, col("total_consumption").cast("double") / days.cast("double"))
         .otherwise(F.lit(0.0)).alias("avg_daily_consumption"),
        F.when(col("platform") == "spotify", followers).alias("followers"),
    )
