"""Landed API payloads (JSON documents) derived from the base tables.

A collector lands one JSON document per API response; here the documents are
generated by Spark from the driver's tables so their number grows with the
data.  Every document holds a bounded page of items — at most 50 videos per
search page, 100 comment threads per page, one report row per day of the
report window — exactly like the API responses they stand in for.  Some
documents carry deliberate defects (empty ``items``, unparseable timestamps,
short / NULL / non-numeric report cells, malformed JSON) so the flatteners'
error handling is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

col = F.col
VIDEO_PAGE = 50
COMMENT_PAGE = 100
# A report document covers one window of REPORT_DAYS days (one row per day).
REPORT_DAYS = 30
REPORT_EPOCH = "2020-01-01"


def _n_shows(catalog) -> F.Column:
    """Number of shows as an uncorrelated scalar subquery (no join needed)."""
    return catalog.base("supplier").select(F.count(F.lit(1))).scalar()


def channel_info(catalog) -> DataFrame:
    """J1 input: one channel document per show; every 7th show has no items."""
    s = catalog.base("supplier")
    item = F.struct(F.concat(F.lit("UC"), col("s_suppkey").cast("string")).alias("id"),
                    F.struct(col("s_name").alias("description")).alias("snippet"))
    items = F.when(col("s_suppkey") % 7 == 0, F.array().cast("array<struct<id:string,snippet:struct<description:string>>>")) \
        .otherwise(F.array(item))
    return s.select(col("s_suppkey").alias("podcast_id"),
                    F.to_json(F.struct(F.lit("youtube#channelListResponse").alias("kind"),
                                       items.alias("items"))).alias("payload"))


def video_search(catalog) -> DataFrame:
    """J2 input: search pages of at most 50 videos per show."""
    p = catalog.base("part").withColumn("n_shows", _n_shows(catalog))
    published = F.when(col("p_partkey") % 13 == 0, F.lit("not-a-date")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad(((col("p_partkey") % 28) + 1).cast("string"), 2, "0"),
                 F.lit("T10:30:00Z")))
    item = F.struct(F.struct(F.concat(F.lit("vid"), col("p_partkey").cast("string")).alias("videoId")).alias("id"),
                    F.struct(col("p_name").alias("title"), col("p_type").alias("description"),
                             published.alias("publishedAt")).alias("snippet"))
    return (p.select((col("p_partkey") % col("n_shows")).alias("podcast_id"),
                     F.floor(col("p_partkey") / (col("n_shows") * VIDEO_PAGE)).alias("page"), item.alias("item"))
            .groupBy("podcast_id", "page")
            .agg(F.to_json(F.struct(F.collect_list("item").alias("items"))).alias("payload")))


def _num(c) -> F.Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def daily_report(catalog) -> DataFrame:
    """J3 input: one analytics report per video; one positional row per day.

    Defects: (views % 11 == 0) → 9 cells; (views % 13 == 0) → a NULL likes
    cell; (views % 17 == 0) → a bad date; (views % 19 == 0) → a 5-cell row."""
    e = catalog.base("events")
    daily = e.groupBy(col("user_id").alias("video"), col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("views"),
        F.sum(F.when(col("event_type") == "click", 1).otherwise(0)).alias("likes"),
        F.sum(F.when(col("event_type") == "error", 1).otherwise(0)).alias("dislikes"),
        F.sum(F.when(col("event_type") == "signup", 1).otherwise(0)).alias("comments"),
        F.sum(F.when(col("event_type") == "view", 1).otherwise(0)).alias("shares"),
        F.round(F.sum("value"), 2).alias("minutes"),
        F.round(F.avg("value"), 3).alias("avg_dur"),
        F.sum(F.when(col("event_type") == "signup", 1).otherwise(0)).alias("subs_gained"),
        F.lit(0).alias("subs_lost"))
    v = col("views")
    day = F.when(v % 17 == 0, F.lit("2024-13-45")).otherwise(col("day").cast("string"))
    likes = F.when(v % 13 == 0, F.lit("null")).otherwise(col("likes").cast("string"))
    cells9 = [F.concat(F.lit('"'), day, F.lit('"')), _num(v), likes, _num(col("dislikes")), _num(col("comments")),
              _num(col("shares")), _num(col("minutes")), _num(col("avg_dur")), _num(col("subs_gained"))]
    row = (F.when(v % 19 == 0, F.concat_ws(",", *cells9[:5]))
           .when(v % 11 == 0, F.concat_ws(",", *cells9))
           .otherwise(F.concat_ws(",", *cells9, _num(col("subs_lost")))))
    window = F.floor(F.datediff(col("day"), F.lit(REPORT_EPOCH).cast("date")) / REPORT_DAYS)
    return (daily.groupBy("video", window.alias("window")).agg(
        F.concat(F.lit('{"kind":"youtubeAnalytics#resultTable","rows":['),
                 F.concat_ws(",", F.collect_list(F.concat(F.lit("["), row, F.lit("]")))),
                 F.lit("]}")).alias("payload"))
            .select(F.concat(F.lit("v"), col("video").cast("string")).alias("video_id"), "payload"))


def show_report(catalog) -> DataFrame:
    """J4 input: one channel report per show, columns in request order
    (day, views, likes, comments, shares, subscribersGained, subscribersLost,
    estimatedMinutesWatched)."""
    o = catalog.base("orders").withColumn("n_shows", _n_shows(catalog))
    daily = (o.groupBy((col("o_custkey") % col("n_shows")).alias("podcast_id"),
                       F.date_add(F.lit("2024-01-01").cast("date"), (col("o_orderkey") % 30).cast("int")).alias("day"))
             .agg(F.count(F.lit(1)).alias("views"),
                  F.sum(F.when(col("o_orderstatus") == "F", 1).otherwise(0)).alias("likes"),
                  F.sum(F.when(col("o_orderstatus") == "P", 1).otherwise(0)).alias("comments"),
                  F.sum(F.when(col("o_orderstatus") == "O", 1).otherwise(0)).alias("shares"),
                  F.countDistinct("o_custkey").alias("subs_gained"),
                  F.lit(0).alias("subs_lost"),
                  F.expr("sum(cast(round(o_totalprice) AS bigint)) div 1000").alias("minutes")))
    row = F.concat(F.lit('["'), col("day").cast("string"), F.lit('",'),
                   F.concat_ws(",", *[col(c).cast("string") for c in
                                      ("views", "likes", "comments", "shares", "subs_gained", "subs_lost",
                                       "minutes")]), F.lit("]"))
    window = F.floor(F.datediff(col("day"), F.lit(REPORT_EPOCH).cast("date")) / REPORT_DAYS)
    return daily.groupBy("podcast_id", window.alias("window")).agg(
        F.concat(F.lit('{"rows":['), F.concat_ws(",", F.collect_list(row)), F.lit("]}")).alias("payload"))


def comment_threads(catalog) -> DataFrame:
    """J5 input: comment-thread pages (≤ 100 threads) per episode."""
    c = catalog.base("conversations")
    published = F.when(col("turn") == 3, F.lit("yesterday")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad((col("turn") + 1).cast("string"), 2, "0"), F.lit("T08:00:00Z")))
    author_id = F.when(col("role") == "user", F.struct(F.concat(F.lit("UCa"), col("conv_id").cast("string"))
                                                       .alias("value")))
    item = F.struct(
        F.concat(col("conv_id").cast("string"), F.lit("-"), col("turn").cast("string")).alias("id"),
        F.struct((col("turn") % 3).cast("int").alias("totalReplyCount"),
                 F.struct(F.struct(col("text").alias("textDisplay"), col("role").alias("authorDisplayName"),
                                   author_id.alias("authorChannelId"),
                                   (F.length("text") % 97).cast("int").alias("likeCount"),
                                   published.alias("publishedAt")).alias("snippet")).alias("topLevelComment"))
        .alias("snippet"))
    return (c.groupBy(col("conv_id").alias("episode_id"), F.floor(col("turn") / COMMENT_PAGE).alias("page"))
            .agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload")))


def platform_metric_lines(catalog) -> DataFrame:
    """ST4 input: one landed metric record per collector event; records of
    failed calls are malformed JSON."""
    e = catalog.base("events")
    platform = (F.when(col("event_id") % 4 == 0, "apple_podcasts").when(col("event_id") % 4 == 1, "spotify")
                .when(col("event_id") % 4 == 2, "amazon_music").otherwise("youtube"))
    body = F.when(col("event_type") == "error", F.concat(F.lit("{oops "), col("props"))).otherwise(col("props"))
    return e.select(col("event_id").alias("record_id"), platform.alias("platform"),
                    col("ts").cast("date").alias("metric_date"), body.alias("payload"))
