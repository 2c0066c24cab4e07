"""Landed-JSON flattening (J1-J6): API payload documents → typed rows.

A payload is parsed once, to VARIANT (``document``); fields are read from that by
path with declared types, so nothing is inferred and no field costs another parse.
Malformed documents or cells become NULL or 0 instead of failing the job, matching the
collector's tolerant parsers.  Each document is a bounded page, and exploding it is a
narrow, per-row operation — no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col = F.col

GEO_SCHEMA = "array<struct<country: string, city: string, count: bigint>>"
DEVICE_SCHEMA = "map<string, bigint>"

# Metric columns of the per-video daily report, in request order.
VIDEO_REPORT_METRICS = ("views", "likes", "dislikes", "comments", "shares", "estimatedMinutesWatched",
                        "averageViewDuration", "subscribersGained", "subscribersLost")
# Metric columns of the channel report, in request order.
SHOW_REPORT_METRICS = ("views", "likes", "comments", "shares", "subscribersGained", "subscribersLost",
                       "estimatedMinutesWatched")


def rfc3339(c: Column) -> Column:
    """RFC 3339 text → UTC wall-clock timestamp; unparseable → NULL."""
    ts = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                    F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")))
    return ts.cast("timestamp_ntz")


#: The column that holds a parsed payload.
DOC = "_doc"
# The types of JSON numbers.
NUMBER_TYPES = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
# Their first letters, which no other type of a variant has: a cell is asked without a pattern.
NUMBER_STARTS = ("BIG", "DOU", "FLO", "DEC")


def parsed(payloads: DataFrame) -> DataFrame:
    """``payloads`` with the document of each as VARIANT (NULL if it is not JSON); one that has it stays as it is."""
    return payloads if DOC in payloads.columns else payloads.withColumn(DOC, F.try_parse_json("payload"))


def field(value: Column, path: str, kind: str) -> Column:
    """A field by its path; missing or of another type → NULL."""
    return F.try_variant_get(value, path, kind)


def each(payloads: DataFrame, keep: list[str], path: str) -> DataFrame:
    """``keep`` and one row ``it`` for each entry of the array at ``path``."""
    return parsed(payloads).select(*keep, F.explode(field(col(DOC), path, "array<variant>")).alias("it"))


def _cell_int(row: Column, i: int, text_numbers: bool) -> Column:
    """Report cell → integer (truncated); missing, NULL and text → 0 (``text_numbers``: text with a number counts)."""
    cell = F.get(row, i)
    number = field(cell, "$", "double").try_cast("bigint")
    if not text_numbers:
        number = F.when(F.substring(F.schema_of_variant(cell), 1, 3).isin(*NUMBER_STARTS), number)
    return F.coalesce(number, F.lit(0).cast("bigint"))


def _count(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def flatten_channel(payloads: DataFrame, keep: list[str] = ()) -> DataFrame:
    """First item of a channel document → (platform_id, description)."""
    doc = col(DOC)
    return parsed(payloads).select(*keep, "podcast_id", field(doc, "$.items[0].id", "string").alias("platform_id"),
                                   field(doc, "$.items[0].snippet.description", "string").alias("description"))


def flatten_videos(payloads: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One episode row per search item; bad publish times → NULL."""
    it = col("it")
    return each(payloads, [*keep, "podcast_id"], "$.items").select(
        *keep, "podcast_id", field(it, "$.id.videoId", "string").alias("platform_episode_id"),
        field(it, "$.snippet.title", "string").alias("episode_title"),
        field(it, "$.snippet.description", "string").alias("description"),
        rfc3339(field(it, "$.snippet.publishedAt", "string")).alias("publish_date"))


def _report_rows(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the cells ``r`` of each report row."""
    return each(payloads, keep, "$.rows").select(*keep, field(col("it"), "$", "array<variant>").alias("r"))


def _day(row: Column) -> Column:
    return F.try_to_timestamp(field(F.get(row, 0), "$", "string"), F.lit("yyyy-MM-dd")).cast("date")


def flatten_report_rows(payloads: DataFrame, id_col: str = "video_id", keep: list[str] = (), text_numbers: bool = False) -> DataFrame:
    """Positional daily rows → 9 metrics; rows with < 9 cells dropped;
    the optional 10th cell is read NULL-safely.  Only JSON numbers count, unless ``text_numbers``."""
    def cell(i: int) -> Column:
        return _cell_int(col("r"), i, text_numbers)

    return _report_rows(payloads, [*keep, id_col]).where(F.size("r") >= 9).select(
        *keep, id_col, _day(col("r")).alias("metric_date"),
        cell(1).alias("views"), cell(2).alias("likes"), cell(3).alias("dislikes"),
        cell(4).alias("comments_count"), cell(5).alias("shares"), cell(6).alias("watch_time_minutes"),
        cell(7).cast("int").alias("average_view_duration_seconds"),
        cell(8).cast("int").alias("subscribers_gained"), cell(9).cast("int").alias("subscribers_lost"))


def flatten_show_rows(payloads: DataFrame, id_col: str = "podcast_id", keep: list[str] = (), text_numbers: bool = False) -> DataFrame:
    """Channel report rows mapped by the request's metric order."""
    def cell(i: int) -> Column:
        return _cell_int(col("r"), i, text_numbers)

    return _report_rows(payloads, [*keep, id_col]).select(
        *keep, id_col, _day(col("r")).alias("metric_date"),
        cell(1).alias("total_views"), cell(2).alias("total_likes"),
        cell(3).alias("total_comments"), cell(4).alias("total_shares"),
        cell(5).cast("int").alias("subscribers_gained"), cell(6).cast("int").alias("subscribers_lost"),
        cell(7).alias("watch_time_minutes"))


def flatten_comments(payloads: DataFrame, key: str = "episode_id", keep: list[str] = ()) -> DataFrame:
    """Comment threads → comment rows (nested author / likes / replies)."""
    it, top = col("it"), "$.snippet.topLevelComment.snippet"
    return each(payloads, [*keep, key], "$.items").select(
        *keep, key, field(it, "$.id", "string").alias("platform_comment_id"),
        field(it, f"{top}.authorDisplayName", "string").alias("author_name"),
        field(it, f"{top}.authorChannelId.value", "string").alias("author_id"),
        field(it, f"{top}.textDisplay", "string").alias("comment_text"),
        _count(field(it, f"{top}.likeCount", "double")).alias("likes_count"),
        _count(field(it, "$.snippet.totalReplyCount", "double")).alias("reply_count"),
        rfc3339(field(it, f"{top}.publishedAt", "string")).alias("published_at"))


def payload_drift(reports: DataFrame) -> DataFrame:
    """What report cells hold against what the parsers expect, per position.

    The merged type of all cells of a position (``schema_of_variant_agg``), as a class, and
    how many are numbers, texts or NULL; ``drifted`` where something else than the declared class
    (text for the day, a number for a metric) was found.  One parse and one partial aggregate.
    """
    cells = _report_rows(reports, []).select(F.posexplode("r").alias("position", "cell"))
    kind = F.schema_of_variant("cell")
    n = {"numbers": kind.rlike(NUMBER_TYPES), "texts": kind == "STRING", "nulls": (kind == "VOID") | col("cell").isNull()}
    per = cells.groupBy("position").agg(
        F.count(F.lit(1)).alias("cells"), *[F.count(F.when(c, 1)).alias(name) for name, c in n.items()],
        F.schema_of_variant_agg("cell").alias("merged"))
    found = F.when(col("merged").rlike(NUMBER_TYPES), "number").when(col("merged") == "STRING", "text").when(
        col("merged") == "VOID", "null").otherwise("mixed")
    expected = F.when(col("position") == 0, "text").otherwise("number")
    return per.select("position", "cells", *n, found.alias("found"), ((found != expected) | (col("nulls") > 0)).alias("drifted"))


def geo_breakdown(metrics: DataFrame) -> DataFrame:
    """Top countries / cities arrays and the device map → long rows, in one pass over the input."""
    def rows(dimension: str, entries: Column, name: str, count: str) -> Column:
        made = F.transform(entries, lambda e: F.struct(F.lit(dimension).alias("dimension"), e[name].alias("name"),
                                                       e[count].alias("count")))
        return F.coalesce(made, F.array().cast("array<struct<dimension: string, name: string, count: bigint>>"))

    every = F.concat(rows("country", F.from_json("top_countries", GEO_SCHEMA), "country", "count"),
                     rows("city", F.from_json("top_cities", GEO_SCHEMA), "city", "count"),
                     rows("device", F.map_entries(F.from_json("device_breakdown", DEVICE_SCHEMA)), "key", "value"))
    return metrics.select("episode_id", "metric_date", F.explode(every).alias("g")).select(
        "episode_id", "metric_date", "g.dimension", "g.name", "g.count")
