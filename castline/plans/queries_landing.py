"""Registration of landed-JSON flattening (J1-J6) and streaming (ST1-ST4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from castline.operators import collector as cl
from castline.operators import landing as ld
from castline.operators import maintain as mn
from castline.plans import oracle as O
from castline.plans.queries_ops import _COM, _PEM
from castline.plans.registry import register
from castline.session import scratch_path, staged, together
from castline.sources import payloads as pl
from castline.streaming import streams as st

col = F.col
NSUPP = "(SELECT count(*) FROM supplier)"

register("flatten_channel", lambda c: ld.flatten_channel(pl.channel_info(c)), """
SELECT s_suppkey AS podcast_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'UC' || cast(s_suppkey AS varchar) END AS platform_id,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS description FROM supplier""")

register("flatten_videos", lambda c: ld.flatten_videos(pl.video_search(c)), f"""
SELECT p_partkey % {NSUPP} AS podcast_id, 'vid' || cast(p_partkey AS varchar) AS platform_episode_id,
       p_name AS episode_title, p_type AS description,
       CASE WHEN p_partkey % 13 = 0 THEN NULL
            ELSE cast('2024-01-' || lpad(cast(p_partkey % 28 + 1 AS varchar), 2, '0') || ' 10:30:00' AS timestamp) END
         AS publish_date
FROM part""")

register("flatten_report_rows", lambda c: ld.flatten_report_rows(pl.daily_report(c)), """
WITH d AS (
  SELECT user_id AS video, cast(ts AS date) AS day, count(*) AS views,
         sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS likes,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS dislikes,
         sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS comments,
         sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS shares,
         round(sum(value), 2) AS minutes, round(avg(value), 3) AS avg_dur
  FROM events GROUP BY 1, 2)
SELECT 'v' || cast(video AS varchar) AS video_id, CASE WHEN views % 17 = 0 THEN NULL ELSE day END AS metric_date,
       cast(views AS bigint) AS views, cast(CASE WHEN views % 13 = 0 THEN 0 ELSE likes END AS bigint) AS likes,
       cast(dislikes AS bigint) AS dislikes, cast(comments AS bigint) AS comments_count, cast(shares AS bigint) AS shares,
       cast(floor(minutes) AS bigint) AS watch_time_minutes, cast(floor(avg_dur) AS int) AS average_view_duration_seconds,
       cast(comments AS int) AS subscribers_gained, cast(0 AS int) AS subscribers_lost
FROM d WHERE views % 19 <> 0""")

register("flatten_show_rows", lambda c: ld.flatten_show_rows(pl.show_report(c)), f"""
SELECT o_custkey % {NSUPP} AS podcast_id, DATE '2024-01-01' + cast(o_orderkey % 30 AS int) AS metric_date,
       count(*) AS total_views, cast(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS bigint) AS total_likes,
       cast(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS bigint) AS total_comments,
       cast(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS bigint) AS total_shares,
       cast(count(DISTINCT o_custkey) AS int) AS subscribers_gained, cast(0 AS int) AS subscribers_lost,
       cast(sum(cast(round(o_totalprice) AS bigint)) // 1000 AS bigint) AS watch_time_minutes
FROM orders GROUP BY 1, 2""")

register("flatten_comments", lambda c: ld.flatten_comments(pl.comment_threads(c)), """
SELECT conv_id AS episode_id, cast(conv_id AS varchar) || '-' || cast(turn AS varchar) AS platform_comment_id,
       role AS author_name, CASE WHEN role = 'user' THEN 'UCa' || cast(conv_id AS varchar) END AS author_id,
       text AS comment_text, cast(length(text) % 97 AS int) AS likes_count, cast(turn % 3 AS int) AS reply_count,
       CASE WHEN turn = 3 THEN NULL
            ELSE try_cast('2024-01-' || lpad(cast(turn + 1 AS varchar), 2, '0') || ' 08:00:00' AS timestamp) END
         AS published_at
FROM conversations""")

register("geo_breakdown", lambda c: ld.geo_breakdown(c.raw("raw_podcast_episode_metrics")), """
SELECT episode_id, metric_date, 'country' AS dimension, g.country AS name, g.count AS count
FROM (SELECT episode_id, metric_date,
             unnest(from_json(top_countries, '[{"country":"VARCHAR","count":"BIGINT"}]')) AS g
      FROM raw_podcast_episode_metrics) a
UNION ALL
SELECT episode_id, metric_date, 'city', g.city, g.count
FROM (SELECT episode_id, metric_date, unnest(from_json(top_cities, '[{"city":"VARCHAR","count":"BIGINT"}]')) AS g
      FROM raw_podcast_episode_metrics) b
UNION ALL
SELECT episode_id, metric_date, 'device', k, cast(json_extract_string(device_breakdown, '$.' || k) AS bigint)
FROM (SELECT episode_id, metric_date, device_breakdown, unnest(json_keys(device_breakdown)) AS k
      FROM raw_podcast_episode_metrics) d""")


# ----------------------------------------------------------- collector run
_PLATFORM_SQL = ("CASE {k} % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music' "
                 "ELSE 'youtube' END")


def landed_documents(c):
    """The documents of all platforms; the channel documents of one platform are not JSON."""
    def of(show):
        return F.expr(_PLATFORM_SQL.format(k=f"({show})"))

    n = c.base("supplier").select(F.count(F.lit(1)).alias("n_shows"))
    shows = pl.channel_info(c).withColumn("platform", of("podcast_id"))
    reports = pl.daily_report(c).withColumn("user", F.expr("cast(substring(video_id, 2) AS bigint)"))
    threads = pl.comment_threads(c)
    number = n.scalar()
    return {
        "channels": shows.withColumn("payload", F.when(col("platform") == "amazon_music", F.concat(F.lit("{oops "), "payload"))
                                     .otherwise(col("payload"))),
        "videos": pl.video_search(c).withColumn("platform", of("podcast_id")),
        "reports": reports.withColumn("show", col("user") % number).withColumn("platform", of("show")).withColumn(
            "video_id", F.concat(F.lit("vid"), col("user").cast("string"))),
        "show_reports": pl.show_report(c).withColumn("platform", of("podcast_id")),
        "threads": threads.withColumn("show", col("episode_id") % number).withColumn("platform", of("show")).withColumn(
            "video_id", F.concat(F.lit("vid"), col("episode_id").cast("string"))),
    }


def landed_files(c):
    """The documents as files: each run, and each step of one that reads them again, reads those."""
    docs = landed_documents(c)
    return dict(zip(docs, together(c.spark, *[lambda k=k: staged(docs[k], f"landed-{k}") for k in docs]), strict=True))


def _collected(c, times=1):
    root, landed = scratch_path(c.spark, "collected"), landed_files(c)
    for _ in range(times):
        run = cl.collect(c.spark, landed, root, "2024-02-01 02:00:00")
    return run


_COLLECT = f"""
WITH n AS (SELECT count(*) AS shows, (SELECT count(*) FROM part) AS parts FROM supplier),
s AS (SELECT s_suppkey AS show, {_PLATFORM_SQL.format(k='s_suppkey')} AS platform,
             s_suppkey % 4 <> 2 AS json, s_suppkey % 4 <> 2 AND s_suppkey % 7 <> 0 AS known FROM supplier),
e AS (SELECT p_partkey AS video, s.platform, s.known FROM part, n JOIN s ON s.show = p_partkey % n.shows),
r AS (SELECT user_id AS video, cast(ts AS date) AS day, count(*) AS views,
             sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS likes,
             sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS dislikes,
             sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS comments,
             sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS shares, floor(round(sum(value), 2)) AS minutes
      FROM events GROUP BY 1, 2),
m AS (SELECT r.*, s.platform, coalesce(e.known, false) AS known, r.views % 17 <> 0 AS dated
      FROM r, n JOIN s ON s.show = r.video % n.shows LEFT JOIN e ON e.video = r.video WHERE r.views % 19 <> 0),
w AS (SELECT o_custkey % n.shows AS show, o_orderkey % 30 AS day FROM orders, n GROUP BY 1, 2),
t AS (SELECT conv_id, turn, s.platform, coalesce(e.known, false) AS known
      FROM conversations, n JOIN s ON s.show = conv_id % n.shows LEFT JOIN e ON e.video = conv_id)
"""

register("collect_run", lambda c: _collected(c).table("raw_podcast_scraper_runs").select(
    "platform", "status", "episodes_processed", "metrics_collected"), _COLLECT.strip() + """
SELECT p.platform, CASE WHEN bool_or(s.known) THEN 'completed' ELSE 'failed' END AS status,
       (SELECT cast(count(*) AS int) FROM e WHERE e.known AND e.platform = p.platform) AS episodes_processed,
       cast((SELECT count(*) FROM m WHERE m.known AND m.dated AND m.platform = p.platform)
          + (SELECT count(*) FROM w JOIN s x ON x.show = w.show WHERE x.known AND x.platform = p.platform) AS int)
         AS metrics_collected
FROM (SELECT DISTINCT platform FROM s) p JOIN s ON s.platform = p.platform GROUP BY p.platform""")
register("collect_quarantine", lambda c: _collected(c, times=2).table("quarantine").groupBy("platform", "kind", "reason").agg(
    F.countDistinct("source_key").alias("sources")), _COLLECT.strip() + """
SELECT platform, 'channel' AS kind, CASE WHEN json THEN 'no item' ELSE 'not JSON' END AS reason, count(*) AS sources
FROM s WHERE NOT known GROUP BY ALL
UNION ALL SELECT platform, 'video', 'unknown show', count(*) FROM e WHERE NOT known GROUP BY ALL
UNION ALL SELECT platform, 'report', CASE WHEN dated THEN 'unknown episode' ELSE 'bad date' END, count(DISTINCT video)
FROM m WHERE NOT (known AND dated) GROUP BY ALL
UNION ALL SELECT s.platform, 'show report', 'unknown show', count(DISTINCT w.show) FROM w JOIN s ON s.show = w.show
WHERE NOT s.known GROUP BY ALL
UNION ALL SELECT platform, 'comment', 'unknown episode', count(*) FROM t WHERE NOT known GROUP BY ALL""")
register("collect_metrics", lambda c: (lambda r: r.table("raw_podcast_episode_metrics").join(
    r.table("raw_podcast_episodes").select(col("id").alias("episode_id"), "platform_episode_id"), "episode_id").select(
    "platform_episode_id", "metric_date", "views", "likes", "dislikes", "comments_count", "shares",
    "watch_time_minutes", "subscribers_gained"))(_collected(c)), _COLLECT.strip() + """
SELECT 'vid' || video AS platform_episode_id, day AS metric_date, views,
       cast(CASE WHEN views % 13 = 0 THEN 0 ELSE likes END AS bigint) AS likes, cast(dislikes AS bigint) AS dislikes,
       cast(comments AS bigint) AS comments_count, cast(shares AS bigint) AS shares,
       cast(minutes AS bigint) AS watch_time_minutes, cast(comments AS int) AS subscribers_gained
FROM m WHERE known AND dated""")


# ---------------------------------------------------------------- streaming
def _days(c, lo, hi):
    return (F.dayofmonth(col(c)) >= lo) & (F.dayofmonth(col(c)) <= hi)


def _stream_append(c):
    """Files land in drops; each daily ``availableNow`` run appends exactly the
    files it has not seen (the checkpoint replaces the sync cursor)."""
    src, sink, ck = (scratch_path(c.spark, n) for n in ("st1-landing", "st1-sink", "st1-ckpt"))
    df = c.raw("raw_youtube_daily_stats")
    for drop in (_days("date", 1, 10), _days("date", 11, 20), _days("date", 21, 31)):
        st.land(df, src, [drop])
        st.stream_append(c.spark, src, df.schema, sink, ck)      # resumes: new files only
    st.stream_append(c.spark, src, df.schema, sink, ck)          # nothing new: no rows added
    return c.spark.read.parquet(sink)


def _stream_upsert(c):
    """Late corrections arrive in two drops; each run upserts the new files in
    one micro-batch, then everything is replayed on a fresh checkpoint."""
    src, target = scratch_path(c.spark, "st2-landing"), scratch_path(c.spark, "st2-target")
    mn.full_rebuild(c.raw("raw_podcast_episode_metrics", by_day=True), target, ["metric_date"], spread=None)
    batch = c.raw("batch_episode_metrics")
    keys, upd = ["episode_id", "metric_date"], [x for x in _PEM[2:] if x != "created_at"]
    ck = scratch_path(c.spark, "st2-ckpt")
    for drop in (_days("metric_date", 24, 27), _days("metric_date", 28, 31)):
        st.land(batch, src, [drop])
        st.stream_upsert(c.spark, src, batch.schema, target, ck, keys, upd, ["updated_at"], "metric_date")
    # Replay everything with a fresh checkpoint: the upsert is idempotent.
    st.stream_upsert(c.spark, src, batch.schema, target, scratch_path(c.spark, "st2-ckpt"), keys, upd,
                     ["updated_at"], "metric_date")
    out = mn.read_table(c.spark, target)
    return out.select(*[col(x).cast("date").alias(x) if x == "metric_date" else col(x) for x in _PEM])


def _stream_insert_once(c):
    """Comments arrive in drops, the last one repeating everything already
    sent; repeated keys are ignored."""
    src, target = scratch_path(c.spark, "st3-landing"), scratch_path(c.spark, "st3-target")
    c.raw("raw_podcast_comments").write.mode("overwrite").parquet(target)
    batch = c.raw("batch_comments")
    ck = scratch_path(c.spark, "st3-ckpt")
    for drop in (col("reply_count") == 1, col("reply_count") == 0, F.lit(True)):
        st.land(batch, src, [drop])
        st.stream_insert_once(c.spark, src, batch.schema, target, ck,
                              ["episode_id", "platform_comment_id"], ["published_at", "comment_text"])
    return mn.read_table(c.spark, target).select(*_COM)


register("stream_append", _stream_append, "SELECT * FROM raw_youtube_daily_stats", ("watch_time_minutes",
                                                                                    "average_view_duration"))
register("stream_upsert", _stream_upsert,
         O.upsert_sql("raw_podcast_episode_metrics", "batch_episode_metrics", _PEM, ["episode_id", "metric_date"],
                      [x for x in _PEM[2:] if x != "created_at"], ["updated_at"]), ("completion_rate",))
register("stream_insert_once", _stream_insert_once,
         O.insert_if_absent_sql("raw_podcast_comments", "batch_comments", _COM, ["episode_id", "platform_comment_id"],
                                ["published_at", "comment_text"]))
register("partial_failure", lambda c: st.partial_failure_summary(pl.platform_metric_lines(c)), """
SELECT platform, records_ok, records_rejected, metric_total,
       CASE WHEN records_ok > 0 THEN 'completed' ELSE 'failed' END AS status
FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify' WHEN 2 THEN 'amazon_music'
                  ELSE 'youtube' END AS platform,
             count(CASE WHEN event_type <> 'error' THEN 1 END) AS records_ok,
             count(CASE WHEN event_type = 'error' THEN 1 END) AS records_rejected,
             cast(sum(CASE WHEN event_type <> 'error' THEN cast(json_extract_string(props, '$.k') AS bigint) END) AS bigint)
               AS metric_total
      FROM events GROUP BY 1) t""")
