"""Registration of work on changes (snapshot differences, ledgers, totals kept by change), reply threads, rolling
distinct contributors, bounded streams and collector runs on ordinary input."""

from __future__ import annotations

from pyspark.sql import functions as F

from castline.operators import changes as ch
from castline.operators import collector as cl
from castline.operators import contributors as cb
from castline.operators import facts as fx
from castline.operators import audits as au
from castline.operators import landing as ld
from castline.operators import layout as ly
from castline.operators import maintain as mn
from castline.operators import threads as th
from castline.plans import oracle_reports as orp
from castline.plans import reports as rp
from castline.plans.queries import S, collector, t2_dim_content, t2_engagement
from castline.plans.queries_landing import _COLLECT, _PLATFORM_SQL, landed_documents
from castline.plans.queries_ops import _COM
from castline.plans.registry import register
from castline.session import scratch_path
from castline.sources import payloads as pl
from castline.streaming import isolation as iso
from castline.streaming import streams as st

col = F.col

# ------------------------------------------------------------------ threads
_PARENT = """CASE WHEN parent_platform_comment_id IS NULL AND episode_id % 11 = 0 THEN concat(episode_id, '-1')
              WHEN likes_count % 29 = 0 THEN concat('gone-', platform_comment_id) ELSE parent_platform_comment_id END"""


def _comments(c):
    """All comments and replies; some first comments answer their own reply (a cycle), some parents are gone."""
    replies = c.raw("batch_comments").where("parent_platform_comment_id IS NOT NULL")
    return c.raw("raw_podcast_comments").unionByName(replies).withColumn("parent_platform_comment_id", F.expr(_PARENT))


register("comment_thread_roots", lambda c: th.comment_thread_roots(_comments(c)), f"""
WITH RECURSIVE c AS MATERIALIZED (
  SELECT episode_id, platform_comment_id AS id, {_PARENT} AS parent FROM (
    SELECT * FROM raw_podcast_comments UNION ALL
    SELECT * FROM batch_comments WHERE parent_platform_comment_id IS NOT NULL) u),
e AS MATERIALIZED (SELECT c.episode_id, c.id, p.id AS up, c.parent IS NOT NULL AND p.id IS NULL AS lost
      FROM c LEFT JOIN c p ON p.episode_id = c.episode_id AND p.id = c.parent),
walk(episode_id, id, anc) AS (
  SELECT episode_id, id, id FROM e
  UNION SELECT w.episode_id, w.id, e.up FROM walk w JOIN e ON e.episode_id = w.episode_id AND e.id = w.anc WHERE e.up IS NOT NULL),
roots AS (SELECT w.episode_id, w.id, w.anc AS root FROM walk w JOIN e ON e.episode_id = w.episode_id AND e.id = w.anc WHERE e.up IS NULL),
d AS (SELECT episode_id, id, count(*) - 1 AS depth FROM walk GROUP BY 1, 2),
z AS (SELECT episode_id, anc, count(*) AS size FROM walk GROUP BY 1, 2),
n AS (SELECT episode_id, up, count(*) AS replies FROM e WHERE up IS NOT NULL GROUP BY 1, 2)
SELECT e.episode_id, e.id AS platform_comment_id, r.root AS root_comment_id, CASE WHEN r.root IS NOT NULL THEN d.depth END AS depth,
       coalesce(n.replies, 0) AS replies, CASE WHEN r.root IS NOT NULL THEN z.size END AS subtree_size, e.lost AS lost_parent,
       r.root IS NULL AS in_cycle
FROM e JOIN d USING (episode_id, id) JOIN z ON z.episode_id = e.episode_id AND z.anc = e.id
LEFT JOIN roots r ON r.episode_id = e.episode_id AND r.id = e.id LEFT JOIN n ON n.episode_id = e.episode_id AND n.up = e.id""")


# ------------------------------------------------------------- contributors
def _day_count(n):
    return (f"(SELECT count(DISTINCT x.author_email) FROM stg_github_commits x WHERE x.repo_full_name = d.repo_full_name "
            f"AND cast(x.committed_at AS date) BETWEEN d.day - INTERVAL {n - 1} DAY AND d.day) AS contributors_{n}d")


register("contributors_rolling", lambda c: cb.contributors_rolling(S(c, "stg_github_commits")), f"""
SELECT d.repo_full_name, d.day, {', '.join(_day_count(n) for n in cb.WINDOWS)}
FROM (SELECT DISTINCT repo_full_name, cast(committed_at AS date) AS day FROM stg_github_commits
      WHERE repo_full_name IS NOT NULL AND committed_at IS NOT NULL) d""")


# ------------------------------------------------------------ sync by change
def _refreshed(c):
    """The next full refresh: renamed, removed and new episodes."""
    rows = c.raw("raw_spotify_episodes")
    kept = rows.where("NOT explicit").withColumn("name", F.when(col("name").like("a%"), F.concat("name", F.lit(" v2"))).otherwise(col("name")))
    return kept.unionByName(rows.where(col("name").like("b%")).withColumn("id", F.concat(F.lit("new-"), "id")))


def _sync_changes(c):
    path = scratch_path(c.spark, "sync-changes")
    ch.sync_changes(c.raw("raw_spotify_episodes"), path, ["id"])
    return ch.sync_changes(_refreshed(c), path, ["id"]).select("change", "id", "name", "duration_ms")


register("sync_changes", _sync_changes, """
WITH o AS (SELECT * FROM raw_spotify_episodes),
n AS (SELECT * REPLACE (CASE WHEN name LIKE 'a%' THEN name || ' v2' ELSE name END AS name) FROM o WHERE NOT explicit
      UNION ALL SELECT * REPLACE ('new-' || id AS id) FROM o WHERE name LIKE 'b%')
SELECT CASE WHEN o.id IS NULL THEN 'inserted' WHEN n.id IS NULL THEN 'deleted' ELSE 'changed' END AS change,
       coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.name ELSE n.name END AS name,
       CASE WHEN n.id IS NULL THEN o.duration_ms ELSE n.duration_ms END AS duration_ms
FROM o FULL OUTER JOIN n ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL OR o.name IS DISTINCT FROM n.name""")


# ---------------------------------------------------------- ledger and totals
def _changed_months(c):
    """The revenue fact after late rows of some months, rebuilt by the ledger."""
    path = scratch_path(c.spark, "changed-months")
    charges = S(c, "stg_stripe_charges")
    late = F.month("created_at") == 5
    for rows in (charges.where(~late | (F.dayofmonth("created_at") < 20)), charges):
        def build(s, e, rows=rows):
            return fx.fact_revenue(rows, s, e).withColumn("created_month", mn.month_of(col("created_at")))

        ch.incremental_by_change(rows, "created_at", build, path, "created_month")
    return mn.read_table(c.spark, path).drop("created_month")


def _performance_by_change(c):
    """Three daily runs, the last two with late corrections of days that are already in the totals."""
    daily, root = scratch_path(c.spark, "engagement"), scratch_path(c.spark, "performance")
    full = t2_engagement(c)
    start, end = mn.range_of(full, "metric_date")
    early = F.dayofmonth("metric_date") <= 10
    runs = [full.where(early & (col("platform") != "twitter")), full.where(early | (F.dayofmonth("metric_date") <= 20)), full]
    kept = ch.PerformanceByChange(c.spark, daily, root)
    for rows in runs:
        mn.incremental_by_time_range(
            c.spark, lambda s, e: rows.where(fx.in_date_range(col("metric_date"), s, e)), daily, "metric_date", start, end)  # noqa: B023
        kept.refresh()
    return kept.table(t2_dim_content(c))


register("incremental_changed_months", _changed_months, "SELECT * FROM fact_revenue", ("amount_dollars",))
register("performance_by_change", _performance_by_change, "SELECT * FROM fact_content_performance", ("avg_daily_views",))

# ------------------------------------------------------------- payload drift
register("payload_drift", lambda c: ld.payload_drift(pl.daily_report(c)), """
WITH d AS (
  SELECT user_id AS video, cast(ts AS date) AS day, count(*) AS views, sum(value) AS total
  FROM events GROUP BY 1, 2),
p AS (SELECT d.views, d.total, unnest(generate_series(0, CASE WHEN views % 19 = 0 THEN 4 WHEN views % 11 = 0 THEN 8 ELSE 9 END)) AS position FROM d),
k AS (SELECT position, count(*) AS cells, count(CASE WHEN position = 0 THEN 1 END) AS texts,
             count(CASE WHEN position = 2 AND views % 13 = 0 OR position IN (6, 7) AND total IS NULL THEN 1 END) AS nulls FROM p GROUP BY 1)
SELECT cast(position AS int) AS position, cells, cells - texts - nulls AS numbers, texts, nulls,
       CASE WHEN position = 0 THEN 'text' WHEN cells = nulls THEN 'null' ELSE 'number' END AS found, nulls > 0 AS drifted
FROM k""")


# ----------------------------------------------------------- collector runs
def _collect(c, runs):
    """Runs one after the other: (time, kinds of documents changed by a function)."""
    landed, root = landed_documents(c), scratch_path(c.spark, "collected")
    for at, change in runs:
        run = cl.collect(c.spark, change(dict(landed)), root, at)
    return run


def _only(landed, kind, platform):
    """Nothing but the documents of one kind and platform, none of them JSON."""
    return {k: d.where(F.lit(k == kind) & (col("platform") == platform)).withColumn("payload", F.concat(F.lit("{oops "), "payload"))
            for k, d in landed.items()}


def _clean(landed):
    """Documents without any defect: shows that are known, their episodes, reports without a bad date."""
    good = landed["channels"].where(~col("payload").like("%\"items\":[]%") & ~col("payload").like("{oops%")).select(
        "platform", "podcast_id").distinct()
    videos = landed["videos"].join(good, ["platform", "podcast_id"], "left_semi")
    ids = ld.flatten_videos(videos, keep=["platform"]).select("platform", col("platform_episode_id").alias("video_id"))
    return {"channels": landed["channels"].join(good, ["platform", "podcast_id"], "left_semi"), "videos": videos,
            "reports": landed["reports"].where(~col("payload").like("%2024-13-45%")).join(ids, ["platform", "video_id"], "left_semi"),
            "show_reports": landed["show_reports"].join(good, ["platform", "podcast_id"], "left_semi"),
            "threads": landed["threads"].join(ids, ["platform", "video_id"], "left_semi")}


def _clean_run(c):
    run = _collect(c, [("2024-02-01 02:00:00", _clean)])
    rejected = run.table("quarantine").agg(F.count(F.lit(1)).alias("rejected"))
    return run.table("raw_podcast_scraper_runs").select(
        "platform", "status", "episodes_processed", "metrics_collected").withColumn("rejected", rejected.scalar())


register("collect_clean_run", _clean_run, _COLLECT.strip() + """,
good AS (SELECT m.*, floor(date_diff('day', DATE '2020-01-01', m.day) / 30) AS win FROM m WHERE known),
usable AS (SELECT g.platform, g.video, g.day FROM good g WHERE NOT EXISTS (
             SELECT 1 FROM r x WHERE x.video = g.video AND x.views % 17 = 0
             AND floor(date_diff('day', DATE '2020-01-01', x.day) / 30) = g.win AND x.views % 19 <> 0)
           AND NOT EXISTS (SELECT 1 FROM r x WHERE x.video = g.video AND x.views % 17 = 0 AND x.views % 19 = 0
             AND floor(date_diff('day', DATE '2020-01-01', x.day) / 30) = g.win))
SELECT p.platform, 'completed' AS status,
       (SELECT cast(count(*) AS int) FROM e WHERE e.known AND e.platform = p.platform) AS episodes_processed,
       cast((SELECT count(*) FROM usable m WHERE m.platform = p.platform)
          + (SELECT count(*) FROM w JOIN s x ON x.show = w.show WHERE x.known AND x.platform = p.platform) AS int)
         AS metrics_collected, cast(0 AS bigint) AS rejected
FROM (SELECT DISTINCT platform FROM s WHERE known) p""")


def _empty_kind(c):
    run = _collect(c, [("2024-02-01 02:00:00", lambda d: d | {k: d[k].where(F.lit(False)) for k in ("reports", "threads")})])
    out = None
    for t in ("raw_podcasts", "raw_podcast_episodes", "raw_podcast_episode_metrics", "raw_podcast_show_metrics", "raw_podcast_comments"):
        part = run.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


register("collect_empty_kind", _empty_kind, _COLLECT.strip() + """
SELECT 'raw_podcasts' AS table_name, (SELECT count(*) FROM s WHERE known) AS n
UNION ALL SELECT 'raw_podcast_episodes', (SELECT count(*) FROM e WHERE known)
UNION ALL SELECT 'raw_podcast_episode_metrics', 0
UNION ALL SELECT 'raw_podcast_show_metrics', (SELECT count(*) FROM w JOIN s ON s.show = w.show WHERE s.known)
UNION ALL SELECT 'raw_podcast_comments', 0""")

register("collect_run_counts", lambda c: _collect(c, [
    ("2024-02-01 02:00:00", lambda d: d), ("2024-02-02 02:00:00", lambda d: _only(d, "videos", "spotify")),
    ("2024-02-03 02:00:00", lambda d: _only(d, "channels", "youtube"))]).table("raw_podcast_scraper_runs").select(
    "platform", "run_started_at", "status", "episodes_processed", "metrics_collected", "error_message"), _COLLECT.strip() + f""",
pages AS (SELECT count(DISTINCT (p_partkey % shows, p_partkey // (shows * 50))) AS n FROM part, n
          WHERE {_PLATFORM_SQL.format(k='(p_partkey % shows)')} = 'spotify'),
first AS (
SELECT p.platform, bool_or(s.known) AS done,
       (SELECT cast(count(*) AS int) FROM e WHERE e.known AND e.platform = p.platform) AS episodes_processed,
       cast((SELECT count(*) FROM m WHERE m.known AND m.dated AND m.platform = p.platform)
          + (SELECT count(*) FROM w JOIN s x ON x.show = w.show WHERE x.known AND x.platform = p.platform) AS int) AS metrics_collected,
       (SELECT count(*) FROM s x WHERE x.platform = p.platform AND NOT x.known) + (SELECT count(*) FROM e WHERE e.platform = p.platform AND NOT e.known)
       + (SELECT count(*) FROM m WHERE m.platform = p.platform AND NOT (m.known AND m.dated))
       + (SELECT count(*) FROM w JOIN s x ON x.show = w.show WHERE x.platform = p.platform AND NOT x.known)
       + (SELECT count(*) FROM t WHERE t.platform = p.platform AND NOT t.known) AS rejected
FROM (SELECT DISTINCT platform FROM s) p JOIN s ON s.platform = p.platform GROUP BY p.platform)
SELECT platform, TIMESTAMP '2024-02-01 02:00:00' AS run_started_at, CASE WHEN done THEN 'completed' ELSE 'failed' END AS status,
       episodes_processed, metrics_collected, CASE WHEN NOT done THEN rejected || ' records rejected' END AS error_message FROM first
UNION ALL SELECT 'spotify', TIMESTAMP '2024-02-02 02:00:00', 'failed', 0, 0, n || ' records rejected' FROM pages WHERE n > 0
UNION ALL SELECT 'youtube', TIMESTAMP '2024-02-03 02:00:00', 'failed', 0, 0,
       (SELECT count(*) FROM s WHERE platform = 'youtube') || ' records rejected'
WHERE EXISTS (SELECT 1 FROM s WHERE platform = 'youtube')""")


# ------------------------------------------------------------------ streams
def _insert_once_bounded(c):
    """Three drops; the later ones repeat all earlier comments, edited, and the last one adds replies."""
    src, target, ck = (scratch_path(c.spark, n) for n in ("st3b-landing", "st3b-target", "st3b-ckpt"))
    rows = c.raw("raw_podcast_comments")
    edited = F.concat(F.lit("edited: "), "comment_text")

    def upto(day):
        return col("published_at") <= F.lit(day).cast("timestamp_ntz")

    def again(day):
        return F.when(upto(day), edited).otherwise(col("comment_text"))

    drops = [("2024-01-05", rows.where(upto("2024-01-05")).unionByName(rows.where(upto("2024-01-02")))),
             ("2024-01-12", rows.where(upto("2024-01-12")).withColumn("comment_text", again("2024-01-05"))),
             ("2024-03-31", rows.withColumn("comment_text", again("2024-01-12")).unionByName(
                 c.raw("batch_comments").where("parent_platform_comment_id IS NOT NULL")))]
    for day, drop in drops:
        landed = drop.select(*_COM, F.lit(day).cast("timestamp_ntz").alias("landed_at"))
        landed.write.mode("append").parquet(src)
        st.stream_insert_once_bounded(c.spark, src, landed.schema, target, ck, ["episode_id", "platform_comment_id"],
                                      "published_at", "landed_at", "7 days", ["landed_at", "comment_text"])
    return mn.read_table(c.spark, target).select(*[col(x) for x in _COM if x != "published_at"])


_NO_TIME = ", ".join(x for x in _COM if x != "published_at")
register("stream_insert_once_bounded", _insert_once_bounded, f"""
SELECT {_NO_TIME} FROM raw_podcast_comments
UNION ALL SELECT {_NO_TIME} FROM batch_comments WHERE parent_platform_comment_id IS NOT NULL""")


def _isolation(c):
    """Drops of five days each, each a day after the last; one platform sends nothing usable in the first three drops, is held, and comes back."""
    src, root = scratch_path(c.spark, "st4-landing"), scratch_path(c.spark, "st4")
    lines = pl.platform_metric_lines(c)
    number = F.floor((F.dayofmonth("metric_date") - 1) / 5).cast("int")
    lines = lines.withColumn("drop", F.lit("2024-01-01").cast("timestamp_ltz") + F.make_dt_interval(number)).withColumn(
        "payload", F.when((col("platform") == "amazon_music") & (number < 3), F.concat(F.lit("{oops "), "payload")).otherwise(col("payload")))
    for n in range(7):
        lines.where(number == n).write.mode("append").parquet(src)
        iso.run_drops(c.spark, src, lines.schema, root)
    return iso.run_log(c.spark, root)


register("stream_isolation", _isolation, """
SELECT platform, records_ok, records_rejected, metric_total,
       CASE WHEN records_ok > 0 THEN 'completed' ELSE 'failed' END AS status
FROM (SELECT platform, count(CASE WHEN ok THEN 1 END) AS records_ok, count(CASE WHEN NOT ok THEN 1 END) AS records_rejected,
             cast(sum(CASE WHEN ok THEN cast(json_extract_string(props, '$.k') AS bigint) END) AS bigint) AS metric_total
      FROM (SELECT *, event_type <> 'error' AND NOT (platform = 'amazon_music' AND day_no < 15) AS ok
            FROM (SELECT *, day(ts) - 1 AS day_no, CASE event_id % 4 WHEN 0 THEN 'apple_podcasts' WHEN 1 THEN 'spotify'
                            WHEN 2 THEN 'amazon_music' ELSE 'youtube' END AS platform FROM events) x) y GROUP BY 1) t""")


# ------------------------------------------------------ co-bucketed joins, sieved keys
def _bucketed(c):
    p, pe, _, psm = collector(c)
    pem = c.raw("raw_podcast_episode_metrics", parts=ly.bucket_count(c.spark))      # dealt by the episode into the buckets
    return p, ly.bucketed(pe, "id", "episodes"), ly.bucketed(pem, "episode_id", "episode_metrics", dealt=True), psm


def _latest_bucketed(c):
    p, pe, pem, _ = _bucketed(c)
    return rp.metrics_latest(pem, pe, p)


def _summary_bucketed(c):
    p, pe, pem, psm = _bucketed(c)
    return rp.performance_summary(p, pe, pem, psm)


register("metrics_latest_bucketed", _latest_bucketed, orp.REPORTS["metrics_latest"], ("completion_rate",))
register("performance_summary_bucketed", _summary_bucketed, orp.REPORTS["performance_summary"], ("avg_completion_rate",))
register("assert_unique_sieve", lambda c: au.duplicate_groups_sieved(S(c, "stg_youtube_video_metrics"), "video_id", "metric_date"),
         """SELECT video_id, metric_date, count(*) AS cnt FROM stg_youtube_video_metrics
            GROUP BY video_id, metric_date HAVING count(*) > 1""")
