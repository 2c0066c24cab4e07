"""Registration of audits (Q-*, A16), maintenance (S2-S15) and calendar
queries.  Maintenance queries run their write path into a fresh folder under
the shared checkpoint directory and return the table read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from castline.operators import audits as au
from castline.operators import dims as dm
from castline.operators import facts as fx
from castline.operators import maintain as mn
from castline.plans import oracle as O
from castline.plans import oracle_models as om
from castline.plans.queries import S, mart_comparison, mart_content, mart_daily, t1_content, t2_engagement
from castline.plans.registry import register
from castline.session import scratch_path
from castline.sources.bindings import BINDINGS

col = F.col

# ------------------------------------------------------------------- audits
_TOOL1_BUILDERS = {
    "content_unified_mapped": t1_content,
    "mart_content_performance": mart_content,
    "mart_daily_metrics": mart_daily,
    "mart_platform_comparison": mart_comparison,
}


def _tool1_table(cat, name):
    if name in _TOOL1_BUILDERS:
        return _TOOL1_BUILDERS[name](cat)
    if name in BINDINGS:
        return cat.raw(name)
    return S(cat, name)


def _runner(cat):
    models = sorted({c.model for c in au.TOOL1_TESTS})
    return au.audit_runner({m: _tool1_table(cat, m) for m in models}, au.TOOL1_TESTS)


register("audit_runner", _runner, au.checks_sql(au.TOOL1_TESTS))
register("assert_not_null", lambda c: au.assert_not_null(t1_content(c), "title"),
         "SELECT * FROM content_unified_mapped WHERE title IS NULL")
register("assert_positive_values", lambda c: au.assert_positive_values(S(c, "stg_stripe_customers"), "balance_cents"),
         "SELECT * FROM stg_stripe_customers WHERE balance_cents < 0", ("balance_dollars",))
register("assert_unique", lambda c: au.duplicate_groups(S(c, "stg_youtube_video_metrics"), "video_id", "metric_date"),
         """SELECT video_id, metric_date, count(*) AS cnt FROM stg_youtube_video_metrics
            GROUP BY video_id, metric_date HAVING count(*) > 1""")
register("duplicate_groups", lambda c: au.duplicate_groups(t2_engagement(c), "content_key"),
         "SELECT content_key, count(*) AS cnt FROM fact_daily_engagement GROUP BY content_key HAVING count(*) > 1")
register("assert_valid_date_key",
         lambda c: au.assert_valid_date_key(t2_engagement(c), "date_key", dm.calendar(c.spark)),
         """SELECT f.date_key FROM fact_daily_engagement f LEFT JOIN dim_date d ON f.date_key = d.date_key
            WHERE d.date_key IS NULL AND f.date_key IS NOT NULL""")
register("anti_date_key",
         lambda c: au.assert_valid_date_key(t2_engagement(c), "date_key", dm.calendar(c.spark)),
         """SELECT f.date_key FROM fact_daily_engagement f WHERE f.date_key IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)""", note="JN12")
register("accepted_values",
         lambda c: au.accepted_values(c.raw("raw_podcasts"), "platform", ("spotify", "youtube")),
         "SELECT * FROM raw_podcasts WHERE platform NOT IN ('spotify', 'youtube')")
register("referential",
         lambda c: au.referential(S(c, "stg_youtube_daily_stats"), "video_id",
                                  S(c, "stg_youtube_videos_json"), "video_id"),
         """SELECT * FROM stg_youtube_daily_stats p WHERE video_id IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM stg_youtube_videos_json e WHERE e.video_id = p.video_id)""",
         ("watch_time_minutes", "avg_view_seconds", "minutes_per_view"))

# --------------------------------------------------------------- upserts
_POD = ["id", "show_name", "platform", "platform_id", "description", "author", "categories", "language",
        "created_at", "updated_at"]
_POD_UPD = ["show_name", "description", "author", "categories", "language", "updated_at"]
_EP = ["id", "podcast_id", "episode_title", "platform_episode_id", "description", "duration_seconds",
       "publish_date", "season_number", "episode_number", "created_at", "updated_at"]
_EP_UPD = ["episode_title", "description", "duration_seconds", "publish_date", "season_number",
           "episode_number", "updated_at"]
# The metric tables' columns.
_PEM = ["episode_id", "metric_date", "plays", "listeners", "engaged_listeners", "views", "likes", "dislikes",
        "comments_count", "shares", "watch_time_minutes", "average_view_duration_seconds", "subscribers_gained",
        "subscribers_lost", "downloads", "streams", "completion_rate", "average_listen_time_seconds",
        "followers_total", "followers_gained", "followers_lost", "top_countries", "top_cities", "device_breakdown",
        "raw_data", "created_at", "updated_at"]
_PSM = ["podcast_id", "metric_date", "total_plays", "total_listeners", "total_engaged_listeners", "total_views",
        "total_downloads", "followers_total", "followers_gained", "followers_lost", "subscribers_total",
        "subscribers_gained", "subscribers_lost", "average_completion_rate", "total_comments", "total_likes",
        "total_shares", "top_countries", "top_cities", "raw_data", "created_at", "updated_at"]
_COM = ["episode_id", "platform_comment_id", "author_name", "author_id", "comment_text", "likes_count",
        "reply_count", "parent_platform_comment_id", "published_at"]
_RUN = ["id", "platform", "run_started_at", "run_completed_at", "status", "episodes_processed",
        "metrics_collected", "error_message", "created_at"]
_RUN_UPD = ["run_completed_at", "status", "episodes_processed", "metrics_collected", "error_message"]


def _upsert_entry(name, target, batch, cols, keys, update, order, doubles=()):
    register(name,
             lambda c: mn.upsert(c.raw(target), c.raw(batch), keys, update, order),
             O.upsert_sql(target, batch, cols, keys, update, order), doubles)


_upsert_entry("upsert_podcasts", "raw_podcasts", "batch_podcasts", _POD, ["platform", "platform_id"], _POD_UPD,
              ["updated_at", "show_name"])
_upsert_entry("upsert_episodes", "raw_podcast_episodes", "batch_podcast_episodes", _EP,
              ["podcast_id", "platform_episode_id"], _EP_UPD, ["updated_at", "id"])
_upsert_entry("upsert_episode_metrics", "raw_podcast_episode_metrics", "batch_episode_metrics", _PEM,
              ["episode_id", "metric_date"], [c for c in _PEM[2:] if c != "created_at"], ["updated_at"],
              ("completion_rate",))
_upsert_entry("upsert_show_metrics", "raw_podcast_show_metrics", "batch_show_metrics", _PSM,
              ["podcast_id", "metric_date"], [c for c in _PSM[2:] if c != "created_at"], ["updated_at"],
              ("average_completion_rate",))
register("insert_comments_if_absent",
         lambda c: mn.insert_if_absent(c.raw("raw_podcast_comments"), c.raw("batch_comments"),
                                       ["episode_id", "platform_comment_id"], ["published_at", "comment_text"]),
         O.insert_if_absent_sql("raw_podcast_comments", "batch_comments", _COM, ["episode_id", "platform_comment_id"],
                                ["published_at", "comment_text"]))
register("run_log", lambda c: mn.run_log(c.raw("raw_podcast_runs_started"), c.raw("batch_run_updates")),
         O.upsert_sql("raw_podcast_runs_started", "batch_run_updates", _RUN, ["id"], _RUN_UPD))
register("dedupe_latest",
         lambda c: mn.dedupe_latest(S(c, "stg_youtube_video_metrics"), ["video_id", "metric_date"],
                                    ["views", "watch_time_seconds", "likes", "comments", "shares", "dislikes",
                                     "subscribers_gained", "subscribers_lost", "extracted_at"]),
         """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY video_id, metric_date
              ORDER BY views DESC, watch_time_seconds DESC, likes DESC, comments DESC, shares DESC, dislikes DESC,
                       subscribers_gained DESC, subscribers_lost DESC, extracted_at DESC) AS _rn
            FROM stg_youtube_video_metrics) z WHERE _rn = 1""", ("avg_view_duration_seconds",))
register("lookback_window",
         lambda c: mn.lookback_window(S(c, "stg_youtube_video_metrics"), "metric_date", O.AS_OF, 30),
         f"""SELECT * FROM stg_youtube_video_metrics
             WHERE metric_date BETWEEN DATE '{O.AS_OF}' - INTERVAL 30 DAY AND DATE '{O.AS_OF}'""",
         ("avg_view_duration_seconds",))


# ------------------------------------------------------------ write paths
def _sync_overwrite(c):
    path = scratch_path(c.spark, "sync-overwrite")
    src = c.raw("raw_spotify_episodes")
    mn.sync_overwrite(src, path)
    mn.sync_overwrite(src, path)  # a re-run replaces, never duplicates
    return mn.read_table(c.spark, path)


def _sync_append(c):
    path = scratch_path(c.spark, "sync-append")
    src = c.raw("raw_spotify_episode_performance")
    src.where(col("date") <= F.lit("2024-01-15").cast("date")).write.mode("overwrite").parquet(path)
    mn.sync_append_cursor(src, path, "date", ["episode_id", "date"])
    mn.sync_append_cursor(src, path, "date", ["episode_id", "date"])  # nothing new: appends zero rows
    return mn.read_table(c.spark, path)


def _full_rebuild(c):
    path = scratch_path(c.spark, "full-rebuild")
    df = mart_daily(c)
    mn.full_rebuild(df, path)
    return mn.read_table(c.spark, path)


def _incremental(c):
    path = scratch_path(c.spark, "incremental")
    dates = S(c, "stg_youtube_video_metrics").select(col("metric_date").alias("d")) \
        .unionByName(S(c, "stg_twitter_tweets").select(col("created_at").cast("date").alias("d"))) \
        .unionByName(S(c, "stg_linkedin_posts").select(col("published_at").cast("date").alias("d"))) \
        .unionByName(S(c, "stg_twitch_streams").select(col("started_at").cast("date").alias("d")))
    start, end = mn.range_of(dates, "d")
    intervals = mn.intervals_with_data(dates, "d", start, end, 30)
    mn.incremental_by_time_range(c.spark, lambda s, e: t2_engagement(c, s, e), path, "metric_date",
                                 start, end, 30, intervals)
    cols = t2_engagement(c).columns
    out = mn.read_table(c.spark, path)
    return out.select(*[col(x).cast("date").alias(x) if x == "metric_date" else col(x) for x in cols])


def _sync_append_late(c):
    """Rows of the last loaded day that arrive after it was read are loaded by the next run."""
    path = scratch_path(c.spark, "sync-late")
    src = c.raw("raw_spotify_episode_performance")
    day = F.lit("2024-01-15").cast("date")
    src.where((col("date") < day) | ((col("date") == day) & (col("starts") % 2 == 0))).write.mode("overwrite").parquet(path)
    mn.sync_append_cursor(src, path, "date", ["episode_id", "date"])
    return mn.read_table(c.spark, path)


def _revenue_partial(c):
    """The month-partitioned fact after a rebuild of a range that begins and ends inside months."""
    path = scratch_path(c.spark, "partial-range")
    charges = S(c, "stg_stripe_charges")

    def build(s, e):
        return fx.fact_revenue(charges, s, e).withColumn("created_month", mn.month_of(col("created_at")))

    start, end = mn.range_of(charges, "created_at")
    mn.incremental_by_time_range(c.spark, build, path, "created_month", start, end, align="month")
    mn.incremental_by_time_range(c.spark, build, path, "created_month", "2018-03-20", "2018-05-04", align="month")
    return mn.read_table(c.spark, path).drop("created_month")


_GAP = ("2024-01-10", "2024-01-20")


def _engagement_emptied(c):
    """The daily fact after some days lost all their source rows and the range was rebuilt."""
    path = scratch_path(c.spark, "emptied-batch")
    full = t2_engagement(c)
    start, end = mn.range_of(full, "metric_date")
    gone = col("metric_date").between(*[F.lit(d).cast("date") for d in _GAP])
    for source in (full, full.where(~gone)):
        found = mn.intervals_with_data(source, "metric_date", start, end, 5)
        mn.incremental_by_time_range(
            c.spark, lambda s, e: source.where(fx.in_date_range(col("metric_date"), s, e)), path, "metric_date",  # noqa: B023
            start, end, 5, found)
    out = mn.read_table(c.spark, path)
    return out.select(*[col(x).cast("date").alias(x) if x == "metric_date" else col(x) for x in full.columns])


def _upsert_table(target, batch, cols, keys, update, order, buckets=16):
    """The written table after a first load, a batch and the batch once more, by key buckets."""
    def run(c):
        path = scratch_path(c.spark, f"upsert-table-{target}")
        for rows in (c.raw(target), c.raw(batch), c.raw(batch)):
            mn.upsert_table(c.spark, path, rows, keys, update, order, buckets=buckets)
        return mn.read_table(c.spark, path).select(*cols)
    return run


def _insert_table(c):
    path = scratch_path(c.spark, "insert-table")
    for rows in (c.raw("raw_podcast_comments"), c.raw("batch_comments"), c.raw("batch_comments")):
        mn.insert_if_absent_table(c.spark, path, rows, ["episode_id", "platform_comment_id"],
                                  ["published_at", "comment_text"], buckets=16)
    return mn.read_table(c.spark, path).select(*_COM)


def _seed_csv(c):
    path = scratch_path(c.spark, "seed-csv")
    # An explicit NULL marker keeps '' (not on that platform) distinct from NULL.
    c.raw("seed_content_mapping").write.mode("overwrite").option("header", True) \
        .option("nullValue", "\\N").csv(path)
    return c.spark.read.schema("content_id string, episode_id string, video_id string") \
        .option("header", True).option("nullValue", "\\N").csv(path)


def _gen_dim_date(c):
    commits = S(c, "stg_github_commits")
    bounds = commits.agg(F.min("committed_at").cast("date").alias("start"),
                         F.max("committed_at").cast("date").alias("end"))
    return dm.calendar_for(bounds)


_BOUNDS = """(SELECT cast(min(committed_at) AS date) AS s, cast(max(committed_at) AS date) AS e FROM stg_github_commits)"""
_GEN_SQL = om.MODELS["dim_date"].replace(
    f"generate_series(DATE '{om.CAL_START}', DATE '{om.CAL_END}', INTERVAL 1 DAY)",
    f"generate_series((SELECT s FROM {_BOUNDS} b), (SELECT e FROM {_BOUNDS} b), INTERVAL 1 DAY)")

register("sync_overwrite", _sync_overwrite, "SELECT * FROM raw_spotify_episodes")
register("sync_append_cursor", _sync_append, "SELECT * FROM raw_spotify_episode_performance", ("avg_listen_seconds",))
register("sync_append_late_rows", _sync_append_late, "SELECT * FROM raw_spotify_episode_performance", ("avg_listen_seconds",))
register("incremental_partial_range", _revenue_partial, "SELECT * FROM fact_revenue", ("amount_dollars",))
register("incremental_emptied_batch", _engagement_emptied,
         f"SELECT * FROM fact_daily_engagement WHERE metric_date NOT BETWEEN DATE '{_GAP[0]}' AND DATE '{_GAP[1]}'",
         ("avg_view_duration_seconds",))
for _n, _args in {
        "podcasts": ("raw_podcasts", "batch_podcasts", _POD, ["platform", "platform_id"], _POD_UPD, ["updated_at", "show_name"]),
        "episodes": ("raw_podcast_episodes", "batch_podcast_episodes", _EP, ["podcast_id", "platform_episode_id"], _EP_UPD,
                     ["updated_at", "id"])}.items():
    register(f"upsert_table_{_n}", _upsert_table(*_args), O.upsert_sql(*_args))
register("insert_table_comments", _insert_table,
         O.insert_if_absent_sql("raw_podcast_comments", "batch_comments", _COM, ["episode_id", "platform_comment_id"],
                                ["published_at", "comment_text"]))
register("full_rebuild", _full_rebuild, "SELECT * FROM mart_daily_metrics", ("youtube_watch_minutes",))
register("incremental_by_time_range", _incremental, "SELECT * FROM fact_daily_engagement",
         ("avg_view_duration_seconds",))
register("seed_csv", _seed_csv, "SELECT * FROM seed_content_mapping")
register("gen_dim_date", _gen_dim_date,
         "SELECT * EXCLUDE (year_quarter, year_month, fiscal_year_quarter) REPLACE (cast(is_weekend AS int) AS is_weekend) "
         f"FROM ({_GEN_SQL}) g")
register("dim_date", lambda c: dm.dim_date(_gen_dim_date(c)), f"SELECT * FROM ({_GEN_SQL}) g")


# -------------------------------------------------------------- full build
def _warehouse_build(c):
    from castline.plans import build as bd
    paths = bd.build_warehouse(c.spark, c, scratch_path(c.spark, "warehouse"))
    return bd.build_summary(c.spark, paths)


def _build_oracle() -> str:
    from castline.plans.build import summary_sql
    return summary_sql()


register("warehouse_build", _warehouse_build, _build_oracle(),
         note="S13/S14 end to end: every model materialised, facts incrementally")
