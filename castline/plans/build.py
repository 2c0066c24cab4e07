"""The warehouse build: every model materialised in dependency order.

This is the job a user runs daily (the reference's ``build`` / ``run``):

1. raw tables that later steps read more than once, and all staging models (kind FULL);
2. podcast-vs-video marts from the written staging tables;
3. the star schema: calendar, platform, content and repository dimensions
   (FULL), the unified content and daily platform models, the three time-range
   facts (incremental, 30-day batches, only the batches that contain source
   data), and the content-performance summary.

Models that do not read each other are built side by side, so that cores do not idle over
each one's last tasks.  Every table is written, audited and only then published: a model whose blocking
audit fails raises, its old table stays, and nothing that reads it and no later step is built.  The
declared column tests and the grain and date-key audits are all part of that;
their counts are written as an audit table.  Downstream models read published
tables, so each step restarts from storage and plans stay small.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.operators import audits as au
from castline.operators import content as ct
from castline.operators import dims as dm
from castline.operators import facts as fx
from castline.operators import maintain as mn
from castline.operators import marts as mt
from castline.operators.staging import STAGING, staged
from castline.session import shuffles_dropped, together

col = F.col

# Models of the build with the columns that make up their content check (no floating-point ones).
CONTENT = {
    "mart_content_performance": ("content_id", "title", "published_date", "duration_seconds", "content_source",
                                 "total_streams", "total_views", "total_likes"),
    "mart_daily_metrics": ("metric_date", "spotify_streams", "youtube_views", "youtube_likes", "day_name"),
    "mart_platform_comparison": ("platform", "total_consumption", "content_count", "days_active"),
    "dim_date": ("date_key", "full_date", "fiscal_quarter", "year_month"),
    "dim_platform": ("platform_key", "platform_id"),
    "int_content_unified": ("content_key", "platform", "native_id", "title"),
    "dim_content": ("content_key", "platform_key", "native_id", "published_date_key"),
    "dim_repository": ("repo_key", "repo_id", "repo_full_name"),
    "int_daily_platform_metrics": ("metric_date", "platform", "total_views", "total_engagement", "content_count"),
    "fact_daily_engagement": ("date_key", "metric_date", "content_key", "platform", "views", "likes", "comments", "shares",
                              "watch_time_seconds", "followers_gained"),
    "fact_github_activity": ("date_key", "activity_date", "repo_key", "commits", "lines_added", "lines_deleted",
                             "unique_contributors", "prs_opened", "prs_merged", "prs_closed", "issues_opened", "issues_closed"),
    "fact_revenue": ("charge_id", "date_key", "customer_id", "amount_cents", "status", "product_name"),
    "fact_content_performance": ("content_key", "platform_key", "total_views", "total_likes", "first_metric_date",
                                 "last_metric_date", "days_with_metrics"),
}
MODELS = tuple(CONTENT)

# Raw tables with declared tests, and those that are aggregates of larger tables.
LANDED = ("raw_spotify_episodes", "raw_spotify_episode_performance", "raw_spotify_show_stats", "raw_youtube_videos",
          "raw_youtube_daily_stats", "seed_content_mapping")

WAREHOUSE_TESTS = [
    au.Check("fact_daily_engagement", "content_key", "not_null"),
    au.Check("fact_daily_engagement", "date_key,content_key", "unique"),
    au.Check("fact_daily_engagement", "date_key", "valid_date_key", blocking=False),
    au.Check("fact_content_performance", "content_key", "unique"),
    au.Check("dim_content", "content_key", "unique"),
    au.Check("dim_repository", "repo_key", "unique"),
    au.Check("dim_date", "date_key", "unique"),
    au.Check("fact_github_activity", "date_key,repo_key", "unique"),
    au.Check("fact_revenue", "charge_id", "unique"),
    au.Check("fact_revenue", "amount_cents", "positive"),
]


def declared_tests() -> list[au.Check]:
    """All tests of the build: the podcast-vs-video column tests report, as there they
    run beside the models; the star schema's audits block."""
    return [replace(c, blocking=False) for c in au.TOOL1_TESTS] + WAREHOUSE_TESTS


def _dates_of(*pairs) -> DataFrame:
    out = None
    for df, c in pairs:
        d = df.select(col(c).cast("date").alias("d"))
        out = d if out is None else out.unionByName(d)
    return out


def build_warehouse(spark: SparkSession, catalog, root: str, start: str | None = None, end: str | None = None,
                    batch_days: int = 30, fail_on_audit: bool = True, checks: list[au.Check] | None = None) -> dict[str, str]:
    """Build and publish all models under ``root``; without a range, all days of the sources.

    Returns the path of each model.  ``fail_on_audit=False`` publishes whatever the audits say.
    Every step reads files and is run once, so what it shuffled goes when it ends.
    """
    with shuffles_dropped(spark):
        return _build(spark, catalog, root, start, end, batch_days, fail_on_audit, checks)


def _build(spark: SparkSession, catalog, root: str, start: str | None, end: str | None, batch_days: int,
           fail_on_audit: bool, checks: list[au.Check] | None) -> dict[str, str]:
    root = root.rstrip("/")
    path = {m: f"{root}/analytics/{m}" for m in (*MODELS, "content_unified_mapped")}
    path |= {t: f"{root}/raw/{t}" for t in LANDED} | {s: f"{root}/staging/{s}" for s in STAGING}
    gate = au.Gate(declared_tests() if checks is None else checks, enforced=fail_on_audit)

    def read(name: str) -> DataFrame:
        return mn.read_table(spark, path[name])

    def full(name: str, df: DataFrame) -> DataFrame:
        mn.full_rebuild(df, path[name], check=gate.of(name))
        return read(name)

    def ranged(name: str, build, partition_col: str, dates: DataFrame, align: str | None = None,
               spread: str | None = "rebalance") -> DataFrame:
        # One row a day: the sources are read once for it.
        dates = spark.createDataFrame(dates.select("d").distinct().collect(), "d date")
        span = (start, end) if start and end else mn.range_of(dates, "d")
        if span is None:
            return full(name, build(None, None))
        found = mn.intervals_with_data(dates, "d", *span, batch_days, align=align)
        mn.incremental_by_time_range(spark, build, path[name], partition_col, *span, batch_days, found, align=align,
                                     check=gate.of(name), spread=spread)
        return read(name)

    # 1. landed raw tables and staging
    class Landed:
        """The catalog, with the raw tables written above read from their files."""

        def raw(self, name: str) -> DataFrame:
            return landed[name] if name in landed else catalog.raw(name)

        def __getattr__(self, name: str):
            return getattr(catalog, name)

    def each(names, df_of) -> dict[str, DataFrame]:
        # The largest ones first: what is begun last should end soon.
        names = sorted(names, key=lambda n: n not in ("stg_github_commits", "raw_spotify_episode_performance"))
        return dict(zip(names, together(spark, *[lambda n=n: full(n, df_of(n)) for n in names]), strict=True))

    landed: dict[str, DataFrame] = {}
    direct = [s for s in STAGING if STAGING[s][1] not in LANDED]
    S = each([*LANDED, *direct], lambda n: catalog.raw(n) if n in LANDED else staged(catalog, n))
    landed |= {t: S.pop(t) for t in LANDED}
    S |= each([s for s in STAGING if s not in direct], lambda n: staged(Landed(), n))
    dim_date = F.broadcast(full("dim_date", dm.dim_date(dm.gen_dim_date(spark))))
    gate.dim_date = dim_date

    # 2. podcast vs video marts
    perf, stats = S["stg_spotify_daily_performance"], S["stg_youtube_daily_stats"]

    def content_marts() -> None:
        content = full("content_unified_mapped", ct.content_unified_mapped(
            S["stg_spotify_episodes"], S["stg_youtube_videos_json"], landed["seed_content_mapping"]))
        full("mart_content_performance", mt.mart_content_performance(content, perf, stats))

    def daily_marts() -> None:
        full("mart_daily_metrics", mt.mart_daily_metrics(perf, stats))
        full("mart_platform_comparison", mt.mart_platform_comparison(perf, stats, S["stg_spotify_show_stats"]))

    # 3. star schema
    yt, tw, li, tc = (S[n] for n in ("stg_youtube_video_metrics", "stg_twitter_tweets", "stg_linkedin_posts",
                                     "stg_twitch_streams"))
    commits, prs, issues = S["stg_github_commits"], S["stg_github_pull_requests"], S["stg_github_issues"]
    charges = S["stg_stripe_charges"]

    def dimensions() -> DataFrame:
        platforms = full("dim_platform", dm.dim_platform(dm.platform_seed(spark)))
        unified = full("int_content_unified", ct.int_content_unified(S["stg_youtube_videos"], tc, tw, li))
        return full("dim_content", dm.dim_content(unified, platforms))

    def daily_platforms() -> None:
        full("int_daily_platform_metrics", fx.int_daily_platform_metrics(yt, tw, li, tc))

    def engagement() -> DataFrame:
        return ranged("fact_daily_engagement", lambda s, e: fx.fact_daily_engagement(yt, tw, li, tc, s, e, by_day=True), "metric_date",
                      _dates_of((yt, "metric_date"), (tw, "created_at"), (li, "published_at"), (tc, "started_at")), spread=None)

    # Multi-year facts are partitioned by month (batches are whole months); daily engagement stays by day.
    def activity() -> None:
        repos = full("dim_repository", dm.dim_repository(S["stg_github_repos"]))
        # Looked up where they lie, rows stay dealt by day; a lookup too large for that moves them by repository.
        stays = mn.plan_bytes(repos.select("repo_key", "repo_full_name")) <= mn.BROADCAST_BATCH_BYTES
        found = F.broadcast(repos) if stays else repos
        ranged("fact_github_activity", lambda s, e: fx.fact_github_activity(commits, prs, issues, found, s, e, by_day=stays)
               .withColumn("activity_month", mn.month_of(col("activity_date"))), "activity_month",
               _dates_of((commits, "committed_at"), (prs, "created_at"), (issues, "created_at")), align="month",
               spread=None if stays else "rebalance")

    def revenue() -> None:
        ranged("fact_revenue", lambda s, e: fx.fact_revenue(charges, s, e)
               .withColumn("created_month", mn.month_of(col("created_at"))), "created_month",
               _dates_of((charges, "created_at")), align="month")

    made = together(spark, activity, engagement, dimensions, content_marts, revenue, daily_marts, daily_platforms)
    full("fact_content_performance", fx.fact_content_performance(made[1], dim_date, made[2]))

    path["audit_results"] = f"{root}/audit/results"
    mn.full_rebuild(spark.createDataFrame(gate.results, "model string, column_name string, test string, failures bigint"),
                    path["audit_results"])
    return path


def build_summary(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count and content sum (32 bits of each row's MD5) of every built table, one aggregate a table."""
    out = None
    for m, columns in CONTENT.items():
        text = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("~")) for c in columns])
        part = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        c = mn.read_table(spark, paths[m]).agg(F.count(F.lit(1)).alias("row_count"), F.sum(part).alias("content")) \
            .select(F.lit(m).alias("model"), "row_count", "content")
        out = c if out is None else out.unionByName(c)
    return out


def summary_sql() -> str:
    """The summary of the same models in the oracle's dialect."""
    parts = []
    for m, columns in CONTENT.items():
        text = " || '|' || ".join(f"coalesce(cast({c} AS varchar), '~')" for c in columns)
        parts.append(f"SELECT '{m}' AS model, count(*) AS row_count, "
                     f"cast(sum(('0x' || substr(md5({text}), 1, 8))::bigint) AS bigint) AS content FROM {m}")
    return "\nUNION ALL\n".join(parts)
