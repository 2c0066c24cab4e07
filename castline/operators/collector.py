"""The collector run: landed API documents to the six raw tables, in sets.

One run takes the documents of all platforms at once.  Documents that are not
JSON, items without what identifies them, and rows whose show or episode nobody
knows go to a quarantine table with the reason; they never stop the other rows or
the other platforms.  Each payload is parsed once.  Surrogate ids are hashes of the
natural keys, so a replayed run finds the ids of the first one, and ids come back by a
join with the written tables; two keys with one id are an error.  The run log has
a row for each platform of which anything landed, counted from this run's own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.operators import landing as ld
from castline.operators import maintain as mn
from castline.session import scratch_path, together

col = F.col
#: Key buckets of the written tables: a batch rewrites and scans only those its keys fall to.
BUCKETS = 8

# Columns that a re-collected row replaces.
PODCAST_UPDATES = ["show_name", "description", "author", "categories", "language", "updated_at"]
EPISODE_UPDATES = ["episode_title", "description", "duration_seconds", "publish_date", "season_number",
                   "episode_number", "updated_at"]


def surrogate_id(*keys: str) -> Column:
    """A positive BIGINT that a natural key always gets again."""
    return F.xxhash64(*[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]).bitwiseAND((1 << 63) - 1)


def _shaped(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``rows`` with exactly the declared columns; those a platform does not report are NULL."""
    return rows.select(*[(col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def _columns(name: str) -> dict[str, str]:
    from castline.sources.schemas import RAW_SCHEMAS
    return dict(part.split() for part in RAW_SCHEMAS[name].split(", "))


class IdCollision(RuntimeError):
    """Two natural keys got one surrogate id."""


class Run:
    """One collector run into the tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, at: str, buckets: int) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.at = F.lit(at).cast("timestamp_ntz")
        self.rejects: list[DataFrame] = []
        self.stages: list[str] = []

    def table(self, name: str) -> DataFrame:
        return mn.read_table(self.spark, f"{self.root}/{name}")

    def staged(self, rows: DataFrame) -> DataFrame:
        """``rows`` written once to the shared scratch folder, as they are read more than once."""
        path = scratch_path(self.spark, "collect")
        rows.write.mode("overwrite").parquet(path)
        self.stages.append(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def reject(self, rows: DataFrame, kind: str, key: str, reason: str) -> None:
        body = col("payload") if "payload" in rows.columns else F.to_json(F.struct(*rows.columns))
        self.rejects.append(rows.select("platform", F.lit(kind).alias("kind"), col(key).cast("string").alias("source_key"),
                                        F.lit(reason).alias("reason"), body.alias("payload")))

    def parsed(self, docs: DataFrame, kind: str, key: str) -> DataFrame:
        """The documents that are JSON, each parsed once; the others are rejected."""
        every = self.staged(ld.parsed(docs.select("platform", key, "payload")))
        self.reject(every.where(col(ld.DOC).isNull()), kind, key, "not JSON")
        return every.where(col(ld.DOC).isNotNull())

    def known(self, rows: DataFrame, names: DataFrame, on: list[str], kind: str, key: str, reason: str) -> DataFrame:
        """Rows with the ids that ``names`` has for them, by one join; rows it does not know are rejected."""
        own = rows.columns
        tagged = self.staged(rows.join(names.withColumn("_known", F.lit(True)), on, "left"))
        self.reject(tagged.where("_known IS NULL").select(own), kind, key, reason)
        return tagged.where("_known").drop("_known")

    def dated(self, rows: DataFrame, kind: str, key: str) -> DataFrame:
        """Rows with a usable day; the others are rejected."""
        rows = self.staged(rows)
        self.reject(rows.where("metric_date IS NULL"), kind, key, "bad date")
        return rows.where("metric_date IS NOT NULL")

    def load(self, name: str, rows: DataFrame, keys: list[str], update: list[str], order: list[str]) -> DataFrame:
        """Upsert rows into a table; returns what was loaded, with the platform."""
        columns = _columns(name)
        shaped = _shaped(rows.withColumns({"created_at": self.at, "updated_at": self.at}), columns | {"platform": "string"})
        staged = self.staged(shaped)
        mn.upsert_table(self.spark, f"{self.root}/{name}", staged.select(*columns), keys, update, order, buckets=self.buckets)
        return staged

    def distinct_ids(self, name: str, loaded: DataFrame, keys: list[str]) -> None:
        """An error if an id of this run stands for two natural keys of the table."""
        ids = loaded.select("id").distinct()
        twice = self.table(name).select("id", *keys).join(ids, "id", "left_semi").groupBy("id").agg(
            F.count(F.lit(1)).alias("n")).where("n > 1")
        if (found := twice.first()) is not None:
            raise IdCollision(f"{name}: id {found['id']} stands for {found['n']} rows")

    def close(self) -> None:
        for path in self.stages:
            mn.Folder(self.spark, path).drop()


def collect(spark: SparkSession, landed: dict[str, DataFrame], root: str, at: str, buckets: int = BUCKETS) -> Run:
    """Load ``channels, videos, reports, show_reports, threads``; each has ``platform``, its key and ``payload``.

    A kind without documents, a run without rejects and a platform without a channel document are normal input.
    """
    run = Run(spark, root, at, buckets)

    # What needs nobody's ids is done for all kinds side by side.
    def channels() -> DataFrame:
        return run.staged(ld.flatten_channel(run.parsed(landed["channels"], "channel", "podcast_id"), keep=["platform"]))

    def video_rows() -> DataFrame:
        return ld.flatten_videos(run.parsed(landed["videos"], "video", "podcast_id"), keep=["platform"])

    def report_rows() -> DataFrame:
        return run.dated(ld.flatten_report_rows(run.parsed(landed["reports"], "report", "video_id"), keep=["platform"]), "report", "video_id")

    def comment_rows() -> DataFrame:
        return run.staged(ld.flatten_comments(run.parsed(landed["threads"], "thread", "video_id"), key="video_id", keep=["platform"]))

    def show_report_rows() -> DataFrame:
        return run.dated(ld.flatten_show_rows(run.parsed(landed["show_reports"], "show report", "podcast_id"), keep=["platform"]),
                         "show report", "podcast_id")

    reports, show_rows, videos, comments, shows = together(spark, report_rows, show_report_rows, video_rows, comment_rows, channels)
    run.reject(shows.where("platform_id IS NULL"), "channel", "podcast_id", "no item")
    shows = shows.where("platform_id IS NOT NULL").withColumns(
        {"show": col("podcast_id"), "id": surrogate_id("platform", "platform_id"), "show_name": col("platform_id")})
    loaded = run.load("raw_podcasts", shows, ["platform", "platform_id"], PODCAST_UPDATES, ["updated_at", "description"])
    run.distinct_ids("raw_podcasts", loaded, ["platform", "platform_id"])
    ids = run.table("raw_podcasts").select("platform", "platform_id", col("id").alias("show_id"))
    names = run.staged(shows.select("platform", "platform_id", "show").distinct().join(ids, ["platform", "platform_id"]).select(
        "platform", col("show").alias("podcast_id"), "show_id"))

    videos = run.known(videos, names, ["platform", "podcast_id"], "video", "platform_episode_id", "unknown show").withColumn(
        "podcast_id", col("show_id"))
    videos = videos.withColumn("id", surrogate_id("podcast_id", "platform_episode_id"))
    episodes = run.load("raw_podcast_episodes", videos, ["podcast_id", "platform_episode_id"], EPISODE_UPDATES,
                        ["updated_at", "episode_title"])
    run.distinct_ids("raw_podcast_episodes", episodes, ["podcast_id", "platform_episode_id"])

    # Ids of the episodes that this run's rows name: no other row of the table takes part in the joins.
    asked = reports.select("video_id").union(comments.select("video_id")).distinct()
    shows_of = names.select("platform", col("show_id").alias("podcast_id")).distinct()
    platform_of = run.staged(
        run.table("raw_podcast_episodes").select("podcast_id", col("platform_episode_id").alias("video_id"), col("id").alias("episode_id"))
        .join(asked, "video_id", "left_semi").join(shows_of, "podcast_id").select("platform", "video_id", "episode_id"))

    def load_reports() -> DataFrame:
        rows = run.known(reports, platform_of, ["platform", "video_id"], "report", "video_id", "unknown episode")
        metric = _columns("raw_podcast_episode_metrics")
        return run.load("raw_podcast_episode_metrics", rows, ["episode_id", "metric_date"],
                        [c for c in metric if c not in ("episode_id", "metric_date", "created_at")], ["updated_at", "views"])

    def load_show_reports() -> DataFrame:
        rows = run.known(show_rows, names, ["platform", "podcast_id"], "show report", "podcast_id", "unknown show").withColumn(
            "podcast_id", col("show_id"))
        metric = _columns("raw_podcast_show_metrics")
        return run.load("raw_podcast_show_metrics", rows, ["podcast_id", "metric_date"],
                        [c for c in metric if c not in ("podcast_id", "metric_date", "created_at")],
                        ["updated_at", "total_views"])

    def load_comments() -> None:
        rows = run.known(comments, platform_of, ["platform", "video_id"], "comment", "platform_comment_id", "unknown episode")
        mn.insert_if_absent_table(spark, f"{run.root}/raw_podcast_comments", _shaped(rows, _columns("raw_podcast_comments")),
                                  ["episode_id", "platform_comment_id"], ["published_at", "comment_text"], buckets=buckets)

    daily, show_daily, _ = together(spark, load_reports, load_show_reports, load_comments)

    rejects = run.rejects[0]
    for more in run.rejects[1:]:
        rejects = rejects.unionByName(more)
    # This run's own rejects are counted; the quarantine table keeps each record once.
    rejects = run.staged(rejects.withColumn("digest", F.md5(F.coalesce("payload", F.lit("")))))
    mn.insert_if_absent_table(spark, f"{run.root}/quarantine", rejects,
                              ["platform", "kind", "source_key", "reason", "digest"], ["payload"], buckets=buckets)
    mn.upsert_table(spark, f"{run.root}/raw_podcast_scraper_runs", run_rows(run, landed, episodes, daily, show_daily, rejects), ["id"],
                    ["run_completed_at", "status", "episodes_processed", "metrics_collected", "error_message"])
    run.close()
    return run


def run_rows(run: Run, landed: dict[str, DataFrame], episodes: DataFrame, daily: DataFrame, show_daily: DataFrame,
             rejects: DataFrame) -> DataFrame:
    """One log row for each platform of which anything landed: counts of this run's rows, in one aggregate."""
    counts = {"episodes": episodes, "metrics": daily, "show_metrics": show_daily, "rejected": rejects}
    tagged = None
    for what, rows in [*counts.items(), *(("landed", docs) for docs in landed.values())]:
        part = rows.select("platform", F.lit(what).alias("what"))
        tagged = part if tagged is None else tagged.unionByName(part)
    n = {c: F.count(F.when(col("what") == c, 1)) for c in counts}
    done = n["episodes"] + n["metrics"] + n["show_metrics"] > 0
    return tagged.groupBy("platform").agg(
        F.when(done, "completed").otherwise("failed").alias("status"),
        n["episodes"].cast("int").alias("episodes_processed"),
        (n["metrics"] + n["show_metrics"]).cast("int").alias("metrics_collected"),
        F.when(~done, F.concat(n["rejected"].cast("string"), F.lit(" records rejected"))).alias("error_message")).select(
        F.xxhash64("platform", run.at.cast("string")).alias("id"), "platform", run.at.alias("run_started_at"),
        run.at.alias("run_completed_at"), "status", "episodes_processed", "metrics_collected", "error_message",
        run.at.alias("created_at"))
