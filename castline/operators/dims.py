"""Dimensions (D1-D4) and the calendar generator (S3).

``dim_date`` and ``dim_platform`` have a proven size bound (one row per
calendar day of a fixed range; seven platforms), so joins against them use an
explicit ``broadcast`` hint.  ``dim_repository`` / ``dim_content`` grow with
the data and are left to AQE's measured-size broadcast decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.functions import date_key, fiscal_quarter, fiscal_year, iso_day_of_week, surrogate_key

col = F.col

CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# The platform lookup seed (platform_id, name, category, url).
PLATFORM_SEED = [
    ("youtube", "YouTube", "video", "https://youtube.com"),
    ("twitch", "Twitch", "video", "https://twitch.tv"),
    ("twitter", "Twitter", "social", "https://twitter.com"),
    ("linkedin", "LinkedIn", "social", "https://linkedin.com"),
    ("github", "GitHub", "code", "https://github.com"),
    ("stripe", "Stripe", "financial", "https://stripe.com"),
    ("notion", "Notion", "productivity", "https://notion.so"),
]


def gen_dim_date(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END,
                 fiscal_start_month: int = 7) -> DataFrame:
    """S3: one row per day in [start, end] with calendar and fiscal attributes.

    ``start`` / ``end`` may be literals or Columns (e.g. a data-derived range
    computed by an aggregate); the day sequence is generated on executors.
    """
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("full_date"))
    return calendar_attributes(days, "full_date", fiscal_start_month)


def calendar_for(bounds: DataFrame, start_col: str = "start", end_col: str = "end",
                 fiscal_start_month: int = 7) -> DataFrame:
    """S3 with a data-derived range: ``bounds`` is a one-row aggregate
    (e.g. min/max of an activity date); its days are exploded on an executor."""
    days = bounds.select(F.explode(F.sequence(col(start_col).cast("date"), col(end_col).cast("date"),
                                              F.expr("interval 1 day"))).alias("full_date"))
    return calendar_attributes(days, "full_date", fiscal_start_month)


def calendar_attributes(days: DataFrame, d: str = "full_date", fiscal_start_month: int = 7) -> DataFrame:
    x = col(d)
    return days.select(
        date_key(x).alias("date_key"),
        x.alias("full_date"),
        F.year(x).alias("year"),
        F.quarter(x).alias("quarter"),
        F.month(x).alias("month"),
        F.date_format(x, "MMMM").alias("month_name"),
        F.weekofyear(x).alias("week_of_year"),
        F.dayofmonth(x).alias("day_of_month"),
        iso_day_of_week(x).alias("day_of_week"),
        F.date_format(x, "EEEE").alias("day_name"),
        F.when(F.weekday(x) >= 5, 1).otherwise(0).alias("is_weekend"),
        fiscal_year(x, fiscal_start_month).alias("fiscal_year"),
        fiscal_quarter(x, fiscal_start_month).alias("fiscal_quarter"),
    )


def dim_date(seed: DataFrame) -> DataFrame:
    """Seed + labels; 0/1 weekend flag → BOOLEAN."""
    return seed.select(
        "date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month",
        "day_of_week", "day_name", col("is_weekend").cast("boolean").alias("is_weekend"),
        "fiscal_year", "fiscal_quarter",
        F.concat(col("year").cast("string"), F.lit("-Q"), col("quarter").cast("string")).alias("year_quarter"),
        F.concat(col("year").cast("string"), F.lit("-"), F.lpad(col("month").cast("string"), 2, "0")).alias("year_month"),
        F.concat(col("fiscal_year").cast("string"), F.lit("-FQ"), col("fiscal_quarter").cast("string"))
         .alias("fiscal_year_quarter"),
    )


def calendar(spark: SparkSession) -> DataFrame:
    """The warehouse calendar (fixed range) as ``dim_date``, broadcast-hinted."""
    return F.broadcast(dim_date(gen_dim_date(spark)))


def platform_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLATFORM_SEED, "platform_id string, platform_name string, "
                                                "platform_category string, platform_url string")


def dim_platform(seed: DataFrame) -> DataFrame:
    """Surrogate key over the platform seed."""
    return seed.select(surrogate_key("platform_id").alias("platform_key"), "platform_id", "platform_name",
                       "platform_category", "platform_url")


def dim_content(content: DataFrame, platforms: DataFrame) -> DataFrame:
    """D3 (+ JN6 platform lookup): content ⟕ dim_platform (7 rows, broadcast)."""
    p = F.broadcast(platforms.select("platform_key", col("platform_id").alias("p_platform_id")))
    return content.join(p, col("platform") == col("p_platform_id"), "left").select(
        "content_key", "platform_key", "platform", "native_id", "content_type", "title", "description",
        "url", "thumbnail_url", "published_at", date_key("published_at").alias("published_date_key"))


def dim_repository(repos: DataFrame) -> DataFrame:
    """D4."""
    return repos.select(
        surrogate_key("repo_id").alias("repo_key"), "repo_id", "repo_name",
        col("full_name").alias("repo_full_name"), col("owner_login").alias("owner"), "description",
        col("language").alias("primary_language"), col("html_url").alias("repo_url"),
        "is_private", "is_fork", "created_at", "updated_at")
