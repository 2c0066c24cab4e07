"""Edge rows of the podcast-vs-video pipeline (hand-computed expectations)."""
import datetime as dt

from castline.operators import content as ct
from castline.operators import marts as mt
from tests.conftest import rows

D = dt.date(2024, 1, 1)


def _inputs(spark):
    eps = spark.createDataFrame([(f"e{i}", f"E{i}", D, 60 * i) for i in (1, 2, 3, 4, 5)],
                                "episode_id string, title string, published_date date, duration_seconds int")
    vids = spark.createDataFrame([(f"v{i}", f"V{i}", D, 10 * i) for i in (1, 2, 3, 6, 7)],
                                 "video_id string, title string, published_date date, duration_seconds int")
    mapping = spark.createDataFrame([
        ("c1", "e1", "v1"),      # both platforms
        ("c2", "e2", ""),        # episode only, blank video
        ("c3", None, "v2"),      # video only, NULL episode
        ("c4", "", ""),          # both blank: survives with NULL title / source
        ("c5", "e3", ""),        # duplicate episode id ...
        ("c6", "e3", "v3"),      # ... mapped twice
        (None, "e4", "v6"),      # NULL content id holding both ids: both are lost
    ], "content_id string, episode_id string, video_id string")
    return eps, vids, mapping


def test_content_unified_mapped_edges(spark):
    out = ct.content_unified_mapped(*_inputs(spark))
    got = rows(out, "content_id", "episode_id", "video_id", "title", "content_source")
    assert got == sorted([
        ("c1", "e1", "v1", "E1", "both_platforms"),
        ("c2", "e2", None, "E2", "spotify_only"),
        ("c3", None, "v2", "V2", "youtube_only"),
        ("c4", None, None, None, None),
        ("c5", "e3", None, "E3", "spotify_only"),
        ("c6", "e3", "v3", "E3", "both_platforms"),
        ("ep-e5", "e5", None, "E5", "spotify_only"),
        ("ep-v7", None, "v7", "V7", "youtube_only"),
    ], key=repr)


def test_content_performance_zero_denominators(spark):
    eps, vids, mapping = _inputs(spark)
    content = ct.content_unified_mapped(eps, vids, mapping)
    perf = spark.createDataFrame([("e1", D, 0, 0, 0, 1.0), ("e1", D, 10, 5, 3, 2.0)],
                                 "episode_id string, metric_date date, starts int, streams int, "
                                 "unique_listeners int, avg_listen_seconds double")
    stats = spark.createDataFrame([("v1", D, 0, 0.0, 0.0, 0, 0)],
                                  "video_id string, metric_date date, views int, watch_time_minutes double, "
                                  "avg_view_seconds double, likes int, comments int")
    out = {r.content_id: r for r in mt.mart_content_performance(content, perf, stats).collect()}
    c1 = out["c1"]
    assert (c1.total_starts, c1.total_streams, c1.spotify_completion_rate) == (10, 5, 0.5)
    assert (c1.total_views, c1.youtube_like_rate, c1.total_consumption) == (0, 0.0, 5)
    assert out["c4"].total_consumption == 0 and out["c4"].avg_listen_seconds is None


def test_daily_metrics_spine_and_null_date(spark):
    perf = spark.createDataFrame([("e1", D, 1, 5, 2, 1.0), ("e1", None, 1, 7, 1, 1.0)],
                                 "episode_id string, metric_date date, starts int, streams int, "
                                 "unique_listeners int, avg_listen_seconds double")
    stats = spark.createDataFrame([("v1", D + dt.timedelta(days=1), 4, 1.5, 1.0, 1, 0)],
                                  "video_id string, metric_date date, views int, watch_time_minutes double, "
                                  "avg_view_seconds double, likes int, comments int")
    for fn in (mt.mart_daily_metrics, mt.date_spine_join):
        got = rows(fn(perf, stats), "metric_date", "spotify_streams", "youtube_views", "total_consumption",
                   "day_of_week", "day_name")
        assert got == sorted([
            (None, 0, 0, 0, None, None),             # NULL date: its own row, never matched
            (D, 5, 0, 5, 1, "Monday   "),
            (D + dt.timedelta(days=1), 0, 4, 4, 2, "Tuesday  "),
        ], key=repr)


def test_platform_comparison_on_empty_inputs_has_two_rows(spark):
    perf = spark.createDataFrame([], "episode_id string, metric_date date, starts int, streams int, "
                                     "unique_listeners int, avg_listen_seconds double")
    stats = spark.createDataFrame([], "video_id string, metric_date date, views int, watch_time_minutes double, "
                                      "avg_view_seconds double, likes int, comments int")
    show = spark.createDataFrame([], "stats_date date, total_streams bigint, followers int, total_listeners bigint")
    got = rows(mt.mart_platform_comparison(perf, stats, show), "platform", "content_count", "days_active",
               "avg_daily_consumption")
    assert got == [("spotify", 0, None, 0.0), ("youtube", 0, None, 0.0)]


def test_large_counts_do_not_overflow(spark):
    """Counts over 10 digits: sums are BIGINT, rates DOUBLE (no DECIMAL(10,0))."""
    perf = spark.createDataFrame([("e1", D, 2_000_000_000, 2_000_000_000, 1, 1.0)] * 3,
                                 "episode_id string, metric_date date, starts int, streams int, "
                                 "unique_listeners int, avg_listen_seconds double")
    r = mt.spotify_per_episode(perf).first()
    assert r.total_streams == 6_000_000_000
