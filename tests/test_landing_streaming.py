import datetime as dt
import json

from pyspark.sql import functions as F

from castline.operators import landing as ld
from castline.operators import maintain as mn
from castline.streaming import streams as st
from tests.conftest import rows


def test_report_rows_edge_cases(spark):
    doc = {"rows": [["2024-01-02", 10, 2, 0, 1, 0, 55.9, 31.7, 1, 2],     # full row
                    ["2024-01-03", 10, None, 0, 1, 0, 5, 3, 1],            # 9 cells, NULL likes
                    ["2024-13-45", 1, 1, 1, 1, 1, 1, 1, 1, 1],             # bad date
                    ["2024-01-04", "abc", 1, 1, 1, 1, 1, 1, 1, 1],         # non-numeric cell
                    ["2024-01-05", 1, 2, 3, 4]]}                            # short row: dropped
    df = spark.createDataFrame([("v1", json.dumps(doc))], "video_id string, payload string")
    got = ld.flatten_report_rows(df).orderBy("views", "metric_date").collect()
    assert len(got) == 4
    by_date = {r.metric_date: r for r in got}
    full = by_date[dt.date(2024, 1, 2)]
    assert (full.views, full.watch_time_minutes, full.average_view_duration_seconds, full.subscribers_lost) == \
        (10, 55, 31, 2)
    nine = by_date[dt.date(2024, 1, 3)]
    assert (nine.likes, nine.subscribers_lost) == (0, 0)
    assert by_date[None].views == 1
    assert by_date[dt.date(2024, 1, 4)].views == 0


def test_videos_bad_timestamp_and_empty_channel(spark):
    search = {"items": [{"id": {"videoId": "a"}, "snippet": {"title": "T", "publishedAt": "2024-01-02T03:04:05Z"}},
                        {"id": {"videoId": "b"}, "snippet": {"title": "U", "publishedAt": "nope"}}]}
    df = spark.createDataFrame([(1, json.dumps(search))], "podcast_id bigint, payload string")
    got = {r.platform_episode_id: r.publish_date for r in ld.flatten_videos(df).collect()}
    assert got == {"a": dt.datetime(2024, 1, 2, 3, 4, 5), "b": None}
    ch = spark.createDataFrame([(1, '{"items": []}'), (2, '{"items":[{"id":"UC2","snippet":{"description":"d"}}]}')],
                               "podcast_id bigint, payload string")
    assert rows(ld.flatten_channel(ch)) == [(1, None, None), (2, "UC2", "d")]


def test_geo_breakdown(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), '[{"country":"US","count":1000}]',
                                 '[{"city":"Berlin","count":5}]', '{"mobile":1000,"desktop":2}')],
                               "episode_id int, metric_date date, top_countries string, top_cities string, "
                               "device_breakdown string")
    got = rows(ld.geo_breakdown(df), "dimension", "name", "count")
    assert got == [("city", "Berlin", 5), ("country", "US", 1000), ("device", "desktop", 2), ("device", "mobile", 1000)]


def test_streaming_equals_batch_and_replay_is_harmless(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    df = spark.range(0, 300).select(F.col("id"), (F.col("id") % 7).alias("g"))
    st.land(df, src, [F.col("g") < 3, F.col("g") >= 3])
    st.stream_append(spark, src, df.schema, sink, str(tmp_path / "ck"), files_per_batch=1)
    st.stream_append(spark, src, df.schema, sink, str(tmp_path / "ck"), files_per_batch=1)  # nothing new
    assert rows(spark.read.parquet(sink)) == rows(df)


def test_stream_upsert_replay_with_fresh_checkpoint(spark, tmp_path):
    target, src = str(tmp_path / "t"), str(tmp_path / "src")
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ver int")
    t.write.parquet(target)
    b = spark.createDataFrame([(1, "a2", 2), (3, "c", 2), (1, "a3", 3)], t.schema)
    st.land(b, src, [F.col("ver") == 2, F.col("ver") == 3])
    for ck in ("ck1", "ck2"):
        st.stream_upsert(spark, src, b.schema, target, str(tmp_path / ck), ["k"], ["v", "ver"], ["ver"],
                         files_per_batch=1)
    assert rows(mn.read_table(spark, target)) == [(1, "a3", 3), (2, "b", 1), (3, "c", 2)]


def test_partial_failure_quarantines_bad_records(spark):
    lines = spark.createDataFrame([(1, "yt", dt.date(2024, 1, 1), '{"k": 5}'), (2, "yt", dt.date(2024, 1, 1), "{oops"),
                                   (3, "sp", dt.date(2024, 1, 1), "{bad")],
                                  "record_id bigint, platform string, metric_date date, payload string")
    good, bad = st.split_valid(lines)
    assert good.count() == 1 and bad.count() == 2
    got = rows(st.partial_failure_summary(lines))
    assert got == [("sp", 0, 1, None, "failed"), ("yt", 1, 1, 5, "completed")]
