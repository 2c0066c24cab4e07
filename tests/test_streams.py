"""Bounded insert-once and isolation of platforms as streams."""
import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from castline.operators import landing as ld
from castline.operators import maintain as mn
from castline.streaming import isolation as iso
from castline.streaming import streams as st
from tests.conftest import rows

START = dt.datetime(2024, 1, 1)
SCHEMA = "k int, text string, published timestamp_ntz, landed timestamp_ntz"


def at(day):
    return START + dt.timedelta(days=day)


def test_insert_once_keeps_state_for_the_delay_only(spark, tmp_path):
    src, target, ck = (f"{tmp_path}/{n}" for n in ("src", "target", "ck"))

    def run(day, records):
        spark.createDataFrame([(k, t, None if p is None else at(p), at(day)) for k, t, p in records], SCHEMA).coalesce(1).write.mode(
            "append").parquet(src)
        return st.stream_insert_once_bounded(spark, src, spark.createDataFrame([], SCHEMA).schema, target, ck, ["k"], "published", "landed",
                                             "1 days", ["landed", "text"])

    state = []
    for day in range(7):      # ten new comments a day, and all of the last days once more, edited
        new = [(100 * day + i, "first", day) for i in range(10)]
        again = [(100 * d + i, "edited", d) for d in range(max(0, day - 4), day) for i in range(10)]
        progress = run(day, new + new[:2] + again)
        assert not any(p["late"] for p in progress)
        state += [p["state_rows"] for p in progress]
    assert max(state) <= 50 and state[-1] <= 50      # five days of ten keys, whatever the table's size
    # a first copy that comes late, a copy of an old record, a record without a time: the table decides
    run(7, [(5000, "late", 2), (1, "edited", 0), (6000, "no time", None), (6000, "no time", None)])
    run(8, [(5000, "again", 2), (6000, "again", None)])
    got = mn.read_table(spark, target)
    assert got.count() == 72 and got.select("k").distinct().count() == 72
    assert rows(got.where("text <> 'first'").select("k", "text")) == [(5000, "late"), (6000, "no time")]


def test_a_batch_that_was_half_written_is_not_written_twice(spark, tmp_path, monkeypatch):
    src, target, ck = (f"{tmp_path}/{n}" for n in ("src", "target", "ck"))
    df = spark.createDataFrame([(k, "t", at(1), at(1)) for k in range(5)], SCHEMA)
    df.write.parquet(src)
    real = mn.insert_if_absent_table

    def dies(*args):
        real(*args)
        raise RuntimeError("killed after the write")

    args = (spark, src, df.schema, target, ck, ["k"], "published", "landed", "3 days")
    monkeypatch.setattr(mn, "insert_if_absent_table", dies)
    try:
        st.stream_insert_once_bounded(*args)
        raise AssertionError("the stream should have failed")
    except Exception as e:
        assert "killed after the write" in str(e)
    monkeypatch.undo()
    st.stream_insert_once_bounded(*args)
    assert mn.read_table(spark, target).count() == 5


# ------------------------------------------------------------------ isolation
LINES = "record_id bigint, platform string, drop timestamp_ltz, metric_date date, payload string"


def lines(spark, drop, ok):
    day = START + dt.timedelta(days=drop)
    data = [(100 * drop + 10 * p + i, name, day, day.date(), f'{{"k": {i}}}' if good and i else "{oops")
            for p, (name, good) in enumerate(ok.items()) for i in range(4)]
    return spark.createDataFrame(data, LINES)


def test_a_failing_platform_is_held_while_others_advance(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/iso"
    counts = []
    for drop, good in enumerate([False, False, False, True, True, True]):
        lines(spark, drop, {"a": True, "b": good}).write.mode("append").parquet(src)
        iso.run_drops(spark, src, lines(spark, 0, {}).schema, root)
        counts.append({r["platform"]: (r["records_ok"], r["records_rejected"]) for r in iso.run_log(spark, root).collect()})
    assert [c["a"] for c in counts] == [(3 * n, n) for n in range(1, 7)]
    # three failures, then held for two days after the last one; the trial works and releases what waited
    assert [c["b"] for c in counts] == [(0, 4), (0, 8), (0, 12), (0, 12), (6, 14), (9, 15)]
    every = spark.read.schema(LINES).parquet(src)
    assert rows(iso.run_log(spark, root)) == rows(st.partial_failure_summary(every))
    iso.run_drops(spark, src, every.schema, root)      # nothing new
    assert rows(iso.run_log(spark, root)) == rows(st.partial_failure_summary(every))


class State:
    """The calls of a group state that the function uses."""

    def __init__(self, value=None, timed_out=False):
        self.value, self.hasTimedOut, self.timeout = value, timed_out, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return 0


def decisions(state, outcomes):
    frame = pd.DataFrame([("p", pd.Timestamp(at(d)), ok, 1) for d, ok in outcomes], columns=["platform", "drop", "ok", "bad"])
    return [(r.action, (r.drop - pd.Timestamp(START)).days) for f in iso.decide(("p",), iter([frame]), state) for r in f.itertuples()]


def test_timers_release_and_expire():
    state = State()
    assert decisions(state, [(0, 0), (1, 0), (2, 0), (3, 5)]) == [("apply", 0), ("apply", 1), ("apply", 2), ("hold", 3)]
    assert state.timeout == int(at(4).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    state.hasTimedOut = True
    assert decisions(state, []) == [("release", 3)]
    assert state.value[0] == iso.FAILURES - 1
    state.hasTimedOut = False
    assert decisions(state, [(5, 0), (6, 1)]) == [("apply", 5), ("hold", 6)]      # the trial failed: held again
    state.value, state.hasTimedOut = (0, 0, [], 1), True
    assert decisions(state, []) == [] and state.value is None


# -------------------------------------------------------------------- VARIANT
def test_a_payload_is_parsed_once(spark):
    docs = spark.createDataFrame([(1, "v", "{}")], "podcast_id int, video_id string, payload string").withColumn("episode_id", F.lit(1))
    for df in (ld.flatten_channel(docs), ld.flatten_videos(docs), ld.flatten_report_rows(docs), ld.flatten_show_rows(docs),
               ld.flatten_comments(docs), ld.payload_drift(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1, plan


def test_only_json_numbers_count(spark):
    doc = '{"rows": [["2024-01-02", "10", 2.9, true, null, [1], {"a": 1}, 1e3, 99999999999999999999, "x"], "no row", []]}'
    df = spark.createDataFrame([("v", doc)], "video_id string, payload string")
    cols = ["views", "likes", "dislikes", "comments_count", "shares", "watch_time_minutes", "average_view_duration_seconds",
            "subscribers_gained", "subscribers_lost"]
    assert rows(ld.flatten_report_rows(df), *cols) == [(0, 2, 0, 0, 0, 0, 1000, 0, 0)]
    assert rows(ld.flatten_report_rows(df, text_numbers=True), "views", "likes") == [(10, 2)]
