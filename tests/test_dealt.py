"""Metric tables dealt once by their group, upserts and bucketed tables that keep that, contributors without bitmaps."""

import datetime as dt

from castline.operators import contributors as cb
from castline.operators import layout as ly
from castline.operators import maintain as mn
from castline.sources.bindings import BINDINGS, DEALT
from castline.sources.catalog import TestdataCatalog
from tests.conftest import rows

KEYS = ["episode_id", "metric_date"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lineitem(spark, tmp_path):
    """Nulls in every column, repeated rows, groups of several orders, suppliers and lines."""
    out = []
    for i in range(240):
        r = [i % 40 + 1, i % 7, i % 5, i % 4, float(i % 50 + 1), 0.25 * (i % 3), 0.5, "ANR"[i % 3]]
        if i % 3 == 0:
            r[i // 3 % 8] = None
        out += [tuple(r)] * (1 + (i % 10 == 0))
    spark.createDataFrame(out, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                               "l_discount double, l_tax double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    return TestdataCatalog(spark, str(tmp_path))


def test_dealt_tables_hold_the_rows_of_their_bindings(spark, tmp_path):
    c = lineitem(spark, tmp_path)
    for name, (table, _, day) in DEALT.items():
        assert day in BINDINGS[name]
        want = spark.sql(BINDINGS[name], **{table: c.base(table)})
        for got in (c.raw(name), c.raw(name, parts=5)):
            assert got.schema == want.schema
            assert rows(got) == rows(want)


def test_dealt_tables_are_shuffled_once(spark, cat):
    for name in DEALT:
        for df in (cat.raw(name), cat.raw(name, parts=5)):
            assert plan(df).count("Exchange") == 1 and "Expand" not in plan(df)


def test_upsert_of_dealt_tables_shuffles_no_whole_key_again(spark, tmp_path):
    c = lineitem(spark, tmp_path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = mn.upsert(c.raw("raw_podcast_episode_metrics"), c.raw("batch_episode_metrics"), KEYS, ["plays", "updated_at"], ["updated_at"])
        text = plan(df)
        assert "SortMergeJoin [_t_episode_id" in text and "hashpartitioning(_t_episode_id" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_upsert_matches_null_keys_and_updates_copies(spark):
    schema = "a bigint, b string, v int, kept int"
    target = spark.createDataFrame([(1, "x", 1, 1), (1, "x", 2, 2), (None, "x", 3, 3), (1, None, 4, 4), (None, None, 5, 5), (2, "y", 6, 6)], schema)
    batch = spark.createDataFrame([(1, "x", 10, 0), (None, "x", 30, 0), (1, None, 40, 0), (None, None, 50, 0), (None, "z", 70, 0)], schema)
    got = rows(mn.upsert(target, batch, ["a", "b"], ["v"], ["v"]))
    assert got == sorted([(1, "x", 10, 1), (1, "x", 10, 2), (None, "x", 30, 3), (1, None, 40, 4), (None, None, 50, 5), (2, "y", 6, 6),
                          (None, "z", 70, 0)], key=repr)


def test_buckets_grow_with_the_shuffle_and_dealt_rows_stay(spark, cat):
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        n = ly.bucket_count(spark)
        assert n == 40
        dealt = cat.raw("raw_podcast_episode_metrics", parts=n)
        table = ly.bucketed(dealt, "episode_id", "episode_metrics", dealt=True)
        files = [f.rpartition("/")[2] for f in table.inputFiles()]
        assert len(files) == len({f.split("_")[1].split(".")[0] for f in files}) <= n       # a bucket is one file
        assert rows(table, *KEYS, "plays") == rows(dealt, *KEYS, "plays")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_contributors_move_no_bitmaps(spark):
    day = dt.datetime(2024, 1, 1)
    data = [("r", "a", day), ("r", "a", day + dt.timedelta(days=3)), ("r", "b", day), ("r", "b", day), ("r", None, day + dt.timedelta(days=9)),
            ("r", "c", day + dt.timedelta(days=400)), (None, "a", day), ("r", "a", None), ("s", None, day)]
    got = cb.contributors_rolling(spark.createDataFrame(data, "repo_full_name string, author_email string, committed_at timestamp_ntz"))
    assert "bitmap" not in plan(got)
    assert rows(got) == sorted([("r", day.date(), 2, 2, 2), ("r", dt.date(2024, 1, 4), 2, 2, 2), ("r", dt.date(2024, 1, 10), 1, 2, 2),
                                ("r", dt.date(2025, 2, 4), 1, 1, 1), ("s", day.date(), 0, 0, 0)], key=repr)


def test_tables_dealt_by_day_are_shuffled_once_and_hold_the_same_rows(spark, tmp_path):
    c = lineitem(spark, tmp_path)
    for name in DEALT:
        df = c.raw(name, by_day=True)
        text = plan(df)
        assert text.count("Exchange") == 1 and "rangepartitioning(_day" in text
        assert rows(df) == rows(c.raw(name)) and df.schema == c.raw(name).schema


def test_a_table_dealt_by_day_is_written_where_it_lies(spark, tmp_path):
    c = lineitem(spark, tmp_path)
    path = f"{tmp_path}/t"
    mn.full_rebuild(c.raw("raw_podcast_episode_metrics", by_day=True), path, ["metric_date"], spread=None)
    assert rows(mn.read_table(spark, path)) == rows(c.raw("raw_podcast_episode_metrics"))
    files = mn.snapshot(spark, path).files
    days = {f.part for f in files}
    assert None in days and len(files) < len(days) + int(spark.conf.get("spark.sql.shuffle.partitions"))
