"""Table writers: nothing is lost on failed reads, partial ranges, null keys and partitions, or a killed job."""
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from castline.operators import versions as vs
from castline.operators import maintain as mn
from castline.session import scratch_path
from tests.conftest import rows

KV = "k int, ver int, v string"


def table(spark, path, data, schema=KV):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(path)


def truncate(path):
    for f in glob.glob(f"{path}/part-*"):
        os.truncate(f, 20)


@pytest.mark.parametrize("broadcast", [None, 10**12])
def test_null_keys_match_alike_on_both_ways(spark, broadcast):
    target = spark.createDataFrame([(None, 1, "a"), (1, 1, "a"), (2, 1, "a")], KV)
    batch = spark.createDataFrame([(None, 2, "b"), (1, 2, "b"), (3, 2, "b")], KV)
    out = mn.upsert(target, batch, ["k"], ["ver", "v"], ["ver"], broadcast_bytes=broadcast)
    assert rows(out) == sorted([(None, 2, "b"), (1, 2, "b"), (2, 1, "a"), (3, 2, "b")], key=repr)
    assert rows(mn.upsert(out, batch, ["k"], ["ver", "v"], ["ver"], broadcast_bytes=broadcast)) == rows(out)


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    table(spark, f"{tmp_path}/t", [(i, 1, "a") for i in range(100)])
    table(spark, f"{tmp_path}/b", [(i, 2, "b") for i in range(90, 110)])
    out = mn.merge(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b"), ["k"], ["ver", "v"], 1 << 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert out.count() == 110


@pytest.mark.parametrize("spoil", ["truncate", "empty"])
@pytest.mark.parametrize("write", ["upsert", "insert", "sync"])
def test_a_failed_read_is_no_first_load(spark, tmp_path, spoil, write):
    path = f"{tmp_path}/t"
    table(spark, path, [(i, 1, "a") for i in range(1000)])
    if spoil == "truncate":
        truncate(path)
    else:
        for f in [*glob.glob(f"{path}/*"), *glob.glob(f"{path}/.*.crc")]:
            os.remove(f)
    batch = spark.createDataFrame([(1, 2, "b")], KV)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):
        {"upsert": lambda: mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], ["ver"]),
         "insert": lambda: mn.insert_if_absent_table(spark, path, batch, ["k"]),
         "sync": lambda: mn.sync_append_cursor(batch, path, "ver", ["k"])}[write]()
    assert sorted(os.listdir(path)) == before


def days(spark, path, col="day"):
    return rows(mn.read_table(spark, path).select("v", F.col(col).cast("date")))


def daily(first, n):
    return [(i, dt.date.fromisoformat(first) + dt.timedelta(days=i)) for i in range(n)]


def builder(spark, source):
    def build(s, e):
        df = spark.createDataFrame(source["rows"], "v int, day date")
        df = df.where(F.col("day").between(F.lit(s).cast("date"), F.lit(e).cast("date")))
        return df.withColumn("month", mn.month_of(F.col("day")))
    return build


@pytest.mark.parametrize("start,end", [("2024-02-20", "2024-02-29"), ("2024-01-10", "2024-01-12"), ("2024-01-20", "2024-02-05")])
def test_a_range_inside_months_keeps_their_other_days(spark, tmp_path, start, end):
    source = {"rows": daily("2024-01-01", 60)}
    path = f"{tmp_path}/f"
    mn.incremental_by_time_range(spark, builder(spark, source), path, "month", "2024-01-01", "2024-02-29", align="month")
    mn.incremental_by_time_range(spark, builder(spark, source), path, "month", start, end, align="month")
    assert days(spark, path) == sorted(source["rows"], key=repr)


def test_batches_without_source_rows_lose_their_partitions(spark, tmp_path):
    source = {"rows": daily("2024-01-01", 90)}
    path = f"{tmp_path}/f"

    def run():
        dates = spark.createDataFrame(source["rows"], "v int, day date")
        found = mn.intervals_with_data(dates, "day", "2024-01-01", "2024-03-30", 30)
        mn.incremental_by_time_range(spark, lambda s, e: builder(spark, source)(s, e).drop("month"), path, "day",
                                     "2024-01-01", "2024-03-30", 30, found)

    run()
    source["rows"] = source["rows"][:30] + source["rows"][60:]
    run()
    assert days(spark, path) == sorted(source["rows"], key=repr)


def test_null_partitions_are_kept(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "k int, p string, v string"
    mn.upsert_table(spark, path, spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "a", "x")], schema), ["k", "p"],
                    ["v"], partition_col="p")
    batch = spark.createDataFrame([(4, None, "y"), (5, "a", "y"), (1, None, "y")], schema)
    mn.upsert_table(spark, path, batch, ["k", "p"], ["v"], partition_col="p")
    assert rows(mn.read_table(spark, path).select("k", "p", "v")) == sorted(
        [(1, None, "y"), (2, None, "x"), (3, "a", "x"), (4, None, "y"), (5, "a", "y")], key=repr)


def test_a_key_cannot_move_between_partitions(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, p string, v string"
    first, moved = ([(1, "a", "x"), (2, "a", "x")], [(1, "b", "y")])
    with pytest.raises(ValueError):
        mn.upsert_table(spark, path, spark.createDataFrame(first, schema), ["k"], ["p", "v"], partition_col="p")
    for data in (first, moved):
        mn.upsert_table(spark, path, spark.createDataFrame(data, schema), ["k"], ["p", "v"], buckets=8)
    assert rows(mn.read_table(spark, path).select("k", "p", "v")) == [(1, "b", "y"), (2, "a", "x")]


def test_a_batch_rewrites_only_files_that_hold_its_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.range(0, 4000).selectExpr("cast(id AS int) AS k", "1 AS ver", "'a' AS v")
    mn.upsert_table(spark, path, first, ["k"], ["ver", "v"], buckets=16)
    before = vs.snapshot(spark, path)
    assert len({f.part for f in before.files}) == 16 and all(f.low <= f.high for f in before.files)
    # 100 keys, of which three are in the table: at most three files are read in full and written
    batch = spark.createDataFrame([(k, 2, "b") for k in [7, 8, 9, *range(5000, 5097)]], KV)
    read = []
    real = vs.read_files

    def reading(spark, path, snap, files=None):
        read.append([f.path for f in (snap.files if files is None else files)])
        return real(spark, path, snap, files)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(mn, "read_files", reading)
        mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], buckets=16)
    after = vs.snapshot(spark, path)
    gone = set(before.files) - set(after.files)
    assert 1 <= len(gone) <= 3 and [sorted(f.path for f in gone)] == [sorted(x) for x in read]
    out = mn.read_table(spark, path)
    assert out.count() == 4097 and out.where("v = 'b'").count() == 100
    mn.insert_if_absent_table(spark, path, spark.createDataFrame([(7, 3, "c"), (9000, 3, "c")], KV), ["k"], buckets=16)
    assert rows(mn.read_table(spark, path).where("k in (7, 9000)").select("k", "v")) == [(7, "b"), (9000, "c")]
    assert set(after.files) <= set(vs.snapshot(spark, path).files)      # an insert adds files only


def test_a_batch_of_one_day_reads_no_other_day(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, day date, v string"
    days_ = [dt.date(2024, 1, d) for d in range(1, 11)]
    mn.upsert_table(spark, path, spark.createDataFrame([(k, d, "a") for k in range(20) for d in days_], schema), ["k", "day"], ["v"],
                    partition_col="day")
    snap = vs.snapshot(spark, path)
    batch = spark.createDataFrame([(3, days_[4], "b"), (99, days_[5], "b")], schema)
    assert {f.part for f in vs.files_for(snap, batch)} <= {"2024-01-05", "2024-01-06"}
    mn.upsert_table(spark, path, batch, ["k", "day"], ["v"], partition_col="day")
    gone = set(snap.files) - set(vs.snapshot(spark, path).files)
    assert {f.part for f in gone} == {"2024-01-05"}      # key 99 is new: it comes to a file of its own
    assert mn.read_table(spark, path).count() == 201


def test_a_large_batch_gives_the_same_table(spark, tmp_path):
    batch = [(1, 1, "a"), (1, 1, "b"), (3, 1, "c"), (3, 2, "a"), (None, 1, "n"), (None, 5, "m")]
    for start in ([], [(1, 9, "t"), (2, 9, "t"), (None, 9, "t"), (None, 8, "u")]):
        out = []
        for n, size in enumerate((1 << 40, None)):
            path = f"{tmp_path}/t{len(start)}{n}"
            table(spark, path, start or [(77, 0, "z")])      # a plain folder, with a repeated null key
            mn.upsert_table(spark, path, spark.createDataFrame(batch, KV), ["k"], ["ver", "v"], broadcast_bytes=size)
            out.append(rows(mn.read_table(spark, path)))
        first = f"{tmp_path}/n{len(start)}"
        mn.upsert_table(spark, first, spark.createDataFrame(batch, KV), ["k"], ["ver", "v"])
        assert out[0] == out[1] and len(out[0]) == len(start) + (3 if not start else 1) + (not start)
        assert rows(mn.read_table(spark, first)) == sorted([(1, 1, "b"), (3, 2, "a"), (None, 5, "m")], key=repr)


WIDE = "k int, day string, made string, ver int, v double, tags map<string,int>"


@pytest.mark.parametrize("layout", [vs.Layout("day", None, ("k", "day")), vs.Layout(None, 3, ("k", "day"))])
def test_a_large_batch_is_merged_in_one_shuffle(spark, layout):
    """Repeated and null keys on both sides, equal and null orders, columns that can't be compared."""
    import random
    rnd = random.Random(7)

    def some(n, made):
        return [(rnd.choice([None, *range(9)]), rnd.choice([None, "a", "b", "c"]), f"{made}{i}", rnd.choice([None, 1, 2, 3]),
                 rnd.choice([None, 0.5, float("nan"), -0.0]), {"x": 1}) for i in range(n)]

    target, batch = spark.createDataFrame(some(40, "t"), WIDE), spark.createDataFrame(some(60, "b"), WIDE)
    keys, update, order = ["k", "day"], ["ver", "v", "tags"], ["ver"]
    got = mn._upsert_by_range(target, batch, keys, update, order, layout)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert got.schema.names == target.schema.names
    assert repr(rows(got)) == repr(rows(mn.upsert(target, batch, keys, update, order)))
    assert repr(rows(mn._upsert_by_range(got, batch, keys, update, order, layout))) == repr(rows(got))


def test_a_large_batch_with_a_hot_key_is_collapsed_first(spark, tmp_path, monkeypatch):
    plain = spark.createDataFrame([(i, n, "a") for i in range(50) for n in (1, 2)], KV)
    hot = plain.unionByName(spark.createDataFrame([(7, n, "h") for n in range(60)], KV))
    assert not mn._crowded(plain, ["k"]) and not mn._crowded(plain.limit(0), ["k"])
    assert mn._crowded(plain.unionByName(plain), ["k"])                 # many rows of each key
    assert not mn._crowded(hot.unionByName(spark.createDataFrame([(i, 1, "c") for i in range(100, 200)], KV)), ["k"])
    monkeypatch.setattr(mn, "HOT_KEY_ROWS", 50)
    big = hot.unionByName(spark.createDataFrame([(i, 1, "c") for i in range(100, 200)], KV))
    assert mn._crowded(big, ["k"])
    merged, seen = mn._upsert_by_range, []
    monkeypatch.setattr(mn, "_upsert_by_range", lambda t, b, *a: seen.append(b.count()) or merged(t, b, *a))
    path = f"{tmp_path}/t"
    table(spark, path, [(7, 0, "t"), (300, 0, "t")])
    mn.upsert_table(spark, path, big, ["k"], ["ver", "v"], ["ver"], broadcast_bytes=None)
    assert seen == [150]
    got = {r[0]: r for r in rows(mn.read_table(spark, path))}
    assert len(got) == 151 and got[7] == (7, 59, "h") and got[8] == (8, 2, "a") and got[300] == (300, 0, "t")


@pytest.mark.parametrize("broadcast", [None, 10**12])
def test_both_ways_update_every_row_of_a_repeated_key_in_the_target(spark, broadcast):
    target = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), (1, 1, "x")], KV)
    batch = spark.createDataFrame([(None, 5, "b"), (None, 4, "a"), (1, 5, "b"), (1, 5, "a"), (3, 30, "c"), (3, 31, "c")], KV)
    got = rows(mn.upsert(target, batch, ["k"], ["ver"], broadcast_bytes=broadcast))
    assert got == sorted([(None, 5, "x"), (None, 5, "y"), (1, 5, "x"), (3, 31, "c")], key=repr)


@pytest.mark.parametrize("write", ["upsert", "insert", "range", "sync", "rebuild"])
def test_an_empty_first_batch_leaves_an_empty_table(spark, tmp_path, write):
    path, schema = f"{tmp_path}/t", "k int, day date, v string"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, dt.date(2024, 1, 2), "a")], schema)

    def load(df):
        {"upsert": lambda: mn.upsert_table(spark, path, df, ["k"], ["day", "v"], buckets=4),
         "insert": lambda: mn.insert_if_absent_table(spark, path, df, ["k"], buckets=4),
         "range": lambda: mn.incremental_by_time_range(spark, lambda s, e: df, path, "day", "2024-01-01", "2024-01-05"),
         "sync": lambda: mn.sync_append_cursor(df, path, "day", ["k"]),
         "rebuild": lambda: mn.full_rebuild(df, path, ["day"])}[write]()

    for _ in range(2):
        load(none)
        assert mn.read_table(spark, path).schema.simpleString() == none.schema.simpleString()
        assert mn.read_table(spark, path).count() == 0
    load(one)
    assert rows(mn.read_table(spark, path)) == rows(one)


def test_repeated_keys_of_one_source_are_loaded_once(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, day date, v string"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    for data in ([(1, d1, "b"), (1, d1, "a")], [(1, d1, "c"), (2, d2, "y"), (2, d2, "x"), (None, d2, "n"), (None, d2, "n")]):
        mn.sync_append_cursor(spark.createDataFrame(data, schema), path, "day", ["k", "day"])
    assert rows(mn.read_table(spark, path)) == sorted([(1, d1, "a"), (2, d2, "x"), (None, d2, "n")], key=repr)


def test_late_rows_of_the_last_day_are_loaded_once(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, day date"
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    early = [(1, d1), (2, d2)]
    late = early + [(3, d2), (4, d3), (None, d2)]
    for data in (early, late, late):
        mn.sync_append_cursor(spark.createDataFrame(data, schema), path, "day", ["k", "day"])
    assert rows(mn.read_table(spark, path)) == sorted(late, key=repr)


def killed(*_):
    raise KeyboardInterrupt


def cut_short(folder, name, text):
    """A store that took half of the list when its writer died."""
    vs.Folder.write_whole(folder, name, text[:len(text) // 2])
    raise KeyboardInterrupt


@pytest.mark.parametrize("death", [killed, cut_short])
@pytest.mark.parametrize("known", [True, False])
def test_a_killed_writer_loses_nothing(spark, tmp_path, monkeypatch, death, known):
    path = f"{tmp_path}/t"
    if known:
        mn.upsert_table(spark, path, spark.createDataFrame([(i, 1, "a") for i in range(10)], KV), ["k"], ["ver", "v"])
    else:
        table(spark, path, [(i, 1, "a") for i in range(10)])
    before = rows(mn.read_table(spark, path))
    batch = spark.createDataFrame([(3, 2, "b"), (50, 2, "b")], KV)
    monkeypatch.setattr(vs.Folder, "write_whole", vs.Folder.write_new, raising=False)
    monkeypatch.setattr(vs.Folder, "write_new", death)
    with pytest.raises(KeyboardInterrupt):
        mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], ["ver"])
    monkeypatch.undo()
    assert rows(mn.read_table(spark, path)) == before
    mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], ["ver"])
    out = mn.read_table(spark, path)
    assert out.count() == 11 and out.where("v = 'b'").count() == 2
    assert len(vs.vacuum(spark, path)) == 1 and out.count() == 11      # what the dead writer left


def test_two_writers_of_one_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    mn.full_rebuild(spark.createDataFrame([(1, 1, "a")], KV), path)
    base = vs.snapshot(spark, path)
    mn.full_rebuild(spark.createDataFrame([(2, 1, "a")], KV), path)
    with pytest.raises(vs.Conflict):
        vs.commit(spark, path, base, base)
    assert rows(mn.read_table(spark, path)) == [(2, 1, "a")]


def test_old_versions_go_and_the_last_one_stays_readable(spark, tmp_path):
    path = f"{tmp_path}/t"
    mn.upsert_table(spark, path, spark.createDataFrame([(i, 1, "a") for i in range(50)], KV), ["k"], ["ver", "v"], buckets=4)
    for n in range(2, 7):
        running = mn.read_table(spark, path)
        mn.upsert_table(spark, path, spark.createDataFrame([(1, n, "b"), (100 + n, n, "b")], KV), ["k"], ["ver", "v"], buckets=4)
        assert running.count() == 48 + n      # begun before the write
    assert min(x for x in os.listdir(f"{path}/versions") if x.isdigit()) == f"{5:012d}"
    live = {f"{path}/{f.path}" for n in (5, 6) for f in vs.version(spark, path, n).files}
    assert set(glob.glob(f"{path}/data/*/*/*.parquet")) == live
    assert mn.compact_table(spark, path, 2) > 0 and mn.read_table(spark, path).count() == 55
    assert len(vs.snapshot(spark, path).files) <= 8


def test_the_table_is_on_another_file_system_than_the_scratch_folder(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.wh.link./t", f"file://{tmp_path}")
    path = "viewfs://wh/t/one"
    mn.upsert_table(spark, path, spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], KV), ["k"], ["ver", "v"], buckets=2)
    mn.upsert_table(spark, path, spark.createDataFrame([(2, 2, "b")], KV), ["k"], ["ver", "v"], buckets=2)
    assert rows(mn.read_table(spark, path)) == [(1, 1, "a"), (2, 2, "b")]


def test_stage_folders_are_removed(spark, tmp_path):
    root = os.path.dirname(scratch_path(spark, "x"))
    path = f"{tmp_path}/t"
    batch = spark.createDataFrame([(1, 1, "a")], KV)
    mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], ["ver"])
    before = set(os.listdir(root))
    for _ in range(3):
        mn.upsert_table(spark, path, batch, ["k"], ["ver", "v"], ["ver"])
    assert set(os.listdir(root)) == before
