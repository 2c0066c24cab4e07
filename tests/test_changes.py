"""Work on changes: snapshot differences, ledgers, totals kept by change, threads, contributors, audits inside the write."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from castline.operators import audits as au
from castline.operators import changes as ch
from castline.operators import contributors as cb
from castline.operators import maintain as mn
from castline.operators import threads as th
from castline.operators import versions as vs
from tests.conftest import rows

DAY = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]


# ------------------------------------------------------------- sync_changes
def test_only_ranges_that_differ_are_read(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/t", "k int, v string"
    old = [(k, f"v{k}") for k in range(400)] + [(None, "n")]
    new = [(k, f"v{k}") for k in range(400) if k not in (7, 8)] + [(9000, "x"), (None, "m")]
    new[20] = (new[20][0], "changed")
    ch.sync_changes(spark.createDataFrame(old, schema), path, ["k"], 64)
    read = []
    real = ch.read_files
    monkeypatch.setattr(ch, "read_files", lambda s, p, snap, files=None: read.append(files) or real(s, p, snap, files))
    got = ch.sync_changes(spark.createDataFrame(new, schema), path, ["k"], 64)
    parts = [{f.part for f in files} for files in read if files is not None]
    assert len(parts) == 2 and all(len(p) <= 5 for p in parts)      # of 64 ranges those of the five keys
    assert rows(got) == sorted([("deleted", 7, "v7"), ("deleted", 8, "v8"), ("inserted", 9000, "x"),
                                ("changed", new[20][0], "changed"), ("changed", None, "m")], key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 1 and "Join" not in plan
    assert rows(ch.sync_changes(spark.createDataFrame(new, schema), path, ["k"], 64)) == []
    assert rows(mn.read_table(spark, path)) == sorted(new, key=repr)


def test_a_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(ch.row_hash(["x", "y"], 1)).distinct().count() == 4


# -------------------------------------------------------------------- ledger
def test_a_late_row_rebuilds_its_month_only(spark, tmp_path):
    path, source = f"{tmp_path}/f", {"rows": [(i, DAY[i]) for i in range(90)]}

    def run(build_fails_from="9999"):
        df = spark.createDataFrame(source["rows"], "v int, day date")

        def build(s, e):
            if s >= build_fails_from:
                raise RuntimeError("killed")
            return df.where(F.col("day").between(F.lit(s).cast("date"), F.lit(e).cast("date"))).withColumn("month", mn.month_of(F.col("day")))

        return ch.incremental_by_change(df, "day", build, path, "month", max_days_per_job=31)

    with pytest.raises(RuntimeError):
        run("2024-02")
    assert [j[0] for j in run()] == ["2024-02-01", "2024-03-01"]      # the first month was done
    assert run() == []
    source["rows"].append((1000, DAY[3]))
    assert run() == [("2024-01-01", "2024-01-31")]
    source["rows"] = [r for r in source["rows"] if r[1].month != 2]
    assert run() == [("2024-02-01", "2024-02-29")]
    assert rows(mn.read_table(spark, path).select("v", "day")) == sorted(source["rows"], key=repr)


def engagement(data):
    return [(c, d, v, v, 1, None, 2) for c, d, v in data]


def test_ten_runs_with_corrections_equal_the_full_rebuild(spark, tmp_path, monkeypatch):
    schema = "content_key string, metric_date date, views bigint, likes bigint, comments bigint, shares bigint, watch_time_seconds bigint"
    rnd, daily = random.Random(2), f"{tmp_path}/daily"
    data = {(f"c{rnd.randrange(12)}", DAY[rnd.randrange(100)]): rnd.randrange(50) for _ in range(250)}
    kept = ch.PerformanceByChange(spark, daily, f"{tmp_path}/p")
    content = spark.createDataFrame([(f"c{i}", f"p{i % 3}") for i in range(10)], "content_key string, platform_key string")
    for n in range(10):
        was = dict(data)
        if n:      # a new day, one that loses a content, one that changes
            data |= {(f"c{rnd.randrange(12)}", DAY[100 + n]): n}
            data.pop(rnd.choice(sorted(data)))
            data[rnd.choice(sorted(data))] = 1000 + n
        df = spark.createDataFrame(engagement([(c, d, v) for (c, d), v in data.items()]), schema)
        # only the days that differ are written again
        touched = sorted({k[1].isoformat() for k in was.keys() | data.keys() if was.get(k) != data.get(k)})
        for d in touched if n else ["all"]:
            s, e = (d, d) if n else ("2024-01-01", "2024-04-29")
            mn.incremental_by_time_range(spark, lambda s, e: df.where(F.col("metric_date").between(F.lit(s).cast("date"), F.lit(e).cast("date"))),
                                         daily, "metric_date", s, e, 200)
        read = []
        real = ch.read_files
        monkeypatch.setattr(ch, "read_files", lambda s, p, snap, files=None: read.append((p, files)) or real(s, p, snap, files))
        months = kept.refresh()
        monkeypatch.undo()
        assert months == (sorted({d[:7] for d in touched}) if n else [f"2024-0{k}" for k in (1, 2, 3, 4)])
        for p, files in read:
            if p == daily:
                assert {f.part[:7] for f in files} <= set(months)
    assert kept.refresh() == []
    full = df.groupBy("content_key").agg(F.sum("views").alias("v"), F.min("metric_date").alias("a"), F.max("metric_date").alias("b"),
                                         F.countDistinct("metric_date").alias("n")).join(content, "content_key", "left")
    assert rows(kept.table(content), "content_key", "platform_key", "total_views", "first_metric_date", "last_metric_date",
                "days_with_metrics") == rows(full, "content_key", "platform_key", "v", "a", "b", "n")


# ------------------------------------------------------------------- threads
def plain_threads(comments):
    up = {c: p for c, p in comments}
    out = {}
    for c in up:
        path, at = [c], c
        while up[at] in up and up[at] not in path:
            at = up[at]
            path.append(at)
        out[c] = (None, None) if up[at] in up else (at, len(path) - 1)
    below = {c: 0 for c in up}
    for c in up:
        if out[c][0] is not None:
            at = c
            while True:
                below[at] += 1
                if up[at] not in up:
                    break
                at = up[at]
    return sorted(((c, out[c][0], out[c][1], sum(p == c for p in up.values()), below[c] if out[c][0] is not None else None,
                    up[c] is not None and up[c] not in up, out[c][0] is None) for c in up), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_threads_with_cycles_and_lost_parents(spark, seed):
    rnd = random.Random(seed)
    comments = [(f"c{i}", rnd.choice([None, "gone", *[f"c{rnd.randrange(60)}" for _ in range(9)]])) for i in range(60)]
    comments += [(f"d{i}", f"d{i - 1}" if i else None) for i in range(70)]      # one long chain
    comments += [("self", "self"), ("h0", None), *[(f"h{i}", "h0") for i in range(1, 50)]]
    df = spark.createDataFrame([(1, c, p) for c, p in comments], "episode_id int, platform_comment_id string, parent_platform_comment_id string")
    df = df.unionByName(df.where("platform_comment_id = 'h0'")).unionByName(df.withColumn("episode_id", F.lit(2)).limit(0))
    got = th.comment_thread_roots(df)
    assert rows(got.drop("episode_id")) == plain_threads(comments)


def test_threads_of_an_empty_table(spark):
    none = spark.createDataFrame([], "episode_id int, platform_comment_id string, parent_platform_comment_id string")
    assert th.comment_thread_roots(none).collect() == []


# -------------------------------------------------------------- contributors
def test_rolling_contributors_are_exact(spark):
    rnd = random.Random(4)
    commits = [(rnd.choice(["a", "b", None]), rnd.choice([None, *[f"m{i}" for i in range(25)]]), dt.datetime.combine(
        DAY[rnd.randrange(100)], dt.time(rnd.randrange(24)))) for _ in range(400)]
    df = spark.createDataFrame(commits, "repo_full_name string, author_email string, committed_at timestamp_ntz")
    got = {(r["repo_full_name"], r["day"]): tuple(r[f"contributors_{n}d"] for n in cb.WINDOWS) for r in cb.contributors_rolling(df).collect()}
    want = {(repo, at.date()): tuple(len({m for r, m, t in commits if r == repo and m and 0 <= (at.date() - t.date()).days < n})
                                     for n in cb.WINDOWS) for repo, _, at in commits if repo}
    assert got == want


# ------------------------------------------------------- audits in the write
def test_row_checks_are_counted_by_the_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    checks = [au.Check("t", "id", "not_null"), au.Check("t", "v", "positive", blocking=False),
              au.Check("t", "kind", "accepted_values", ("a", "b"), blocking=False), au.Check("t", "id", "unique")]
    scanned = []
    real = au.run_checks
    monkeypatch.setattr(au, "run_checks", lambda m, df, cs, d=None: scanned.append([c.test for c in cs]) or real(m, df, cs, d))
    gate, schema = au.Gate(checks), "id int, v int, kind string, day date"
    mn.full_rebuild(spark.createDataFrame([(1, -1, "a", DAY[0]), (2, 5, "z", DAY[1]), (3, -7, None, DAY[0])], schema), path, ["day"],
                    check=gate.of("t"))
    assert scanned == [["unique"]]      # nothing else reads the candidate
    assert sorted(r[1:] for r in gate.results) == [("id", "not_null", 0), ("id", "unique", 0), ("kind", "accepted_values", 1), ("v", "positive", 2)]
    before = vs.snapshot(spark, path)
    with pytest.raises(au.AuditFailure):
        mn.full_rebuild(spark.createDataFrame([(None, 1, "a", DAY[0])], schema), path, ["day"], check=gate.of("t"))
    assert vs.snapshot(spark, path) == before
    only_rows = au.Gate(checks[:1])
    mn.full_rebuild(spark.createDataFrame([], schema), f"{path}0", check=only_rows.of("t"))
    assert only_rows.results == [("t", "id", "not_null", 0)]
