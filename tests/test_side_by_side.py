"""Jobs side by side, audits that move hashes first, activity by one pass on the grain."""

import datetime as dt
import threading
import time

import pytest

from castline.operators import audits as au
from castline.operators import facts as fx
from castline.operators import maintain as mn
from castline.operators import versions as vs
from castline.plans import build as bd
from castline.session import together
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_together_keeps_order_waits_for_all_and_raises(spark):
    met, done = threading.Barrier(2, timeout=60), []
    assert together(spark, lambda: met.wait() * 0 + spark.range(3).count(), lambda: met.wait() * 0 + spark.range(5).count()) == [3, 5]

    def slow():
        time.sleep(1)
        done.append(spark.range(2).count())

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        together(spark, fails, slow)
    assert done == [2]
    assert together(spark) == []


def test_models_that_read_nothing_of_each_other_are_built_side_by_side(spark, cat, tmp_path, monkeypatch):
    at_work, most, lock = set(), [0], threading.Lock()
    real = mn.full_rebuild

    def watched(df, path, *args, **kwargs):
        with lock:
            at_work.add(path)
            most[0] = max(most[0], len(at_work))
        try:
            return real(df, path, *args, **kwargs)
        finally:
            with lock:
                at_work.discard(path)

    monkeypatch.setattr(mn, "full_rebuild", watched)
    paths = bd.build_warehouse(spark, cat, str(tmp_path / "w"))
    assert most[0] > 1
    assert all(mn.read_table(spark, p) is not None for p in paths.values())


def test_unique_audit_moves_hashes_and_counts_whole_keys(spark):
    data = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None), (2, None)], "k int, t string")
    assert not au.may_repeat(data, "k", "t")                       # keys with a NULL are no keys
    assert au.may_repeat(data, "k")
    gate = au.Gate([au.Check("t", "k,t", "unique"), au.Check("t", "k", "unique"), au.Check("t", "t", "unique")], enforced=False)
    gate.of("t")(data)
    assert {(c, n) for _, c, _, n in gate.results} == {("k,t", 0), ("k", 2), ("t", 1)}
    assert len(gate.results) == 3


def test_activity_meets_once_on_the_grain(spark):
    day, late = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 23)
    commits = spark.createDataFrame(
        [("r", "a", day, 1, 2), ("r", "a", late, 3, None), ("r", None, day, 5, 1), ("s", None, day, None, None), (None, "a", day, 1, 1),
         ("r", "b", dt.datetime(2024, 1, 2), 1, 1), ("r", "a", None, 1, 1)],
        "repo_full_name string, author_email string, committed_at timestamp_ntz, lines_added int, lines_deleted int")
    prs = spark.createDataFrame([("r", day, day, day), ("r", late, None, day), ("r", day, None, None), ("t", day, None, None)],
                                "repo_full_name string, created_at timestamp_ntz, merged_at timestamp_ntz, closed_at timestamp_ntz")
    issues = spark.createDataFrame([("r", day, None), ("r", day, day), ("u", late, None)],
                                   "repo_full_name string, created_at timestamp_ntz, closed_at timestamp_ntz")
    for span in ((None, None), ("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-02")):
        got = fx.combined_activity(commits, prs, issues, *span)
        want = fx.full_outer_chain(commits, prs, issues, *span)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert rows(got.where("repo_full_name IS NOT NULL")) == rows(want.where("repo_full_name IS NOT NULL"))
    assert plan(got).count("Exchange hashpartitioning") == 2       # commits by author, then everything on the grain


def test_files_are_listed_without_sorting_their_rows(spark, tmp_path, monkeypatch):
    seen, real = [], vs.DataFile
    monkeypatch.setattr(vs, "DataFile", lambda *a, **k: seen.append(a) or real(*a, **k))
    data = spark.createDataFrame([(i % 3 if i % 4 else None, f"m{i % 5}" if i % 5 else None, i) for i in range(60)], "k int, m string, v int")
    for layout, parts in ((vs.Layout("m"), {None, "m1", "m2", "m3", "m4"}), (vs.Layout("m", None, ("k", "m")), {None, "m1", "m2", "m3", "m4"}),
                          (vs.Layout(None, None, ("k",)), {None})):
        path = str(tmp_path / str(len(seen)))
        files = vs.write_files(data, path, layout)
        assert {f.part for f in files} == parts and len({f.path for f in files}) == len(files)
        assert all((f.low is not None) == bool(layout.keys) for f in files)
        got = vs.read_files(spark, path, vs.Snapshot(0, data.schema, layout).adding(files))
        assert rows(got) == rows(data)
