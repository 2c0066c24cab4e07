"""Property-based checks of the keyed maintenance operators against a plain
Python model of the reference's sequential ``ON CONFLICT`` semantics."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from castline.operators import maintain as mn

SCHEMA = "k int, v int, ver int, created int"
keys = st.integers(0, 6)
rows_ = st.lists(st.tuples(keys, st.integers(0, 99)), max_size=8)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _model_upsert(target, batch):
    out = {k: dict(v=v, ver=ver, created=c) for k, v, ver, c in target}
    for k, v, ver, c in sorted(batch, key=lambda r: r[2]):      # applied in arrival (version) order
        old = out.get(k)
        out[k] = dict(v=v, ver=ver, created=old["created"] if old else c)
    return sorted((k, d["v"], d["ver"], d["created"]) for k, d in out.items())


def _frames(spark, t, b):
    target = [(k, v, 0, 100 + k) for k, v in dict(t).items()]          # unique keys
    batch = [(k, v, i + 1, 200 + i) for i, (k, v) in enumerate(b)]     # distinct versions
    return target, batch, spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)


@SETTINGS
@given(t=rows_, b=rows_)
def test_upsert_matches_sequential_model_and_is_idempotent(spark, t, b):
    target, batch, tdf, bdf = _frames(spark, t, b)
    got = sorted(tuple(r) for r in mn.upsert(tdf, bdf, ["k"], ["v", "ver"], ["ver"]).collect())
    assert got == _model_upsert(target, batch)
    via_broadcast = mn.upsert(tdf, bdf, ["k"], ["v", "ver"], ["ver"], broadcast_bytes=10**12)
    assert sorted(tuple(r) for r in via_broadcast.collect()) == got
    again = mn.upsert(spark.createDataFrame(got, SCHEMA), bdf, ["k"], ["v", "ver"], ["ver"])
    assert sorted(tuple(r) for r in again.collect()) == got


@SETTINGS
@given(t=rows_, b=rows_)
def test_insert_if_absent_matches_model(spark, t, b):
    target, batch, tdf, bdf = _frames(spark, t, b)
    model = {r[0]: r for r in target}
    for r in sorted(batch, key=lambda r: r[2]):
        model.setdefault(r[0], r)
    got = sorted(tuple(r) for r in mn.insert_if_absent(tdf, bdf, ["k"], ["ver"]).collect())
    assert got == sorted(model.values())


# --------------------------------------------------- rewritten plans = literal plans
import datetime as dt  # noqa: E402

from castline.operators import facts as fx  # noqa: E402
from castline.operators import marts as mt  # noqa: E402

D0 = dt.date(2024, 1, 1)
T0 = dt.datetime(2024, 1, 1, 12)
days = st.one_of(st.none(), st.integers(0, 3).map(lambda i: D0 + dt.timedelta(days=i)))
perf_rows = st.lists(st.tuples(days, st.integers(0, 9), st.one_of(st.none(), st.integers(0, 9))), max_size=6)
stat_rows = st.lists(st.tuples(days, st.integers(0, 9), st.floats(0, 10, allow_nan=False)), max_size=6)


@SETTINGS
@given(p=perf_rows, s=stat_rows)
def test_daily_mart_union_groupby_equals_spine_join(spark, p, s):
    perf = spark.createDataFrame([("e", d, a, b, 1, 1.0) for d, a, b in p],
                                 "episode_id string, metric_date date, starts int, streams int, "
                                 "unique_listeners int, avg_listen_seconds double")
    stats = spark.createDataFrame([("v", d, n, w, 1.0, 1, 0) for d, n, w in s],
                                  "video_id string, metric_date date, views int, watch_time_minutes double, "
                                  "avg_view_seconds double, likes int, comments int")

    def norm(df):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
    assert norm(mt.mart_daily_metrics(perf, stats)) == norm(mt.date_spine_join(perf, stats))


repos = st.sampled_from(["org/a", "org/b", None])
hours = st.integers(0, 72).map(lambda h: T0 + dt.timedelta(hours=h))
gh_rows = st.lists(st.tuples(repos, hours, st.booleans()), max_size=6)


@SETTINGS
@given(c=gh_rows, p=gh_rows, i=gh_rows)
def test_github_union_groupby_equals_full_outer_chain(spark, c, p, i):
    commits = spark.createDataFrame([(r, t, 1, 2, "a@x" if f else "b@x") for r, t, f in c],
                                    "repo_full_name string, committed_at timestamp_ntz, lines_added int, "
                                    "lines_deleted int, author_email string")
    prs = spark.createDataFrame([(r, t, t if f else None, t) for r, t, f in p],
                                "repo_full_name string, created_at timestamp_ntz, merged_at timestamp_ntz, "
                                "closed_at timestamp_ntz")
    issues = spark.createDataFrame([(r, t, t if f else None) for r, t, f in i],
                                   "repo_full_name string, created_at timestamp_ntz, closed_at timestamp_ntz")
    dim = spark.createDataFrame([("k-a", "org/a"), ("k-b", "org/b")], "repo_key string, repo_full_name string")
    literal = fx.repo_lookup(fx.full_outer_chain(commits, prs, issues, "2024-01-01", "2024-01-31"), dim)
    rewritten = fx.fact_github_activity(commits, prs, issues, dim, "2024-01-01", "2024-01-31")
    assert sorted(map(tuple, literal.collect()), key=repr) == sorted(map(tuple, rewritten.collect()), key=repr)
