"""The collector's runs read documents that were landed once."""

from pyspark.sql import functions as F

from castline.plans import queries_landing as ql
from castline.sources import payloads as pl
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_landed_once_for_all_runs(spark, cat, monkeypatch):
    made, real = [], pl.daily_report
    monkeypatch.setattr(pl, "daily_report", lambda c: made.append(1) or real(c))
    landed = ql.landed_files(cat)
    fresh = ql.landed_documents(cat)
    assert {k: rows(d.select(sorted(d.columns)).drop("payload")) for k, d in landed.items()} == {
        k: rows(d.select(sorted(d.columns)).drop("payload")) for k, d in fresh.items()}
    assert all("Exchange" not in plan(d) and d.inputFiles() for d in landed.values())
    made.clear()
    ql._collected(cat, times=2).table("quarantine").agg(F.count(F.lit(1))).collect()
    assert len(made) == 1
