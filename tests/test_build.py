"""The build publishes only what passes its blocking audits, and writes all declared tests."""
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from castline.operators import audits as au
from castline.operators import maintain as mn
from castline.plans import build as bd


def test_build_publishes_after_the_audits(spark, cat, tmp_path):
    root = str(tmp_path / "w")
    paths = bd.build_warehouse(spark, cat, root)
    results = {(r["model"], r["column_name"], r["test"]) for r in mn.read_table(spark, paths["audit_results"]).collect()}
    assert results == {(c.model, c.column, c.test) for c in bd.declared_tests()}
    assert len(results) == len(au.TOOL1_TESTS) + len(bd.WAREHOUSE_TESTS)
    before = {m: mn.read_table(spark, paths[m]).count() for m in ("fact_revenue", "dim_content", "fact_github_activity")}

    # A test that cannot pass stops the build where it fails; what was published stays.
    bad = [replace(c, test="positive", blocking=True) if (c.model, c.test) == ("fact_revenue", "positive") else c
           for c in bd.declared_tests()] + [au.Check("fact_revenue", "status", "accepted_values", ("never",))]
    with pytest.raises(au.AuditFailure):
        bd.build_warehouse(spark, Fewer(cat), root, checks=bad)
    assert mn.read_table(spark, paths["fact_revenue"]).count() == before["fact_revenue"]


class Fewer:
    """The same catalog with half of the charges."""

    def __init__(self, cat):
        self.cat = cat

    def raw(self, name):
        rows = self.cat.raw(name)
        return rows.where(F.col("id").cast("bigint") % 2 == 0) if name == "raw_stripe_charges" else rows

    def __getattr__(self, name):
        return getattr(self.cat, name)


def test_a_failing_candidate_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    gate = au.Gate([au.Check("t", "id", "unique"), au.Check("t", "v", "positive", blocking=False)])
    mn.full_rebuild(spark.createDataFrame([(1, 1), (2, -1)], "id int, v int"), path, check=gate.of("t"))
    with pytest.raises(au.AuditFailure):
        mn.full_rebuild(spark.createDataFrame([(1, 1), (1, 2)], "id int, v int"), path, check=gate.of("t"))
    assert mn.read_table(spark, path).count() == 2
    assert sorted((r[2], r[3]) for r in gate.results) == [("positive", 0), ("positive", 1), ("unique", 0), ("unique", 1)]
    open_gate = au.Gate(gate.checks, enforced=False)
    mn.full_rebuild(spark.createDataFrame([(1, 1), (1, 2)], "id int, v int"), path, check=open_gate.of("t"))
    assert mn.read_table(spark, path).where("id = 1").count() == 2
