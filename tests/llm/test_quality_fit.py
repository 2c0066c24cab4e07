"""The quality fit uses every label, and its threshold is exact."""

import numpy as np
import pytest

from castline.llm import quality


def test_all_labels_are_fitted(spark):
    labels = spark.range(45_000).selectExpr("id DIV 2 AS doc_id", "cast(id % 4 > 0 AS int) AS quality", "0 AS toxic")
    got = quality.trusted_ids(labels)
    assert got.count() == 22_500
    assert got.where("good = 0").count() == 11_250


@pytest.mark.parametrize("values", [[0.5], [2.0] * 7, [-1e300, 1e-320, 0.0, 2e-320, 1e300, 0.0], list(np.random.default_rng(3).normal(size=5000)),
                                    [1.0 + k * 2.0 ** -52 for k in range(40)]])
def test_ranks_are_exact(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "llr double")
    for rank in {0, len(values) // 3, len(values) // 2, len(values) - 1}:
        assert quality.at_rank(rows, rank) == sorted(values)[rank]


def test_threshold_is_that_of_the_sorted_scores(spark):
    rnd = np.random.default_rng(5)
    good, bad = rnd.normal(1.0, 0.2, 3001), rnd.normal(-1.0, 0.5, 1000)
    rows = spark.createDataFrame([(1, float(v)) for v in good] + [(0, float(v)) for v in bad], "good int, llr double").cache()
    floor, middle = np.quantile(good, 1 - quality.KEEP_SHARE, method="lower"), np.median(bad)
    assert quality.threshold(rows) == floor - quality.SLACK * (floor - middle)
    assert quality.threshold(rows.where("good = 1")) == -np.inf
    assert quality.threshold(rows.withColumn("llr", -rows.llr)) == -np.inf
