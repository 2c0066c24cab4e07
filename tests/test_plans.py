"""Plan-shape guarantees (sf0.001).

The per-query check (no cross / nested-loop joins, no Python UDF operators)
runs inside ``test_oracle.test_query_matches_oracle`` on the same DataFrame;
here: deduplication without windows, partial aggregation before shuffles, and
the fan-out summary never materialising pairs.
"""
import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_is_a_partial_aggregate_not_a_window(spark):
    text = plan(QUERIES["dedupe_latest"](spark, SF_SMALL))
    assert "Window" not in text
    assert "partial_max_by" in text


def test_fact_aggregations_are_partial_before_the_shuffle(spark):
    text = plan(QUERIES["fact_daily_engagement"](spark, SF_SMALL))
    assert "partial_sum" in text and "partial_avg" in text


def join_output_rows(df) -> list[int]:
    """After execution: rows emitted by every join of the final adaptive plan."""
    def children(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return [node.executedPlan()]
        if "QueryStage" in name:
            return [node.plan()]
        ch = node.children()
        return [ch.apply(i) for i in range(ch.size())]

    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if "Join" in node.nodeName():
            metric = node.metrics().get("numOutputRows")
            if metric.isDefined():
                out.append(int(metric.get().value()))
        stack.extend(children(node))
    return out


def test_fan_out_summary_never_materialises_pairs(spark, cat):
    """The literal view joins metric rows × show-metric rows (``pairs`` rows,
    more than the metric table itself).  Our plan aggregates both sides first:
    no join emits more rows than the metric table has.  That the result still
    equals the literal view is checked by the oracle test."""
    from pyspark.sql import functions as F
    pem = cat.raw("raw_podcast_episode_metrics")
    psm = cat.raw("raw_podcast_show_metrics")
    pairs = pem.join(cat.raw("raw_podcast_episodes").select(F.col("id").alias("eid"), "podcast_id"),
                     F.col("episode_id") == F.col("eid")).groupBy("podcast_id").count() \
        .join(psm.groupBy("podcast_id").count().withColumnRenamed("count", "n"), "podcast_id") \
        .agg(F.sum(F.col("count") * F.col("n"))).first()[0]
    n_metrics = pem.count()
    assert pairs > n_metrics                       # the literal view would blow the data up
    df = QUERIES["performance_summary"](spark, SF_SMALL)
    df.collect()
    emitted = join_output_rows(df)
    assert emitted and max(emitted) <= n_metrics


def test_aggregate_before_join_bounds_join_outputs(spark, cat):
    """Per-episode / per-video metrics are aggregated before the content
    joins, so no join in the mart emits more rows than there are content
    rows plus mapping rows; the collector top-k joins see one row per episode."""
    content = QUERIES["content_unified_mapped"](spark, SF_SMALL).count()
    mapping = cat.raw("seed_content_mapping").count()
    mart = QUERIES["mart_content_performance"](spark, SF_SMALL)
    mart.collect()
    assert max(join_output_rows(mart)) <= content + mapping
    episodes = cat.raw("raw_podcast_episodes").count()
    top = QUERIES["top_podcast_episodes"](spark, SF_SMALL)
    top.collect()
    assert max(join_output_rows(top)) <= episodes


def test_bucketed_metrics_are_not_shuffled_for_their_joins(spark, cat):
    from castline.operators import layout as ly
    from castline.plans import reports as rp
    from castline.plans.queries import collector
    p, pe, pem, psm = collector(cat)
    pe, pem = ly.bucketed(pe, "id", "episodes", 4), ly.bucketed(pem, "episode_id", "episode_metrics", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (rp.metrics_latest(pem, pe, p), rp.performance_summary(p, pe, pem, psm)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin [episode_id" in plan
            assert "hashpartitioning(episode_id" not in plan and "hashpartitioning(id#" not in plan.split("podcast_id")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_the_sieve_shuffles_hashes_and_groups_suspects_only(spark):
    from pyspark.sql import functions as F

    from castline.operators import audits as au
    rows_ = [(f"k{i % 90}", None if i % 7 == 0 else i % 90) for i in range(100)] + [(None, None)] * 3 + [("only", 1)]
    df = spark.createDataFrame(rows_, "a string, b int")
    assert sorted(map(tuple, au.duplicate_groups_sieved(df, "a", "b").collect()), key=repr) == sorted(
        map(tuple, au.duplicate_groups(df, "a", "b").collect()), key=repr)
    unique = spark.range(1000).select(F.concat(F.lit("a long key "), F.col("id")).alias("a"))
    sieved = au.duplicate_groups_sieved(unique, "a")
    assert sieved.collect() == []
    plan = sieved._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(h#" in plan
