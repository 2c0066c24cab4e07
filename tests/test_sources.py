"""Sources: declared raw schemas, landed-table reads, bindings."""
from pyspark.sql import functions as F

from castline.operators import marts as mt
from castline.operators import staging as stg
from castline.sources.catalog import WarehouseCatalog, land_raw_tables
from castline.sources.schemas import RAW_SCHEMAS
from tests.conftest import rows


def test_bindings_produce_the_declared_schemas(spark, cat):
    for name, ddl in RAW_SCHEMAS.items():
        declared = spark.createDataFrame([], ddl).schema.simpleString()
        assert cat.raw(name).schema.simpleString() == declared, name


def test_landed_tables_read_with_declared_schema_give_the_same_marts(spark, cat, tmp_path):
    names = ["raw_spotify_episode_performance", "raw_youtube_daily_stats"]
    wh = land_raw_tables(cat, str(tmp_path / "raw"), names)

    def daily(c):
        return mt.mart_daily_metrics(stg.staged(c, "stg_spotify_daily_performance"),
                                     stg.staged(c, "stg_youtube_daily_stats"))
    assert rows(daily(cat)) == rows(daily(wh))


def test_missing_landed_column_reads_as_null(spark, cat, tmp_path):
    root = str(tmp_path / "raw")
    cat.raw("raw_twitter_tweets").drop("public_metrics_quote_count").write.parquet(f"{root}/raw_twitter_tweets")
    wh = WarehouseCatalog(spark, root)
    df = stg.staged(wh, "stg_twitter_tweets")
    assert df.where(F.col("quote_count") != 0).count() == 0        # NULL → 0 by the staging default
    assert df.count() == cat.raw("raw_twitter_tweets").count()
