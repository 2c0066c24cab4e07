"""S1 ``src_table``: resolve a raw table by (system, table).

Two catalogs implement the same interface:

* :class:`TestdataCatalog` derives every ``raw_<system>_<table>`` from the
  driver's base Parquet tables through :mod:`castline.sources.bindings`.
* :class:`WarehouseCatalog` reads landed Parquet tables from a warehouse root
  with the declared schema (never inferred), which is what a production sync
  writes.

Operators only ever see DataFrames, so they are indifferent to the catalog.
Base DataFrames are created once per catalog; every read is lazy, so Catalyst
still prunes columns and pushes filters into each Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.session import configure
from castline.sources.bindings import BINDINGS, DEALT, base_tables_of, counted_columns, dealt_sql


def table_name(system: str, table: str) -> str:
    """The reference names ``raw.<table>`` and lets two sources collide on
    ``videos``; we qualify every raw table by its source system."""
    return f"raw_{system}_{table}"


class TestdataCatalog:
    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    def raw(self, name: str, parts: int | None = None, by_day: bool = False) -> DataFrame:
        """A raw landed table (``raw_…``) or seed bound to the base tables.

        Tables of ``DEALT`` come out dealt by their group, or with ``parts`` by its key into so many partitions, or
        with ``by_day`` by ranges of day and key: a writer of days finds them together."""
        if name in DEALT:
            table, key, day = DEALT[name]
            rows = self.base(table).withColumns({"_key": F.expr(key), "_day": F.expr(day)})
            if by_day:
                rows = rows.repartitionByRange("_day", "_key")
            else:
                rows = rows.repartition(parts, "_key") if parts else rows.repartition("_key", "_day")
            firsts = {f"_first_{c}": F.col(c).isNotNull() & (F.row_number().over(Window.partitionBy("_key", "_day", c).orderBy(c)) == 1)
                      for c in counted_columns(name)}
            return self.spark.sql(dealt_sql(name), **{table: rows.withColumns(firsts)})
        sql = BINDINGS[name]
        return self.spark.sql(sql, **{t: self.base(t) for t in base_tables_of(sql)})

    def source(self, system: str, table: str) -> DataFrame:
        return self.raw(table_name(system, table))


class WarehouseCatalog:
    """Landed tables under ``root/<raw table>/`` (Parquet, declared schemas)."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict | None = None):
        from castline.sources.schemas import RAW_SCHEMAS
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.schemas = RAW_SCHEMAS if schemas is None else schemas

    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.parquet(f"{self.root}/{name}")

    def base(self, name: str) -> DataFrame:
        return self.raw(name)

    def source(self, system: str, table: str) -> DataFrame:
        return self.raw(table_name(system, table))


def land_raw_tables(source: TestdataCatalog, root: str, names=None) -> WarehouseCatalog:
    """S4 for the test bindings: write each raw table as landed Parquet under
    ``root`` (full-refresh sync) and return a catalog reading them back."""
    from castline.sources.schemas import RAW_SCHEMAS
    for name in names or RAW_SCHEMAS:
        source.raw(name).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    return WarehouseCatalog(source.spark, root)
