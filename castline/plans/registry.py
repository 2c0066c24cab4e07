"""Query registry: every operator of the inventory as a named query.

Each entry pairs a Spark builder ``(catalog) -> DataFrame`` with the DuckDB
oracle SQL (or ``None`` for operators that are not SQL-expressible, e.g.
streaming runs).  ``__spark_entry__`` exposes both halves to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from castline.plans import oracle as O
from castline.sources.catalog import TestdataCatalog


@dataclass
class Entry:
    build: Callable[[TestdataCatalog], DataFrame]
    oracle: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def register(name: str, build, oracle_final: str | None, doubles=(), note: str = "") -> None:
    """``oracle_final`` is a SELECT over model/binding names; it is composed
    with its CTEs and its DOUBLE columns rounded to 6 places."""
    if name in REGISTRY:
        raise KeyError(f"duplicate query {name}")
    sql = None
    if oracle_final is not None:
        sql = O.compose(O.rounded(f"({oracle_final.strip()}) AS q", tuple(doubles)))
    REGISTRY[name] = Entry(build, sql, tuple(doubles), note)


def finalize(df: DataFrame) -> DataFrame:
    """Round DOUBLE columns to 6 places (engine-independent comparison):
    first to 10 places, then half away from zero to 6."""
    exprs = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            # Two-step rounding: noise below 1e-10 is absorbed first, so values
            # on an exact 7th-decimal tie round the same way in every engine.
            exprs.append(F.round(F.round(F.col(f.name).cast("double"), 10), 6).alias(f.name))
            changed = True
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs) if changed else df


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    load()
    return finalize(REGISTRY[name].build(TestdataCatalog(spark, sf_dir)))


def load() -> dict[str, Entry]:
    """Import the modules that populate REGISTRY (idempotent, lazy to avoid
    import cycles) and return it."""
    from castline.plans import queries  # noqa: F401
    from castline.plans import queries_changes  # noqa: F401
    from castline.plans import queries_landing  # noqa: F401
    from castline.plans import queries_ops  # noqa: F401
    return REGISTRY
