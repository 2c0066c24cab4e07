import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from castline.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def cat(spark):
    from castline.sources.catalog import TestdataCatalog
    return TestdataCatalog(spark, SF_SMALL)


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
