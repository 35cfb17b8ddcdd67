from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from storefront.session import build_session
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": f"file://{shared}"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.exists(f"{SMALL}/orders.parquet"):
        pytest.skip("test tables not present")
    return SMALL


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
