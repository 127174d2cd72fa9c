"""Every registered query against the same query in DuckDB, on the smallest tables."""

import os

import pytest

from meterline.queries import REGISTRY
from tools.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_agrees(spark, con, name):
    assert differences(REGISTRY[name], spark, con, SF_DIR) is None


def test_inventory_is_covered():
    covered = {i for q in REGISTRY.values() for i in q.covers}
    counts = dict(P=10, F=8, J=8, A=11, W=2, O=5, U=3, X=16, D=1, N=6, M=12, Q=10, R=22, S=28)
    wanted = {f"{k}{i}" for k, n in counts.items() for i in range(1, n + 1)} | {"ML1", "E1", "ST1"}
    # Reading a pandas frame works on driver memory only; tests/test_sources.py covers it.
    assert wanted - covered == {"S13"}


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())
