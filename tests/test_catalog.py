"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402


@pytest.fixture(scope="module")
def connection(folder):
    return compare.sql_connection(folder)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, connection, folder, name):
    assert compare.compare(spark, connection, folder, name) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["marca", "n", "preco_medio", "idade_media"]
