from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vitrine.schemas import CARDS  # noqa: E402
from vitrine.session import local_session  # noqa: E402

AS_OF = datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cards(spark):
    def make(batch, source="loja"):
        rows = [(i + 1, source, i, lines) for i, lines in enumerate(batch)]
        return spark.createDataFrame(rows, CARDS)

    return make


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
