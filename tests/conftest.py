from __future__ import annotations

import datetime
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from daygrain.schemas import OBSERVATIONS  # noqa: E402
from daygrain.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", shuffle_partitions=8, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture
def observations(spark):
    """Build a fact table from dicts; days count from 2026-03-01 as day 1."""

    def build(*rows):
        records = []
        for row in rows:
            day = row.get("day", 1)
            record = {
                "city": row.get("city", "A"),
                "date": datetime.date(2026, 2, 28) + datetime.timedelta(days=day),
            }
            for name in OBSERVATIONS.names:
                if name not in record:
                    record[name] = row.get(name)
            records.append(tuple(record[n] for n in OBSERVATIONS.names))
        return spark.createDataFrame(records, OBSERVATIONS)

    return build


def column(df, name, order=("city", "date")):
    """Values of one column in key order."""
    return [row[name] for row in df.orderBy(*order).collect()]
