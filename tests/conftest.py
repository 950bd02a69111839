from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shopfloor import schemas  # noqa: E402
from shopfloor.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[2]", shuffle_partitions=2, app_name="shopfloor-tests")
    checkpoint_dir(s)  # tests set their own scratch checkpoint folder
    yield s
    s.stop()


# Own rows, one decision each: ids that differ only in case or by a blank, a
# repeated delivery, a year's last and next day, a run without output, values
# below zero, an inspection of nothing and one with more defects than pieces.
PRODUCTION_ROWS = [
    ("w7-a", "north", "press", "mx-2", "S3", "bolt", "2023-12-31", 250, 240, 238, 450.0, 431.5),
    ("W7-a", "north", "press", "mx-2", "S3", "bolt", "2024-01-01", 250, 255, 251, 450.0, 450.0),
    ("w7-a ", "south", "oven", "ov-9", "S2", "tile", "2024-02-29", 90, 0, 0, 300.0, 12.0),
    ("w8", "south", "oven", "ov-9", "S1", "tile", "2024-02-29", 80, 72, 60, 240.0, 200.0),
    ("w8", "south", "oven", "ov-9", "S1", "tile", "2024-02-29", 80, 72, 60, 240.0, 200.0),
    ("late", "north", "lathe", "lt-1", "S1", "gear", "2022-06-30", -3, 7, -2, 120.0, 118.0),
]

DOWNTIME_ROWS = [
    ("stop1", "mx-2", "2023-12-31", "S3", "jam", 12.5, "n"),
    ("stop2", "mx-2", "2023-12-31", "S3", "tooling", 37.5, "y"),
    ("stop3", "mx-2", "2024-01-01", "S3", "power", 8.0, "N"),
    ("stop4", "ov-9", "2024-02-29", "S1", "cleaning", 24.0, "Y"),
    ("stop5", "ov-9", "2024-02-29", "S1", "sensor", -6.0, "N"),
    ("stop6", "nowhere", "2024-02-29", "S1", "jam", 99.0, "N"),
]

QUALITY_ROWS = [
    ("i1", "mx-2", "bolt", "2023-12-31", "S3", 160, 4, "burr"),
    ("i2", "mx-2", "bolt", "2023-12-31", "S3", 40, 1, "burr"),
    ("i3", "ov-9", "tile", "2024-02-29", "S1", 30, 45, "crack"),
    ("i4", "lt-1", "gear", "2022-06-30", "S1", 0, 0, "none"),
]


@pytest.fixture
def production_df(spark):
    return spark.createDataFrame(PRODUCTION_ROWS, schemas.PRODUCTION)


@pytest.fixture
def downtime_df(spark):
    return spark.createDataFrame(DOWNTIME_ROWS, schemas.DOWNTIME)


@pytest.fixture
def quality_df(spark):
    return spark.createDataFrame(QUALITY_ROWS, schemas.QUALITY)


def nullable(schema):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
