from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

# Our own readings of weather stations: a repeated row, a missing number and a
# missing date (FIXTURES.md section 1).
READINGS_CSV = """reading_id,station,sky,humidity,wind_kmh,taken_on,verified
11,Fjord,clear,40,3.5,2023-11-30,true
12,Mesa,rain,80,12.25,2023-11-30,true
13,Fjord,rain,75,,2023-12-01,false
14,Dune,clear,20,7.0,2023-12-31,true
15,Mesa,snow,90,3.5,2024-01-01,false
15,Mesa,snow,90,3.5,2024-01-01,false
16,Dune,clear,25,20.0,,true
"""


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    from pyspark.sql import SparkSession

    from strata.session import local_session

    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    session = local_session(
        4,
        shuffle_partitions=8,
        warehouse_dir=os.path.join(scratch, "warehouse"),
    )
    # Tests only: a checkpoint folder when the environment names none.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return session


@pytest.fixture()
def tmp_dir(scratch):
    return tempfile.mkdtemp(dir=scratch)


@pytest.fixture(scope="session")
def readings_path(scratch):
    path = os.path.join(scratch, "station_readings.csv")
    with open(path, "w") as f:
        f.write(READINGS_CSV)
    return path


@pytest.fixture(scope="session")
def readings(spark, readings_path):
    from strata.sources.readers import load

    return load(spark, readings_path, "csv")
