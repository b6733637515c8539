import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def sf_dir():
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_code(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def larger_dir(sf_dir):
    """Ten times the rows where they are there: enough labels to learn from."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    return folder if os.path.isdir(folder) else sf_dir
