import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = os.environ.get("HEDDLE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from heddle.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    sys.path.insert(0, os.path.join(ROOT, "tests"))
    from compare import duck

    return duck(small)
