import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheetlake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app_name="sheetlake-tests",
                  conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g",
                        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sheetlake-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="sheetlake-test-")
