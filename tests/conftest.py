import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tablekeep.session import Workspace, local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
DATA = os.path.join(ROOT, "tests", "data")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    kept = {"spark.sql.ui.retainedExecutions": "300"}
    return local_session("8", conf={"spark.sql.warehouse.dir": warehouse, **kept})


@pytest.fixture
def ws(spark):
    area = Workspace(spark)
    yield area
    area.close()
