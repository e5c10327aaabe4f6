import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = os.environ.get("AMBERMILL_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ambermill.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    s = local_session("tests", 4, **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh"))})
    yield s
    s.stop()


@pytest.fixture
def sf():
    return SF
