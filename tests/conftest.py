import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sparkgate.session import build_session
    ckpt = tempfile.mkdtemp(prefix="sparkgate-test-ckpt-")
    s = build_session("local[4]", 4, app_name="sparkgate-tests",
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
