import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meteoframe.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="meteoframe-tests", shuffle_partitions=8,
                      extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # the session's shared folder when one is configured; a scratch one only if unset
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
