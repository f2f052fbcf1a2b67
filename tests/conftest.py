from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SEEDS = os.path.join(ROOT, "tests", "fixtures", "seeds")
SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import local_session

    s = local_session("*", shuffle_partitions=8, app="strata-tests")
    # tests own their checkpoint dir (a cluster names a shared one in spark.checkpoint.dir)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
