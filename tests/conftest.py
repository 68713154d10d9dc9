from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from propgraph.session import get_spark
    s = get_spark("local[4]", app="propgraph-tests", shuffle_partitions=4)
    # Tests run in local mode without a cluster folder: use a fresh one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="propgraph-test-ckpt-"))
    yield s
