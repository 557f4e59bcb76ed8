import os
import sys
import warnings
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONWARNINGS", "ignore")
warnings.filterwarnings("ignore")

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trailguard.session import build_session
    s = build_session(master="local[4]", app="trailguard-tests", shuffle_partitions=4)
    yield s
    s.stop()
