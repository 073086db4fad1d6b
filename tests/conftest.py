import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import checkpoint_dir, local_session
    s = local_session("*", app="sluice-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()
