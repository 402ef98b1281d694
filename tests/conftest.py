from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from foliospark.session import local_session

    s = local_session(8, 4, "tests")
    s.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{ROOT / 'tests'}"
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    return DATA
