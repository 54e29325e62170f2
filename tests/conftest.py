import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from khabarloom.runtime import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
