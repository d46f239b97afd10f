import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from inkwell.session import session, ship

    s = session("4", partitions=4, memory="4g")
    ship(s)
    return s
