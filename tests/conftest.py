import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from scquarry.session import local_session

    return local_session(4, 4, "4g")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
