import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ionsift.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of plain tuples, NULL last."""

    def read(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in r))

    return read
