import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session, clear_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("strata-tests", "local[4]", {"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_scratch(s)


@pytest.fixture
def write_text(tmp_path):
    """Write ``text`` as one CSV file in a fresh folder and return the folder."""
    counter = {"n": 0}

    def _write(text: str, name: str = "part.csv") -> str:
        counter["n"] += 1
        folder = tmp_path / f"in{counter['n']}"
        folder.mkdir()
        (folder / name).write_text(text, encoding="utf-8")
        return str(folder)

    return _write
