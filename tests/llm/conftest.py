import os
from pathlib import Path

import pytest

from threadmill.shipping import ship_package

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shipped(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(shipped):
    """Documents from (doc_id, text) pairs, with the columns of the table and a clashing one."""

    def make(rows, langs=None):
        full = [(i, t, (langs or {}).get(i), "s", len(t or ""), "x") for i, t in rows]
        return shipped.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score string"
        )

    return make


@pytest.fixture(scope="session")
def folder():
    if not os.path.exists(FOLDER):
        pytest.skip("no test tables")
    return str(Path(FOLDER))
