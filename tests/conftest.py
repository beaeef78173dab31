import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from viewloom.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    df = df.select(*order) if order else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(v) for v in r])
