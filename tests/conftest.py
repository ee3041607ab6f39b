import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spanfeat.session import build_session, checkpoint_root, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    root = checkpoint_root(session).removeprefix("file:")
    clear_scratch(session)
    left = [n for n in os.listdir(root) if re.fullmatch(r".+-[0-9a-f]{32}", n)] if os.path.isdir(root) else []
    session.stop()
    assert not left, f"scratch tables left behind: {left[:5]}"


@pytest.fixture
def rows():
    """Sorted plain tuples of a small result."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))

    return collect
