import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gatefold.session import build_session, ensure_checkpoint_dir

    session = build_session(
        "gatefold-tests", master="local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
