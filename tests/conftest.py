import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakewarden.session import session

    out = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__sql__warehouse__dir=f"file://{tmp_path_factory.mktemp('warehouse')}")
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    from shared import SF

    for path in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return c
