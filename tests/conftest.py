import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

sys.path.insert(0, str(ROOT / "tests"))

from sf_data import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from orbitframe.session import session

    folder = tmp_path_factory.mktemp("spark")
    more = {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse",
    }
    s = session("tests", "local[4]", **more)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in sorted(DATA.glob("*.parquet")):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="session")
def same():
    """Whether two pandas frames hold the same rows in any order."""

    def text(v):
        if v is None or v != v:
            return "null"
        return repr(round(v, 6)) if isinstance(v, float) else str(v)

    def rows(df):
        return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))

    return lambda a, b: sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)
