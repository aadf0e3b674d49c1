import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH", "")]))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from foliant.session import local_session

    session = local_session("4", partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    """Runs SQL over the tables of one size; rows as sorted lists of comparable values."""
    import duckdb

    def run(sql: str, sf: str = "sf0.01"):
        con = duckdb.connect()
        for p in Path(f"{DATA}/{sf}").glob("*.parquet"):
            con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        rel = con.sql(sql)
        return rel.columns, rel.fetchall()

    return run


def same_rows(df, columns, rows) -> None:
    names = sorted(df.columns)
    assert names == sorted(columns)
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    left = sorted(repr([plain(r[n]) for n in names]) for r in df.collect())
    order = [list(columns).index(n) for n in names]
    right = sorted(repr([plain(r[i]) for i in order]) for r in rows)
    assert left == right
