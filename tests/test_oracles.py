"""Every registered query of the library against its SQL on the smallest driver tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from odometra.plans import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables are not here")


def shown(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.6g}"
    return str(value.tolist() if hasattr(value, "tolist") else value)


def rows(frame: pd.DataFrame):
    return sorted(tuple(map(shown, r)) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return db


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    if name not in ORACLES:
        assert len(got.columns) == len(set(got.columns))
        return
    found = duck.sql(ORACLES[name])
    want = pd.DataFrame(found.fetchall(), columns=found.columns, dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
