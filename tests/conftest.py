import os
import sys
from pathlib import Path

import pandas as pd
import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


def same_rows(a, b):
    """Whether two pandas frames hold the same rows, order aside."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    text = lambda v: "~" if v is None or v is pd.NA or v != v else repr(round(float(v), 6)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)
    rows = lambda x: sorted(tuple(map(text, r)) for r in x[cols].itertuples(index=False))
    return rows(a) == rows(b)
