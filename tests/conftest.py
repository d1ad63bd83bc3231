import decimal
import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sluicework.plans.registry import TABLES  # noqa: E402
from sluicework.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "tests", **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        }
    )
    yield session
    session.stop()


def plain(value):
    """A value in the form in which both engines are compared."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    return repr(value) if isinstance(value, (bool, float)) else str(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())


def duck_rows(folder, sql):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    relation = con.sql(sql)
    columns = sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    return columns, sorted(repr([plain(r[i]) for i in at]) for r in relation.fetchall())
