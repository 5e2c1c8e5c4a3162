"""Every query with an oracle equals its DuckDB SQL on the smallest driver tables.  (check_oracle.py runs the same at sf0.01.)"""

import pytest

import __spark_entry__ as E

from .conftest import SF001
from .oracle_harness import compare, duck

ORACLE = E.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF001), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "appointment_id"
