"""Every registered query against the same question asked in SQL of another engine."""

import pytest
from compare import compare, connect

from workload.oracle import ORACLE
from workload.queries import REGISTERED

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(SF) as con:
        yield con


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLE)


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_sql(spark, duck, name):
    rows, problems = compare(REGISTERED[name](spark, SF), duck, ORACLE[name])
    assert not problems
    assert rows > 0
