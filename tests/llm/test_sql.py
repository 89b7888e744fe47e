import pytest

from tests.oracle import compared, connection
from voxloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got, expected = compared(queries.queries()[name](spark, SF), duck, queries.oracle_sql()[name])
    assert got == expected


def test_each_operator_has_a_query():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert [n for n in found if n.startswith("op")] == list(queries.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 11))
    assert "pipeline" in found and "pipeline" not in __spark_entry__.oracle_sql()
