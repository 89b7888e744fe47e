import pytest

from voxloom.plans import oracles, registry

from .oracle import compared, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got, expected = compared(registry.queries()[name](spark, SF), duck, oracles.oracle_sql()[name])
    assert got == expected


def test_only_the_exact_shuffle_has_no_sql():
    assert set(registry.queries()) - set(oracles.oracle_sql()) == {"split_exact"}


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())


def test_the_library_does_not_need_the_training_data_package():
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['voxloom.llm'] = None; import __spark_entry__ as e;"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()); assert e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
