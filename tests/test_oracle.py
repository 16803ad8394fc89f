"""Every registered job that has SQL, compared with it on the smallest tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
JOBS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def problems(spark):
    """All comparisons, a few at a time: the jobs are small and mostly wait."""
    con = connect(SF)

    def run(name):
        try:
            return compare(spark, con.cursor(), JOBS[name], SQL[name], SF)[0]
        except Exception as error:
            return f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(4) as pool:
        return dict(zip(SQL, pool.map(run, SQL)))


def test_every_sql_belongs_to_a_job():
    assert set(SQL) <= set(JOBS)


@pytest.mark.parametrize("name", list(SQL))
def test_job_agrees_with_sql(problems, name):
    assert problems[name] is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
