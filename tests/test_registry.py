"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_point
from tallyfield.registry.oracles import ORACLES as SQL
from tallyfield.registry.oracles import rank_clean, rank_files
from tallyfield.registry.queries import QUERIES, _rank_folder
from tallyfield.sources import rankfiles


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, sf_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_nested_loop_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoop", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("dialects", [False, True])
def test_rank_files_of_many_parts(spark, duck, sf_dir, dialects):
    def read(spark, sf):
        return rankfiles.read_rankings(spark, _rank_folder(spark, sf, 30, dialects), "ranks_*", sniff=dialects)

    assert compare(spark, duck, sf_dir, read, rank_clean(rank_files(30))) is None
