"""Every core query against its SQL; those without one run."""

import pytest

from khabarloom.plans.queries import oracle_sql, queries

from .conftest import SF
from .oracle import connect, same


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, con, name):
    same(spark, con, SF, queries()[name], oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() >= 0


@pytest.mark.parametrize("name", ["t1_stream_insert", "t3_state_stream"])
def test_streams_take_several_batches(spark, tmp_path, monkeypatch, name):
    from khabarloom.plans import queries as plans

    monkeypatch.setattr(plans, "shared_dir", lambda _: str(tmp_path))
    assert queries()[name](spark, SF).count() > 0
    filled = [b for b in tmp_path.glob("*/out/batch=*") if spark.read.parquet(str(b)).count() > 0]
    assert len(filled) == 4


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
