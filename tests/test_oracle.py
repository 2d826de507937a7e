"""Every query with SQL against DuckDB on the small tables; the others must run."""

import pytest
from conftest import DATA
from oracle import same

from wavetide.plans import event_pairs, problems

QUERIES = {**problems.QUERIES, **event_pairs.QUERIES}
SQL = {**problems.SQL, **event_pairs.SQL}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, f"{DATA}/sf0.001")
    if name in SQL:
        _, ours, theirs = same(df, SQL[name], f"{DATA}/sf0.001")
        assert (ours, theirs) == ([], [])
    else:
        df.collect()


def test_entry(spark):
    import __spark_entry__ as e

    assert len(e.entry(spark).schema) == 3
    assert set(e.oracle_sql()) <= set(e.queries())
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6, 7)} <= set(e.queries())
