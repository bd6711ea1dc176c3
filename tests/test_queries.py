"""Each registered query of the feed library against DuckDB."""

import pytest
from compare import differences, duck
from digestloom.plans import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, name):
    assert not differences(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLE[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE)
