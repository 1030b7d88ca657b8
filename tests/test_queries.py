"""Every query outside the training-data subpackage equals its DuckDB SQL."""

import pytest
from comparing import TESTDATA, compared

from concord.plans import catalogue

QUERIES, ORACLE = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, name):
    ours, theirs, found, wanted = compared(spark, QUERIES[name], ORACLE[name], TESTDATA / "sf0.001")
    assert ours == theirs
    assert found == wanted


def test_entry_has_the_contract_functions(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).collect()) == 1
