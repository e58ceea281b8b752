"""Every SQL-expressible query against DuckDB on the smallest folder.

``tests/check_all.py`` does the same for any other folder.
"""

import pytest
from compare import duck, mismatch

import __spark_entry__ as e

SF_DIR = "/root/testdata/sf0.001"
# The smallest folder has no machine of one model, hence no column for it.
LARGER = {"m6_one_hot": "/root/testdata/sf0.01"}
ORACLE = e.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    folder = LARGER.get(name, SF_DIR)
    assert mismatch(e.queries()[name](spark, folder), duck(folder), ORACLE[name]) is None


def test_entry(spark):
    df = e.entry(spark)
    assert df.columns == ["is_pre_failure", "avg_volt_3h", "avg_rotate_3h", "avg_pressure_3h", "avg_vibration_3h"]
    assert df.count() == 2
