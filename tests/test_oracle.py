"""Every registered query of the library against its SQL, over the smallest tables."""

import os

import pytest

from docmill.plans import ORACLE_SQL, QUERIES
from oracle import differences

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables are absent")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLE_SQL:
        assert differences(spark, SF, QUERIES[name], ORACLE_SQL[name]) == ""
    else:
        assert QUERIES[name](spark, SF).count() > 0
